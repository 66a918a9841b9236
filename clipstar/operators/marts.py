"""Reporting marts over the star schema (KPIs, by media/channel, daily
trend, geography, previews).  Every ORDER BY spells out its null order and
ends on a unique key, so each mart has exactly one answer."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _hours(total_seconds: str) -> F.Column:
    return F.round(F.col(total_seconds) / 3600.0, 2)


def kpi_summary(fact: DataFrame) -> DataFrame:
    """Total plays, watch hours, distinct visitors, and the unweighted mean
    furthest-point-watched (per fact row, in percent)."""
    return fact.agg(
        F.sum("play_count").alias("total_plays"),
        F.round(F.sum("total_watch_time") / 3600.0, 2).alias("total_watch_hours"),
        F.count_distinct("visitor_id").alias("unique_visitors"),
        F.round(F.avg("watched_percent") * 100, 2).alias("avg_watched_percent"),
    )


def kpi_summary_filled(fact: DataFrame) -> DataFrame:
    """The KPI row with NULLs shown as 0 (an empty fact gives one zero row)."""
    k = kpi_summary(fact)
    return k.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in k.columns])


def _per_media(fact: DataFrame) -> DataFrame:
    # Aggregate the fact to one row per media before joining the dimension:
    # the join then moves one row per media instead of the whole fact.
    return fact.groupBy("media_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("play_count").alias("_plays"),
        F.sum("total_watch_time").alias("_watch"),
    )


def _by_title_channel(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Inner join on media_id (drops facts of unknown or NULL media), grouped
    by title and channel: same-titled media on one channel merge."""
    per_media = _per_media(fact).join(dim_media.select("media_id", "title", "channel"), "media_id")
    return per_media.groupBy("title", "channel").agg(
        F.sum("_rows").alias("_rows"), F.sum("_plays").alias("_plays"),
        F.sum("_watch").alias("_watch"))


def engagement_by_media(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    g = _by_title_channel(fact, dim_media)
    return g.select("title", "channel", F.col("_plays").alias("plays"),
                    _hours("_watch").alias("watch_hours")) \
        .orderBy(F.desc_nulls_last("plays"), F.asc_nulls_last("title"), F.asc_nulls_last("channel"))


def media_channel_rollup(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    g = _by_title_channel(fact, dim_media)
    return g.select("title", "channel", F.col("_rows").alias("engagement_rows"),
                    F.col("_plays").alias("total_plays"),
                    _hours("_watch").alias("total_watch_hours")) \
        .orderBy(F.desc_nulls_last("total_plays"), F.asc_nulls_last("title"),
                 F.asc_nulls_last("channel"))


# --- marts from partial sums ------------------------------------------------
#
# Sums by day and media merge by adding, the set of visitors by union, so the marts after a batch need the sums of the
# days it touched and its visitors, not the facts of other days.

def day_sums(fact: DataFrame) -> DataFrame:
    return fact.groupBy("media_id", "date").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("play_count").alias("plays"),
        F.sum("total_watch_time").alias("watch_time"), F.sum("watched_percent").alias("watched_sum"),
        F.count("watched_percent").alias("watched_count"))


def kpi_from_sums(sums: DataFrame, visitors: DataFrame) -> DataFrame:
    """As kpi_summary; ``visitors`` has each visitor of the facts once."""
    total = sums.agg(F.sum("plays").alias("total_plays"), F.round(F.sum("watch_time") / 3600.0, 2).alias("total_watch_hours"),
                     F.round(F.sum("watched_sum") / F.sum("watched_count") * 100, 2).alias("avg_watched_percent"))
    seen = visitors.agg(F.count("visitor_id").alias("unique_visitors"))
    return total.withColumn("_one", F.lit(1)).join(seen.withColumn("_one", F.lit(1)), "_one") \
        .select("total_plays", "total_watch_hours", "unique_visitors", "avg_watched_percent")


def engagement_from_sums(sums: DataFrame, dim_media: DataFrame) -> DataFrame:
    """As engagement_by_media."""
    per_media = sums.groupBy("media_id").agg(F.sum("plays").alias("plays"), F.sum("watch_time").alias("watch"))
    by_title = per_media.join(dim_media.select("media_id", "title", "channel"), "media_id").groupBy("title", "channel") \
        .agg(F.sum("plays").alias("plays"), F.sum("watch").alias("watch"))
    return by_title.select("title", "channel", "plays", _hours("watch").alias("watch_hours")) \
        .orderBy(F.desc_nulls_last("plays"), F.asc_nulls_last("title"), F.asc_nulls_last("channel"))


def trend_from_sums(sums: DataFrame) -> DataFrame:
    """As daily_plays_trend."""
    return sums.groupBy("date").agg(F.sum("plays").alias("plays")).orderBy(F.asc_nulls_last("date"))


def daily_plays_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date").agg(F.sum("play_count").alias("plays")) \
        .orderBy(F.asc_nulls_last("date"))


def visitor_geography(dim_visitor: DataFrame) -> DataFrame:
    return dim_visitor.where(F.col("country").isNotNull()).groupBy("country") \
        .agg(F.count(F.lit(1)).alias("visitors")) \
        .orderBy(F.desc_nulls_last("visitors"), F.asc_nulls_last("country"))


def top_countries(dim_visitor: DataFrame, n: int = 20) -> DataFrame:
    """The dashboard's top-n countries; plans as TakeOrderedAndProject."""
    return visitor_geography(dim_visitor).limit(n)


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """``SELECT * ... LIMIT n`` with an order, so the preview is reproducible."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(n)
