"""Queries over the Silver/Gold star schema built from the test tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.functions.channel import mapping_from_json_column
from clipstar.operators import dims, marts
from clipstar.plans.registry import register
from clipstar.plans.registry import star_sql as _star_sql
from clipstar.plans.star import Star

# --- Silver ---------------------------------------------------------------

@register("silver_media_stats", _star_sql("SELECT * FROM silver_media"))
def q_silver_media_stats(s: Star) -> DataFrame:
    """Flatten + type + non-null media_id."""
    return s.silver_media.drop("landing")


@register("silver_visitor_events", _star_sql("SELECT * FROM silver_events"))
def q_silver_visitor_events(s: Star) -> DataFrame:
    """Non-null event_key, deterministic dedup, typed timestamp and written date."""
    return s.silver_events


# --- Gold dimensions --------------------------------------------------------

@register("dim_media", _star_sql(
    "SELECT media_id, title, url, 'Unknown' AS channel, created_at FROM media_latest"))
def q_dim_media(s: Star) -> DataFrame:
    """Latest snapshot per media; no channel mapping configured."""
    return dims.dim_media(profile=s.profile)


@register("dim_media_channel", _star_sql(
    "SELECT media_id, title, url, channel, created_at FROM dim_media"))
def q_dim_media_channel(s: Star) -> DataFrame:
    """Channel from a mapping table, default for unmapped media."""
    return s.dim_media


@register("dim_media_default_channel", _star_sql(
    "SELECT media_id, 'Direct' AS channel FROM media_latest"))
def q_dim_media_default_channel(s: Star) -> DataFrame:
    """Empty mapping with a caller-chosen default channel."""
    return dims.dim_media(profile=s.profile, channel_mapping={}, default_channel="Direct") \
        .select("media_id", "channel")


#: A channel mapping as configured: a few media by id.
CONFIGURED_CHANNELS = {"0": "YouTube", "1": "Facebook", "4": "YouTube", "5": "Newsletter"}


@register("channel_map_literal", _star_sql(
    "SELECT media_id, CASE media_id WHEN '0' THEN 'YouTube' WHEN '1' THEN 'Facebook' WHEN '4' THEN 'YouTube' "
    "WHEN '5' THEN 'Newsletter' ELSE 'Unknown' END AS channel FROM media_latest"))
def q_channel_map_literal(s: Star) -> DataFrame:
    """Channel from a mapping given in the configuration."""
    return dims.dim_media(profile=s.profile, channel_mapping=CONFIGURED_CHANNELS).select("media_id", "channel")


@register("channel_map_json", _star_sql("SELECT media_id, channel FROM dim_media"))
def q_channel_map_json(s: Star) -> DataFrame:
    """Channel from a mapping given as JSON texts, one object to a line."""
    texts = s.channel_mapping.select(F.to_json(F.create_map("media_id", "channel")).alias("text"))
    mapping = mapping_from_json_column(texts, "text")
    return dims.dim_media(profile=s.profile, channel_mapping=mapping).select("media_id", "channel")


@register("latest_play_rate", _star_sql("SELECT * FROM play_rate_latest"))
def q_latest_play_rate(s: Star) -> DataFrame:
    """play_rate of the latest snapshot by load_date."""
    return dims.latest_play_rate(profile=s.measures)


@register("dim_visitor", _star_sql("SELECT * FROM dim_visitor"))
def q_dim_visitor(s: Star) -> DataFrame:
    """Latest ip/country per visitor, anonymous visitors as one NULL row."""
    return s.dim_visitor


# --- Gold fact ---------------------------------------------------------------

@register("fact_daily_agg", _star_sql(
    "SELECT media_id, visitor_id, date, play_count, watched_percent, "
    "ROUND(percent_viewed_sum, 6) AS percent_viewed_sum FROM daily"))
def q_fact_daily_agg(s: Star) -> DataFrame:
    """Grain aggregate: count, max, sum per media/visitor/day."""
    return s.fact_base.withColumn("percent_viewed_sum", F.round("percent_viewed_sum", 6))


@register("fact_watch_time", _star_sql(
    "SELECT media_id, visitor_id, date, ROUND(total_watch_time, 4) AS total_watch_time FROM fact"))
def q_fact_watch_time(s: Star) -> DataFrame:
    """Watch time = sum(percent_viewed) * coalesce(duration, 0) via the media join."""
    return s.fact.select("media_id", "visitor_id", "date",
                         F.round("total_watch_time", 4).alias("total_watch_time"))


_FACT_SQL = _star_sql(
    "SELECT media_id, visitor_id, date, play_count, play_rate, "
    "ROUND(total_watch_time, 4) AS total_watch_time, watched_percent FROM fact")


@register("fact_media_engagement", _FACT_SQL)
def q_fact_media_engagement(s: Star) -> DataFrame:
    """The flagship: the full daily engagement fact."""
    return s.fact.withColumn("total_watch_time", F.round("total_watch_time", 4))


# --- Marts -----------------------------------------------------------------

@register("kpi_summary", _star_sql(
    "SELECT CAST(SUM(play_count) AS BIGINT) AS total_plays, "
    "ROUND(SUM(total_watch_time) / 3600.0, 2) AS total_watch_hours, "
    "COUNT(DISTINCT visitor_id) AS unique_visitors, "
    "ROUND(AVG(watched_percent) * 100, 2) AS avg_watched_percent FROM fact"))
def q_kpi_summary(s: Star) -> DataFrame:
    """Global KPIs (A3, P10)."""
    return marts.kpi_summary(s.fact)


@register("kpi_summary_filled", _star_sql(
    "SELECT COALESCE(CAST(SUM(play_count) AS BIGINT), 0) AS total_plays, "
    "COALESCE(ROUND(SUM(total_watch_time) / 3600.0, 2), 0) AS total_watch_hours, "
    "COUNT(DISTINCT visitor_id) AS unique_visitors, "
    "COALESCE(ROUND(AVG(watched_percent) * 100, 2), 0) AS avg_watched_percent FROM fact"))
def q_kpi_summary_filled(s: Star) -> DataFrame:
    """KPIs with NULL shown as 0."""
    return marts.kpi_summary_filled(s.fact)


@register("engagement_by_media", _star_sql(
    "SELECT d.title, d.channel, CAST(SUM(f.play_count) AS BIGINT) AS plays, "
    "ROUND(SUM(f.total_watch_time) / 3600.0, 2) AS watch_hours "
    "FROM fact f JOIN dim_media d ON f.media_id = d.media_id "
    "GROUP BY d.title, d.channel ORDER BY plays DESC"))
def q_engagement_by_media(s: Star) -> DataFrame:
    """Plays and hours by (title, channel)."""
    return marts.engagement_by_media(s.fact_for_marts, s.dim_media)


@register("media_channel_rollup", _star_sql(
    "SELECT d.title, d.channel, COUNT(*) AS engagement_rows, "
    "CAST(SUM(f.play_count) AS BIGINT) AS total_plays, "
    "ROUND(SUM(f.total_watch_time) / 3600.0, 2) AS total_watch_hours "
    "FROM fact f JOIN dim_media d ON f.media_id = d.media_id "
    "GROUP BY d.title, d.channel ORDER BY total_plays DESC"))
def q_media_channel_rollup(s: Star) -> DataFrame:
    """The catalog's example mart: rows, plays and hours by title/channel."""
    return marts.media_channel_rollup(s.fact_for_marts, s.dim_media)


@register("daily_plays_trend", _star_sql(
    "SELECT date, CAST(SUM(play_count) AS BIGINT) AS plays FROM fact GROUP BY date ORDER BY date"))
def q_daily_plays_trend(s: Star) -> DataFrame:
    """Plays per day (A5, O2)."""
    return marts.daily_plays_trend(s.fact)


@register("visitor_geography", _star_sql(
    "SELECT country, COUNT(*) AS visitors FROM dim_visitor WHERE country IS NOT NULL "
    "GROUP BY country ORDER BY visitors DESC"))
def q_visitor_geography(s: Star) -> DataFrame:
    """Visitors per country."""
    return marts.visitor_geography(s.dim_visitor)


@register("top_countries", _star_sql(
    "SELECT country, COUNT(*) AS visitors FROM dim_visitor WHERE country IS NOT NULL "
    "GROUP BY country ORDER BY visitors DESC, country ASC LIMIT 20"))
def q_top_countries(s: Star) -> DataFrame:
    """Top 20 countries by visitors (O3)."""
    return marts.top_countries(s.dim_visitor, 20)


@register("preview_fact", _star_sql(
    "SELECT media_id, visitor_id, date, play_count, play_rate, "
    "ROUND(total_watch_time, 4) AS total_watch_time, watched_percent FROM fact "
    "ORDER BY date ASC NULLS FIRST, media_id ASC NULLS FIRST, visitor_id ASC NULLS FIRST LIMIT 10"))
def q_preview_fact(s: Star) -> DataFrame:
    """``SELECT * ... LIMIT 10`` on the fact, ordered by its key."""
    return marts.preview(s.fact, ["date", "media_id", "visitor_id"], 10) \
        .withColumn("total_watch_time", F.round("total_watch_time", 4))


@register("preview_dim_media", _star_sql(
    "SELECT media_id, title, url, channel, created_at FROM dim_media "
    "ORDER BY media_id ASC NULLS FIRST LIMIT 10"))
def q_preview_dim_media(s: Star) -> DataFrame:
    """``SELECT * FROM dim_media LIMIT 10``, ordered by its key."""
    return marts.preview(s.dim_media, ["media_id"], 10)


@register("preview_dim_visitor", _star_sql(
    "SELECT * FROM dim_visitor ORDER BY visitor_id ASC NULLS FIRST LIMIT 10"))
def q_preview_dim_visitor(s: Star) -> DataFrame:
    """``SELECT * FROM dim_visitor LIMIT 10``, ordered by its key; the
    anonymous visitor (NULL id) comes first (O4)."""
    return marts.preview(s.dim_visitor, ["visitor_id"], 10)
