"""Gold dimensions: latest media snapshot, latest visitor attributes."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstar.functions.channel import DEFAULT_CHANNEL, attach_channel

# "Latest" picks as the greatest struct(order keys..., kept columns...): a
# struct compares field by field with NULL lowest, so this is
# ORDER BY updated_at DESC NULLS LAST, load_date DESC, ... with the kept
# columns finishing the order (rows equal on all of them give the same answer
# whichever wins).  max() of such structs is associative, so a stored pick
# merged with new rows equals the pick over everything: the dimensions are
# maintained incrementally from this state.  Silver has one snapshot per media
# and day, so load_date decides play_rate alone.
#
# duration_seconds comes third so that media_measures, which keeps only
# (updated_at, load_date, duration_seconds), lands on the dimension's duration.
DIMENSION_PICK = ["updated_at", "load_date", "duration_seconds", "title", "url", "created_at"]
PLAY_RATE_PICK = ["load_date", "play_rate"]
VISITOR_PICK = ["received_at", "event_key", "ip", "country"]


def _struct(cols: list[str]):
    return F.struct(*[F.col(c) for c in cols])


def media_state(silver_media: DataFrame) -> DataFrame:
    """Per media: the winning snapshot for the dimension (``dim_pick``) and
    for play_rate (``rate_pick``), in one aggregation (one shuffle, partial
    aggregation before it).  The two orders differ on purpose: the dimension
    follows updated_at then load_date, play_rate follows load_date only."""
    return silver_media.groupBy("media_id").agg(
        F.max(_struct(DIMENSION_PICK)).alias("dim_pick"),
        F.max(_struct(PLAY_RATE_PICK)).alias("rate_pick"))


def combine_media_state(rows: DataFrame) -> DataFrame:
    """One row per media of picks (media_id, dim_pick, rate_pick, version,
    anew): max of maxes (exact).  A row that was picked anew replaces those of
    earlier versions; so does the combined row."""
    anew = F.max(F.when(F.col("anew"), F.col("version")))
    counted = rows.withColumn("_anew", anew.over(Window.partitionBy("media_id"))) \
        .where(F.col("_anew").isNull() | (F.col("version") >= F.col("_anew")))
    return counted.groupBy("media_id").agg(
        F.max("dim_pick").alias("dim_pick"), F.max("rate_pick").alias("rate_pick"),
        F.coalesce(F.max("_anew"), F.max("version")).alias("version"), F.bool_or("anew").alias("anew"))


def profile_from_state(state: DataFrame) -> DataFrame:
    return state.select(
        "media_id", "dim_pick.title", "dim_pick.url", "dim_pick.created_at",
        "dim_pick.duration_seconds", F.col("rate_pick.play_rate").alias("play_rate"))


def media_profile(silver_media: DataFrame) -> DataFrame:
    """One row per media_id: title, url, created_at, duration_seconds of the
    latest snapshot by ``updated_at DESC NULLS LAST, load_date DESC``, and
    play_rate of the latest snapshot by ``load_date DESC``."""
    return profile_from_state(media_state(silver_media))


def media_measures(silver_media: DataFrame) -> DataFrame:
    """What the fact needs per media -- duration (of the dimension's latest
    snapshot) and play_rate -- without carrying titles and urls through the
    shuffle.  Same picks as media_profile."""
    return silver_media.groupBy("media_id").agg(
        F.max(_struct(DIMENSION_PICK[:3])).alias("_dim"),
        F.max(_struct(PLAY_RATE_PICK)).alias("_rate"),
    ).select("media_id", F.col("_dim.duration_seconds").alias("duration_seconds"),
             F.col("_rate.play_rate").alias("play_rate"))


def dim_media(silver_media: DataFrame | None = None,
              channel_mapping: Mapping[str, str] | DataFrame | None = None,
              default_channel: str = DEFAULT_CHANNEL, *, profile: DataFrame | None = None,
              with_duration: bool = False) -> DataFrame:
    """media_id, title, url, channel, created_at (+ duration_seconds on request)."""
    base = profile if profile is not None else media_profile(silver_media)
    cols = ["media_id", "title", "url", "channel", "created_at"]
    if with_duration:
        cols.append("duration_seconds")
    return attach_channel(base, channel_mapping, default_channel).select(*cols)


def latest_play_rate(silver_media: DataFrame | None = None, *,
                     profile: DataFrame | None = None) -> DataFrame:
    base = profile if profile is not None else media_profile(silver_media)
    return base.select("media_id", "play_rate")


def visitor_state(silver_events: DataFrame) -> DataFrame:
    """Per visitor_key: the latest event's (received_at, event_key, ip,
    country).  Anonymous events (NULL visitor_key) form one group; the partial
    aggregate keeps that hot group from landing in one task."""
    return silver_events.groupBy("visitor_key").agg(F.max(_struct(VISITOR_PICK)).alias("pick"))


def combine_visitor_state(rows: DataFrame) -> DataFrame:
    """One row per visitor of stored and new picks (exact: max of maxes)."""
    return rows.groupBy("visitor_key").agg(F.max("pick").alias("pick"))


def dim_visitor_from_state(state: DataFrame) -> DataFrame:
    return state.select(F.col("visitor_key").alias("visitor_id"),
                        F.col("pick.ip").alias("ip_address"), F.col("pick.country").alias("country"))


def dim_visitor(silver_events: DataFrame) -> DataFrame:
    """Latest ip/country per visitor_key; anonymous visitors are one row with
    visitor_id NULL, as the marts expect."""
    return dim_visitor_from_state(visitor_state(silver_events))
