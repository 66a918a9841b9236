"""Resolve a media's distribution channel (YouTube, Facebook, ...).

The media API has no channel field, so it comes from a mapping supplied by
the caller: a dict from configuration, JSON texts, or a table.  All become a
mapping table that is left-joined; its size in bytes decides how.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHANNEL = "Unknown"


def mapping_from_json(spark, text: str) -> DataFrame:
    """Parse ``{"media_id": "channel", ...}`` JSON text into a mapping DataFrame
    with columns (media_id, channel); parsing happens in Spark, not the driver."""
    return mapping_from_json_column(spark.createDataFrame([(text,)], "mapping_json string"),
                                    "mapping_json")


def mapping_from_json_column(df: DataFrame, column: str) -> DataFrame:
    """Explode a column of JSON object texts into (media_id, channel) rows."""
    parsed = F.from_json(F.col(column), "map<string,string>")
    return df.select(F.explode(parsed).alias("media_id", "channel"))


def attach_channel(df: DataFrame, mapping: Mapping[str, str] | DataFrame | None,
                   default: str = DEFAULT_CHANNEL, key: str = "media_id") -> DataFrame:
    """Add a ``channel`` column: the mapped value, else ``default``."""
    if mapping is None or (isinstance(mapping, Mapping) and not mapping):
        return df.withColumn("channel", F.lit(default))
    if isinstance(mapping, Mapping):
        mapping = df.sparkSession.createDataFrame(sorted(mapping.items()), "media_id string, channel string")
    # One channel per media: a duplicated mapping key must not fan out rows.
    table = mapping.groupBy(F.col("media_id").alias("_map_key")).agg(
        F.min("channel").alias("_map_channel"))
    joined = df.join(table, F.col(key) == F.col("_map_key"), "left")
    return joined.withColumn("channel", F.coalesce(F.col("_map_channel"), F.lit(default))) \
        .drop("_map_key", "_map_channel")
