"""Plain table reads and writes, and the ingestion checkpoint."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipstar.schemas import CHECKPOINT_DDL
from clipstar.sources.commits import Versions, path_exists


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a whole table; partitions that vanished disappear."""
    writer = df.write.format(fmt).mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """A table by its declared schema; one that was never written, or was written without rows, is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.format(fmt).schema(ddl).load(path)


# --- checkpoint -----------------------------------------------------------
#
# One row per media: media_id, last_event_received_at (string, compared as
# text, as the API writes it), last_ingested_at.

def empty_checkpoint(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CHECKPOINT_DDL)


def load_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed checkpoint; an empty one when none was ever saved."""
    return Versions(spark, path, CHECKPOINT_DDL).read()


def save_checkpoint(spark: SparkSession, checkpoint: DataFrame, path: str, after: int | None = None) -> int:
    """Save the checkpoint as the next version and return that; with ``after``, only if that is still the newest
    version (else ``Conflict``)."""
    rows = checkpoint.select("media_id", "last_event_received_at", "last_ingested_at")
    return Versions(spark, path, CHECKPOINT_DDL).write(rows, after)
