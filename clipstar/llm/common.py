"""Helpers shared by the operators: tables cut in the shared folder, row keys, and the worker's import path."""
from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstar.session import scratch_path, shared_dir

_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Register the shared folder, let Python workers import the package, and keep workers small: an Arrow batch is
    bounded by bytes, so that a batch of very long texts stays small, and freed buffers go back to the system."""
    shared_dir(spark)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = ":".join([_ROOT, *paths])
    env.update({"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_ARENA_MAX": "2"})
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Saved:
    """Tables written to the shared folder of one operator run: each cuts lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, f"llm-{name}"), 0

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def small(self, df: DataFrame) -> DataFrame:
        """A table of a few bytes per document or group: its tasks take several shuffle partitions, one after the
        other, so that it doesn't become as many tiny files."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.table(df.coalesce(max(8, partitions // 8)))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def text_of(column: str = "text") -> Column:
    """The text, null counted as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key() -> Column:
    """With doc_id, identifies a document row; rows that share both are repeats of one row."""
    return F.xxhash64(F.col("text"))


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows whose (doc_id, row key) is in ``dropped(doc_id, row_key)``; all columns as they were."""
    d = dropped.select(F.col("doc_id").alias("_drop_id"), F.col("row_key").alias("_drop_key"))
    return docs.join(d, docs["doc_id"].eqNullSafe(d["_drop_id"])
                     & F.xxhash64(docs["text"]).eqNullSafe(d["_drop_key"]), "left_anti")
