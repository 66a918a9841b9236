"""The corpus pipeline: stages that filter ``documents`` one after the other, then pack what is left.

Each stage takes (spark, docs, sf_dir) and calls one operator of ``clipstar.llm``; its result is written as Parquet to
the shared folder and read back as the next stage's ``docs``.  All stages but the last return the columns of their
``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clipstar.llm import decontaminate, exact_dedup, language, packing, simhash
from clipstar.llm.common import Saved, prepare, read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no language: null, empty and letterless texts, and those that no mixture of the learnt
    languages explains better than chance."""
    return language.drop_unknown(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontaminate", benchmark_leaks),
    ("packing", packed),
]

#: SQL cannot express these stages (mixture inference, naming, tries, tokenizers); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last stage."""
    prepare(spark)
    saved = Saved(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
