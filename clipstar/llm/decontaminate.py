"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

An item is found in a document that contains ``CONTAINMENT`` (0.8) or more of the item's distinct ``SHINGLE_WORDS``-word
(5) shingles.  Items are short and documents long, so a sketch of the whole document would miss them; the search is
asymmetric: an item is held by the smallest MinHash values of its shingles (bottom-k sketch of one hash function) and
a document is probed with all of its shingles.

Items are partitioned by size, doubling from class to class.  A document that contains t of an item's n shingles lacks
n - t of them at most, so it has one of the n - ceil(0.8 n) + 1 smallest.  Each class keeps as many as its largest
size needs; a class also has the fewest shingles that a document needs to hold any of its items, and shorter documents
are not probed for it.  So the sketch loses no item, at about a fifth of the items' shingles.

Found pairs are verified by the shingles themselves, not their hashes, over the documents that the search found.

An item of fewer than five words is its own one shingle.  Documents are probed with windows of each such length that
occurs among the items, so it is found inside any document that has its words in a row.

The tables of sketches and shingles are joined as the planner and adaptive execution see fit from their sizes.  Every
document's whole text is read.

Words are runs of letters and digits in lower case.  Defined cases: a null text or one without words contains no item,
and such an item is found in no document; a document of fewer than five words has its whole word sequence as its
five-word shingle; repeated items and documents give one pair for each pair of ids; null ids are ids like others; an
empty table gives no pairs; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, row_key, text_of, without_rows

SHINGLE_WORDS = 5
CONTAINMENT = 0.8


def with_words(rows: DataFrame, column: str = "text") -> DataFrame:
    """Add ``words``; the generator keeps the split out of the lambdas that index it, which would repeat it."""
    words = F.filter(F.split(F.lower(text_of(column)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return rows.withColumn("words", F.explode(F.array(words))).where(F.size("words") > 0)


def _positions(k: int) -> Column:
    """Start of each shingle from 0; a shorter sequence has one."""
    return F.sequence(F.lit(0), F.greatest(F.size("words") - k, F.lit(0)))


def shingle_texts(k: int) -> Column:
    return F.array_distinct(F.transform(_positions(k), lambda i: F.concat_ws(" ", F.slice("words", i + 1, k))))


def shingle_hashes(k: int) -> Column:
    """64-bit hashes in the order of the text; words past the end count as null, which the hash skips."""
    return F.transform(_positions(k), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(k)]))


def item_sketches(items: DataFrame, k: int, containment: float) -> DataFrame:
    """(hash, item_id, item_key, least): the smallest hashes of each item, as many as its size class needs."""
    sized = with_words(items).select("item_id", "item_key", F.array_sort(F.array_distinct(shingle_hashes(k))).alias("h")) \
        .withColumn("class", F.length(F.bin(F.size("h"))) - 1)
    lowest, highest = F.pow(F.lit(2), F.col("class")), F.pow(F.lit(2), F.col("class") + 1) - 1
    needed = (highest - F.ceil(highest * containment) + 1).cast("int")
    return sized.select(F.explode(F.slice("h", F.lit(1), needed)).alias("hash"), "item_id", "item_key",
                        F.ceil(lowest * containment).cast("int").alias("least"))


def short_lengths(items: DataFrame, k: int) -> list[int]:
    """Word counts below ``k`` that items have; k - 1 numbers at most."""
    return sorted(r[0] for r in with_words(items).select(F.size("words").alias("n")).where(F.col("n") < k)
                  .distinct().collect())


def find_items(docs: DataFrame, items: DataFrame, k: int = SHINGLE_WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """One row per (document, item) found: doc_id, row_key, item_id, item_shingles, shared, containment.

    ``docs(doc_id, text)``, ``items(item_id, text)``.
    """
    spark = docs.sparkSession
    prepare(spark)
    saved = Saved(spark, "decontaminate")
    # An item is its id and text; rows that repeat both are one.
    items = items.select("item_id", row_key().alias("item_key"), "text").dropDuplicates(["item_id", "item_key"])
    sketches = saved.small(item_sketches(items, k, containment))
    sizes = [k, *short_lengths(items, k)]
    probes = with_words(docs.select("doc_id", row_key().alias("row_key"), text_of().alias("text"))) \
        .select("doc_id", "row_key", F.greatest(F.size("words") - k + 1, F.lit(1)).alias("n"),
                F.explode(F.concat(*[shingle_hashes(n) for n in sizes])).alias("hash"))
    hits = probes.join(sketches, "hash") \
        .where(F.col("n") >= F.col("least"))
    found = saved.small(hits.select("doc_id", "row_key", "item_id", "item_key").distinct())

    parts = saved.small(with_words(items).select("item_id", "item_key", shingle_texts(k).alias("s"))
                        .select("item_id", "item_key", F.size("s").alias("item_shingles"),
                                F.explode("s").alias("shingle")))
    # The texts of found documents only; repeats of a row are one.
    keys = found.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")).distinct()
    held = docs.select("doc_id", row_key().alias("row_key"), "text")
    held = held.join(keys, held["doc_id"].eqNullSafe(keys["_id"]) & (held["row_key"] == keys["_key"]), "left_semi")
    shingles = with_words(held).select("doc_id", "row_key", F.explode(F.concat(*[shingle_texts(n) for n in sizes])).alias("shingle"))
    shared = shingles.join(parts, "shingle") \
        .groupBy("doc_id", "row_key", "item_id", "item_key", "item_shingles") \
        .agg(F.count_distinct("shingle").alias("shared"))
    f = found.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "row_key", "item_id", "item_key")])
    same = [shared[c].eqNullSafe(f[f"_{c}"]) for c in ("doc_id", "row_key", "item_id", "item_key")]
    verified = shared.join(f, same[0] & same[1] & same[2] & same[3], "left_semi") \
        .where(F.col("shared") >= F.col("item_shingles") * containment)
    return verified.groupBy("doc_id", "row_key", "item_id").agg(
        F.max(F.struct((F.col("shared") / F.col("item_shingles")).alias("containment"), "item_shingles", "shared"))
        .alias("best")).select(
        "doc_id", "row_key", "item_id", F.col("best.item_shingles").cast("long").alias("item_shingles"),
        F.col("best.shared").alias("shared"), F.col("best.containment").alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    saved = Saved(docs.sparkSession, "contaminated")
    return without_rows(docs, saved.small(find_items(docs, items).select("doc_id", "row_key").distinct()))
