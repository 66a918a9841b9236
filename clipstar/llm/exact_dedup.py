"""Exact duplicates by deterministic block naming.

The normalised text is cut into blocks of ``BLOCK_BYTES`` bytes.  All blocks of all documents are sorted, and a
block's name is its integer rank among the distinct blocks; then the names of adjacent blocks (2i, 2i+1) form a pair,
pairs are sorted and named in the same way, and so on until each document has one name.  Two documents that end at the
same level have the same name exactly if their texts are equal: names are ranks of compared values, never hashes, so
there are no collisions.

Naming is one range-partitioned sort per level on (value, row, position).  The row and position in the sort key split
the blocks of a hot group of copies over many tasks.  Each sorted partition numbers its runs of equal values; one summary
row per partition (first value, last value, number of runs) gives the offsets, and the driver sees nothing else.
Level k has half the rows of level k-1, so all levels together move little more than the blocks once.

Defined cases: a null text is empty, and all empty texts are equal; a null doc_id is a row like any other and sorts
after all others; rows that repeat a doc_id and text are separate rows of one group, of which one is kept; an empty
table gives an empty result; other columns are not read.  Input rows are numbered as they are read, once.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, row_key, text_of, without_rows

BLOCK_BYTES = 256
_WHITE = b" \t\n\x0b\x0c\r"
_EMIT_BYTES = 4 << 20

_BLOCKS = ("rid long, pos int, n int, value binary, doc_id long, row_key long, n_chars int, text_sha256 string")


def _blocks(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("rid", "pos", "n", "value", "doc_id", "row_key", "n_chars", "text_sha256")
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        rows: list[tuple] = []
        held = 0

        def emit() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[] for _ in fields]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(fields))

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for rid, doc_id, key, n_chars, text in zip(batch.column("rid").to_pylist(),
                                                       batch.column("doc_id").to_pylist(),
                                                       batch.column("row_key").to_pylist(),
                                                       batch.column("n_chars").to_pylist(), texts):
                body = text.as_py().translate(None, _WHITE)
                n = max(1, -(-len(body) // size))
                rows.append((rid, 0, n, body[:size], doc_id, key, n_chars, hashlib.sha256(body).hexdigest()))
                rows += [(rid, i, n, body[i * size:(i + 1) * size], None, None, None, None) for i in range(1, n)]
                held += len(body) + 64
                if held >= _EMIT_BYTES:
                    yield emit()
                    rows, held = [], 0
        if rows:
            yield emit()
    return cut


def _number_runs(values: list[str]):
    """Number the runs of equal values in each sorted partition from 0; the last row is the partition's summary."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        run = -1
        pid = 0
        seen = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if seen is None:
                pid = batch.column("pid")[0].as_py()
                first = [batch.column(v)[0].as_py() for v in values]
            cols = [batch.column(v) for v in values]
            new = np.zeros(batch.num_rows, bool)
            for c in cols:
                # Nulls equal nulls: the second name of a pair is null at an odd end.
                eq = pc.fill_null(pc.equal(c[1:], c[:-1]), False)
                both = pc.and_(pc.is_null(c[1:]), pc.is_null(c[:-1]))
                new[1:] |= ~np.asarray(pc.or_(eq, both).to_numpy(zero_copy_only=False), bool)
            new[0] = [c[0].as_py() for c in cols] != last
            local = run + np.cumsum(new)
            run = int(local[-1])
            last = [c[batch.num_rows - 1].as_py() for c in cols]
            keep = [n for n in batch.schema.names if n not in values]
            seen = batch.schema
            out = [batch.column(n) for n in keep] + [pa.array(local, pa.int64())]
            nulls = pa.nulls(batch.num_rows, pa.int64())
            out += [nulls] + [pa.nulls(batch.num_rows, seen.field(v).type) for v in values for _ in (0, 1)]
            yield pa.RecordBatch.from_arrays(out, names=keep + ["local", "runs"] + _edges(values))
        if seen is not None:
            keep = [n for n in seen.names if n not in values]
            cols = [pa.array([pid], seen.field(n).type) if n == "pid" else pa.nulls(1, seen.field(n).type) for n in keep]
            cols += [pa.nulls(1, pa.int64()), pa.array([run + 1], pa.int64())]
            for i, v in enumerate(values):
                cols += [pa.array([first[i]], seen.field(v).type), pa.array([last[i]], seen.field(v).type)]
            yield pa.RecordBatch.from_arrays(cols, names=keep + ["local", "runs"] + _edges(values))
    return number


def _edges(values: list[str]) -> list[str]:
    return [f"{edge}_{v}" for v in values for edge in ("first", "last")]


def name_values(rows: DataFrame, values: list[str], order: list[str], saved: Saved, small: bool) -> DataFrame:
    """Replace ``values`` by one column ``name``: the rank of the row's values among all distinct ones."""
    keys = [F.col(c).asc_nulls_first() for c in [*values, *order]]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pid", F.spark_partition_id())
    kinds = dict(rows.dtypes)
    out = [f"{c} {t}" for c, t in ranged.dtypes if c not in values]
    edges = [f"{e}_{v} {kinds[v]}" for v in values for e in ("first", "last")]
    numbered = ranged.mapInArrow(_number_runs(values), ", ".join([*out, "local long, runs long", *edges]))
    numbered = saved.small(numbered) if small else saved.table(numbered)
    # One summary row per partition: its number of runs and its first and last value.
    offsets, start, last = [], 0, None
    for s in sorted(numbered.where("runs is not null").collect(), key=lambda r: r["pid"]):
        if last is not None and last == [s[f"first_{v}"] for v in values]:
            start -= 1
        offsets.append((s["pid"], start))
        start, last = start + s["runs"], [s[f"last_{v}"] for v in values]
    table = rows.sparkSession.createDataFrame(offsets, "pid int, start long")
    return numbered.where("runs is null").join(F.broadcast(table), "pid") \
        .withColumn("name", F.col("start") + F.col("local")) \
        .drop("pid", "start", "local", "runs", *_edges(values))


def duplicate_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, row_key, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Of equal texts, the row with the most code points in the original text stays, then the smallest doc_id.
    """
    spark = docs.sparkSession
    prepare(spark)
    saved = Saved(spark, "blocks")
    numbered = docs.select("doc_id", text_of().alias("text"), row_key().alias("row_key")) \
        .select(F.monotonically_increasing_id().alias("rid"), "doc_id", "row_key",
                F.length("text").alias("n_chars"), "text")
    blocks = numbered.mapInArrow(_blocks(block_bytes), _BLOCKS)
    level = name_values(blocks, ["value"], ["rid", "pos"], saved, False)
    meta = level.where("pos = 0").select("rid", "doc_id", "row_key", "n_chars", "text_sha256", "n",
                                         F.col("name").alias("name0"))
    done, k = None, 0
    level = level.select("rid", "pos", "n", "name")
    longest = level.agg(F.max("n")).first()[0] or 1
    while longest > 1:
        k += 1
        # A pair has two rows at most, so no group grows with the data.
        pairs = level.where("n > 1").groupBy("rid", (F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.first("n").alias("n"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b")) \
            .withColumn("n", ((F.col("n") + 1) / 2).cast("int"))
        level = name_values(pairs, ["a", "b"], ["rid", "pos"], saved, True)
        ended = level.where("n = 1").select("rid", F.lit(k).alias("level"), "name")
        done = ended if done is None else done.unionByName(ended)
        longest = -(-longest // 2)
    rows = meta.withColumn("level", F.lit(0)).withColumn("name", F.col("name0"))
    if done is not None:
        rows = meta.where("n = 1").select("*", F.lit(0).alias("level"), F.col("name0").alias("name")).unionByName(
            meta.where("n > 1").join(done, "rid"))
    rows = saved.small(rows.select("rid", "doc_id", "row_key", "n_chars", "text_sha256", "level", "name"))
    best = F.min(F.struct((-F.col("n_chars")).alias("size"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    groups = saved.small(rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
                         .where("group_size > 1")
                         .select("level", "name", "group_size", F.col("best.doc_id").alias("keep"),
                                 F.col("best.rid").alias("keep_rid")))
    # Both sides are read back from tables, so a hot group's rows are split by the skew join.
    return rows.join(groups, ["level", "name"], "left").select(
        "doc_id", "row_key",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_rid") == F.col("rid"), F.lit(True)).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return keep_one_each(docs, duplicate_groups(docs))


def keep_one_each(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` of which ``decisions(doc_id, row_key, kept)`` keeps a row.

    Rows that repeat both doc_id and text share a key; of a kept key with several rows one stays.
    """
    saved = Saved(docs.sparkSession, "decisions")
    keys = saved.small(decisions.groupBy("doc_id", "row_key").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")))
    kept = without_rows(docs, keys.where("not kept"))
    repeated = keys.where("kept and rows > 1")
    if repeated.isEmpty():
        return kept
    # Rare: only the rows of repeated keys pass the aggregate.
    once = without_rows(kept, repeated)
    r = repeated.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"))
    same = docs.join(r, docs["doc_id"].eqNullSafe(r["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(r["_key"]),
                     "left_semi")
    one = same.groupBy("doc_id", "text").agg(*[F.first(c).alias(c) for c in docs.columns
                                               if c not in ("doc_id", "text")])
    return once.unionByName(one.select(docs.columns))
