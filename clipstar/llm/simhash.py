"""SimHash near duplicates by a binary trie self-join.

A document's fingerprint has 64 bits: bit i is set if over half of its shingles' XXH64 values have it.  Fingerprints
link at ``MAX_BITS`` (4) or fewer differing bits; documents are near duplicates if links connect them.

The self-join walks pairs of nodes of a binary trie together, from the top bit down: a pair of equal bits keeps its
count of differing bits, a pair of unequal bits adds one, and a pair over its error budget is dropped with everything
below.  Two numbers with at most 4 differing bits have at most 2 in one half, and that half, cut in three segments,
has a segment without any.  So there are six bit orders (segment, rest of its half, other half), each with budget 0 in
the segment, 2 to the end of the half and 4 to the end, and together they miss no link.  The segment of budget 0 is
the distribution key; Spark groups the fingerprints of one order and segment value into a unit, and the
tries of many units are walked at once with array operations.

Distinct fingerprints only take part, so exact copies cost one row.  From a dense cluster a unit returns links that
connect it, one per member, not all pairs; a node pair whose fingerprints are all connected already is not walked
further.  A unit of over ``UNIT_ROWS`` fingerprints is split into blocks which meet in pairs, so a task's memory is
bounded and no link is lost.

Defined cases: a null or wordless text has fingerprint zero and links like any other; a null doc_id is never a
component's id unless all its documents have none; rows that repeat doc_id and text are of one component; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, row_key, text_of
from clipstar.llm.components import connected_components
from clipstar.llm.exact_dedup import keep_one_each

SHINGLE_WORDS = 4
MAX_BITS = 4
UNIT_ROWS = 1 << 20
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle_words: int) -> int:
    """Of a UTF-8 text; words are what the ASCII white space leaves, A-Z in lower case."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxh64_intdigest(b" ".join(words), 42)  # over half of one value: its own bits
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1:].tolist())
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(fps.view(np.int64))],
                names=["doc_id", "row_key", "fp"])
    return run


def _orders() -> list[tuple[list[int], int]]:
    """Bit positions from the first to the last walked, and the length of the segment of budget 0."""
    out = []
    for half in (range(63, 31, -1), range(31, -1, -1)):
        bits, other = list(half), [b for b in range(63, -1, -1) if b not in half]
        for lo, hi in ((0, 11), (11, 22), (22, 32)):
            out.append((bits[lo:hi] + bits[:lo] + bits[hi:] + other, hi - lo))
    return out


def _permute(values: np.ndarray, order: list[int], inverse: bool = False) -> np.ndarray:
    """Move bit order[0] to bit 63, order[1] to bit 62 and so on; runs of neighbouring bits move together."""
    out = np.zeros_like(values)
    i = 0
    while i < 64:
        j = i
        while j + 1 < 64 and order[j + 1] == order[j] - 1:
            j += 1
        width, low_from, low_to = j - i + 1, order[j], 63 - j
        mask = np.uint64((1 << width) - 1)
        if inverse:
            low_from, low_to = low_to, low_from
        out |= ((values >> np.uint64(low_from)) & mask) << np.uint64(low_to)
        i = j + 1
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once per bit order, with the value of the order's segment."""
    orders = _orders()
    for batch in batches:
        fps = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
        for o, (order, width) in enumerate(orders):
            v = _permute(fps, order)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(v), o, np.int32)), pa.array((v >> np.uint64(64 - width)).astype(np.int32)),
                 pa.array(v.view(np.int64))], names=["o", "segment", "v"])


class _Forest:
    """Smallest connected index of each fingerprint of a unit chunk."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def trie_join(v: np.ndarray, unit: np.ndarray, segment_bits: np.ndarray, max_bits: int,
              chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) that connect all values of a unit within ``max_bits``; ``v`` ascends within each unit.

    ``segment_bits``: of each unit, the bits from the top that all its values share.
    """
    n = len(v)
    forest = _Forest(n)
    near = (unit[1:] == unit[:-1]) & (np.bitwise_count(v[1:] ^ v[:-1]) <= max_bits)
    at = np.flatnonzero(near)
    forest.join(at, at + 1)
    starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    ends = np.append(starts[1:], n)
    zeros: dict[int, np.ndarray] = {}  # by depth: how many of the first values have a zero bit there

    def split(depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if depth not in zeros:
            bit = (v >> np.uint64(63 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate(([0], np.cumsum(bit == 0)))
        z = zeros[depth]
        return lo + z[hi] - z[lo]

    depths = segment_bits[starts]
    stack = []
    for depth in np.unique(depths)[::-1]:
        pick = (depths == depth) & (ends - starts > 1)
        s, e = starts[pick], ends[pick]
        stack.append((int(depth), s, e, s, e, np.zeros(len(s), np.int8)))
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > chunk:
            cut = len(alo) // 2
            stack.append((depth, alo[cut:], ahi[cut:], blo[cut:], bhi[cut:], err[cut:]))
            stack.append((depth, alo[:cut], ahi[:cut], blo[:cut], bhi[:cut], err[:cut]))
            continue
        # Where all values of both nodes are connected already, nothing below can add to it.
        changes = np.concatenate(([0], np.cumsum(forest.label[1:] != forest.label[:-1]))) if n else np.zeros(0)
        known = (changes[alo] == changes[ahi - 1]) & (changes[blo] == changes[bhi - 1]) \
            & (forest.label[alo] == forest.label[blo])
        single = (ahi - alo == 1) & (bhi - blo == 1)
        a, b = alo[single & ~known], blo[single & ~known]
        hit = np.bitwise_count(v[a] ^ v[b]) <= max_bits
        if hit.any():
            forest.join(a[hit], b[hit])
        go = ~single & ~known
        if not go.any() or depth >= 64:
            continue
        alo, ahi, blo, bhi, err = alo[go], ahi[go], blo[go], bhi[go], err[go]
        amid, bmid = split(depth, alo, ahi), split(depth, blo, bhi)
        own = alo == blo
        parts = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
                 (amid[~own], ahi[~own], blo[~own], bmid[~own], err[~own] + 1)]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts))
        budget = min(max_bits, 2) if depth < 32 else max_bits
        stay = (ahi > alo) & (bhi > blo) & (err <= budget)
        stay &= ~((alo == blo) & (ahi - alo == 1))
        if stay.any():
            stack.append((depth + 1, alo[stay], ahi[stay], blo[stay], bhi[stay], err[stay]))
    members = np.flatnonzero(forest.label != np.arange(n))
    return forest.label[members], members


def _join_units(max_bits: int, chunk_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders()
        held: list[tuple[np.ndarray, ...]] = []

        def links(o, key, v):
            # Within a unit ascending; units stay where they are.
            by = np.lexsort((v, key))
            o, key, v = o[by], key[by], v[by]
            same = np.concatenate(([False], (key[1:] == key[:-1]) & (v[1:] == v[:-1]))) if len(v) else key != key
            o, key, v = o[~same], key[~same], v[~same]
            widths = np.array([w for _, w in orders])
            a, b = trie_join(v, key, widths[o], max_bits)
            outs_a, outs_b = np.zeros(len(a), np.uint64), np.zeros(len(a), np.uint64)
            for i, (order, _) in enumerate(orders):
                at = o[a] == i
                outs_a[at], outs_b[at] = _permute(v[a[at]], order, True), _permute(v[b[at]], order, True)
            return pa.RecordBatch.from_arrays([pa.array(outs_a.view(np.int64)), pa.array(outs_b.view(np.int64))],
                                              names=["a", "b"])

        def flush(parts, last):
            o, key, v = (np.concatenate(x) for x in zip(*parts))
            # Unless it is the last, the last unit may go on in the next batch.
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            rest = [(o[cut:], key[cut:], v[cut:])] if cut < len(key) else []
            return (links(o[:cut], key[:cut], v[:cut]) if cut else None), rest

        unit, count, before = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("o", "segment", "i", "j")]
            new = np.zeros(batch.num_rows, bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            now = tuple(int(c[0]) for c in cols)
            new[0] = before is not None and now != before
            before = tuple(int(c[-1]) for c in cols)
            key = unit + np.cumsum(new)
            unit = int(key[-1])
            held.append((cols[0].astype(np.int64), key, np.ascontiguousarray(batch.column("v").to_numpy()).view(np.uint64)))
            count += batch.num_rows
            if count >= chunk_rows:
                out, held = flush(held, False)
                count = sum(len(x[1]) for x in held)
                if out is not None:
                    yield out
        if held:
            out, _ = flush(held, True)
            if out is not None:
                yield out
    return run


def link_fingerprints(nodes: DataFrame, max_bits: int = MAX_BITS, unit_rows: int = UNIT_ROWS,
                      saved: Saved | None = None) -> DataFrame:
    """(a, b) links that connect the distinct fingerprints ``nodes(fp long)`` within ``max_bits`` (at most 4)."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the bit orders hold for up to 4 differing bits")
    spark = nodes.sparkSession
    saved = saved or Saved(spark, "trie")
    units = saved.small(nodes.select("fp").mapInArrow(_units, "o int, segment int, v long"))
    # At most 6 x 2048 rows reach the driver, whatever the input.
    large = [(r["o"], r["segment"], -(-r["count"] // unit_rows))
             for r in units.groupBy("o", "segment").count().where(F.col("count") > unit_rows).collect()]
    if large:
        sizes = spark.createDataFrame(large, "o int, segment int, blocks int")
        units = units.join(F.broadcast(sizes), ["o", "segment"], "left").withColumn(
            "blocks", F.coalesce("blocks", F.lit(1)))
    else:
        units = units.withColumn("blocks", F.lit(1))
    block = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    # With one block, the unit itself; with more, every pair of blocks is a unit, and a block goes to all its pairs.
    pairs = units.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("o", "segment", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "v")
    dealt = pairs.repartition("o", "segment", "i", "j").sortWithinPartitions("o", "segment", "i", "j")
    return dealt.mapInArrow(_join_units(max_bits, unit_rows), "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    unit_rows: int = UNIT_ROWS) -> DataFrame:
    """One row per document: doc_id, row_key, fp (long, the fingerprint's bits), component_id (its smallest doc_id),
    root (the component's smallest fingerprint, which names it: a component_id may be null or repeat)."""
    spark = docs.sparkSession
    prepare(spark)
    saved = Saved(spark, "simhash")
    fps = saved.table(docs.select("doc_id", row_key().alias("row_key"), text_of().alias("text"))
                      .mapInArrow(_fingerprints(shingle_words), "doc_id long, row_key long, fp long"))
    nodes = saved.small(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = connected_components(link_fingerprints(nodes, max_bits, unit_rows, saved), saved)
    member = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    member = saved.small(member)
    ids = saved.small(member.groupBy("root").agg(F.min("least_id").alias("component_id")))
    of_fp = saved.small(member.join(ids, "root").select("fp", "component_id", "root"))
    return fps.join(of_fp, "fp").select("doc_id", "row_key", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the smallest doc_id, null last (of repeats of it, the smallest row key)."""
    saved = Saved(docs.sparkSession, "simhash-keep")
    rows = saved.small(near_duplicates(docs).select("doc_id", "row_key", "root"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    b = saved.small(rows.groupBy("root").agg(best.alias("best")))
    kept = rows.join(b, "root").select(
        "doc_id", "row_key", (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
                              & (F.col("row_key") == F.col("best.row_key"))).alias("kept"))
    return keep_one_each(docs, kept)
