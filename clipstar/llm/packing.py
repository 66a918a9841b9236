"""Packing by shortest-pack-first over the length histogram.

Documents become token ids; one of over ``CAPACITY`` ids is cut into full pieces and a rest.  The lengths of all pieces
form a histogram of at most ``CAPACITY`` bins, which is all the planner sees.  It places lengths longest first: the
pieces of one length go into the shortest open packs (those with the most space) as long as they fit there, as many
pieces at a time as packs of that pattern, and open new packs otherwise.  The result is a list of packing patterns with
counts.  Pieces of one length are alike, so a pattern's slots take them by rank: piece number r of a length goes to the
slot whose interval of ranks holds r.

Ranks come from one range-partitioned sort by (length, row, start) and the row counts of its partitions, so a length
that a third of all pieces have is spread over many tasks.  Plan and intervals are bounded by the number of
lengths, not by the data.  The ids themselves never leave the task that makes them: a piece is (start, length,
checksum).

Defined cases: a null or empty text is its end token alone; documents that repeat an id are packed one by one; a null
doc_id is kept; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import functools
import heapq
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, text_of

CAPACITY = 4096
END_ID = 2
#: Letter runs whose ids a Python worker keeps from one task to the next; as many again that were kept before.
CACHE_WORDS = 250_000

# One run of letters that are single code points in normal form, then marks that are neither letters nor
# apostrophes: the tokenizer's pre-tokenizer parts them, and lowers letters one by one.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:%$&#*()]*)")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokenize:
    """Ids of white-space separated words, each word tokenized once and kept.

    The tokenizer drops white space and merges within its pre-tokens only, so a text's ids are those of its words, and
    a word of letters and marks has the ids of the letters and of the marks.  For runs of A-Z its model is called
    directly, past the normalizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        self.marks: dict[str, tuple[int, ...]] = {"": ()}

    def word(self, word: str) -> tuple[int, ...]:
        plain = _PLAIN.fullmatch(word)
        if plain is None:
            return tuple(self.whole.encode(word, add_special_tokens=False).ids)
        letters, marks = plain[1].lower(), plain[2]
        ids = self.letters.get(letters)
        if ids is None:
            ids = self.before.get(letters)
            if ids is None:
                ids = tuple(t.id for t in self.model.tokenize(letters)) if letters.isascii() \
                    else tuple(self.whole.encode(letters, add_special_tokens=False).ids)
            if len(self.letters) >= CACHE_WORDS:
                self.letters, self.before = {}, self.letters
            self.letters[letters] = ids
        end = self.marks.get(marks)
        if end is None:
            end = tuple(self.whole.encode(marks, add_special_tokens=False).ids)
            if len(self.marks) < 10_000:
                self.marks[marks] = end
        return ids + end

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and where each text's ids begin (and the last end)."""
        words = pc.ascii_split_whitespace(texts)
        flat = words.flatten().dictionary_encode()
        code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        each = [self.word(w) for w in flat.dictionary.to_pylist()]
        each.append((end_id,))
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        first = np.concatenate(([0], np.cumsum(sizes)))
        bank = np.fromiter((i for ids in each for i in ids), np.uint32, int(first[-1]))
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        # After each text's words, one more word: the end.
        code = np.insert(code, np.cumsum(counts), len(each) - 1)
        bounds = np.concatenate(([0], np.cumsum(counts + 1)))
        lengths = sizes[code]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(ends[-1]) + np.repeat(first[code] - ends[:-1], lengths)
        return bank[at], ends[bounds]


@functools.cache
def tokenizer(path: str) -> Tokenize:
    """One for each Python worker: tasks refer to this function by its name, so its cache outlives them."""
    return Tokenize(path)


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = tokenizer(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                ids, bounds = tokenize.texts(part.column("text"), end_id)
                raw = ids.astype("<u4").tobytes()
                row, start, length, crc, total = [], [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for s in range(a, b, capacity):
                        e = min(b, s + capacity)
                        row.append(i)
                        start.append(s - a)
                        length.append(e - s)
                        crc.append(zlib.crc32(raw[4 * s:4 * e]))
                        total.append(b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid").take(pa.array(row, pa.int32())),
                     part.column("doc_id").take(pa.array(row, pa.int32())),
                     *(pa.array(c, pa.int64()) for c in (start, length, crc, total))],
                    names=["rid", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def plan_packs(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of packs, [(length, pieces of it in each pack), ...]) patterns that hold every piece once.

    Lengths go longest first.  The open pack patterns form a heap by space, most space first.  If all packs of the
    roomiest pattern take one or more pieces of a length, as many pieces as needed go in at once; a
    pattern of which only some packs get a piece is parted in two.
    """
    full: list[tuple[int, list[tuple[int, int]]]] = []
    heap: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # -space, order, packs, pattern
    order = 0

    def put(space: int, packs: int, pattern: list[tuple[int, int]]) -> None:
        nonlocal order
        if space == 0:
            full.append((packs, pattern))
        else:
            order += 1
            heapq.heappush(heap, (-space, order, packs, pattern))

    def add(pattern: list[tuple[int, int]], length: int, k: int) -> list[tuple[int, int]]:
        if pattern and pattern[-1][0] == length:
            return [*pattern[:-1], (length, pattern[-1][1] + k)]
        return [*pattern, (length, k)]

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not heap or -heap[0][0] < length:
                # A new pack is then the roomiest one, and takes pieces of this length as long as they fit.
                per = min(left, capacity // length)
                packs = left // per
                put(capacity - per * length, packs, [(length, per)])
                left -= packs * per
                continue
            space, _, packs, pattern = heapq.heappop(heap)
            space = -space
            if left < packs:
                put(space, packs - left, pattern)
                put(space - length, left, add(pattern, length, 1))
                left = 0
            else:
                # Until this pattern is no longer the roomiest, each further piece goes to it again.
                below = -heap[0][0] if heap else 0
                k = max(1, min(left // packs, space // length, -(-(space - below) // length)))
                put(space - k * length, packs, add(pattern, length, k))
                left -= k * packs
    return full + [(packs, pattern) for _, _, packs, pattern in sorted(heap)]


def _intervals(plan, histogram: dict[int, int]) -> tuple[np.ndarray, ...]:
    """Slots by the global rank of the pieces they take: first rank, first sequence, packs, pieces per pack, offset.

    Of a slot with m pieces in each of its packs, piece q of the slot's ranks goes to pack q // m at place q % m.
    """
    begin, rank = {}, 0
    for length in sorted(histogram):
        begin[length], rank = rank, rank + histogram[length]
    rows, sequence = [], 0
    for packs, pattern in plan:
        offset = 0
        for length, m in pattern:
            rows.append((begin[length], sequence, m, length, offset))
            begin[length] += packs * m
            offset += length * m
        sequence += packs
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows))


def _assign(slots: tuple[np.ndarray, ...], offsets: np.ndarray):
    first, sequence, per, length, offset = slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            rank = offsets[at >> 33] + (at & ((1 << 33) - 1))
            slot = np.searchsorted(first, rank, side="right") - 1
            q = rank - first[slot]
            names = [n for n in batch.schema.names if n != "at"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(sequence[slot] + q // per[slot]), pa.array(offset[slot] + q % per[slot] * length[slot])],
                names=[*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    prepare(spark)
    saved = Saved(spark, "packing")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_of().alias("text"))
    pieces = saved.table(rows.mapInArrow(
        _pieces(vocabulary or tokenizer_path(), end_id, capacity),
        "rid long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))
    # At most ``capacity`` lengths.
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    result = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    if not histogram:
        return spark.createDataFrame([], result)
    order = ["length", "rid", "start"]
    # The id of a row of a sorted partition: the partition's number times 2^33, and the row's number in it.
    ranked = saved.small(pieces.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id()).drop("rid"))
    sizes = {r["p"]: r["count"] for r in ranked.groupBy(F.shiftright("at", 33).alias("p")).count().collect()}
    offsets = np.zeros(max(sizes) + 2, np.int64)
    for p, n in sizes.items():
        offsets[p + 1] = n
    slots = _intervals(plan_packs(histogram, capacity), histogram)
    return ranked.mapInArrow(_assign(slots, np.cumsum(offsets)), result)
