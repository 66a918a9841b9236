"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

The probability of a token after its context is l2 n(context, token)/n(context) + l1 n(token)/N + l0/(V+1).  The weights
depend on the bucket of the context's frequency (0, 1, 2-3, 4-7, ...).  They are learnt by expectation-maximisation on
held-out counts: the training documents are dealt into two parts by their text (copies go together), and the events of
either part are predicted with the counts of the other, from which they are thus deleted.

Counts are those of all training documents, at any size, and no vocabulary is collected or broadcast:

1. Documents are put into chunks of ``CHUNK_BYTES`` of text, one table row each.
2. A chunk adds up its own tokens and bigrams and asks for the corpus counts of its distinct ones: keys and its training
   counts go to buckets by key.  A frequent word is asked for once per chunk, so no key is hot.
3. A bucket adds up the counts of its keys and answers every chunk in the chunk's order, so answers hold counts only.
4. Chunks read their answers from the shared folder by chunk number, and both the statistics for the weights
   and the scores are made in the chunk.  The texts are never shuffled.

The weights' statistics are a histogram of (context bucket, bigram estimate, unigram estimate), estimates rounded to an
eighth of a power of two, so its size is bounded whatever the corpus; all held-out events are in it.

A word is the 64-bit XXH64 of its bytes; two words of a corpus of V share a hash with a chance of V^2 / 2^65.  A bigram
is a 56-bit mix of two words: of B different bigrams, one in 2^56 / B shares its counts with another.  Keys travel
sorted, as differences in byte planes, which drops the bytes that are zero.

Defined cases: a null or empty text is its end token; a null doc_id counts as the empty string for the fold; the first
token's context is an end; repeated rows count as often as they occur; without training documents N and V are zero
and the weights are those of ``DEFAULT``; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, text_of
from clipstar.llm.warc import file_system

CHUNK_BYTES = 4 << 20
FOLDS, TEST_FOLD = 7, 2
BUCKETS = 26
STEPS = 60
DEFAULT = (0.5, 0.4, 0.1)
END = b"\n"  # no word has white space
_LEVELS = 512  # of an estimate: 0 for zero, 1 + 8 times its negative base-2 logarithm otherwise

_CHUNKS = "chunk long, bytes long, doc_id array<long>, held_out array<boolean>, part array<int>, text array<string>"
_ASKED = "bucket int, chunk long, words binary, word_counts binary, pairs binary, pair_counts binary"
_ANSWERS = "chunk long, bucket int, word_counts binary, pair_counts binary, n0 long, n1 long, types long"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == TEST_FOLD


def _chunks(chunk_bytes: int):
    names = ["chunk", "bytes", "doc_id", "held_out", "part", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, number = 0, None

        def row() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t.column(c).combine_chunks())
                     for c in names[2:]]
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([size], pa.int64()), *lists],
                                              names=names)

        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_numpy()
            start = 0
            while start < batch.num_rows:
                if number is None:
                    number = batch.column("row")[start].as_py()
                fits = int(np.searchsorted(np.cumsum(sizes[start:]) + size, chunk_bytes, side="right"))
                take = min(batch.num_rows - start, max(fits, 0 if held else 1))
                if take:
                    part = batch.slice(start, take)
                    held.append(pa.RecordBatch.from_arrays([part.column(c) for c in names[2:]], names=names[2:]))
                    size += int(sizes[start:start + take].sum())
                    start += take
                if start < batch.num_rows:
                    yield row()
                    held, size, number = [], 0, None
        if held:
            yield row()
    return run


@functools.cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, so that small ones cost little more than their low byte."""
    flat = np.ascontiguousarray(values).reshape(-1)
    return _zstd()[0].compress(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(_zstd()[1].decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as their differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


class Chunk:
    """A chunk's tokens: ``word`` and ``pair`` number each token's word and its bigram among the distinct ones."""

    def __init__(self, texts: pa.Array, buckets: int):
        from xxhash import xxh64_intdigest

        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat, doc = split.flatten(), pc.list_parent_indices(split).to_numpy()
        some = pc.not_equal(flat, "")
        flat, doc = flat.filter(some).dictionary_encode(), doc[np.asarray(some.to_numpy(zero_copy_only=False), bool)]
        words = flat.dictionary.cast(pa.binary()).to_pylist()
        hashes = np.fromiter((xxh64_intdigest(w) for w in [*words, END]), np.uint64, len(words) + 1)
        counts = np.bincount(doc, minlength=len(texts))
        ends = np.cumsum(counts)
        end = len(words)
        self.word = np.insert(flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends, end)
        self.doc = np.repeat(np.arange(len(texts)), counts + 1)
        context = np.empty_like(self.word)
        context[1:] = self.word[:-1]  # after an end comes a first token, whose context is that end
        if len(context):
            context[0] = end
        h = hashes[context] * np.uint64(0x9E3779B97F4A7C15)
        h ^= (h >> np.uint64(29)) ^ (hashes[self.word] * np.uint64(0xC2B2AE3D27D4EB4F))
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))) & np.uint64(0xFFFFFFFFFFFFFF00)
        coded = pa.array(h).dictionary_encode()
        self.pair = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words, self.pairs = hashes, coded.dictionary.to_numpy()
        self.context_of = np.empty(len(self.pairs), np.int64)
        self.word_of = np.empty(len(self.pairs), np.int64)
        self.context_of[self.pair], self.word_of[self.pair] = context, self.word
        self.docs = len(texts)
        # Distinct keys in ascending order, parted into ranges of equal width.
        self.order = [_by_bucket(k, buckets) for k in (self.words, self.pairs)]

    def counts(self, tokens: np.ndarray, size: int, where: np.ndarray) -> np.ndarray:
        return np.bincount(tokens[where], minlength=size)


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
    return order, np.concatenate(([0], np.searchsorted(keys[order], edges), [len(keys)]))


def _train(row_held: pa.Array, row_part: pa.Array) -> list[np.ndarray]:
    """Of each training part, which documents are in it."""
    train = ~np.asarray(row_held.to_numpy(zero_copy_only=False), bool)
    part = row_part.to_numpy(zero_copy_only=False)
    return [train & (part == p) for p in (0, 1)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() if c == "chunk" else batch.column(c)[i].values
                   for c in ("chunk", "doc_id", "held_out", "part", "text")}


def _ask(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row["text"], buckets)
            parts = [m[chunk.doc] for m in _train(row["held_out"], row["part"])]
            out: dict[str, list] = {}
            for name, keys, tokens, (order, bounds) in (("words", chunk.words, chunk.word, chunk.order[0]),
                                                        ("pairs", chunk.pairs, chunk.pair, chunk.order[1])):
                n = np.stack([chunk.counts(tokens, len(keys), p) for p in parts]).astype(np.uint32)[:, order]
                keys = keys[order]
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                out[name] = [pack_keys(keys[a:b]) for a, b in cuts]
                out[f"{name[:-1]}_counts"] = [_pack(n[:, a:b]) for a, b in cuts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(buckets, dtype=np.int32)), pa.array([row["chunk"]] * buckets, pa.int64()),
                 *(pa.array(out[c], pa.binary()) for c in ("words", "word_counts", "pairs", "pair_counts"))],
                names=["bucket", "chunk", "words", "word_counts", "pairs", "pair_counts"])
    return run


def _answer(table: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's keys in the order of each asking chunk, and the bucket's totals as chunk -1."""
    chunks = table.column("chunk").to_pylist()
    answers: dict[str, list[bytes]] = {}
    totals = (0, 0, 0)
    for name in ("word", "pair"):
        keys = [unpack_keys(k) for k in table.column(f"{name}s").to_pylist()]
        bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        coded = pa.array(np.concatenate(keys)).dictionary_encode()
        code, size = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
        own = [_unpack(c, np.uint32).reshape(2, -1) for c in table.column(f"{name}_counts").to_pylist()]
        own = np.concatenate(own, axis=1)
        total = np.stack([np.bincount(code, weights=own[p], minlength=size) for p in (0, 1)]).astype(np.uint64)
        if name == "word":
            totals = (int(total[0].sum()), int(total[1].sum()), int((total.sum(axis=0) > 0).sum()))
        given = total[:, code]
        answers[name] = [_pack(given[:, a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    n = len(chunks)
    bucket = table.column("bucket")[0].as_py()
    return pa.table({
        "chunk": pa.array([*chunks, -1], pa.int64()), "bucket": pa.array([bucket] * (n + 1), pa.int32()),
        "word_counts": pa.array([*answers["word"], None], pa.binary()),
        "pair_counts": pa.array([*answers["pair"], None], pa.binary()),
        "n0": pa.array([None] * n + [totals[0]], pa.int64()), "n1": pa.array([None] * n + [totals[1]], pa.int64()),
        "types": pa.array([None] * n + [totals[2]], pa.int64())})


class Answers:
    """The answers of chunks, in files by chunk number."""

    def __init__(self, folder: str):
        self.system, self.root = file_system(folder)

    def of(self, number: int, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Counts [part, word] and [part, pair] over the corpus."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        files = [f.path for f in self.system.get_file_info(fs.FileSelector(f"{self.root}/chunk={number}"))
                 if f.base_name.endswith(".parquet")]
        rows = []
        for path in files:
            with self.system.open_input_file(path) as source:
                rows += pq.ParquetFile(source).read(["bucket", "word_counts", "pair_counts"]).to_pylist()
        rows.sort(key=lambda r: r["bucket"])
        out = []
        for name, (order, _) in zip(("word_counts", "pair_counts"), chunk.order):
            given = np.concatenate([_unpack(r[name], np.uint64).reshape(2, -1) for r in rows], axis=1)
            counts = np.empty_like(given, dtype=np.float64)
            counts[:, order] = given
            out.append(counts)
        return out[0], out[1]


def context_bucket(n: np.ndarray) -> np.ndarray:
    """0 for no occurrence, else 1 + the binary logarithm, at most the last bucket."""
    return np.minimum(np.frexp(n)[1], BUCKETS - 1)


def _ratio(a: np.ndarray, b) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def _level(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.rint(-8 * np.log2(p)), 0, _LEVELS - 2) + 1, 0).astype(np.int64)


def level_value(q: np.ndarray) -> np.ndarray:
    return np.where(q > 0, np.exp2(-(q - 1) / 8.0), 0.0)


def _histogram(folder: str, buckets: int, totals: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(folder)
        for row in _rows(batches):
            chunk = Chunk(row["text"], buckets)
            words, pairs = answers.of(row["chunk"], chunk)
            cells, weights = [], []
            for p, docs in enumerate(_train(row["held_out"], row["part"])):
                events = chunk.counts(chunk.pair, len(chunk.pairs), docs[chunk.doc])
                at = np.flatnonzero(events)
                other = 1 - p
                seen = words[other][chunk.context_of[at]]
                p2 = _level(_ratio(pairs[other][at], seen))
                p1 = _level(_ratio(words[other][chunk.word_of[at]], float(totals[other])))
                cells.append((context_bucket(seen) * _LEVELS + p2) * _LEVELS + p1)
                weights.append(events[at])
            cell, where = np.unique(np.concatenate(cells), return_inverse=True)
            weight = np.bincount(where, weights=np.concatenate(weights), minlength=len(cell))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(weight.astype(np.int64))],
                                             names=["cell", "events"])
    return run


def learn_weights(cell: np.ndarray, events: np.ndarray, types: int) -> np.ndarray:
    """[bucket, (bigram, unigram, uniform)] by expectation-maximisation; a bucket without events takes the one below."""
    weights = np.tile(np.array(DEFAULT), (BUCKETS, 1))
    bucket = cell // _LEVELS // _LEVELS
    p = np.stack([level_value(cell // _LEVELS % _LEVELS), level_value(cell % _LEVELS),
                  np.full(len(cell), 1.0 / (types + 1))])
    for b in range(BUCKETS):
        at = bucket == b
        if not at.any():
            if b:
                weights[b] = weights[b - 1]
            continue
        w, q, n = np.array(DEFAULT), p[:, at], events[at].astype(np.float64)
        for _ in range(STEPS):
            share = w[:, None] * q
            w = (share * (n / share.sum(axis=0))).sum(axis=1) / n.sum()
            w = np.maximum(w, 1e-9)
            w /= w.sum()
        weights[b] = w
    return weights


def _score(folder: str, buckets: int, tokens: int, types: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(folder)
        for row in _rows(batches):
            chunk = Chunk(row["text"], buckets)
            words, pairs = (a.sum(axis=0) for a in answers.of(row["chunk"], chunk))
            base = np.log10((words + 1) / (tokens + 1 * (types + 1)))
            seen = words[chunk.context_of]
            w = weights[context_bucket(seen)]
            p = w[:, 0] * _ratio(pairs, seen) + w[:, 1] * _ratio(words[chunk.word_of], float(tokens)) \
                + w[:, 2] / (types + 1)
            sums = [np.bincount(chunk.doc, weights=x, minlength=chunk.docs)
                    for x in (base[chunk.word], np.log10(p)[chunk.pair], words[chunk.word] > 0)]
            n = np.bincount(chunk.doc, minlength=chunk.docs)
            yield pa.RecordBatch.from_arrays(
                [row["doc_id"], row["held_out"], pa.array(n.astype(np.int64)), pa.array(sums[2].astype(np.int64)),
                 pa.array(np.full(chunk.docs, tokens, np.int64)), pa.array(sums[0]), pa.array(sums[1])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    prepare(spark)
    saved = Saved(spark, "lm")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       F.pmod(F.xxhash64(text_of()), F.lit(2)).cast("int").alias("part"), text_of().alias("text"))
    chunks = saved.table(rows.mapInArrow(_chunks(chunk_bytes), _CHUNKS))
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // chunk_bytes))
    asked = chunks.mapInArrow(_ask(buckets), _ASKED)
    answers = asked.groupBy("bucket").applyInArrow(_answer, _ANSWERS)
    folder = saved.path("answers")
    answers.repartition("chunk").write.partitionBy("chunk").parquet(folder)
    sums = spark.read.schema(_ANSWERS).parquet(folder).where("chunk = -1").agg(
        F.sum("n0"), F.sum("n1"), F.sum("types")).first()
    n0, n1, types = (int(x or 0) for x in sums)
    cells = chunks.mapInArrow(_histogram(folder, buckets, (n0, n1)), "cell long, events long") \
        .groupBy("cell").agg(F.sum("events").alias("events")).collect()
    weights = learn_weights(np.array([c[0] for c in cells], np.int64), np.array([c[1] for c in cells], np.int64), types)
    return chunks.mapInArrow(
        _score(folder, buckets, n0 + n1, types, weights),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
