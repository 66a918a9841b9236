"""Phrase collocations by prefix-free parsing.

Words are what ``[^\\x20\\x09]+`` finds in the pieces that ``[.,;:!?\\x0A-\\x0D]`` leaves of a text, A-Z in lower case.
Everything is counted per language.

Parsing: a window of ``WINDOW`` words whose hash is divisible by ``CHUNK_WORDS`` starts a chunk, whatever text surrounds
it, so repeated passages fall into the same chunks.  A chunk runs on over the window that starts the next one (never
over the end of a piece), so every phrase of up to WINDOW + 1 words lies whole in the chunk in which it starts, and is
counted there alone.  Distinct chunks with their frequencies are the dictionary: one shuffle of the texts, with repeats
summed before it.  From then on only distinct chunks are read, each counted by its frequency.

Counting: a phrase is no more frequent than its parts.  Tasks sum 64-bit hashes of all pairs of words; pairs that reach
``MIN_COUNT`` set bits of a filter.  Then they sum the hashes of phrases of three and four words whose pairs all pass.
A last pass over the dictionary counts as text the phrases that pass the filters, and the words of such pairs.  So
hashes and filters decide nothing: they only spare work.  A filter has at most ``FILTER_BITS`` bits (16 MB); with more
phrases than that it spares less.

A phrase's score is that of its lowest-scoring cut.  A phrase goes if a longer candidate that contains it has at least
``ABSORB`` percent of its count.  Of a language, the first ``TOP`` are the report.  All arithmetic is on integers, with
decimals where a product may pass 64 bits.

Defined cases: a null text is empty, a null language is ``und``; an empty table, or one without frequent phrases, gives
an empty result; repeated rows count each; phrases equal in score and count are ordered by their UTF-8 bytes; other
columns are not read.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, text_of

MAX_WORDS = 4
WINDOW = MAX_WORDS - 1
CHUNK_WORDS = 32
MIN_COUNT = 30
ABSORB = 80
TOP = 2000
FILTER_BITS = 1 << 27
BITS_EACH = 256       # for each frequent hash, as far as FILTER_BITS allow
GATHER_BYTES = 8 << 20
_GATHER = 1 << 22     # hashes that a task sums at once
_LONG_WORD = 64       # bytes from which a word is hashed by itself

_WORD, _SPACE, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_LOWER[_KIND != _WORD] = ord(" ")
_SPREAD, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _stir(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _SPREAD + more
    return (h ^ (h >> np.uint64(32))) * _STIR


class Words(NamedTuple):
    """The words of a batch of texts, in order."""
    text: np.ndarray    # bytes of the words, each with one separator behind: a line feed at a piece's end, else a space
    start: np.ndarray   # of each word in text
    end: np.ndarray
    counts: np.ndarray  # words of each text
    piece: np.ndarray   # rising number of the word's piece

    @staticmethod
    def of(text: np.ndarray, end: np.ndarray, new: np.ndarray, counts: np.ndarray) -> Words:
        start = np.empty_like(end)
        start[:1] = 0
        start[1:] = end[:-1] + 1
        return Words(text, start, end, counts, np.cumsum(new))

    def each(self, values: np.ndarray) -> np.ndarray:
        """For each word the value of its text."""
        return np.repeat(values, self.counts)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's number among the distinct words, and these."""
        size = self.end - self.start
        inside = np.ones(len(self.text), bool)
        inside[self.end] = False
        words = pa.LargeStringArray.from_buffers(
            len(size), pa.py_buffer(np.concatenate(([0], np.cumsum(size)))), pa.py_buffer(self.text[inside])).dictionary_encode()
        return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary

    def hashes(self) -> np.ndarray:
        """64 bits of each word, eight bytes at a time."""
        padded = np.concatenate((self.text, np.zeros(8, np.uint8)))
        eight = np.ndarray(len(self.text) + 1, "<u8", padded, strides=(1,))
        size = self.end - self.start
        h = _stir(size.astype(np.uint64), eight[self.start] & _FIRST_BYTES[np.minimum(size, 8)])
        for at in range(8, _LONG_WORD, 8):
            more = np.flatnonzero(size > at)
            if not len(more):
                break
            h[more] = _stir(h[more], eight[self.start[more] + at] & _FIRST_BYTES[np.minimum(size[more] - at, 8)])
        more = np.flatnonzero(size > _LONG_WORD)
        if len(more):
            from xxhash import xxh64_intdigest

            h[more] = [xxh64_intdigest(self.text[a:b].tobytes())
                       for a, b in zip(self.start[more].tolist(), self.end[more].tolist())]
        return h


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of string or binary values without nulls, and where each value begins and the last one ends."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds.astype(np.int64) - bounds[0]


def words_of(texts: pa.Array) -> Words:
    """The words of texts (string, without nulls)."""
    # A line feed behind each text, so that every word has a separator behind it.
    raw, bounds = _bytes(pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar("\n", texts.type)))
    kind = _KIND[raw]
    inside = kind == _WORD
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begin = np.flatnonzero(begins)
    # A line feed may be the last kept byte of one text and stand before the first word of the next one.
    text = _LOWER[raw[keep]]
    end = np.flatnonzero(text == ord(" "))
    new = np.zeros(len(begin) + 1, bool)
    new[:1] = True
    new[np.searchsorted(begin, np.flatnonzero(kind == _BREAK))] = True
    text[end[np.flatnonzero(new[1:])]] = ord("\n")
    counts = np.diff(np.searchsorted(begin, bounds))
    return Words.of(text, end, new[:-1], counts)


def chunk_words(chunks: pa.Array) -> Words:
    """The words of chunks, which end without a separator."""
    raw, bounds = _bytes(pc.binary_join_element_wise(chunks, pa.scalar(b"", chunks.type), pa.scalar(b"\n", chunks.type)))
    end = np.flatnonzero((raw == ord(" ")) | (raw == ord("\n")))
    counts = np.diff(np.searchsorted(end, bounds))
    new = np.ones(len(end), bool)
    new[1:] = raw[end[:-1]] == ord("\n")
    return Words.of(raw, end, new, counts)


def chunk_bounds(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each chunk, first word after its own ones, first word after its overlap with the next."""
    n = len(hashes)
    row = words.each(np.arange(len(words.counts)))
    first = np.ones(n, bool)
    first[1:] = row[1:] != row[:-1]
    if n >= WINDOW:
        window = hashes[:n - WINDOW + 1]
        for i in range(1, WINDOW):
            window = _stir(window, hashes[i:n - WINDOW + 1 + i])
        whole = row[:n - WINDOW + 1] == row[WINDOW - 1:]
        first[:n - WINDOW + 1] |= whole & ((window >> np.uint64(20)) % np.uint64(CHUNK_WORDS) == 0)
    start = np.flatnonzero(first)
    stop = np.append(start[1:], n)
    last_piece = words.piece[stop - 1] if n else stop
    piece_end = np.searchsorted(words.piece, last_piece, "right")
    return start, stop, np.minimum(stop + WINDOW, np.maximum(stop, piece_end))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = words_of(batch.column("text"))
        start, stop, reach = chunk_bounds(words, words.hashes())
        text = words.text.tobytes()
        chunks = [text[a:b] for a, b in zip(words.start[start].tolist(), words.end[reach - 1].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").take(pa.array(words.each(np.arange(batch.num_rows))[start])), pa.array(chunks, pa.binary()),
             pa.array((stop - start).astype(np.int32))], names=["lang", "chunk", "own_words"])


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, own_words, n): distinct chunks, the words of each that are its own, and how often it occurs."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    return texts.mapInArrow(_parse, "lang string, chunk binary, own_words int") \
        .groupBy("lang", "chunk", "own_words").agg(F.count(F.lit(1)).alias("n"))


class Filter(NamedTuple):
    """Bits by the low bits of a hash; ``bits`` is a power of two."""
    bits: int
    octets: np.ndarray

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        return (self.octets[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Phrases(NamedTuple):
    """What phrases start at each word of some chunks: entry i of the tuples is for i + 1 words."""
    words: Words
    own: np.ndarray                  # the word is one of its chunk's own
    weight: np.ndarray               # how often its chunk occurs
    lang: np.ndarray                 # code of its language
    hashes: tuple[np.ndarray, ...]   # of the phrase, its length and its language
    whole: tuple[np.ndarray, ...]    # the phrase lies within the piece, and so within the chunk

    @staticmethod
    def of(batch: pa.RecordBatch, lengths: int = MAX_WORDS) -> Phrases:
        from xxhash import xxh64_intdigest

        words = chunk_words(batch.column("chunk"))
        lang = batch.column("lang").dictionary_encode()
        seeds = np.array([xxh64_intdigest(s.encode()) for s in lang.dictionary.to_pylist()], np.uint64)
        lang = words.each(lang.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        single = words.hashes()
        n, hashes, whole = len(single), [], []
        h = _stir(single, seeds[lang]) if n else single
        for length in range(1, lengths + 1):
            some = np.zeros(n, bool)
            if n >= length:
                some[:n - length + 1] = words.piece[:n - length + 1] == words.piece[length - 1:]
            if length > 1:
                after = single[length - 1:]
                h = np.append(_stir(h[:len(after)], after), np.zeros(n - len(after), np.uint64))
            hashes.append(h)
            whole.append(some)
        own = np.arange(n) < words.each(np.cumsum(words.counts) - words.counts + batch.column("own_words").to_numpy())
        return Phrases(words, own, words.each(batch.column("n").to_numpy()), lang, tuple(hashes), tuple(whole))

    def in_pairs(self, pairs: Filter) -> tuple[np.ndarray, ...]:
        """As ``whole``, of phrases of two words or more whose pairs all may be frequent; of words in such a pair."""
        pair = self.whole[1] & pairs.may_have(self.hashes[1])
        word = pair.copy()
        word[1:] |= pair[:-1]
        out = [word, pair]
        for _ in range(3, MAX_WORDS + 1):
            longer = np.zeros(len(pair), bool)
            longer[:-1] = out[-1][:-1] & pair[1:] if len(out) == 2 else out[-1][:-1] & out[-1][1:]
            out.append(longer)
        return tuple(out)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of GATHER_BYTES or more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= GATHER_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _sum(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, weights
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weights, first)


def _rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), 1 << 18):
        yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 18)].view(np.int64)), pa.array(n[i:i + (1 << 18)])],
                                         names=["h", "n"])


def _count_hashes(pairs: Filter | None, min_count: int) -> Callable:
    """Sums by hash of all pairs; with a filter of pairs, of the longer phrases that pass it.  The words of its pairs
    count as frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights, held = [], [], 0
        for batch in _gathered(batches):
            phrases = Phrases.of(batch, MAX_WORDS if pairs else 2)
            if pairs is None:
                at = np.flatnonzero(phrases.whole[1] & phrases.own)
                hashes.append(phrases.hashes[1][at])
                weights.append(phrases.weight[at])
            else:
                word, _, *longer = phrases.in_pairs(pairs)
                known = np.unique(phrases.hashes[0][word])
                hashes.append(known)
                weights.append(np.full(len(known), min_count))
                for h, some in zip(phrases.hashes[2:], longer):
                    at = np.flatnonzero(some & phrases.own)
                    hashes.append(h[at])
                    weights.append(phrases.weight[at])
            held += len(batch.column("n")) * CHUNK_WORDS
            if held >= _GATHER:
                yield from _rows(*_sum(np.concatenate(hashes), np.concatenate(weights)))
                hashes, weights, held = [], [], 0
        if held:
            yield from _rows(*_sum(np.concatenate(hashes), np.concatenate(weights)))
    return run


def _frequent(min_count: int) -> Callable:
    """Of rows (h, n) that are dealt by h, the hashes that reach ``min_count``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            keys.append(batch.column("h").to_numpy())
            n.append(batch.column("n").to_numpy())
            held += batch.num_rows
            if held >= max(_GATHER, len(keys[0])):
                key, some = _sum(np.concatenate(keys), np.concatenate(n))
                keys, n, held = [key], [some], 0
        key, some = _sum(np.concatenate(keys), np.concatenate(n))
        yield pa.RecordBatch.from_arrays([pa.array(key[some >= min_count])], names=["h"])
    return run


def _numbered(first: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct (first, then), and where one of each is."""
    key = first * (then.max(initial=0) + 1) + then
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _count_texts(pairs: Filter, longer: Filter) -> Callable:
    """Counts by text of the phrases that pass the filters, and of the words of frequent pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            phrases = Phrases.of(batch)
            words, text = phrases.words, phrases.words.text.tobytes()
            langs = batch.column("lang").dictionary_encode().dictionary
            code, distinct = words.codes()
            passes = phrases.in_pairs(pairs)
            number = code + phrases.lang * len(distinct)  # of the phrase that starts at the word and is of one word less
            for i, (some, h) in enumerate(zip(passes, phrases.hashes)):
                some = longer.may_have(h) if i == 0 else some if i == 1 else some & longer.may_have(h)
                # A phrase without a number for the part before it passed by chance: if that isn't frequent, it isn't.
                at = np.flatnonzero(some & (number >= 0))
                then = np.zeros(len(at), np.int64) if i == 0 else code[at + i]
                own, one = _numbered(number[at], then)
                if i:
                    number = np.full(len(code), -1, np.int64)
                    number[at] = own
                n = np.bincount(own, weights=phrases.weight[at] * phrases.own[at], minlength=len(one)).astype(np.int64)
                one = at[one][n > 0]
                spans = zip(words.start[one].tolist(), words.end[one + i].tolist())
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(phrases.lang[one])), pa.array([text[a:b] for a, b in spans], pa.binary()).cast(pa.string()),
                     pa.array(np.full(len(one), i + 1, np.int32)), pa.array(n[n > 0])], names=["lang", "phrase", "words", "n"])
    return run


def _filter(frequent: DataFrame) -> Filter:
    """A filter of the hashes in ``frequent(h)``; at most FILTER_BITS bits reach the driver, in rows of 4 KB."""
    count = frequent.count()
    bits = min(FILTER_BITS, 1 << max(18, (BITS_EACH * count).bit_length()))
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = frequent.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("part")) \
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("octets")).toArrow()
    octets = np.zeros((bits >> 15, 1 << 12), np.uint8)
    for part, some in zip(rows.column("part").to_pylist(), rows.column("octets").to_pylist()):
        octets[part] = np.frombuffer(some, np.uint8)
    return Filter(bits, octets.reshape(-1))


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of the phrases of 2 to MAX_WORDS words that occur ``min_count`` times or more and of their
    words, and (lang, n) with the words of each language."""
    prepare(docs.sparkSession)
    saved = Saved(docs.sparkSession, "collocations")
    chunks = saved.table(dictionary(docs))
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("own_words")).alias("n"))

    def frequent(pairs: Filter | None) -> Filter:
        # A task sends each hash once, so no hash has more rows than there are tasks.
        sums = chunks.mapInArrow(_count_hashes(pairs, min_count), "h long, n long").repartition("h")
        return _filter(saved.table(sums.mapInArrow(_frequent(min_count), "h long")))

    pairs = frequent(None)
    longer = frequent(pairs)
    counts = chunks.mapInArrow(_count_texts(pairs, longer), "lang string, phrase string, words int, n long") \
        .groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    return saved.small(counts), saved.small(totals)


def _part(first: int | F.Column, count: int | F.Column) -> F.Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    counts, totals = phrase_counts(docs, min_count)
    candidates = counts.where("words > 1").withColumnRenamed("f", "a")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))) \
        .withColumn("left", _part(1, F.col("k"))).withColumn("right", _part(F.col("k") + 1, F.col("words")))
    side = counts.select("lang", "phrase", "f")
    cuts = cuts.join(side.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(side.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr(
        "(cast(2000000 as decimal(8,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)"))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # (first word, words) of the parts of two words or more that a longer candidate has.
    inner = F.expr("flatten(transform(sequence(2, words - 1), c -> transform(sequence(1, words - c + 1), "
                   "s -> array_join(slice(split(phrase, ' '), s, c), ' '))))")
    inside = candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    absorbed = F.expr(f"cast(100 as decimal(3,0)) * cast(longer as decimal(19,0)) >= "
                      f"cast({ABSORB} as decimal(3,0)) * cast(a as decimal(19,0))")
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~absorbed)
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score") \
        .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
