"""Language identification by mixture inference: a document's languages and their shares.

Training counts byte trigrams (hashed to ``BUCKETS``) of the labelled documents by language, over all of their text;
each task adds up its own counts before the shuffle.  The model has the counts that aren't zero, by bucket, and goes to
the tasks with the function; its size is that of the labelled vocabulary of trigrams, 12 bytes a language and bucket at
most, for any number of languages.

A document is a mixture of languages: every trigram is drawn from one of them.  Expectation-maximisation finds the
shares that make the document's trigram counts likeliest.  Then the language set is selected by penalised likelihood:
the k languages of largest share for k = 1, 2, ..., shares fitted anew, as long as the log likelihood grows by more than
``0.5 log n + MIN_GAIN n`` for n trigrams.  The document's language is the one with the largest share in that
set, its score that language's share of the whole mixture.  The empty set stands for trigrams drawn from all buckets
alike: a text which that explains better than the best mixture is in no learnt language, and ``drop_unknown`` drops it.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is any text if there is nothing
to learn from; a label that is null is not learnt; a null doc_id counts as the empty string for the fold, which is
held out; repeated rows count as often as they occur; an empty table gives an empty result; other columns are not read.
Letters are those of Unicode, texts of any length are read whole.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare

BUCKETS = 1 << 15
FOLDS = 5
SMOOTH = 0.5
STEPS = 25
MIN_GAIN = 0.02
HELD_LANGUAGES = 256  # whose counts a task holds before it sends them
UNKNOWN = "und"

# Everything in ASCII but letters parts words; bytes of other letters stay.
_WORDS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the lower-case text, words set apart by one space."""
    body = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_WORDS).split()) + b" "
    b = np.frombuffer(body, np.uint8).astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether the row's fold is not learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                names=["lang", "bucket", "n"])
        counts.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            if lang not in counts:
                if len(counts) >= HELD_LANGUAGES:
                    yield from rows()
                counts[lang] = np.zeros(BUCKETS, np.int64)
            counts[lang] += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
    yield from rows()


class Model:
    """Languages in order of their names, and smoothed trigram probabilities from counts (language, bucket, n)."""

    def __init__(self, languages: list[str], language: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.languages = languages
        order = np.argsort(bucket, kind="stable")
        self.language, self.n = language[order].astype(np.int32), n[order].astype(np.float64)
        self.start = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
        totals = np.bincount(language, weights=n, minlength=len(languages)) if languages else np.zeros(0)
        self.unit = 1 / (totals + SMOOTH * BUCKETS)

    def at(self, buckets: np.ndarray) -> np.ndarray:
        """p[language, bucket] of these buckets."""
        sizes = self.start[buckets + 1] - self.start[buckets]
        column = np.repeat(np.arange(len(buckets)), sizes)
        entry = np.arange(sizes.sum()) + np.repeat(self.start[buckets] - (np.cumsum(sizes) - sizes), sizes)
        p = np.full((len(self.languages), len(buckets)), SMOOTH)
        p[self.language[entry], column] += self.n[entry]
        return p * self.unit[:, None]

    def _fit(self, p: np.ndarray, counts: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
        n = counts.sum()
        for _ in range(STEPS):
            new = share * (p @ (counts / (share @ p))) / n
            moved = np.abs(new - share).max()
            share = new
            if moved < 1e-3:
                break
        return share, float(counts @ np.log(share @ p))

    def infer(self, text: str) -> tuple[str, float, list[tuple[str, float]]]:
        """The language, its score, and the selected languages with their shares."""
        return self.explain(text)[:3]

    def explain(self, text: str) -> tuple[str, float, list[tuple[str, float]], float]:
        """As ``infer``, and by how much the selected mixture's log likelihood is above that of the empty set."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, [], -1.0
        every = np.bincount(trigrams(text), minlength=BUCKETS)
        at = np.flatnonzero(every)
        counts, p = every[at].astype(np.float64), self.at(at)
        n = counts.sum()
        share, _ = self._fit(p, counts, np.full(len(p), 1 / len(p)))
        order = np.argsort(-share, kind="stable")
        chosen, best = np.ones(1), float(counts @ np.log(p[order[0]]))
        for k in range(2, len(p) + 1):
            start = np.maximum(share[order[:k]], 1e-3)
            fitted, fit = self._fit(p[order[:k]], counts, start / start.sum())
            if fit - best <= 0.5 * np.log(n) + MIN_GAIN * n:
                break
            chosen, best = fitted, fit
        first = int(np.argmax(chosen))
        found = [(self.languages[order[i]], float(s)) for i, s in enumerate(chosen)]
        return self.languages[order[first]], float(min(1.0, share[order[first]])), found, best + n * np.log(BUCKETS)


def train(docs: DataFrame, folds: int = FOLDS) -> Model:
    """From the text and non-null lang of the documents that are not held out."""
    prepare(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), folds)) \
        .select("text", "lang")
    counts = Saved(docs.sparkSession, "languages").small(
        labelled.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # Three numbers a language and bucket, of the pairs that occur.
    names = counts.select("lang").distinct().orderBy("lang").toArrow().column("lang").to_pylist()
    rows = counts.toArrow()
    place = {lang: i for i, lang in enumerate(names)}
    lang = rows.column("lang").combine_chunks().dictionary_encode()
    code = np.array([place[x] for x in lang.dictionary.to_pylist()], np.int64)
    language = code[lang.indices.to_numpy(zero_copy_only=False)] if len(code) else np.zeros(0, np.int64)
    return Model(names, language, rows.column("bucket").to_numpy().astype(np.int64), rows.column("n").to_numpy())


def _infer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.infer(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([",".join(f"{l}:{s:.3f}" for l, s in f[2]) for f in found], pa.string())],
                names=["doc_id", "held_out", "lang_pred", "score", "languages"])
    return run


def identify(docs: DataFrame, model: Model | None = None, folds: int = FOLDS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, languages (selected set with shares)."""
    model = model or train(docs, folds)
    return docs.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "text").mapInArrow(
        _infer(model), "doc_id long, held_out boolean, lang_pred string, score double, languages string")


def _known(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            yield batch.filter(pa.array([model.explain(t.as_py() or "")[3] > 0 for t in text], pa.bool_()))
    return run


def drop_unknown(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """The documents that the best mixture explains better than the empty set does, in all their columns; without
    anything to learn from, all that have a letter."""
    model = train(docs, folds)
    if not model.languages:
        return docs.where(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    return docs.mapInArrow(_known(model), docs.schema)
