"""Quality by co-training a text view and a metadata view.

The text view sees the words of a text (hashed, each once) and its style: shares of capitals, marks, numbers and repeated
words, in steps.  The metadata view sees language, source and length, never the text.  Both are logistic regressions,
calibrated on labelled documents that were kept aside (Platt scaling).  In every round each view labels for the other
one the unlabelled documents it is surest of: of each class the share ``HANDED`` of all unlabelled documents, by the
class's prior, as far as the view's log odds are ``MIN_LIFT`` beyond those of the prior.  Then both are fitted again; a
view that then explains the documents kept aside worse stays as it was.  A target's rounds end when, after the first, a
view has nothing to hand over, or both the same as before.  At last calibrated log odds are added, less the prior that both contain.

Texts are read once: the buckets of every document go to a table in the shared folder, two bytes a word.  A round reads
that table twice: tasks count the scores of all unlabelled documents in steps, which gives the bounds of the shares;
then they count, by bucket and class, the documents that a view is given.  A task sends its counts packed, one row for each
part of the buckets; they are summed in two steps.  The sums are exact and no larger than the model.  In the fit a
bucket's count stands for as many rows of that one bucket, and all given documents of a class together weigh at most
``GIVEN`` of its labelled ones, each the same.

Two targets are trained so: good quality, and toxic language.  A document is kept if it is likelier good than not and
likelier clean than toxic.

Only the labelled side is bounded: about ``LABELLED`` labelled doc_ids, chosen by a hash, with one row each.  Their
features, not their texts, come to the driver.  Labelled documents that are not chosen count as unlabelled.  All documents
are scored, over their whole texts, by a model of 2 x (TEXT_BUCKETS + META_BUCKETS) weights.

Defined cases: a null text is empty, null metadata is a value of its own, missing metadata columns count as null;
labels that are null are not learnt, several labels of a document are averaged and rounded half up; of a labelled doc_id
with several rows, that of the least buckets is learnt; a null doc_id is unlabelled; without labels of both classes a
target has score 0.5 for every document, and such a target drops none; repeated rows give a row each; an empty table
gives an empty result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare, text_of

LABELLED = 8000
ROUNDS = 3
HANDED = 0.05
GIVEN = 0.1
STEPS = 1 << 10   # of log odds from -REACH to REACH, in which the shares are bounded
REACH = 8.0
MIN_LIFT = 0.5
WORSE = 0.01
PART_BUCKETS = 1 << 12
TEXT_BUCKETS = 1 << 17
META_BUCKETS = 1 << 12
STYLE_STEPS = 10
EPOCHS = 100
RIDGE = 0.01
MIN_ROWS = 10
SURE = 2.0
META = ("lang", "source", "n_chars")

_EDGES = ".,!?;:'\"()[]{}$%&#*|"
_STYLES = ("capital", "mark", "number", "repeated", "long")


class Rows(NamedTuple):
    """Sparse rows of ones: row i has the buckets index[bounds[i]:bounds[i+1]]."""
    index: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def dot(self, weights: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(self)), np.diff(self.bounds))
        return np.bincount(row, weights=weights[self.index], minlength=len(self))

    def take(self, at: np.ndarray) -> Rows:
        sizes = np.diff(self.bounds)[at]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        index = self.index[np.arange(bounds[-1]) + np.repeat(self.bounds[:-1][at] - bounds[:-1], sizes)]
        return Rows(index, bounds)


def _hash(value: str, buckets: int) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(value.encode("utf-8", "surrogatepass")) % buckets


def text_rows(texts: pa.Array) -> Rows:
    """Buckets of the words and styles of each text."""
    words = pc.ascii_split_whitespace(texts)
    flat, doc = words.flatten(), pc.list_parent_indices(words).to_numpy().astype(np.int64)
    some = np.asarray(pc.not_equal(flat, "").to_numpy(zero_copy_only=False), bool)
    flat, doc = flat.filter(pa.array(some)).dictionary_encode(), doc[some]
    code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = flat.dictionary.to_pylist()
    inner = [w.strip(_EDGES) for w in distinct]
    room = TEXT_BUCKETS - len(_STYLES) * STYLE_STEPS
    bucket = np.fromiter((_hash(w.lower(), room) for w in inner), np.int64, len(inner))
    kinds = np.array([[len(w) > 1 and w.isupper() for w in inner], [len(w) - len(i) > 1 for w, i in zip(distinct, inner)],
                      [any(map(str.isdigit, w)) for w in distinct], [False] * len(inner),
                      [len(w) > 14 for w in inner]], float)
    n = np.bincount(doc, minlength=len(texts))
    # Each bucket once per text.
    pair = pa.array(doc * TEXT_BUCKETS + bucket[code]).dictionary_encode().dictionary.to_numpy()
    own_doc, own = pair // TEXT_BUCKETS, pair % TEXT_BUCKETS
    shares = [np.bincount(doc, weights=k[code], minlength=len(texts)) / np.maximum(n, 1) for k in kinds]
    shares[3] = 1 - np.bincount(own_doc, minlength=len(texts)) / np.maximum(n, 1)
    for i, s in enumerate(shares):
        step = np.minimum((np.sqrt(np.maximum(s, 0)) * STYLE_STEPS).astype(np.int64), STYLE_STEPS - 1)
        own_doc = np.concatenate((own_doc, np.arange(len(texts))))
        own = np.concatenate((own, room + i * STYLE_STEPS + step))
    order = np.argsort(own_doc, kind="stable")
    return Rows(own[order], np.concatenate(([0], np.cumsum(np.bincount(own_doc, minlength=len(texts))))))


def meta_rows(batch: pa.RecordBatch) -> Rows:
    values = []
    for lang, source, n_chars in zip(*(batch.column(c).to_pylist() for c in META)):
        size = "none" if n_chars is None else str(int(max(0, n_chars)).bit_length())
        values.append([_hash(v, META_BUCKETS) for v in (f"lang={lang}", f"source={source}", f"size={size}",
                                                        f"lang={lang} size={size}")])
    index = np.array(values, np.int64).reshape(-1)
    return Rows(index, np.arange(0, len(index) + 1, 4))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: Rows, y: np.ndarray, buckets: int, given: np.ndarray) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression by AdaGrad; both classes weigh the same.

    ``given[label]`` has the documents by bucket that the other view labelled so and, last, how many these are.
    Buckets of fewer than ``MIN_ROWS`` rows (fewer still in a small sample) get no weight, nor do those whose log odds
    ratio between the classes is within ``SURE`` standard errors of none: they are learnt by heart, not understood, and
    in long texts their noise adds up.
    """
    w, squares = np.zeros(buckets + 1), np.full(buckets + 1, 1e-8)
    own = np.array([(y == 0).sum(), (y > 0).sum()])
    label = np.repeat(y > 0, np.diff(rows.bounds))
    with_it = np.stack([np.bincount(rows.index[label == k], minlength=buckets) for k in (0, 1)]) + given[:, :-1]
    without = (own + given[:, -1])[:, None] - with_it
    odds = np.log((with_it + 0.5) / (np.maximum(without, 0) + 0.5))
    error = np.sqrt((1 / (with_it + 0.5) + 1 / (np.maximum(without, 0) + 0.5)).sum(axis=0))
    common = (with_it.sum(axis=0) >= max(2, min(MIN_ROWS, len(y) // 400))) & (np.abs(odds[1] - odds[0]) >= SURE * error)
    each = np.minimum(1, GIVEN * own / np.maximum(1, given[:, -1]))
    unit = 0.5 / np.maximum(1, own + each * given[:, -1])
    weight = unit[(y > 0).astype(np.int64)]
    bad, good = (unit * each)[:, None] * given[:, :-1]
    sizes = np.diff(rows.bounds)
    for _ in range(EPOCHS):
        g = (sigmoid(rows.dot(w[:-1]) + w[-1]) - y) * weight
        step = np.append(np.bincount(rows.index, weights=np.repeat(g, sizes), minlength=buckets) * common, g.sum())
        step[:-1] += (sigmoid(w[:-1] + w[-1]) * (bad + good) - good) * common
        step[:-1] += RIDGE * w[:-1]
        squares += step * step
        w -= 0.3 * step / np.sqrt(squares)
    return w


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log odds of y by z (Platt), by Newton's method with a small ridge."""
    scale = max(1e-9, float(np.std(z)))
    x = np.stack([z / scale, np.ones(len(z))], axis=1)
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y == 0).sum() + 2))
    b = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ b)
        gradient = x.T @ (p - target) + 1e-2 * b
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        b -= np.linalg.solve(hessian, gradient)
    return max(0.0, float(b[0])) / scale, float(b[1])


class Target(NamedTuple):
    """One target's two views, their calibrations (slope, intercept) and the log odds of the prior."""
    weights: tuple[np.ndarray, np.ndarray]
    scales: tuple[tuple[float, float], tuple[float, float]]
    prior: float

    def lift(self, view: int, rows: Rows) -> np.ndarray:
        """Log odds by one view, less those of the prior."""
        (slope, intercept), w = self.scales[view], self.weights[view]
        return slope * (rows.dot(w[:-1]) + w[-1]) + intercept - self.prior

    def probability(self, views: tuple[Rows, Rows]) -> np.ndarray:
        return sigmoid(self.prior + self.lift(0, views[0]) + self.lift(1, views[1]))


_SIZES = (TEXT_BUCKETS, META_BUCKETS)
Given = tuple[np.ndarray, np.ndarray]


def nothing_given() -> Given:
    """For each view, no documents by label and bucket."""
    return tuple(np.zeros((2, size + 1), np.int64) for size in _SIZES)


def _step(lift: np.ndarray) -> np.ndarray:
    return np.clip((lift + REACH) * (STEPS / (2 * REACH)), 0, STEPS - 1).astype(np.int64)


def score_counts(target: Target, views: tuple[Rows, Rows]) -> np.ndarray:
    """By view, the documents in each step of its lift."""
    return np.stack([np.bincount(_step(target.lift(v, views[v])), minlength=STEPS) for v in (0, 1)])


def bounds(target: Target, counts: np.ndarray) -> np.ndarray:
    """By view, up to which step documents are handed over as bad, and from which one as good: the share HANDED of the
    class, one step at least, and only on the class's own side of the prior."""
    low, high = (int(x) for x in _step(np.array([-MIN_LIFT, MIN_LIFT])))
    out = np.zeros((2, 2), np.int64)
    share = HANDED * counts.sum(axis=1) * 1.0
    good = float(sigmoid(np.array([target.prior]))[0])
    for v in (0, 1):
        up = np.flatnonzero(counts[v, high:])[::-1] + high
        down = np.flatnonzero(counts[v, :low + 1])
        out[v] = -1, STEPS
        if len(up):
            enough = np.cumsum(counts[v, up]) <= share[v] * good
            out[v, 1] = up[max(0, enough.sum() - 1)]
        if len(down):
            enough = np.cumsum(counts[v, down]) <= share[v] * (1 - good)
            out[v, 0] = down[max(0, enough.sum() - 1)]
    return out


def add_confident(target: Target, limits: np.ndarray, views: tuple[Rows, Rows], given: Given) -> None:
    """Count in ``given`` the documents that a view is sure of, by the buckets of the other view, which learns them."""
    for v in (0, 1):
        step = _step(target.lift(v, views[v]))
        for label, sure in enumerate((step <= limits[v, 0], step >= limits[v, 1])):
            at = np.flatnonzero(sure)
            if len(at):
                other = given[1 - v][label]
                other[:-1] += np.bincount(views[1 - v].take(at).index, minlength=_SIZES[1 - v])
                other[-1] += len(at)


def learn(views: tuple[Rows, Rows], y: np.ndarray, aside: np.ndarray, given: Given) -> Target | None:
    """``y`` of the labelled rows; those ``aside`` calibrate, the others train.  None without both classes."""
    train_at, check = np.flatnonzero(~aside), np.flatnonzero(aside)
    if len(set(y[train_at].tolist())) < 2 or len(set(y[check].tolist())) < 2:
        return None
    weights = tuple(fit(views[v].take(train_at), y[train_at], _SIZES[v], given[v]) for v in (0, 1))
    scales = tuple(calibrate(views[v].take(check).dot(weights[v][:-1]) + weights[v][-1], y[check]) for v in (0, 1))
    share = float(np.clip(y[check].mean(), 1e-3, 1 - 1e-3))
    return Target(weights, scales, float(np.log(share / (1 - share))))


class Labelled(NamedTuple):
    views: tuple[Rows, Rows]
    y: np.ndarray
    aside: np.ndarray


def co_train(known: list[Labelled], count_scores, count_given, log: list | None = None) -> list[Target | None]:
    """A target for each of ``known``.  ``count_scores(targets)`` has ``score_counts`` over all unlabelled documents,
    ``count_given(targets, limits)`` what ``add_confident`` gives over them, both by target; None has no part in it.
    ``log`` gets, for each round, by target how many documents each view was given of each label."""
    given: list[Given] = [nothing_given() for _ in known]
    targets = [learn(*k, g) for k, g in zip(known, given)]
    running = list(targets)
    for turn in range(ROUNDS):
        if not any(running):
            break
        limits = [bounds(t, c) if t else None for t, c in zip(running, count_scores(running))]
        new = count_given(running, limits)
        for i, t in enumerate(running):
            # A view may begin with nothing to hand over; later this ends the exchange, as do the same labels again.
            nothing = [not g[:, -1].any() for g in new[i]]
            if t is None or all(nothing) or turn and any(nothing) or all((a == b).all() for a, b in zip(given[i], new[i])):
                running[i] = None
                continue
            given[i] = new[i]
            running[i] = targets[i] = better(t, learn(*known[i], new[i]), known[i])
        if log is not None:
            log.append([[g[:, -1].tolist() for g in new[i]] if t else None for i, t in enumerate(running)])
    return targets


def better(old: Target, new: Target, known: Labelled) -> Target:
    """Of each view the refitted form, unless its log loss on the documents kept aside is greater by more than ``WORSE``."""
    at = np.flatnonzero(known.aside)
    rows, y = [v.take(at) for v in known.views], known.y[at]

    def loss(target: Target, v: int) -> float:
        z = target.prior + target.lift(v, rows[v])
        return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())
    pick = [new if loss(new, v) <= loss(old, v) + WORSE else old for v in (0, 1)]
    return Target(tuple(p.weights[v] for v, p in enumerate(pick)), tuple(p.scales[v] for v, p in enumerate(pick)), old.prior)


def _pack(rows: Rows) -> pa.Array:
    """Each row's buckets, ascending: how many are below 65,536 (four bytes), then the low two bytes of each."""
    out = []
    for a, b in zip(rows.bounds[:-1].tolist(), rows.bounds[1:].tolist()):
        ids = np.sort(rows.index[a:b])
        out.append(int(np.searchsorted(ids, 1 << 16)).to_bytes(4, "little") + (ids & 0xFFFF).astype("<u2").tobytes())
    return pa.array(out, pa.binary())


def _unpack(values: pa.Array) -> Rows:
    if not len(values):
        return Rows(np.zeros(0, np.int64), np.zeros(1, np.int64))
    lengths = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    data = np.frombuffer(b"".join(values.to_pylist()), "<u2").astype(np.int64)
    start = np.cumsum(lengths) - lengths
    low = data[start] | data[start + 1] << 16
    inside = np.ones(len(data), bool)
    inside[start] = inside[start + 1] = False
    bounds = np.concatenate(([0], np.cumsum(lengths - 2)))
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths - 2)
    return Rows(data[inside] + (place >= np.repeat(low, lengths - 2)) * (1 << 16), bounds)


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple[Rows, Rows]]]:
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            yield batch, (_unpack(batch.column("words")), _unpack(batch.column("meta")))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _pack(text_rows(batch.column("text"))), _pack(meta_rows(batch))],
                names=["doc_id", "words", "meta"])


def _count_scores(targets: list[Target | None]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(targets), 2, STEPS), np.int64)
        for _, views in _views(batches):
            for i, t in enumerate(targets):
                if t:
                    counts[i] += score_counts(t, views)
        yield _counted(dict(enumerate(counts.reshape(-1, STEPS))))
    return run


def _counted(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    """A row for each part with counts: two bytes for the place and eight for the number of each that isn't zero."""
    parts, packed = [], []
    for part, own in counts.items():
        at = np.flatnonzero(own)
        if len(at):
            parts.append(part)
            packed.append(at.astype("<u2").tobytes() + own[at].astype("<i8").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])


def _uncounted(packed: bytes, size: int) -> np.ndarray:
    n, out = len(packed) // 10, np.zeros(size, np.int64)
    out[np.frombuffer(packed, "<u2", n)] = np.frombuffer(packed, "<i8", n, 2 * n)
    return out


def _add_counts(rows: pa.Table) -> pa.Table:
    """Sum of one part's packed counts; other columns are equal in all rows."""
    total = sum(_uncounted(c.as_py(), PART_BUCKETS) for c in rows.column("counts"))
    at = rows.schema.get_field_index("counts")
    return rows.slice(0, 1).set_column(at, "counts", _counted({0: total}).column("counts"))


def _count_given(targets: list[Target | None], limits: list):
    """Packed counts of what ``add_confident`` gives, a row for each PART_BUCKETS buckets that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [nothing_given() for _ in targets]
        for _, views in _views(batches):
            for t, limit, counts in zip(targets, limits, given):
                if t:
                    add_confident(t, limit, views, counts)
        yield _counted({((i * 2 + v) * 2 + label) * TEXT_BUCKETS * 2 + first: own[first:first + PART_BUCKETS]
                        for i, pair in enumerate(given) for v, by_label in enumerate(pair)
                        for label, own in enumerate(by_label) for first in range(0, len(own), PART_BUCKETS)})
    return run


def _score(targets: list[Target | None]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, views in _views(batches):
            half = np.full(batch.num_rows, 0.5)
            good, toxic = (t.probability(views) if t else half for t in targets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(good), pa.array(toxic), pa.array((good >= 0.5) & (toxic <= 0.5))],
                names=["doc_id", "quality_score", "toxic_score", "kept"])
    return run


def _inputs(docs: DataFrame) -> DataFrame:
    kinds = {"lang": "string", "source": "string", "n_chars": "long"}
    meta = [(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]
    return docs.select("doc_id", text_of().alias("text"), *meta)


def _chosen(rows: DataFrame, count: int, bound: int, seed: int) -> DataFrame:
    """About ``bound`` of ``count`` rows, by a hash of doc_id."""
    share = min(1.0, bound / max(1, count))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(F.col("doc_id").isNotNull() & (place < share))


class Unlabelled:
    """The features of the unlabelled documents, and what a round needs of them."""

    def __init__(self, features: DataFrame, targets: int):
        self.features, self.targets = features, targets
        # Rows of about as many tasks are summed together in each of the two steps.
        self.groups = max(1, round(int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5))

    def _sum(self, count) -> Iterator[tuple[int, bytes]]:
        rows = self.features.mapInArrow(count, "part int, counts binary")
        half = rows.select("*", F.pmod(F.spark_partition_id(), F.lit(self.groups)).alias("of")) \
            .groupBy("part", "of").applyInArrow(_add_counts, "part int, counts binary, of int")
        table = half.select("part", "counts").groupBy("part").applyInArrow(_add_counts, "part int, counts binary").toArrow()
        return zip(table.column("part").to_pylist(), table.column("counts").to_pylist())

    def count_scores(self, targets: list[Target | None]) -> np.ndarray:
        out = np.zeros((self.targets * 2, STEPS), np.int64)
        for part, counts in self._sum(_count_scores(targets)):
            out[part] = _uncounted(counts, STEPS)
        return out.reshape(self.targets, 2, STEPS)

    def count_given(self, targets: list[Target | None], limits: list) -> list[Given]:
        """At most a number for each target, view, label and bucket reaches the driver."""
        given = [nothing_given() for _ in targets]
        for part, counts in self._sum(_count_given(targets, limits)):
            which, first = divmod(part, TEXT_BUCKETS * 2)
            own = given[which // 4][which // 2 % 2][which % 2][first:first + PART_BUCKETS]
            own[:] = _uncounted(counts, PART_BUCKETS)[:len(own)]
        return given


def features_of(docs: DataFrame) -> DataFrame:
    """(doc_id, words, meta): the packed buckets of every row, written to the shared folder."""
    prepare(docs.sparkSession)
    return Saved(docs.sparkSession, "quality-features").table(
        _inputs(docs).mapInArrow(_features, "doc_id long, words binary, meta binary"))


def train(features: DataFrame, labels: DataFrame, log: list | None = None) -> list[Target | None]:
    """The targets good quality and toxic, from ``labels(doc_id, quality, toxic)``."""
    one = labels.groupBy("doc_id").agg(*[F.floor(F.avg(c) + 0.5).cast("int").alias(c) for c in ("quality", "toxic")])
    few = Saved(features.sparkSession, "quality").small(_chosen(one, one.count(), LABELLED, 1).limit(2 * LABELLED))
    # At most 2 x LABELLED rows of three numbers are broadcast, and as many documents' features come to the driver.
    known = features.join(F.broadcast(few), "doc_id").groupBy("doc_id", "quality", "toxic") \
        .agg(F.min(F.struct("words", "meta")).alias("row"))
    aside = (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)) == 0).alias("aside")
    rows = known.select("quality", "toxic", aside, "row.words", "row.meta").toArrow()
    labelled = []
    for c in ("quality", "toxic"):
        part = rows.filter(rows.column(c).is_valid())
        views = tuple(_unpack(part.column(v).combine_chunks()) for v in ("words", "meta"))
        labelled.append(Labelled(views, part.column(c).to_numpy().astype(np.float64),
                                 part.column("aside").to_numpy().astype(bool)))
    free = Unlabelled(features.join(F.broadcast(few.select("doc_id")), "doc_id", "left_anti"), len(labelled))
    return co_train(labelled, free.count_scores, free.count_given, log)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, quality_score, toxic_score (0 to 1), kept."""
    features = features_of(docs)
    targets = train(features, labels)
    return features.mapInArrow(_score(targets), "doc_id long, quality_score double, toxic_score double, kept boolean")
