import random

import numpy as np
import pyarrow as pa

from clipstar.llm import quality
from clipstar.llm.common import read

DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality string, toxic string, aside string"
LABELS = "doc_id long, quality int, toxic int, text string"


def frames(spark, docs, labels):
    return (spark.createDataFrame([(i, t, g, s, n, "a", "b", "c") for i, t, g, s, n in docs], DOCS),
            spark.createDataFrame([(*r, "x") for r in labels], LABELS))


def corpus(n=400):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(150)]
    docs, labels = [], []
    for i in range(n):
        good, rude = i % 3 > 0, i % 5 == 0
        body = [rng.choice(words) for _ in range(60)]
        if not good:
            body = [w.upper() + "!!" for w in body]
        if rude:
            body[rng.randrange(60)] = "idiot"
            body[rng.randrange(60)] = "moron"
        docs.append((i, " ".join(body), "en", "spam" if not good and i % 2 else "site", len(body)))
        if i % 4:
            labels.append((i, int(good), int(rude)))
    return docs, labels


def test_both_targets_are_learnt_and_clean_documents_stay(spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in quality.score(*frames(spark, docs, labels)).collect()}
    assert len(got) == len(docs)
    unseen = [i for i in got if i % 4 == 0]
    assert np.mean([(got[i].quality_score >= 0.5) == (i % 3 > 0) for i in unseen]) > 0.95
    assert np.mean([(got[i].toxic_score > 0.5) == (i % 5 == 0) for i in unseen]) > 0.9
    clean = [i for i in unseen if i % 3 and i % 5]
    assert np.mean([got[i].kept for i in clean]) > 0.95


def test_accuracy_on_the_documents_table(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    from pyspark.sql import functions as F

    known = labels.where(F.col("doc_id") % 3 > 0)
    asked = {r.doc_id: r.quality for r in labels.where(F.col("doc_id") % 3 == 0).collect()}
    got = {r.doc_id: r for r in quality.score(docs, known).collect()}
    assert got.keys() == {r.doc_id for r in docs.select("doc_id").collect()}
    right = [(got[i].quality_score >= 0.5) == (q == 1) for i, q in asked.items()]
    assert np.mean(right) > 0.9
    assert np.mean([got[i].quality_score >= 0.5 for i, q in asked.items() if q]) > 0.95


def train_here(known, pool, log=None):
    """Co-training with the unlabelled documents in ``pool`` instead of a table."""
    def count_given(targets, limits):
        given = quality.nothing_given()
        quality.add_confident(targets[0], limits[0], pool, given)
        return [given]
    return quality.co_train([known], lambda targets: [quality.score_counts(targets[0], pool)], count_given, log)[0]


def test_views_exchange_labels():
    rng = np.random.default_rng(1)
    n = 400
    y = (np.arange(n) % 2).astype(float)
    word = [["good" if v else "bad", f"w{rng.integers(20)}"] for v in y]
    text = quality.text_rows(pa.array([" ".join(w) for w in word]))
    meta = quality.meta_rows(pa.RecordBatch.from_pydict({
        "lang": ["en"] * n, "source": ["a" if v else "b" for v in y], "n_chars": [5] * n}))
    odd_text = quality.text_rows(pa.array(["new" if v else "old" for v in y]))
    target = train_here(quality.Labelled((text, meta), y, np.arange(n) // 2 % 4 == 0), (odd_text, meta))
    # The text view has "new" and "old" from the metadata view's labels of the pool only.
    p = quality.text_rows(pa.array(["new", "old"])).dot(target.weights[0][:-1])
    assert p[0] > p[1]


def test_odd_rows_and_missing_labels(spark):
    docs, labels = corpus(120)
    docs += [(900, None, None, None, None), (901, "", "en", "s", -3), (None, "text", "en", "s", 4), docs[0], docs[0],
             (902, "w " * 50_000, "en", "s", 100_000)]
    labels += [(1, None, None), (None, 1, 0), (2, 0, 1), (99999, 1, 1)]
    d, l = frames(spark, docs, labels)
    got = quality.score(d, l).collect()
    assert len(got) == len(docs) and all(0 <= r.quality_score <= 1 and 0 <= r.toxic_score <= 1 for r in got)
    assert len({(r.quality_score, r.toxic_score) for r in got if r.doc_id == 0}) == 1
    bare = quality.score(d.select("doc_id", "text"), l.where("false")).collect()
    assert {(r.quality_score, r.toxic_score, r.kept) for r in bare} == {(0.5, 0.5, True)}
    assert quality.score(d.where("false"), l).collect() == []


def test_every_unlabelled_document_reaches_the_other_view(spark):
    docs, labels = [], []
    for i in range(9000):
        good = i % 2
        # Only the source of unlabelled documents tells their class; two words are in a few of them each.
        words = f"{'fine' if good else 'poor'} w{i % 7}" if i < 400 else f"{'rareup' if good else 'raredown'} w{i % 7}" \
            if i >= 8970 else f"w{i % 7} w{i % 5}"
        docs.append((i, words, "en", "a" if good else "b", 10))
        if i < 400:
            labels.append((i, good, 0))
    d, l = frames(spark, docs, labels)
    target, _ = quality.train(quality.features_of(d), l)
    p = quality.text_rows(pa.array(["rareup", "raredown"])).dot(target.weights[0][:-1])
    w = target.weights[0]
    up, down = (quality._hash(x, quality.TEXT_BUCKETS - 50) for x in ("rareup", "raredown"))
    assert w[up] > 0 > w[down] and p[0] > p[1]


def test_both_views_receive_labels_on_the_given_tables(spark, monkeypatch):
    sf = "/root/testdata/sf0.1"
    features, labels, log = quality.features_of(read(spark, sf, "documents")), read(spark, sf, "labels"), []
    target = quality.train(features, labels, log)[0]
    rounds = [r[0] for r in log if r[0]]
    assert rounds and all(sum(by_label) > 0 for r in rounds for by_label in r)
    monkeypatch.setattr(quality, "ROUNDS", 0)
    alone = quality.train(features, labels)[0]
    assert np.abs(target.weights[0] - alone.weights[0]).max() > 0.01


def test_rounds_in_tasks_equal_rounds_here(spark, monkeypatch):
    """The packed counts of many tasks against counting all rows at once."""
    docs, labels = corpus(600)
    d, l = frames(spark, docs, labels[::3])
    monkeypatch.setattr(quality, "PART_BUCKETS", 1 << 10)
    log, here = [], []
    features = quality.features_of(d.repartition(7))
    got = quality.train(features, l, log)[0]
    ids = {i for i, _, _ in labels[::3]}
    by_id = {r[0]: r for r in docs}
    pick = lambda keep: [by_id[i] for i in sorted(by_id) if keep(i)]

    def views(rows):
        meta = pa.RecordBatch.from_pydict({"lang": [r[2] for r in rows], "source": [r[3] for r in rows],
                                           "n_chars": [r[4] for r in rows]})
        return quality.text_rows(pa.array([r[1] for r in rows])), quality.meta_rows(meta)
    known = pick(lambda i: i in ids)
    aside = {r.doc_id: r.a for r in spark.sql(
        "select id as doc_id, pmod(xxhash64(id, 2), 4) = 0 as a from range(600)").collect()}
    y = {i: q for i, q, _ in labels}
    want = train_here(quality.Labelled(views(known), np.array([float(y[r[0]]) for r in known]),
                                       np.array([aside[r[0]] for r in known])), views(pick(lambda i: i not in ids)), here)
    assert [r[0] for r in log if r[0]] == [r[0] for r in here if r[0]]
    assert np.allclose(got.weights[0], want.weights[0], atol=1e-6)


def test_packed_features_come_back():
    texts = pa.array(["", "a b c a", " ".join(f"w{i}" for i in range(5000))])
    rows = quality.text_rows(texts)
    back = quality._unpack(quality._pack(rows))
    assert (back.bounds == rows.bounds).all()
    for a, b in zip(rows.bounds[:-1], rows.bounds[1:]):
        assert sorted(rows.index[a:b]) == back.index[a:b].tolist()
    assert len(quality._unpack(quality._pack(quality.text_rows(pa.array([], pa.string()))))) == 0


def test_one_row_of_a_repeated_labelled_document_is_learnt(spark):
    docs, labels = corpus(200)
    many = docs + [(labels[0][0], f"text {i}", "en", "s", i) for i in range(300)]
    d, l = frames(spark, many, labels)
    got = quality.score(d, l).collect()
    assert len(got) == len(many)
