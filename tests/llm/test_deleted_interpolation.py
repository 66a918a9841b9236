import math
import random
import re
import zlib

import numpy as np

from clipstar.llm import deleted_interpolation as lm
from clipstar.llm.common import read

SCHEMA = "doc_id long, text string, lang string, chunk string, part string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z") for i, t in rows], SCHEMA)


def tokens(text):
    lowered = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lowered), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def base_scores(rows):
    c, total = {}, 0
    for i, t in rows:
        if not held(i):
            for w in tokens(t):
                c[w] = c.get(w, 0) + 1
                total += 1
    out = []
    for i, t in rows:
        ws = tokens(t)
        out.append((i, held(i), len(ws), sum(w in c for w in ws), total,
                    round(sum(math.log10((c.get(w, 0) + 1) / (total + len(c) + 1)) for w in ws), 6)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(1)
    words = ["the", "The", "İs", "été", "ÉTÉ", "a\x1cb", "x.", "dog", "runs", "fast", "日本"] + [f"w{i}" for i in range(200)]
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(rng.choice(words[:rng.choice([5, 40, 211])])
                                                     for _ in range(rng.randint(0, 60)))) for i in range(300)]
    return rows + [(900, None), (901, ""), (902, " \n "), (None, "the dog"), (903, " lead trail "), (903, " lead trail "),
                   (904, "long text " * 4000)]


def test_base_score_matches_brute_force(spark):
    rows = cases()
    for chunk_bytes in (1 << 20, 700):
        got = lm.score(frame(spark, rows).repartition(3), chunk_bytes).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                       for r in got), key=str) == base_scores(rows)


def test_score_does_not_depend_on_chunks_and_matches_the_formula(spark):
    rows = cases()
    a, b = (sorted((str(r.doc_id), r.n_tokens, round(r.score, 6)) for r in lm.score(frame(spark, rows), n).collect())
            for n in (1 << 20, 900))
    assert a == b
    uni, bi, n = {}, {}, 0
    for i, t in rows:
        if not held(i):
            last = None
            for w in tokens(t):
                uni[w] = uni.get(w, 0) + 1
                bi[last, w] = bi.get((last, w), 0) + 1
                n, last = n + 1, w
    seen = [weights_seen(spark, rows)]
    weights, types = seen[0]
    assert types == len(uni)
    want = []
    for i, t in rows:
        total, last = 0.0, None
        for w in tokens(t):
            c = uni.get(last, 0)
            l2, l1, l0 = weights[min(c.bit_length(), lm.BUCKETS - 1)]
            total += math.log10((l2 * bi.get((last, w), 0) / c if c else 0) + l1 * uni.get(w, 0) / n + l0 / (types + 1))
            last = w
        want.append((str(i), len(tokens(t)), round(total, 6)))
    assert a == sorted(want)


def weights_seen(spark, rows):
    kept = {}
    learn = lm.learn_weights

    def keep(cell, events, types):
        kept["x"] = (learn(cell, events, types), types)
        return kept["x"][0]
    lm.learn_weights = keep
    try:
        lm.score(frame(spark, rows))
    finally:
        lm.learn_weights = learn
    return kept["x"]


def test_weights_follow_the_data():
    q = lambda p: int(lm._level(np.array([p]))[0])
    cell = [(5 * lm._LEVELS + q(0.5)) * lm._LEVELS + q(0.001), (1 * lm._LEVELS + q(0.0)) * lm._LEVELS + q(0.01)]
    w = lm.learn_weights(np.array(cell), np.array([1000, 1000]), 10_000)
    assert np.allclose(w.sum(axis=1), 1) and w[5, 0] > 0.9 and w[1, 0] < 1e-6 < w[1, 1]


def test_model_beats_the_base_on_held_out_documents(spark):
    got = [r for r in lm.score(read(spark, "/root/testdata/sf0.01", "documents")).collect() if r.held_out]
    assert len(got) > 50 and sum(r.score for r in got) > sum(r.base_score for r in got)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_no_training_and_empty(spark):
    only = next(i for i in range(100) if held(i))
    r = lm.score(frame(spark, [(only, "some words")])).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and r.score <= 0
    assert lm.score(frame(spark, [])).collect() == []


def test_keys_survive_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 1000):
        keys = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert np.array_equal(lm.unpack_keys(lm.pack_keys(keys)), keys)
