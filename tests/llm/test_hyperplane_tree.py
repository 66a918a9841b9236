"""Hard negatives against a scan of all rows."""
import math

import numpy as np
import pytest

from clipstar.llm import hyperplane_tree as T

ROWS = "vec_id long, embedding array<double>, label int"


def brute(rows):
    data = []
    for i, v, label in rows:
        if label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        row = (i, tuple(math.floor(256 * x) for x in v), label)
        if row not in data:
            data.append(row)
    last = (1 << 63) - 1
    order = lambda s: (-s[0], last if s[1] is None else s[1])
    out = []
    for i, v, label in data:
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in data if j != i]
        positives = sorted((s for s in scores if s[2] == label), key=order)[:5]
        for p, j, _ in positives:
            inside = sorted((s for s in scores if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:5]
            out += [(i, j, k + 1, s[1], p, s[0]) for k, s in enumerate(inside)]
    return sorted(out, key=repr)


def result(spark, rows):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    return sorted((tuple(r) for r in T.mine(df).collect()), key=repr)


def some_rows(seed, n, dim, hot=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    vectors = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * 0.4
    vectors[:hot] = vectors[0]
    return [(int(i * 5), v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(vectors)]


def test_equals_a_scan(spark):
    rows = some_rows(1, 500, 6)
    got = result(spark, rows)
    assert got == brute(rows) and len(got) > 200


def test_many_cells_blocks_and_a_hot_vector(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 40), ("BLOCK_FLOATS", 6 * 256), ("CHUNK", 3), ("LEAF_ROWS", 20)):
        monkeypatch.setattr(T, name, value)
    rows = some_rows(2, 900, 6, hot=300)
    rows += [(i + 1, rows[0][1], 2) for i in range(0, 400, 4)]
    assert result(spark, rows) == brute(rows)


def test_ties_negative_scores_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 9), (100, [-1.0, 0.0], 1), (200, [0.0, 0.0], 0), (300, [1.0, 2.0, 3.0], 0), (400, [], 0)]
    rows += [(i, [1.0, 0.0], i % 3) for i in range(1, 30)] + [(30 + i, [0.9, 0.1], i % 3) for i in range(20)]
    rows += [(500, None, 1), (600, [nan, 1.0], 1), (700, [inf, 1.0], 1), (800, [None, 1.0], 1), (900, [1.0, 1.0], None),
             (1000, [1e30, 1.0], 1), (None, [1.0, 0.0], 0), (None, [1.0, 0.0], 1), (7, [0.5, 0.5], -1)]
    rows += [rows[5]] * 4
    assert result(spark, rows) == brute([r for r in rows if r[0] != 1000])


def test_whole_numbers_beyond_doubles(spark):
    big = float((1 << 30) - 1) / 256
    rows = [(100, [big, big, 1 / 256], 1), (1, [big, big, 2 / 256], 1), (2, [big, big, 1 / 256], 2), (3, [big, big, 0.0], 2)]
    assert result(spark, rows) == brute(rows)


def test_no_anchors_no_rows_and_clashing_columns(spark):
    schema = ROWS + ", q long, cell int, vector string, tree binary"
    rows = [(r[0], r[1], r[2], 1, 1, "", b"") for r in some_rows(3, 60, 4)]
    df = spark.createDataFrame(rows, schema)
    assert sorted((tuple(r) for r in T.mine(df).collect()), key=repr) == brute([r[:3] for r in rows])
    assert T.mine(df.where("vec_id % 100 > 0")).collect() == []
    assert T.mine(df.limit(0)).collect() == []


@pytest.mark.parametrize("leaf_rows", [5, 64])
def test_visits_leave_out_nothing(leaf_rows):
    rng = np.random.default_rng(4)
    rows = rng.integers(-300, 300, (700, 5)).astype(float)
    norm = (rows ** 2).sum(axis=1).max()
    tree = T.Tree(T.augmented(rows, norm), leaf_rows)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(700)) and len(tree.leaves) > 5
    leaf = tree.route(T.augmented(rows, norm))
    assert all((leaf[own] == i).all() for i, own in enumerate(tree.leaves))
    anchors = rows[:20]
    scores = anchors @ rows.T
    high = np.sort(scores, axis=1)[:, -20]
    own = (anchors ** 2).sum(axis=1)
    near, far = np.sqrt(np.maximum(own + norm - 2 * high, 0)), np.sqrt(own + norm - 2 * (high - 2000))
    query = np.concatenate((anchors, np.zeros((20, 1))), axis=1)
    seen = {(a, r) for i, at in tree.visits(query, lambda at: (near[at], far[at])) for a in at.tolist()
            for r in tree.leaves[i].tolist()}
    inside = (scores <= high[:, None]) & (scores >= high[:, None] - 2000)
    assert set(zip(*(x.tolist() for x in np.nonzero(inside)))) <= seen
    assert len(seen) < 20 * 700
