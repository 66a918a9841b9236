"""Near duplicates among embeddings against all pairs."""
import numpy as np
import pytest

from clipstar.llm import flat_graph as G

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, limit=0.9):
    """vec_id -> (n_links, component_id) of rows with different ids."""
    good = [(i, np.array(v, float)) for i, v in rows
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _ in rows}
    if good:
        dim = max(len(v) for _, v in good)
        units = np.stack([np.pad(v, (0, dim - len(v))) for _, v in good])
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(units @ units.T >= limit)):
            if a != b:
                links[good[a][0]].add(good[b][0])
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(links[i]), min(seen))
    return out


def clustered(rng, n, dim, clusters, spread):
    centres = rng.normal(size=(clusters, dim))
    pick = rng.integers(0, clusters, n)
    return centres[pick] + rng.normal(size=(n, dim)) * spread


def result(spark, rows, partitions=4):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], ROWS).repartition(partitions)
    got = G.near_duplicates(df).collect()
    assert len(got) == len(rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}, got


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    vectors = np.concatenate([clustered(rng, 300, 16, 25, 0.25), rng.normal(size=(300, 16))]).astype(np.float32)
    vectors[50:90] = vectors[7]                       # a large group of equal vectors
    vectors[100] = vectors[3] * 5                     # the same direction, another length
    rows = [(i * 3, v.tolist()) for i, v in enumerate(vectors)]
    want = brute(rows)
    got, full = result(spark, rows)
    assert sum(n for n, _ in want.values()) > 1000
    assert got == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in full)
    assert {r["audited_recall"] for r in full} == {1.0}


def test_many_cells_blocks_and_a_hot_cluster(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 60), ("BLOCK_FLOATS", 8 * 256), ("AUDIT_ROWS", 200), ("_CORE", 8)):
        monkeypatch.setattr(G, name, value)
    rng = np.random.default_rng(2)
    vectors = np.concatenate([clustered(rng, 400, 8, 60, 0.1), clustered(rng, 500, 8, 1, 0.12)]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    want = brute(rows)
    got, _ = result(spark, rows)
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.95 * links
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.95 * len(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0]), (10, [0.0, -1.0]), (11, [1e-30, 0.0]), (12, [3e38, 0.0])]
    want = brute(rows[:10]) | {}
    got, full = result(spark, rows)
    assert got[1] == (4, 1) and got[9] == (4, 1) and got[11] == (4, 1) and got[12] == (4, 1)
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 10))
    assert want[2][1] == got[2][1] == 1
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in full)


def test_null_ids_repeats_clashing_columns_and_empty_tables(spark):
    schema = ROWS + ", node long, vector string, unit string, cell int"
    rows = [(None, [1.0, 0.0], 1, 1, "", "", 1), (4, [1.0, 0.01], 1, 1, "", "", 1), (4, [1.0, 0.01], 1, 1, "", "", 1),
            (None, [0.0, 1.0], 1, 1, "", "", 1)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in G.near_duplicates(df).collect()),
                 key=repr)
    assert got == sorted([(4, 2, 4, True), (4, 2, 4, True), (None, 2, 4, False), (None, 0, None, False)], key=repr)
    assert G.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 65, 900])
def test_graph_reaches_what_is_near(n):
    rng = np.random.default_rng(n)
    vectors = clustered(rng, n, 12, max(1, n // 8), 0.1)
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    graph = G.build_graph(vectors)
    assert graph.neighbours.shape == (n, G.DEGREE)
    q, node = graph.search(vectors, G.BEAM, 0.9)[2]
    found = {(a, b) for a, b in zip(q.tolist(), node.tolist())}
    assert len(found) == len(q)
    true = set(zip(*(x.tolist() for x in np.nonzero(vectors @ vectors.T >= 0.9))))
    assert len(found & true) >= 0.97 * len(true) and not found - {(a, b) for a, b in found if
                                                                 vectors[a] @ vectors[b] >= 0.9 - 1e-5}


def test_robust_pruning_drops_what_a_nearer_neighbour_covers():
    vectors = np.array([[1, 0], [0.99, 0.14], [0.98, 0.2], [0, 1]], np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    near = np.array([[3, 2, 1, -1]])
    sims = np.array([[vectors[0] @ vectors[i] for i in (3, 2, 1)] + [-2]], np.float32)
    kept = [i for i in G.robust_prune(vectors, near, sims, 4)[0] if i >= 0]
    assert kept[0] == 1 and 2 not in kept
