"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Components become floor(256 x); a score is the integer inner product.  A coordinate that gives all rows the same norm turns
scores into distances: with the largest squared norm M and an anchor q, d^2 = |q|^2 + M - 2 * score.  A window of scores is
an annulus around the anchor.

The tree: a node has ``FAN_OUT`` split points, far from each other; a row goes to the subtree of the nearest one.  For every
two subtrees i and j the node has the least and the greatest distance from split point i to the rows below j.  A search
measures the anchor's distance to all split points of a node and leaves out each subtree in which, by the triangle
inequality and some split point's range, no row can lie in the annulus.  The rows of the leaves that remain are scored
exactly.  The annulus narrows as results come in.

The upper tree is fitted on ``SAMPLE_FLOATS`` numbers of rows and has at most ``MAX_CELLS`` leaves; all rows are routed
through it, and its ranges are taken over all rows.  Its leaves are cells, cut by a hash into blocks of about
``BLOCK_FLOATS`` numbers; each block has a lower tree.  An anchor first looks into one block of its own cell, which gives
the bound for the search in the other cells.  Anchors of one block come in bounded lists, so no task holds all of them.

Rows with equal label and vector are a class of which only the first 6 ids take part: no result has more of one class
(5, and the anchor itself).  Anchors with equal label and vector are searched once.

Defined cases: rows with a null label, a null vector, a null or non-finite component, or a component that doesn't fit 31
bits after the multiplication take no part; rows that repeat vec_id, label and vector are one row, and rows that share a
vec_id only are never each other's positives; rows without a vec_id come last among equal scores; a vector that is
shorter than others ends in zeros; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare

POSITIVES = 5
NEGATIVES = 5
ANCHOR_EVERY = 100
FAN_OUT = 16
LEAF_ROWS = 64
CELL_ROWS = 2048
MAX_CELLS = 4096
SAMPLE_FLOATS = 1 << 21
BLOCK_FLOATS = 1 << 20
CHUNK = 256  # anchors of a list
_NO_ID = (1 << 63) - 1
_LOW, _HIGH = -(1 << 62), 1 << 62


class Node(NamedTuple):
    """Children are nodes, or leaves as -1 - leaf.  nearest[i, j] and farthest[i, j]: from point i to rows below child j."""
    points: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray
    children: list[int]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def split_points(rows: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Up to ``count`` different rows, each the farthest from those before it among three times as many."""
    some = rows[rng.choice(len(rows), min(len(rows), 3 * count), replace=False)]
    chosen, gap = [0], distances(some, some[:1])[:, 0]
    while len(chosen) < min(count, len(some)) and gap.max() > 1e-6 * (1 + np.abs(some).max()):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(some, some[chosen[-1:]])[:, 0])
    return some[chosen]


class Tree:
    """Nodes over augmented rows; ``leaves`` has the rows of each leaf."""

    def __init__(self, rows: np.ndarray, leaf_rows: int, max_leaves: int | None = None):
        self.nodes: list[Node] = []
        self.leaves: list[np.ndarray] = []
        self.scale = float(np.sqrt((rows * rows).sum(axis=1).max(initial=0)))
        rng = np.random.default_rng(11)
        # Breadth first, so that a bound on leaves cuts all branches at about the same depth.
        queue = [(np.arange(len(rows)), None)]
        while queue:
            at, parent = queue.pop(0)
            open_leaves = len(self.leaves) + len(queue) + 1
            points = split_points(rows[at], FAN_OUT, rng) if len(at) > leaf_rows and (
                max_leaves is None or open_leaves + FAN_OUT <= max_leaves) else rows[:0]
            if len(points) < 2:
                place = -1 - len(self.leaves)
                self.leaves.append(at)
            else:
                place = len(self.nodes)
                apart = distances(rows[at], points)
                near = apart.argmin(axis=1)
                nearest = np.full((len(points), len(points)), np.inf)
                farthest = np.full((len(points), len(points)), -np.inf)
                for j in range(len(points)):
                    own = apart[near == j]
                    nearest[:, j], farthest[:, j] = own.min(axis=0, initial=np.inf), own.max(axis=0, initial=-np.inf)
                    queue.append((at[near == j], (place, j)))
                self.nodes.append(Node(points, nearest, farthest, [0] * len(points)))
            if parent:
                self.nodes[parent[0]].children[parent[1]] = place

    def route(self, rows: np.ndarray, ranges: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """The leaf of each row.  ``ranges`` gathers, by node * FAN_OUT + child, the least and greatest distances."""
        leaf = np.zeros(len(rows), int)
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            k, at = todo.pop()
            node = self.nodes[k]
            apart = distances(rows[at], node.points)
            near = apart.argmin(axis=1)
            for j in np.unique(near):
                own = near == j
                if ranges is not None:
                    low, high = ranges.get(k * FAN_OUT + j, (np.inf, -np.inf))
                    ranges[k * FAN_OUT + j] = np.minimum(low, apart[own].min(axis=0)), np.maximum(high, apart[own].max(axis=0))
                child = node.children[j]
                if child < 0:
                    leaf[at[own]] = -1 - child
                else:
                    todo.append((child, at[own]))
        return leaf

    def visits(self, anchors: np.ndarray, annulus: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) \
            -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, anchors that have to look into it).  ``annulus(anchors)`` is asked again at every node, as it narrows."""
        # Over the rounding of distances, which goes with the length of the vectors.
        slack = 4e-6 * (1 + self.scale + float(np.sqrt((anchors * anchors).sum(axis=1).max(initial=0))))
        todo = [(0 if self.nodes else -1, np.arange(len(anchors)))]
        while todo:
            k, at = todo.pop()
            if k < 0:
                yield -1 - k, at
                continue
            node = self.nodes[k]
            apart = distances(anchors[at], node.points)[:, :, None]
            low, high = (x[:, None] for x in annulus(at))
            # Of a row below child j, by each point i: no nearer, and no farther, than this.
            least = np.maximum(apart - node.farthest[None], node.nearest[None] - apart).max(axis=1)
            most = (apart + node.farthest[None]).min(axis=1)
            open_ = (least <= high + slack) & (most >= low - slack) & np.isfinite(node.farthest).all(axis=0)[None]
            for j, child in enumerate(node.children):
                if open_[:, j].any():
                    todo.append((child, at[open_[:, j]]))


def augmented(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Rows with one more coordinate, so that all have the squared norm ``norm``."""
    rest = np.sqrt(np.maximum(norm - (vectors * vectors).sum(axis=1), 0))
    return np.concatenate((vectors, rest[:, None]), axis=1)


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers as doubles, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), dim))
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(vectors)), sizes), at] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; in doubles where every partial sum fits 53 bits, else in 64-bit integers."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Block(NamedTuple):
    """A lower tree with its classes: vectors, labels and first ids."""
    tree: Tree
    vectors: np.ndarray
    labels: np.ndarray
    ids: list[list[int]]


class Found(NamedTuple):
    anchor: np.ndarray
    window: np.ndarray
    score: np.ndarray
    row: np.ndarray


def search_block(block: Block, norm: float, vectors: np.ndarray, labels: np.ndarray, lows: np.ndarray, highs: np.ndarray,
                 same: bool, count: int) -> Found:
    """Rows of the ``count`` highest scores, ties included, in each window [low, high] (anchors x windows) of each anchor,
    among rows of the same or of other labels.  Windows with low > high are empty."""
    own = (vectors * vectors).sum(axis=1)
    best = np.full((*lows.shape, count), -np.inf)
    floor = lows.astype(float)
    filled = lows <= highs
    found: list[Found] = []

    def annulus(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = np.where(filled[at], highs[at], -np.inf).max(axis=1)
        low = np.where(filled[at], floor[at], np.inf).min(axis=1)
        # An anchor without windows gets an empty annulus.
        near = np.where(high > -np.inf, own[at] + norm - 2 * np.maximum(high, -(2.0 ** 60)), np.inf)
        far = np.where(low < np.inf, own[at] + norm - 2 * np.minimum(low, 2.0 ** 60), -1)
        return np.sqrt(np.maximum(near, 0)), np.where(far >= 0, np.sqrt(np.maximum(far, 0)), -1)

    query = np.concatenate((vectors, np.zeros((len(vectors), 1))), axis=1)
    for leaf, at in block.tree.visits(query, annulus):
        rows = block.tree.leaves[leaf]
        scores = exact_scores(vectors[at], block.vectors[rows])
        fits = (labels[at][:, None] == block.labels[rows][None]) == same
        for w in range(lows.shape[1]):
            inside = fits & (scores >= lows[at, w][:, None]) & (scores <= highs[at, w][:, None])
            inside &= scores >= floor[at, w][:, None]
            if not inside.any():
                continue
            both = np.concatenate((best[at, w], np.where(inside, scores, -np.inf)), axis=1)
            best[at, w] = -np.partition(-both, count - 1, axis=1)[:, :count]
            floor[at, w] = np.maximum(floor[at, w], best[at, w].min(axis=1))
            a, r = np.nonzero(inside & (scores >= floor[at, w][:, None]))
            found.append(Found(at[a], np.full(len(a), w), scores[a, r], rows[r]))
    if not found:
        none = np.zeros(0, np.int64)
        return Found(none, none, none, none)
    out = Found(*(np.concatenate(x) for x in zip(*found)))
    keep = out.score >= floor[out.anchor, out.window]
    return Found(*(x[keep] for x in out))


def _top(found: Found, ids: list[list[int]], count: int) -> Found:
    """Of each anchor and window the ``count`` first by score and id; ``row`` becomes the id."""
    sizes = np.array([len(ids[r]) for r in found.row.tolist()], int)
    each = np.repeat(np.arange(len(sizes)), sizes)
    own = np.array([i for r in found.row.tolist() for i in ids[r]], np.int64)
    anchor, window, score = found.anchor[each], found.window[each], found.score[each]
    order = np.lexsort((own, -score, window, anchor))
    anchor, window, score, own = anchor[order], window[order], score[order], own[order]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])
    first = np.flatnonzero(new)
    rank = np.arange(len(anchor)) - np.repeat(first, np.diff(np.append(first, len(anchor))))
    keep = rank < count
    return Found(anchor[keep], window[keep], score[keep], own[keep])


def _route(tree: Tree, dim: int, norm: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.route(augmented(matrix(batch.column("vector"), dim), norm))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=[*batch.schema.names, "cell"])
    return run


def _ranges(tree: Tree, dim: int, norm: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            tree.route(augmented(matrix(batch.column("vector"), dim), norm), ranges)
        if ranges:
            slots = sorted(ranges)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int32()), *(pa.array([ranges[s][k].tolist() for s in slots], pa.list_(pa.float64()))
                                                for k in (0, 1))], names=["slot", "low", "high"])
    return run


def _build(dim: int, norm: float) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("class")
        vectors = matrix(rows.column("vector").combine_chunks(), dim)
        block = Block(Tree(augmented(vectors, norm), LEAF_ROWS), vectors, rows.column("label").to_numpy(),
                      rows.column("ids").to_pylist())
        return pa.table({"cell": rows.column("cell")[:1], "block": rows.column("block")[:1],
                         "tree": pa.array([pickle.dumps(block, protocol=5)], pa.binary())})
    return run


def _visits(tree: Tree, dim: int, norm: float) -> Callable:
    """A row per query and cell that it has to look into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("vector"), dim)
            own = (vectors * vectors).sum(axis=1)
            lows = np.array([min(x) for x in batch.column("lows").to_pylist()], float)
            highs = np.array([max(x) for x in batch.column("highs").to_pylist()], float)
            near = np.sqrt(np.maximum(own + norm - 2 * highs, 0))
            far = np.sqrt(np.maximum(own + norm - 2 * lows, 0))
            query = np.concatenate((vectors, np.zeros((len(vectors), 1))), axis=1)
            for leaf, at in tree.visits(query, lambda at: (near[at], far[at])):
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(at)) for c in batch.columns), pa.array(np.full(len(at), leaf, np.int32))],
                    names=[*batch.schema.names, "cell"])
    return run


def _search(dim: int, norm: float, same: bool, count: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, queries in zip(batch.column("tree"), batch.column("queries")):
                block: Block = pickle.loads(tree.as_py())
                queries = dict(zip(("q", "label", "vector", "lows", "highs"), queries.values.flatten()))
                vectors = matrix(queries["vector"], dim)
                lows, highs = queries["lows"].to_pylist(), queries["highs"].to_pylist()
                width = max(map(len, lows))
                # Filled up with empty windows.
                low = np.array([x + [1] * (width - len(x)) for x in lows], np.int64)
                high = np.array([x + [0] * (width - len(x)) for x in highs], np.int64)
                found = search_block(block, norm, vectors, queries["label"].to_numpy(), low, high, same, count)
                found = _top(found, block.ids, count)
                q = queries["q"].to_numpy()[found.anchor]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(high[found.anchor, found.window]), pa.array(found.score), pa.array(found.row)],
                    names=["q", "high", "score", "id"])
    return run


class Index:
    """The tree over classes(class, label, vector, ids)."""

    def __init__(self, classes: DataFrame, saved: Saved):
        self.saved = saved
        squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        count, self.dim, self.norm = classes.agg(
            F.count(F.lit(1)), F.max(F.greatest(F.size("vector"), F.lit(1))), F.max(squares)).first()
        bound = max(256, SAMPLE_FLOATS // self.dim)
        share = min(1.0, 0.9 * bound / count)
        place = F.pmod(F.xxhash64("class"), F.lit(1 << 30)) / float(1 << 30)
        sample = classes.where(place < share).limit(bound).select("vector").toArrow().column("vector").combine_chunks()
        rows = augmented(matrix(sample, self.dim), self.norm)
        # A leaf of the upper tree stands for CELL_ROWS classes, as far as the sample goes.
        self.tree = Tree(rows, max(4 * FAN_OUT, round(CELL_ROWS * min(1.0, len(rows) / count))),
                         max(1, min(MAX_CELLS, SAMPLE_FLOATS // self.dim)))
        routed = saved.table(classes.mapInArrow(
            _route(self.tree, self.dim, self.norm), "class long, label int, vector array<long>, ids array<long>, cell int"))
        self._widen(routed)
        block_rows = max(256, BLOCK_FLOATS // self.dim)
        # A row for each cell, MAX_CELLS at most.
        self.sizes = saved.small(routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")))
        block = F.pmod(F.xxhash64("class", F.lit(3)), F.col("blocks")).cast("int").alias("block")
        self.blocks = saved.table(routed.join(F.broadcast(self.sizes), "cell").select("*", block).drop("blocks")
                                  .groupBy("cell", "block").applyInArrow(_build(self.dim, self.norm), "cell int, block int, tree binary"))

    def _widen(self, routed: DataFrame) -> None:
        """Take the upper tree's ranges over all rows: a row for each child of its nodes, MAX_CELLS at most."""
        if not self.tree.nodes:
            return
        ranges = routed.select("vector").mapInArrow(_ranges(self.tree, self.dim, self.norm),
                                                    "slot int, low array<double>, high array<double>")
        each = ranges.groupBy("slot").agg(
            *[F.min(F.get("low", F.lit(i))).alias(f"low{i}") for i in range(FAN_OUT)],
            *[F.max(F.get("high", F.lit(i))).alias(f"high{i}") for i in range(FAN_OUT)]).toArrow().to_pylist()
        for node in self.tree.nodes:
            node.nearest[:], node.farthest[:] = np.inf, -np.inf
        for row in each:
            node, j = self.tree.nodes[row["slot"] // FAN_OUT], row["slot"] % FAN_OUT
            for i in range(len(node.points)):
                node.nearest[i, j], node.farthest[i, j] = row[f"low{i}"], row[f"high{i}"]

    def search(self, queries: DataFrame, same: bool, count: int, home: bool) -> DataFrame:
        """(q, high, score, id): of queries(q, label, vector, lows, highs) the ``count`` first rows in each window, which
        its upper end names.  ``home``: only of one block of the query's own cell."""
        step = _route if home else _visits
        placed = queries.mapInArrow(step(self.tree, self.dim, self.norm),
                                    "q long, label int, vector array<long>, lows array<long>, highs array<long>, cell int")
        placed = placed.join(F.broadcast(self.sizes), "cell")
        if home:
            placed = placed.withColumn("block", F.pmod("q", "blocks").cast("int"))
        else:
            placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        lists = max(1, -(-queries.count() // CHUNK))
        chunks = placed.groupBy("cell", "block", F.pmod(F.xxhash64("q"), F.lit(lists)).alias("list")).agg(
            F.collect_list(F.struct("q", "label", "vector", "lows", "highs")).alias("queries"))
        found = chunks.join(self.blocks, ["cell", "block"]).select("tree", "queries").mapInArrow(
            _search(self.dim, self.norm, same, count), "q long, high long, score long, id long")
        order = Window.partitionBy("q", "high").orderBy(F.desc("score"), F.asc("id"))
        return self.saved.small(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count))

    def first(self, queries: DataFrame, same: bool, count: int) -> DataFrame:
        """``search`` over all cells, within the bounds that the query's own cell gives."""
        seen = self.search(queries, same, count, home=True).where(F.col("rank") == count).select("q", "high", "score")
        bounds = seen.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("high", "score"))).alias("bounds"))
        lows = F.zip_with("lows", "highs", lambda low, high: F.greatest(low, F.try_element_at("bounds", high)))
        return self.search(queries.join(bounds, "q", "left").select("q", "label", "vector", lows.alias("lows"), "highs"),
                           same, count, home=False)


def rows_of(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector): rows that take part, with the labels and components of the contract."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: 256 * x)
    good = F.col("label").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float(1 << 31)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    return embeddings.where(good).select("vec_id", label.alias("label"), F.transform(v, lambda x: F.floor(x)).alias("vector")).distinct()


def mine(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = embeddings.sparkSession
    prepare(spark)
    saved = Saved(spark, "hyperplane-tree")
    rows = saved.table(rows_of(embeddings))
    ids = F.coalesce("vec_id", F.lit(_NO_ID))
    order = Window.partitionBy("label", "vector").orderBy("id")
    classes = saved.table(rows.select("label", "vector", ids.alias("id")).withColumn("place", F.row_number().over(order))
                          .where(F.col("place") <= POSITIVES + 1).groupBy("label", "vector")
                          .agg(F.array_sort(F.collect_list("id")).alias("ids"))
                          .select(F.monotonically_increasing_id().alias("class"), "label", "vector", "ids"))
    anchors = saved.table(rows.where(F.col("vec_id") % ANCHOR_EVERY == 0))
    # Not the classes' numbers: these would be the same, but an anchor need not be among its class's first ids.
    queries = saved.table(anchors.groupBy("label", "vector").agg(F.count(F.lit(1)).alias("rows"))
                          .select(F.monotonically_increasing_id().alias("q"), "label", "vector"))
    if queries.isEmpty():
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    index = Index(classes, saved)
    every = queries.select("*", F.array(F.lit(_LOW)).alias("lows"), F.array(F.lit(_HIGH)).alias("highs"))
    near = index.first(every, True, POSITIVES + 1).select("q", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    members = anchors.join(queries, ["label", "vector"]).select(F.col("vec_id").alias("anchor_id"), "q")
    first = Window.partitionBy("anchor_id", "q").orderBy(F.desc("positive_score"), F.asc("positive"))
    positives = saved.small(members.join(near, "q").where(F.col("positive") != F.col("anchor_id"))
                            .withColumn("place", F.row_number().over(first)).where(F.col("place") <= POSITIVES).drop("place"))
    # 80 p <= 100 n <= 100 p has no n for a negative p; else n is at least 4 p / 5, rounded up: p less a whole fifth.
    windows = positives.where("positive_score >= 0").select("q", F.col("positive_score").alias("high")).distinct() \
        .groupBy("q").agg(F.array_sort(F.collect_list("high")).alias("highs"))
    wanted = saved.small(queries.join(windows, "q").select(
        "q", "label", "vector", F.expr("transform(highs, h -> h - h div 5)").alias("lows"), "highs"))
    if wanted.isEmpty():
        negatives = spark.createDataFrame([], "q long, high long, score long, id long, rank int")
    else:
        negatives = index.first(wanted, False, NEGATIVES)
    n = negatives.select("q", F.col("high").alias("positive_score"), F.col("rank").cast("int").alias("rank"),
                         F.nullif("id", F.lit(_NO_ID)).alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(n, ["q", "positive_score"]).select(
        "anchor_id", F.nullif("positive", F.lit(_NO_ID)).alias("positive_id"), "rank", "negative_id", "positive_score",
        "negative_score")
