"""Near duplicates among embeddings by a robust-pruned flat graph.

Rows with equal vectors are one node.  Cells are the Voronoi cells of centroids fitted on a bounded sample; a node goes to
its ``OVERLAP`` nearest, so shards overlap, and a cell that is too large for one task is cut into blocks by a hash.  In
each block a graph is built by inserting nodes in batches: a greedy search from the block's medoid finds candidates, and
robust pruning keeps a neighbour unless one already kept is nearer to it by the factor ``ALPHA``.  The adjacency lists of
a node's shards are united.

The search runs for every node in every block of its cells, over the united lists: greedily from the block's medoid with
a beam, and from every node within range on to all its neighbours until no new one is in range.  A link found is followed
into those cells of its far end in which the near end isn't, until nothing is added.  Every link is verified in double
precision.  The recall is audited: a bounded number of nodes is compared with all others, and while less than
``RECALL`` of their links was found, the index is built anew with more overlap and a wider beam.

Bounds: the sample, the centroids and the audited nodes are at most ``SAMPLE_FLOATS`` numbers, a block at most about
``BLOCK_FLOATS``; blocks of one cell meet in pairs.  All rows are indexed and searched; only links travel.

Vectors of different lengths are compared as if the shorter ones ended in zeros.  Defined cases: a vector that is null,
empty, zero, or has a null or non-finite component links with nothing, and its component is itself; equal vectors link;
rows that repeat vec_id and vector are rows of their own that link; a null vec_id is a component's id only if all its rows
have none, and such a row isn't kept; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved, prepare
from clipstar.llm.components import connected_components

LIMIT = 0.9
DEGREE = 24
BEAM = 48
ALPHA = 1.2
OVERLAP = 2
CELL_ROWS = 4096
MAX_CELLS = 1024
SAMPLE_FLOATS = 1 << 21
BLOCK_FLOATS = 1 << 22
AUDIT_ROWS = 512
RECALL = 0.95
ATTEMPTS = 3
_SLACK = 1e-4   # of float32 similarities, before verification
_WIDTH = 4      # nodes of a beam that are expanded at once
_CORE = 64      # nodes that are linked before any search


def unit_vectors(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of length 1 from lists of numbers, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), dim))
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(vectors)), sizes), at] = vectors.flatten().to_numpy(zero_copy_only=False)
    out /= np.abs(out).max(axis=1, keepdims=True, initial=1e-300)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def packed(rows: np.ndarray) -> pa.Array:
    """One binary value of doubles per row."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows, np.float64)], pa.binary())


def unpacked(values: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), np.float64).reshape(-1, dim)


def centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means; the first centroids are evenly spaced rows."""
    sample = sample.astype(np.float32)
    count = min(count, len(sample))
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)]
    for _ in range(8):
        near = np.concatenate([(sample[i:i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        order = np.argsort(near, kind="stable")
        filled, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(sample[order], first, axis=0)
        centres = centres.copy()
        centres[filled] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


class Graph:
    """Nodes 0 to n-1 with unit vectors and up to ``degree`` neighbours each (-1: none)."""

    def __init__(self, vectors: np.ndarray, neighbours: np.ndarray, entry: int):
        self.vectors, self.neighbours, self.entry = vectors, neighbours, entry

    def search(self, queries: np.ndarray, beam: int, limit: float | None = None) \
            -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """The nodes and similarities in the beam of each query (-1, -2: none) after a greedy search from the entry;
        with ``limit``, also all (query, node) within it that a walk over nodes within it reaches."""
        n, b = len(self.vectors), len(queries)
        seen = np.zeros((b, n), bool)
        ids, sims = np.full((b, beam), -1), np.full((b, beam), -2, np.float32)
        done = np.zeros((b, beam), bool)
        ids[:, 0], sims[:, 0] = self.entry, queries @ self.vectors[self.entry]
        seen[:, self.entry] = True
        hits = [(np.arange(b)[sims[:, 0] >= limit], np.full((sims[:, 0] >= limit).sum(), self.entry))] \
            if limit is not None else []
        while True:
            todo = (ids >= 0) & ~done
            todo &= np.cumsum(todo, axis=1) <= _WIDTH
            q, place = np.nonzero(todo)
            if not len(q):
                break
            done |= todo
            q, node, sim = self._new(queries, q, ids[q, place], seen)
            if limit is not None:
                hits.append((q[sim >= limit], node[sim >= limit]))
            # Merge: the new ones of a query stand side by side behind its beam.
            counts = np.bincount(q, minlength=b)
            width = counts.max(initial=0)
            if not width:
                continue
            place = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
            more_ids, more_sims = np.full((b, width), -1), np.full((b, width), -2, np.float32)
            more_ids[q, place], more_sims[q, place] = node, sim
            ids, sims = np.concatenate((ids, more_ids), 1), np.concatenate((sims, more_sims), 1)
            done = np.concatenate((done, np.zeros((b, width), bool)), 1)
            best = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            ids, sims, done = (np.take_along_axis(x, best, 1) for x in (ids, sims, done))
        if limit is None:
            return ids, sims, (np.zeros(0, int), np.zeros(0, int))
        found = front = tuple(np.concatenate(x) for x in zip(*hits))
        while len(front[0]):
            q, node, sim = self._new(queries, *front, seen)
            front = q[sim >= limit], node[sim >= limit]
            found = tuple(np.concatenate(x) for x in zip(found, front))
        return ids, sims, found

    def _new(self, queries: np.ndarray, q: np.ndarray, node: np.ndarray, seen: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours of ``node`` that its query ``q`` hasn't seen, and their similarities, ordered by query."""
        out, n = [], len(self.vectors)
        for i in range(0, len(q), 1 << 15):
            near = self.neighbours[node[i:i + (1 << 15)]]
            some, place = np.nonzero(near >= 0)
            key = q[i:i + (1 << 15)][some] * n + near[some, place]
            key = np.unique(key[~seen.reshape(-1)[key]])
            seen.reshape(-1)[key] = True
            out.append(key)
        key = np.sort(np.concatenate(out)) if out else np.zeros(0, int)
        q, node = key // n, key % n
        sims = [np.einsum("ij,ij->i", queries[q[i:i + (1 << 16)]], self.vectors[node[i:i + (1 << 16)]])
                for i in range(0, len(key), 1 << 16)]
        return q, node, np.concatenate(sims) if sims else np.zeros(0, np.float32)


def robust_prune(vectors: np.ndarray, near: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (``near``, -1: none, with their similarities), those that are kept, nearest first."""
    order = np.argsort(-np.where(near >= 0, sims, -3), axis=1, kind="stable")
    near, sims = np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)
    theirs = vectors[np.maximum(near, 0)]
    # Squared distances of unit vectors: 2 - 2 * similarity.
    apart = 2 - 2 * (theirs @ theirs.transpose(0, 2, 1))
    own = 2 - 2 * sims
    alive, kept = near >= 0, np.zeros(near.shape, bool)
    for j in range(near.shape[1]):
        pick = alive[:, j] & (kept.sum(axis=1) < degree)
        kept[:, j] = pick
        alive &= ~(pick[:, None] & (ALPHA * ALPHA * apart[:, j] <= own))
    place = np.argsort(~kept, axis=1, kind="stable")[:, :degree]
    out = np.where(np.take_along_axis(kept, place, 1), np.take_along_axis(near, place, 1), -1)
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)


def _step(n: int) -> int:
    """Queries at once, so that the marks of what they have seen stay small."""
    return int(np.clip((1 << 24) // max(1, n), 32, 1024))


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> Graph:
    """``vectors``: unit float32 rows in any order; equal input gives an equal graph."""
    n = len(vectors)
    entry = int((vectors @ vectors.mean(axis=0)).argmax())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    graph = Graph(vectors, np.full((n, degree), -1), entry)
    done = 0
    while done < n:
        batch = order[done:done + min(max(done, _CORE), _step(n))]
        own = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(own, -2)
        inside = np.argsort(-own, axis=1, kind="stable")[:, :degree]
        near, sims = batch[inside], np.take_along_axis(own, inside, 1)
        near = np.where(sims > -2, near, -1)
        if done:
            ids, found, _ = graph.search(vectors[batch], beam)
            near, sims = np.concatenate((ids, near), 1), np.concatenate((found, sims), 1)
        graph.neighbours[batch] = robust_prune(vectors, near, sims, degree)
        _link_back(graph, batch, degree)
        done += len(batch)
    return graph


def _link_back(graph: Graph, batch: np.ndarray, degree: int) -> None:
    """Add each new node to its neighbours' lists; lists that overflow are pruned, the nearest 64 new ones at most each."""
    some, place = np.nonzero(graph.neighbours[batch] >= 0)
    source, target = batch[some], graph.neighbours[batch[some], place]
    fresh = ~(graph.neighbours[target] == source[:, None]).any(axis=1)
    source, target = source[fresh], target[fresh]
    sims = np.einsum("ij,ij->i", graph.vectors[source], graph.vectors[target])
    order = np.lexsort((-sims, target))
    source, target, sims = source[order], target[order], sims[order]
    rows, first, counts = np.unique(target, return_index=True, return_counts=True)
    rank = np.arange(len(target)) - np.repeat(first, counts)
    row = np.repeat(np.arange(len(rows)), counts)[rank < 64]
    more, more_sims = np.full((len(rows), 64), -1), np.full((len(rows), 64), -2, np.float32)
    more[row, rank[rank < 64]], more_sims[row, rank[rank < 64]] = source[rank < 64], sims[rank < 64]
    for i in range(0, len(rows), 512):
        at = rows[i:i + 512]
        old = graph.neighbours[at]
        old_sims = np.einsum("ij,ikj->ik", graph.vectors[at], graph.vectors[np.maximum(old, 0)])
        near = np.concatenate((old, more[i:i + 512]), 1)
        sims = np.concatenate((old_sims, more_sims[i:i + 512]), 1)
        fits = (near >= 0).sum(axis=1) <= degree
        pruned = robust_prune(graph.vectors, near[~fits], sims[~fits], degree)
        graph.neighbours[at[~fits]] = pruned
        front = np.argsort(near[fits] < 0, axis=1, kind="stable")[:, :degree]
        graph.neighbours[at[fits]] = np.take_along_axis(near[fits], front, 1)


def _to_cells(centres: np.ndarray, overlap: int, dim: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_vectors(batch.column("vector"), dim)
            near = np.argsort(-(units.astype(np.float32) @ centres.T), axis=1, kind="stable")[:, :overlap]
            row = np.repeat(np.arange(len(units)), near.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.reshape(-1).astype(np.int32)), batch.column("node").take(pa.array(row)),
                 packed(units).take(pa.array(row))], names=["cell", "node", "unit"])
    return run


def _build(dim: int, beam: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        node = rows.column("node").to_numpy()
        graph = build_graph(unpacked(rows.column("unit"), dim).astype(np.float32), beam=beam)
        some = graph.neighbours >= 0
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(some.sum(axis=1)))), pa.int32()),
                                         pa.array(node[graph.neighbours[some]]))
        return rows.append_column("neighbours", lists).append_column("entry", pa.array(np.arange(len(node)) == graph.entry))
    return run


def _search(dim: int, beam: int, limit: float) -> Callable:
    """Links between the nodes of block ``high`` and those of block ``low``, over the graph of the latter."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        block, low, high = (rows.column(c).to_numpy() for c in ("block", "low", "high"))
        index, query = np.flatnonzero(block == low), np.flatnonzero(block == high)
        node = rows.column("node").to_numpy()
        units = unpacked(rows.column("unit"), dim)
        theirs = node[index]
        lists = rows.column("neighbours").combine_chunks().take(pa.array(index))
        counts = np.diff(lists.offsets.to_numpy())
        ids = lists.flatten().to_numpy()
        at = np.minimum(np.searchsorted(theirs, ids), len(theirs) - 1)
        width = int(counts.max(initial=1))
        near = np.full((len(index), width), -1)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        near[np.repeat(np.arange(len(index)), counts), place] = np.where(theirs[at] == ids, at, -1)
        entry = np.flatnonzero(rows.column("entry").to_numpy(zero_copy_only=False)[index])
        graph = Graph(units[index].astype(np.float32), near, int(entry[0]))
        links = []
        for i in range(0, len(query), _step(len(index))):
            own = query[i:i + _step(len(index))]
            q, other = graph.search(units[own].astype(np.float32), beam, limit - _SLACK)[2]
            a, b = own[q], index[other]
            true = (node[a] != node[b]) & (np.einsum("ij,ij->i", units[a], units[b]) >= limit)
            links.append(np.stack([np.minimum(node[a], node[b])[true], np.maximum(node[a], node[b])[true]]))
        both = np.unique(np.concatenate(links, axis=1), axis=1) if links else np.zeros((2, 0), np.int64)
        return pa.table({"a": pa.array(both[0], pa.int64()), "b": pa.array(both[1], pa.int64())})
    return run


def _dot() -> F.Column:
    return F.aggregate(F.zip_with("u", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


class Index:
    """The nodes of a table of vectors with their united graph."""

    def __init__(self, nodes: DataFrame, saved: Saved, overlap: int = OVERLAP, beam: int = BEAM):
        self.nodes, self.saved, self.beam = nodes, saved, beam
        count, self.dim = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
        centres = centroids(self._some(max(1, SAMPLE_FLOATS // self.dim), 1, count),
                            int(np.clip(-(-count // CELL_ROWS), 1, min(MAX_CELLS, SAMPLE_FLOATS // self.dim))))
        self.count = count
        in_cells = saved.table(nodes.select("node", "vector").mapInArrow(
            _to_cells(centres, overlap, self.dim), "cell int, node long, unit binary"))
        block_rows = max(256, BLOCK_FLOATS // self.dim)
        # A row for each cell, MAX_CELLS at most.
        sizes = in_cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        shards = in_cells.join(F.broadcast(sizes), "cell").withColumn("block", block)
        self.graph = saved.table(shards.select("cell", "block", "blocks", "node", "unit").groupBy("cell", "block").applyInArrow(
            _build(self.dim, beam), "cell int, block int, blocks int, node long, unit binary, neighbours array<long>, entry boolean"))
        self.united = saved.table(self.graph.groupBy("node").agg(
            F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"), F.collect_set("cell").alias("cells")))

    def _some(self, bound: int, seed: int, count: int) -> np.ndarray:
        """Unit vectors of about ``bound`` nodes, chosen by a hash."""
        share = min(1.0, 0.9 * bound / max(1, count))
        place = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        rows = self.nodes.where(place < share).limit(bound).select("vector").toArrow()
        return unit_vectors(rows.column("vector").combine_chunks(), self.dim)

    def links(self, limit: float) -> DataFrame:
        """(a, b), a < b: linked nodes that the search finds."""
        other = self.graph.drop("neighbours").join(self.united.select("node", "neighbours"), "node") \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        units = other.select("cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                             "block", "node", "unit", "neighbours", "entry")
        found = self.saved.table(units.groupBy("cell", "low", "high").applyInArrow(
            _search(self.dim, self.beam, limit), "a long, b long").distinct())
        new = found
        while not new.isEmpty():
            new = self.saved.table(self._onward(new, found, limit))
            found = found.unionByName(new)
        return found

    def _onward(self, new: DataFrame, found: DataFrame, limit: float) -> DataFrame:
        """Links to the far end's neighbours in cells in which the near end isn't."""
        ways = new.unionByName(new.select(F.col("b").alias("a"), F.col("a").alias("b")))
        cells = self.united.select(F.col("node").alias("a"), "cells")
        lists = self.graph.select(F.col("node").alias("b"), "cell", "neighbours")
        far = ways.join(cells, "a").join(lists, "b").where(~F.array_contains("cells", F.col("cell"))) \
            .select("a", F.explode("neighbours").alias("b")).where("a <> b") \
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct() \
            .join(found, ["a", "b"], "left_anti")
        vectors = self.nodes.select("node", "vector").mapInArrow(
            lambda batches, dim=self.dim: _numbers(batches, dim), "node long, unit array<double>")
        return far.join(vectors.select(F.col("node").alias("a"), F.col("unit").alias("u")), "a") \
            .join(vectors.select(F.col("node").alias("b"), F.col("unit").alias("v")), "b") \
            .where(_dot() >= limit).select("a", "b")

    def recall(self, links: DataFrame, limit: float) -> float:
        """Share of the links of up to AUDIT_ROWS nodes, compared with all others, that ``links`` has."""
        bound = min(AUDIT_ROWS, max(1, SAMPLE_FLOATS // self.dim))
        share = min(1.0, 0.9 * bound / max(1, self.count))
        place = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
        rows = self.nodes.where(place < share).limit(bound).select("node", "vector").toArrow()
        chosen = rows.column("node").to_numpy()
        units = unit_vectors(rows.column("vector").combine_chunks(), self.dim)

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node = batch.column("node").to_numpy()
                near, row = np.nonzero(units @ unit_vectors(batch.column("vector"), units.shape[1]).T >= limit)
                a, b = chosen[near], node[row]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[a != b]), pa.array(np.maximum(a, b)[a != b])],
                                                 names=["a", "b"])
        true = self.saved.small(self.nodes.select("node", "vector").mapInArrow(compare, "a long, b long").distinct())
        every = true.count()
        return true.join(links, ["a", "b"], "left_semi").count() / every if every else 1.0


def _numbers(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = unit_vectors(batch.column("vector"), dim)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(units) + 1) * dim, pa.int32()), pa.array(units.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "unit"])


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector): the vector as doubles, null where it can't be compared."""
    v = F.col("embedding").cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return embeddings.select("vec_id", F.when(good, v).alias("vector"))


def near_duplicates(embeddings: DataFrame, limit: float = LIMIT) -> DataFrame:
    """vec_id, n_links, component_id, kept, audited_recall (the same for all rows)."""
    spark = embeddings.sparkSession
    prepare(spark)
    saved = Saved(spark, "flat-graph")
    rows = vectors_of(embeddings)
    nodes = saved.table(rows.where("vector is not null").groupBy("vector")
                        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
                        .withColumn("node", F.monotonically_increasing_id()))
    links, recall = None, 1.0
    if not nodes.isEmpty():
        for attempt in range(ATTEMPTS):
            index = Index(nodes, saved, OVERLAP << attempt, BEAM << attempt)
            links = index.links(limit)
            recall = index.recall(links, limit)
            if recall >= RECALL:
                break
    else:
        links = spark.createDataFrame([], "a long, b long")
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sums = ways.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")) \
        .agg(F.sum("copies").alias("linked"))
    roots = connected_components(links, saved)
    placed = nodes.select("node", "vector", "first", "copies").join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    known = placed.join(ids, "root").join(sums, "node", "left").select(
        "vector", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(known, "vector", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
                      F.lit(float(recall)).alias("audited_recall"))
