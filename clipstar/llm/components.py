"""Connected components of a link table, by contraction: hook each node to its smallest neighbour, jump pointers to
the roots, replace links by links between roots, and go on until no link is left.

Every step is an aggregate with a map-side part or a join between two saved tables, so a hub with a third of the links
is split by the skew join.  Nothing but row counts reaches the driver.  A component's root is its smallest node.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.llm.common import Saved


def _to_roots(parents: DataFrame, saved: Saved) -> DataFrame:
    """(node, root) from (node, root) whose roots may have parents themselves."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        jumped = saved.small(parents.join(up, "root", "left").select(
            "node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")))
        moved = not jumped.where("moved").isEmpty()
        parents = jumped.select("node", "root")
        if not moved:
            return parents


def connected_components(links: DataFrame, saved: Saved) -> DataFrame:
    """(node, root) for every node of ``links(a, b)`` except the roots themselves; a null or self link is ignored."""
    links = saved.small(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct())
    assigned = None
    while not links.isEmpty():
        parents = saved.small(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        roots = _to_roots(parents, saved)
        if assigned is None:
            assigned = roots
        else:
            r = roots.withColumnRenamed("node", "root_node").withColumnRenamed("root", "new_root")
            moved = assigned.join(r, assigned["root"] == r["root_node"], "left").select(
                "node", F.coalesce("new_root", "root").alias("root"))
            # Nodes of this round were roots before, so they are not in ``assigned`` yet.
            assigned = saved.small(moved.unionByName(roots))
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        half = links.join(ra, "a", "left").select(F.coalesce("root_a", "a").alias("a"), "b")
        links = saved.small(half.join(rb, "b", "left").select("a", F.coalesce("root_b", "b").alias("b"))
                            .where("a <> b")
                            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if assigned is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return assigned
