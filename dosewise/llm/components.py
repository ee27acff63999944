"""Connected components of an edge table, as Spark joins.

Each round hooks every node onto its smallest smaller neighbour, flattens the
resulting trees by pointer jumping, and rewrites the edges onto the roots; the
edges left over shrink quickly and the loop ends when there are none.  The
per-round maps are then applied in order.  Every intermediate table is written
to the shared checkpoint folder, so a lost executor costs one stage.  Grouped
steps are plain ``min`` aggregates (combined before the shuffle) and joins on a
unique right side, so a hub with a third of all edges is split by the planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewise.session import stored


def _flatten(parents: DataFrame) -> DataFrame:
    """(node, parent) trees to (node, parent = root)."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        nxt = stored(parents.join(up, "parent", "left")
                     .select("node", F.coalesce("above", "parent").alias("parent"),
                             F.col("above").isNotNull().alias("moved")), "jump")
        parents = nxt.select("node", "parent")
        if nxt.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type -> (node, root): the smallest node
    of its component for every node that has an edge to another node.  Self
    loops, repeats and nulls in the edges are ignored."""
    def ordered(e):
        return (e.where("a is not null and b is not null and a <> b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    left = stored(ordered(edges), "edges")
    labels = None
    while not left.isEmpty():
        parents = _flatten(stored(left.groupBy(F.col("b").alias("node"))
                                  .agg(F.min("a").alias("parent")), "hook"))
        pa = parents.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        pb = parents.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        moved = (left.join(pa, "a", "left").join(pb, "b", "left")
                 .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
        if labels is None:
            labels = parents
        else:
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            old = labels.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"))
            labels = stored(old.unionByName(parents.join(labels.select("node"), "node", "left_anti")), "labels")
        left = stored(ordered(moved), "edges")
    if labels is None:
        t = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {t}, root {t}")
    labels = labels.withColumnRenamed("parent", "root")
    # a root is its own label
    return labels.unionByName(labels.select(F.col("root").alias("node"), "root").distinct()
                              .join(labels.select("node"), "node", "left_anti"))
