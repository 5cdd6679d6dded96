"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.llm.common import written


def unique_side(rows, keys, **aggregates):
    """``rows`` grouped by ``keys``, as a join side that stays open to skew splitting.

    Grouping by a hash of the keys as well keeps the grouped rows from being
    partitioned by the keys alone, so a join shuffles both sides and adaptive execution
    can split the partition of a key with most of the rows.
    """
    marked = rows.withColumn("__hash", F.xxhash64(*keys)).groupBy(*keys, "__hash")
    return (marked.agg(*[v.alias(k) for k, v in aggregates.items()]) if aggregates else marked.agg(F.lit(1))).select(
        *keys, *aggregates
    )


def _lookup(rows, column, pointers):
    """``rows`` with ``column`` replaced by where its pointer leads, itself if it has none."""
    side = pointers.select(F.col("node").alias("__node"), F.col("component").alias("__to"))
    joined = rows.join(side, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(column, F.coalesce("__to", column)).drop("__node", "__to")


def connected_components(edges, name="components"):
    """(node, component) of every node in ``edges`` (a, b); component is its smallest node.

    Each round points every node at its smallest neighbour if that is smaller than
    itself, shortens the pointers until they reach a root, and keeps the edges between
    different roots.  Edges are combined per task before they are shuffled and nothing is
    gathered per node, so a node with most of the edges is no burden.  Rounds are few:
    every one at least halves the roots that still have edges.
    """
    plain = edges.select("a", "b").where("a <> b")
    rest = written(plain.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    labels = None
    while not rest.isEmpty():
        both = rest.union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        pointers = written(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), name)
        while True:
            further = written(_lookup(pointers.withColumn("was", F.col("component")), "component", pointers), name)
            pointers = further.select("node", "component")
            if further.where("component <> was").isEmpty():
                break
        labels = pointers if labels is None else written(_lookup(labels, "component", pointers), name)
        moved = _lookup(_lookup(rest, "a", pointers), "b", pointers).where("a <> b")
        rest = written(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    return labels if labels is not None else rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
