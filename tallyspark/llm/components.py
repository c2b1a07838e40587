"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: every step replaces the edges of a
node by edges to the smallest node it knows, until each component is a star around
its smallest node.  A step is one aggregation (map-side combined) and one join, so a
node with very many edges is never gathered in one task.  Each round is written to
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step over edges (a, b) with b < a.

    Large star: each neighbour above a node points to the smallest one known there.
    Small star: so do the node itself and its neighbours below.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(smallest, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        below = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = below.unionByName(smallest.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame):
    return edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
    ).first()


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    ``edges`` has two columns of one orderable type; direction, repeats and loops do
    not matter, nodes without a proper edge do not appear.
    """
    left, right = edges.columns
    a, b = F.col(left), F.col(right)
    current = materialize(
        edges.where(a != b)
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct(),
        "edges",
    )
    before = _state(current)
    while True:
        current = materialize(_star(_star(current, True), False), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
