"""Subtree totals in a forest by centroid decomposition.

A component is a connected piece of the forest with one top.  Its centroid is the deepest
node whose subtree holds at least half of the component; the nodes that do are exactly
the path from the centroid to the top.  The subtree total of the centroid, which is
its own values and the totals of the components below it, is added to every node of
that path.  Then the centroid is taken out, which leaves the components below its children
and the one above it, each with at most half of the nodes, and the same is done to them.
A node's subtree total is the sum of what was added to it: at most one addition for each
halving, however deep or wide the forest.

Components of more than ``small`` nodes are split with joins and aggregations, all at a
time, one round a halving; smaller ones are finished inside tasks.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import materialize

SMALL = 20_000
_NODE = ["conv_id", "depth"]


def component_totals(parent: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Subtree totals of a forest given by parents (-1 for a top); parents come first."""
    out = [[0] * len(v) for v in values]
    children: list[list[int]] = [[] for _ in parent]
    tops = []
    for v, p in enumerate(parent):
        (children[p] if p >= 0 else tops).append(v)
    taken = [False] * len(parent)
    size = [1] * len(parent)
    for v in range(len(parent) - 1, -1, -1):
        if parent[v] >= 0:
            size[parent[v]] += size[v]
    while tops:
        top = tops.pop()
        total = size[top]
        path, heavy = [], top
        while heavy is not None:
            path.append(heavy)
            heavy = next((w for w in children[heavy] if not taken[w] and 2 * size[w] >= total), None)
        centroid = path[-1]
        # The totals of the components below the centroid, and the centroid's own values.
        sums, rest = [0] * len(values[centroid]), [centroid]
        while rest:
            v = rest.pop()
            sums = [a + b for a, b in zip(sums, values[v], strict=True)]
            rest += [w for w in children[v] if not taken[w]]
        for v in path:
            out[v] = [a + b for a, b in zip(out[v], sums, strict=True)]
            size[v] -= size[centroid] if v != centroid else 0
        taken[centroid] = True
        tops += [w for w in children[centroid] if not taken[w]]
        if centroid != top:
            tops.append(top)
    return out


def _within_tasks(nodes: DataFrame, values: list[str], small: int) -> DataFrame:
    """Totals of whole components of at most ``small`` nodes."""
    names = [*_NODE, *values]

    def finish(rows):
        # Sorted by component and depth, so parents come first.
        place, parents, held = {}, [], []
        for at, (conv, depth, parent, comp, comp_depth, *own) in enumerate(rows):
            place[conv, depth] = at
            inside = (conv, depth) != (comp, comp_depth)
            parents.append(place[parent, depth - 1] if inside else -1)
            held.append(tuple(own))
        totals = component_totals(parents, held)
        columns = [[r[0] for r in rows], [r[1] for r in rows], *map(list, zip(*totals, strict=True))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches):
        rows: list = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if len(rows) >= small and row[3:5] != rows[-1][3:5]:
                    yield finish(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield finish(rows)

    return (
        nodes.select(*_NODE, "parent_conv_id", "comp", "comp_depth", *values)
        .repartition("comp", "comp_depth")
        .sortWithinPartitions("comp", "comp_depth", "depth")
        .mapInArrow(run, ", ".join(f"{c} long" for c in names))
    )


def _split(open_nodes: DataFrame, steps: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Take the centroid out of every component: what it adds, and the components left."""
    key = ["comp", "comp_depth"]
    totals = open_nodes.groupBy(*key).agg(F.max("size").alias("total"))
    sized = open_nodes.join(totals, key).withColumn("heavy", F.col("size") * 2 >= F.col("total"))
    centroids = (
        sized.where("heavy")
        .groupBy(*key)
        .agg(F.max_by(F.struct(F.col("conv_id").alias("c_conv"), F.col("depth").alias("c_depth"), F.col("size").alias("c_size")), "depth").alias("c"))
        .select(*key, "c.*")
    )
    # Where the way from the top of all to a node passes the depth of the centroid.
    passed = steps.select(
        F.col("member").alias("conv_id"), F.col("depth").alias("c_depth"), F.col("conv_id").alias("at"), "next"
    )
    placed = materialize(
        sized.join(centroids, key)
        .join(passed, ["conv_id", "c_depth"], "left")
        .withColumn("is_centroid", (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth")))
        .withColumn("below", (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("at") == F.col("c_conv"), F.lit(False))),
        "components",
    )
    sums = placed.where("below or is_centroid").groupBy(*key).agg(*[F.sum(v).alias(v) for v in values])
    added = placed.where("heavy").select(*_NODE, *key).join(sums, key).select(*_NODE, *values)
    left = placed.where("not is_centroid").select(
        *_NODE,
        "parent_conv_id",
        *values,
        F.when(F.col("below"), F.col("next")).otherwise(F.col("comp")).alias("comp"),
        F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("comp_depth")).alias("comp_depth"),
        # Of the path only the part above the centroid is left.
        F.when(F.col("heavy"), F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
    )
    return added, left


def subtree_totals(nodes: DataFrame, steps: DataFrame, values: list[str], small: int = SMALL) -> DataFrame:
    """(conv_id, depth, values): every node's subtree totals, itself included.

    ``nodes``: conv_id and depth (the key), parent_conv_id (the parent lies one higher;
    null at a root), ``size`` (nodes of the subtree) and ``values`` (longs).
    ``steps``: member, depth, conv_id, next: the node at each depth of the way from the
    root to each node (member: the conv_id of the node below) and the next one's conv_id.
    """
    # The way to a node starts at its root; roots lie at depth 0.
    first = steps.where("depth = 0").select(F.col("member").alias("conv_id"), F.col("conv_id").alias("comp"))
    left = nodes.join(first, "conv_id").withColumn("comp_depth", F.lit(0).cast("long"))
    done, added = [], []
    while True:
        left = materialize(left, "open-components")
        sizes = left.groupBy("comp", "comp_depth").agg(F.max("size").alias("_total"))
        large = materialize(sizes.where(F.col("_total") > small).select("comp", "comp_depth"), "large-components")
        if large.isEmpty():
            done.append(left)
            break
        key = ["comp", "comp_depth"]
        done.append(left.join(large, key, "left_anti"))
        more, left = _split(left.join(large, key, "left_semi"), steps, values)
        added.append(more)
    total = None
    for part in [*added, *[_within_tasks(d, values, small) for d in done]]:
        total = part if total is None else total.unionByName(part)
    return total.groupBy(*_NODE).agg(*[F.sum(v).alias(v) for v in values])
