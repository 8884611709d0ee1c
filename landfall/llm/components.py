"""Connected components of an edge table, by contraction, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.base import saved


def _tidy(edges: DataFrame) -> DataFrame:
    return (
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _flattened(parent: DataFrame) -> DataFrame:
    """(node, top) of a forest (node, top): every node jumps to its top's top until nothing moves."""
    while True:
        up = parent.select(F.col("node").alias("mid"), F.col("top").alias("above"))
        jumped = saved(
            parent.join(up, parent.top == up.mid).select("node", F.col("above").alias("top"), (F.col("above") != F.col("top")).alias("moved")),
            "jump",
        )
        parent = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node it can reach.

    Each round every node hooks to its smallest neighbour, chains are flattened by
    pointer jumping, and edges are rewritten between the tops; at least every second
    top goes, so the rounds are logarithmic. Hubs only meet partial minima and
    joins that AQE can split. Loops and repeated edges do no harm; no edges, no rows.
    """
    edges = saved(_tidy(edges), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("top"))
        parent = _flattened(saved(parent, "hook"))
        if found is None:
            found = parent.withColumnRenamed("top", "root")
        else:
            step = parent.withColumnRenamed("node", "old")
            found = found.join(step, found.root == step.old, "left").select("node", F.coalesce("top", "root").alias("root"))
        left, right = (parent.select(F.col("node").alias(k), F.col("top").alias(f"top_{k}")) for k in "ab")
        edges = saved(_tidy(edges.join(left, "a").join(right, "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return saved(found, "components")
