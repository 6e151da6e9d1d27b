"""Connected components of an edge table, by hooking every node to its least neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _flattened(parents: DataFrame) -> DataFrame:
    """node, root from node, parent (parent < node or equal): parents of parents until nothing moves."""
    parents = stored(parents, "parents")
    while True:
        up = parents.select(F.col("node").alias("_p"), F.col("parent").alias("_pp"))
        jumped = (parents.join(up, parents.parent == up["_p"], "left")
                  .select("node", F.coalesce("_pp", "parent").alias("parent"),
                          (F.coalesce("_pp", "parent") != F.col("parent")).alias("moved")))
        jumped = stored(jumped, "jumped")
        if jumped.where("moved").isEmpty():
            return parents
        parents = jumped.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """node, root for edges (a, b): root is the least node of the component. Loops, repeats and both directions may
    occur; nodes only in loops are left out; no edges give no rows.

    Each round halves the nodes of a component at least, as every node but a local minimum goes into a smaller
    one. Hub nodes are grouped with a partial minimum and joined by skew-splitting joins; rounds end in a table.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        hooked = _flattened(ends.groupBy("node").agg(F.min("other").alias("parent"))
                            .withColumn("parent", F.least("node", "parent")))
        if roots is None:
            roots = hooked.withColumnRenamed("parent", "root")
        else:
            step = hooked.select(F.col("node").alias("_n"), "parent")
            roots = stored(roots.join(step, roots.root == step["_n"], "left")
                           .select("node", F.coalesce("parent", "root").alias("root")), "roots")
        a = hooked.select(F.col("node").alias("a"), F.col("parent").alias("_a"))
        b = hooked.select(F.col("node").alias("b"), F.col("parent").alias("_b"))
        edges = stored(edges.join(a, "a").join(b, "b").where("_a <> _b")
                       .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
