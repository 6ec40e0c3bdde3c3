"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import map_batches, stage


def _forest():
    """Union-find over a batch of edges: the edges from each node to its root, the smallest."""

    def one(a, b):
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.get(top, top)) != top:
                top = up
            while x != top:
                root[x], x = top, root.get(x, x)
            return top

        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        pairs = [(x, find(x)) for x in root]
        return {"a": [x for x, _ in pairs], "b": [y for _, y in pairs]}

    return one


def components(edges: DataFrame, name: str) -> DataFrame:
    """(a, b) -> (node, component): every node of an edge with the smallest node it is connected to.

    Each batch of edges first shrinks to a spanning forest. Then, in rounds,
    every node's larger neighbours are linked to its smallest one (large star)
    and its smaller neighbours too (small star), until all trees are stars. A
    node's edges never meet in one task: the minimum is pre-aggregated and
    joined back, where Spark can split a hot node.
    """
    e = map_batches(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b"), "a long, b long", _forest)
    e = stage(e.distinct(), name)  # a > b from here on
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        large = stage(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), name)
        # all stars: no node has two parents, no parent has a parent
        ups = e.groupBy("a").agg(F.min("b").alias("p"), F.max("b").alias("q"))
        roots = e.select(F.col("b").alias("a")).distinct()
        if ups.where("p <> q").isEmpty() and roots.join(e, "a", "left_semi").isEmpty():
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select(F.col("a").alias("node"), F.col("a").alias("component")))
