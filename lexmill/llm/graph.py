"""Connected components of graphs that no machine holds, and of small ones in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import forget, stored


def _with_least(edges: DataFrame, both: bool) -> DataFrame:
    """u, v and m: the least of u's neighbours, and with ``both`` of u itself. A hub's edges are a skewed side, which adaptive execution splits."""
    least = F.least(F.min("v"), F.col("u")) if both else F.min("v")
    return edges.join(edges.groupBy("u").agg(least.alias("m")), "u")


def components(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A stored table, to be forgotten, and of it: node, root (the least node reachable) of every node of the edges (a, b), long ids.

    Large-star and small-star steps in turn until nothing changes; every round is stored, so
    no lineage grows and lost executors cost one round; the round before is then deleted. Loops (a = b) and null ends are
    dropped, repeated edges count once; without edges the result is empty.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = stored(e.distinct())
    before = None
    while True:
        seen = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == before or not seen["n"]:
            return e, e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = seen
        either = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(either, True).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_least(large, False)
        last, e = e, stored(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .distinct()
        )
        forget(last)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node reachable of each of ``n`` nodes by edges a - b."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while True:
            jump = root[root]
            if (jump == root).all():
                break
            root = jump
        live = root[a] != root[b]
        a, b = a[live], b[live]
    return root
