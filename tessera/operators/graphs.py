"""What hangs together in a graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is the component's least node.

    Large-star and small-star steps in turn: every node's larger neighbours go to its least one, then its smaller ones
    do. Rounds grow with the logarithm of the nodes; each is a table in the shared folder, and only counts come here.
    """
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    last = mark(edges)
    for _ in range(most_rounds if last[0] else 0):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = mark(edges)
        if now == last:
            break
        last = now
    else:
        if last[0]:
            raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
