"""Connected components of a graph in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of edges (a, b); root is the component's least node.

    Alternates the large-star and small-star steps of Kiveris et al.; each keeps the components
    and a round count in the logarithm of the nodes is typical. Every round is a table in the
    shared folder, so a lost executor costs one round at most. Only counts come to the driver.
    """
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    last = mark(edges)
    for _ in range(most_rounds):
        if not last[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small)
        now = mark(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
