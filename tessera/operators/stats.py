"""Descriptions, shares, correlations, summaries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F


def unpivoted(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, value) of every number of the columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "metric", "value").where("value IS NOT NULL")


def quantiles(values: DataFrame, by: str, wanted: dict[str, float], value: str = "value", buckets: int = 4096) -> DataFrame:
    """Exact interpolated quantiles of each group: by, and a column for each that is wanted.

    Equal values are counted before they are shuffled, then ranked within ranges of values and offset by
    the counts of the ranges below; so a group is dealt over many tasks, none of which holds a map of
    its values.
    """
    v = values.where(F.col(value).isNotNull()).groupBy(by, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    limits = v.groupBy(by).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("total"))
    at = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("low"), F.col("high") - F.col("low")) * (buckets - 1)), F.lit(0))
    v = v.join(limits, by).withColumn("range", at)
    sums = v.groupBy(by, "range").agg(F.sum("n").alias("k"))
    before = F.coalesce(F.sum("k").over(W.partitionBy(by).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    v = v.withColumn("upto", F.sum("n").over(W.partitionBy(by, "range").orderBy("v"))).join(sums.select(by, "range", before.alias("before")), [by, "range"])
    first, last = F.col("before") + F.col("upto") - F.col("n"), F.col("before") + F.col("upto")
    place = lambda q: (F.col("total") - 1) * F.lit(q)
    pick = lambda rank: F.max(F.when((first <= rank) & (rank < last), F.col("v")))
    out = v.groupBy(by).agg(F.max("total").alias("total"), *[pick(f(place(q))).alias(f"{name}_{side}") for name, q in wanted.items() for side, f in (("lo", F.floor), ("hi", F.ceil))])
    return out.select(by, *[(F.col(f"{c}_lo") + (F.col(f"{c}_hi") - F.col(f"{c}_lo")) * (place(q) - F.floor(place(q)))).alias(c) for c, q in wanted.items()])


def describe(df: DataFrame, columns: list[str], quartiles: bool = True, digits: int = 6) -> DataFrame:
    """metric, n, mean, std (of the population), min, max, and median, q1, q3 (interpolated)."""
    v, long = F.col("value"), unpivoted(df, columns)
    out = long.groupBy("metric").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    if quartiles:
        out = out.join(quantiles(long, "metric", {"median": 0.5, "q1": 0.25, "q3": 0.75}), "metric")
    return out.select("metric", "n", *[F.round(c, digits).alias(c) for c in out.columns[2:]])


def percent(cond: Column) -> Column:
    return F.avg(cond.cast("int")) * 100


def shares(df: DataFrame, *by: str) -> DataFrame:
    """Rows per group and their share of all rows."""
    n = df.groupBy(*by).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy(F.lit(0))), 6))


def correlations(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """a, b, r of every two columns, in one pass."""
    two = list(combinations(columns, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(two)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(f"r{i}", digits).alias("r")) for i, (a, b) in enumerate(two)])).alias("c")).select("c.*")


def strength(r: Column) -> Column:
    return F.when(F.abs(r) > 0.7, "Strong").when(F.abs(r) > 0.5, "Moderate").otherwise("Weak")


def leaks(names: DataFrame, name: str = "name", split: str = "split") -> DataFrame:
    """Names that occur in several rows: how often, and in which splits."""
    return names.groupBy(name).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(split)), ",").alias("splits")).where("n > 1")
