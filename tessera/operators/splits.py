"""Repeatable splits, samples and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.sampling import hash32
from ..sources.scratch import written


def ranked_in_buckets(df: DataFrame, order: list[str], bucket: str, by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Adds rank (from 1) of each row in its group, and n, the group's rows, without sorting a group in
    one task: rows are ranked within their bucket, a column that must rise with the order, and
    the buckets' counts are summed up before. Replaces the bucket column."""
    keys = [*by, bucket]
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))  # over one row a bucket
    counts = df.groupBy(*keys).agg(F.count("*").alias("__count"))
    before = F.coalesce(F.sum("__count").over(group.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("__before", before).withColumn("n", F.sum("__count").over(group))
    counts = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], "__before", "n")
    rows = df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = rows.join(counts, same).withColumn("rank", F.col("rank") + F.col("__before"))
    return out.drop(bucket, "__before", *[f"__{k}" for k in keys])


def ranked_in_ranges(df: DataFrame, order: list[str], by: list[str] | tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """ranked_in_buckets for any order: Spark samples the order's values and cuts them in ranges of about as many rows,
    whatever they look like. The ranges are written with the rows, as another sample would give others. Nulls come first;
    rows that are equal in all of ``order`` are in one range."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(df.repartitionByRange(ranges, *by, *order).withColumn("__range", F.spark_partition_id()))
    return ranked_in_buckets(cut, order, "__range", by)


def ranked(df: DataFrame, key: str, by: list[str], salt: str = "") -> DataFrame:
    """Adds rank (from 1) in the order of a hash of the key, and n, the group's rows."""
    h = hash32(F.col(key), salt)
    df = df.withColumn("__hash", h).withColumn("__bucket", F.shiftright("__hash", 20))
    return ranked_in_buckets(df, ["__hash", key], "__bucket", by).drop("__hash")


def first_of_each(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each group; each task keeps k rows of a group before they are shuffled."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def targets(df: DataFrame, by: list[str], multiple: float, tries: int) -> DataFrame:
    """n rows of each group, how many are wanted to make it int(n * multiple), the tries for them, and how
    often the rows have to be gone through."""
    n = df.groupBy(*by).agg(F.count("*").alias("n"))
    n = n.withColumn("wanted", F.floor(F.col("n") * F.lit(float(multiple))) - F.col("n"))
    return n.withColumn("most_attempts", F.col("wanted") * tries).withColumn("rounds", F.ceil(F.col("wanted") / F.col("n")))


def split_by_rank(df: DataFrame, key: str, train: float = 0.7, val: float = 0.2, salt: str = "") -> DataFrame:
    """Exact cuts at int(n * train) and int(n * (train + val)), in binary doubles. The exact rank is a
    global order; where near cuts do, use split_by_hash."""
    out = ranked(df, key, [], salt)
    a, b = F.floor(F.col("n") * F.lit(float(train))), F.floor(F.col("n") * F.lit(train + val))
    return out.withColumn("split", F.when(F.col("rank") <= a, "train").when(F.col("rank") <= b, "val").otherwise("test")).drop("rank", "n")


def split_by_hash(df: DataFrame, key: Column, train: float = 0.7, val: float = 0.2, salt: str = "") -> DataFrame:
    """Cuts of the hash's range: no order, no shuffle, near the wanted shares."""
    u = hash32(key, salt) / float(2**32)
    return df.withColumn("split", F.when(u < train, "train").when(u < train + val, "val").otherwise("test"))


def sample(df: DataFrame, key: str, by: list[str], k: int | None = None, ratio: Column | float | None = None, salt: str = "") -> DataFrame:
    """k rows of each group, or int(n * ratio): the first in the order of a hash. Of k rows each task keeps its
    own first k, and only those meet."""
    if k is not None:
        return first_of_each(df.withColumn("__hash", hash32(F.col(key), salt)), by, ["__hash", key], k).drop("__hash")
    most = F.floor(F.col("n") * (F.lit(float(ratio)) if isinstance(ratio, (int, float)) else ratio))
    return ranked(df, key, by, salt).where(F.col("rank") <= most).drop("rank", "n")


def weighted_sample(df: DataFrame, key: str, weight: str, quota: dict[str, int], by: str = "bin", salt: str = "", parts: int = 64) -> DataFrame:
    """Each group's quota of rows without repeats, with chances in proportion to weight: those of the least
    -ln(u) / weight, u from a hash of the key (exponential keys). A group with fewer rows gives all; rows without weight
    and groups without quota give none.

    Rows are dealt over ``parts`` first, and only the best of each part meet.
    """
    u = (hash32(F.col(key), salt) + 1) / float(2**32 + 1)
    race = df.where(F.col(weight) > 0).withColumn("__race", F.round(-F.log(u) / F.col(weight), 9)).withColumn("__part", F.pmod(F.xxhash64(key), F.lit(parts)))
    most = F.coalesce(*[F.when(F.col(by) == n, k) for n, k in quota.items()], F.lit(0))
    for group in ([by, "__part"], [by]):
        race = race.withColumn("__r", F.row_number().over(W.partitionBy(*group).orderBy("__race", key))).where(F.col("__r") <= most).drop("__r")
    return race.drop("__race", "__part")


def quotas(weights: dict[str, float], total: int) -> dict[str, int]:
    """total cut in whole numbers in proportion to the weights, by largest remainders; ties go by name."""
    exact = {n: total * w / sum(weights.values()) for n, w in weights.items()}
    out = {n: int(x) for n, x in exact.items()}
    for n in sorted(exact, key=lambda n: (out[n] - exact[n], n))[: total - sum(out.values())]:
        out[n] += 1
    return out


# Bins of a box's aspect ratio, from (and without) to, and their weights.
BINS = {"tiny": (2.0, 2.5, 3.0), "small": (2.5, 3.0, 2.0), "medium": (3.0, 3.5, 1.0), "large": (3.5, 4.5, 0.7), "extra_large": (4.5, 6.0, 2.5)}


def aspect_bin(aspect: Column) -> Column:
    """The bin of an aspect ratio, null outside all."""
    return F.coalesce(*[F.when((aspect >= low) & (aspect < high), name) for name, (low, high, _) in BINS.items()])


def bin_quotas(total: int) -> dict[str, int]:
    """How many of ``total`` rows each bin gives, by the bins' weights."""
    return quotas({name: weight for name, (*_, weight) in BINS.items()}, total)


def split_groups(df: DataFrame, group: str, train: float = 0.8, salt: str = "") -> DataFrame:
    """Whole groups go to train or val: the first int(n * train) in hash order to train."""
    groups = ranked(df.select(group).distinct(), group, [], salt)
    groups = groups.select(group, F.when(F.col("rank") <= F.floor(F.col("n") * F.lit(float(train))), "train").otherwise("val").alias("split"))
    return df.join(groups, group)


def base_scene(stem: Column) -> Column:
    """The scene of an augmented file: its stem without _aug and a number."""
    return F.regexp_replace(stem, r"_aug(_\d+)?$", "")


def numbered(df: DataFrame, by: list[str], order: list[str], start: int = 0, name: str = "counter") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1 + start)


def round_robin(df: DataFrame, key: str, wanted: int, by: list[str]) -> DataFrame:
    """``wanted`` attempts per group that cycle over its rows in order: attempt, and the row's columns."""
    first = first_of_each(df, by, [key], wanted)  # of a group, no more rows than attempts meet in a task
    counts, same = df.groupBy(*[F.col(k).alias(f"__{k}") for k in by]).agg(F.count("*").alias("n")), F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    rows = first.withColumn("at", F.row_number().over(W.partitionBy(*by).orderBy(key)) - 1).join(counts, same).drop(*[f"__{k}" for k in by])
    times = F.floor((F.lit(wanted) - 1 - F.col("at")) / F.col("n"))
    return rows.where(F.col("at") < wanted).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), times))).withColumn("attempt", F.col("turn") * F.col("n") + F.col("at")).drop("turn", "at", "n")
