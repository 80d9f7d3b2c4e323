"""Joins of files and labels, candidate lookup, duplicate groups, merging with precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import hashing
from ..sources.scratch import written
from .graphs import components
from .matching import settled_in_order

#: Signatures of a band's cell that are compared with one another.
HOT = 100


def correspondence(images: DataFrame, labels: DataFrame, key: list[str]) -> DataFrame:
    """Keys with an image, a label or both, and which."""
    a, b = images.select(*key).distinct().withColumn("has_image", F.lit(True)), labels.select(*key).distinct().withColumn("has_label", F.lit(True))
    out = a.join(b, key, "full_outer")
    return out.select(*key, F.coalesce("has_image", F.lit(False)).alias("has_image"), F.coalesce("has_label", F.lit(False)).alias("has_label"))


def first_candidate(wanted: DataFrame, candidates: DataFrame, key: str, rank: str = "rank") -> DataFrame:
    """Each key's candidate of the lowest rank: one equi-join, no OR."""
    best = candidates.groupBy(key).agg(F.min_by(F.struct(*[c for c in candidates.columns if c != key]), F.col(rank)).alias("c"))
    return wanted.join(best, key, "left").select(*wanted.columns, "c.*")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def exact_groups(files: DataFrame, hash_col: str, path: str) -> DataFrame:
    """Hashes of several files: the first path, and how many."""
    return files.groupBy(hash_col).agg(F.count("*").alias("n"), F.min(path).alias("first")).where("n > 1")


#: What makes two files one, and how files go to another place.
DEDUP_KEYS, TRANSFERS = ("md5", "filename"), ("copy", "symlink")


def transfer_plan(files: DataFrame, root: str, dedup: str = "md5", transfer: str = "copy") -> DataFrame:
    """path, target, action of the files that go to ``root``: the first by path of those with one hash or, as ``dedup``
    says, one name. files: path, split, name, hash."""
    for value, known in ((dedup, DEDUP_KEYS), (transfer, TRANSFERS)):
        if value not in known:
            raise ValueError(f"no {value}; there are {', '.join(known)}")
    key = "hash" if dedup == "md5" else "name"
    first = files.groupBy(key).agg(F.min_by(F.struct("path", "split", "name"), "path").alias("f")).select("f.*")
    return first.select("path", F.concat_ws("/", F.lit(root), F.lit("images"), "split", "name").alias("target"), F.lit(transfer).alias("action"))


def _bands(fixed: int, most: int) -> list[int]:
    """Masks that cut the bits which are not fixed in most + 1 bands, each with the fixed bits."""
    free, n = [i for i in range(64) if not fixed >> i & 1], most + 1
    return [fixed | sum(1 << i for i in free[len(free) * k // n : len(free) * (k + 1) // n]) for k in range(n)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >> 63 else mask


def near_pairs(hashes: DataFrame, id_col: str, sign: str, most: int = 3) -> DataFrame:
    """a < b with signatures (64 bits) at most so many bits apart, and the distance: between the first ids of different
    signatures, and from the first id of a signature to its copies (distance 0). with_copies() has the copies' links too.

    Cut in most + 1 bands, two such signatures have an equal band: an equi-join on it, no pairs
    of all with all. A cell with over HOT signatures is not joined but cut further: of the bits that are not equal in it
    yet, again most + 1 bands, of which a near pair has one equal; and so on while bits are left. Equal signatures are
    joined once, as groups, before, so a cell with few bits left is small.
    """
    groups = hashes.groupBy(sign).agg(F.min(id_col).alias("rep"))
    left, masks, met = groups.select("rep", F.col(sign).alias("s")).withColumn("fixed", F.lit(0).cast("long")), [0], []
    while masks:
        cuts = F.create_map(*[x for m in masks for x in (F.lit(m).cast("long"), F.array(*[F.lit(_signed(x)).cast("long") for x in _bands(m % 2**64, most)]))])
        cells = left.withColumn("fixed", F.explode(cuts[F.col("fixed")]))
        cells = written(cells.withColumn("bits", F.col("s").bitwiseAND(F.col("fixed"))))
        hot = cells.groupBy("fixed", "bits").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("fixed", "bits")
        masks = [r.fixed for r in hot.select("fixed").distinct().collect()]  # bands, not cells: a few
        cold = cells.join(hot, ["fixed", "bits"], "left_anti") if masks else cells
        other = cold.select("fixed", "bits", F.col("rep").alias("b"), F.col("s").alias("t"))
        pair = cold.join(other, ["fixed", "bits"]).where("rep < b").select(F.col("rep").alias("a"), "b", hashing.distance(F.col("s"), F.col("t")).alias("distance"))
        met.append(pair.where(F.col("distance") <= most))
        left = cells.join(hot, ["fixed", "bits"], "left_semi").select("rep", "s", "fixed")
    near = reduce(DataFrame.unionByName, met).distinct()
    same = hashes.join(groups, sign).where(F.col(id_col) != F.col("rep")).select(F.col("rep").alias("a"), F.col(id_col).alias("b"), F.lit(0).alias("distance"))
    return near.unionByName(same)


def with_copies(near: DataFrame) -> DataFrame:
    """What near_pairs gives, with the links of all copies: every a < b with signatures as near as asked, and the distance.
    As many rows as there are such pairs."""
    near = written(near)
    copies = near.where("distance = 0").select(F.col("a").alias("rep"), F.col("b").alias("id"))
    members = copies.unionByName(copies.select("rep", F.col("rep").alias("id")).distinct())
    ends = near.where("distance > 0")
    for side in ("a", "b"):
        of = members.select(F.col("rep").alias(side), "id")
        ends = ends.join(of, side, "left").withColumn(side, F.coalesce("id", side)).drop("id")
    ends = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")
    same = members.withColumnRenamed("id", "a").join(members.withColumnRenamed("id", "b"), "rep").where("a < b")
    return ends.unionByName(same.select("a", "b", F.lit(0).alias("distance")))


def near_groups(near: DataFrame) -> DataFrame:
    """star_groups of all that with_copies has, from what near_pairs gives: no pairs of copies are made.

    The first of equal signatures is its class's least id. If it heads a group it takes the others; if not, the head that
    takes it is before them and takes them too. So only first ones are settled, and copies go where theirs goes.
    """
    near = written(near)
    groups = written(star_groups(near.where("distance > 0")))
    copies = near.where("distance = 0").select(F.col("a").alias("rep"), F.col("b").alias("member"))
    heads = copies.join(groups.select("head", F.col("member").alias("rep")), "rep", "left")
    return groups.unionByName(heads.select(F.coalesce("head", "rep").alias("head"), "member"))


def star_groups(pairs: DataFrame) -> DataFrame:
    """(head, member): in order of id, a row that is not in a group yet heads one, and takes all later
    rows near it that are in none. Not transitive: what a member is near to stays out.

    Links that hang together are settled in order in one task, where they are MOST_PAIRS at most: a chain costs no round a
    link. Larger ones go through rounds first: a row without a smaller undecided neighbour is a head.
    """
    edges = written(pairs.select("a", "b").distinct())
    whole = components(edges)
    edges = edges.join(whole.select(F.col("node").alias("a"), "root"), "a").select("root", "a", "b")
    gone = settled_in_order(edges, ["root"], "a", "b")
    heads = edges.join(gone.select("root", F.col("b").alias("a")), ["root", "a"], "left_anti")
    return heads.groupBy("b").agg(F.min("a").alias("head")).select("head", F.col("b").alias("member"))


def merge_with_precedence(rows: DataFrame, key: str = "key", valid: str = "valid", order: tuple[str, ...] = ("prio", "pos")) -> DataFrame:
    """Adds outcome: accepted, duplicate or invalid, as if rows were visited in order, a key were
    taken by its first valid row, and later rows of a taken key were duplicates whatever they are."""
    at = F.struct(*order)
    first = F.min(F.when(F.col(valid), at)).over(W.partitionBy(key))
    return rows.withColumn("__first", first).withColumn("outcome", F.when(F.col("__first").isNotNull() & (at > F.col("__first")), "duplicate").when(~F.col(valid), "invalid").otherwise("accepted")).drop("__first")
