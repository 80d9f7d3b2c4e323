"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, table, text_of, written


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64, digest: bool = False) -> DataFrame:
    """Finds texts that are equal once white space is deleted; one row of each group stays.

    Three narrowing passes: lengths that occur twice; among those, (length, hash of the
    first ``prefix_chars`` characters) that occur twice; only rows of such groups have
    their whole content hashed. Counts are combined before each shuffle, and joins have a
    small side of counts that Spark broadcasts when its measured size allows and otherwise
    sort-merges, with skewed keys split by AQE; so a group with a third of all rows is fine.

    Returns per input row: id, keep_id, group_size, kept, and with ``digest`` also
    text_sha256 of the normalised text. Other columns of ``docs`` are ignored.

    Null text counts as empty; empty texts form one group. The row with the most code
    points stays, then the smallest id; a null id counts as largest. Repeated rows with one
    id are all marked kept if that id stays. An empty table gives an empty result.
    """
    norm = F.translate("text", WS, "")
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    keyed = base.select("id", "text", F.octet_length(norm).alias("len"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("prefix"))

    lengths = base.groupBy(F.octet_length(norm).alias("len")).agg(F.count("*").alias("n")).where("n > 1").select("len")
    prefixes = keyed.select("len", "prefix").join(lengths, "len", "left_semi").groupBy("len", "prefix").agg(F.count("*").alias("n")).where("n > 1").select("len", "prefix", F.lit(True).alias("again"))

    hashed = F.sha2(norm, 256)
    narrow = keyed.join(prefixes, ["len", "prefix"], "left").select("id", F.char_length("text").alias("points"), "len", "prefix", F.when(F.col("again"), hashed).alias("full"), *([hashed.alias("text_sha256")] if digest else []))
    narrow = written(narrow)

    best = F.struct(-F.col("points"), F.col("id").isNull(), F.col("id"))
    groups = narrow.where("full IS NOT NULL").groupBy("len", "prefix", "full").agg(F.min(best).alias("best"), F.count("*").alias("n"))
    groups = groups.select("len", "prefix", "full", F.col("best.id").alias("keep"), "n")
    out = narrow.join(groups, ["len", "prefix", "full"], "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return out.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        *(["text_sha256"] if digest else []),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest=True)


ORACLE = {
    "op3_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, count(*) AS group_size, first(doc_id ORDER BY points DESC, doc_id) AS keep_id
  FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
""",
}
QUERIES = {"op3_exact_dedup": op3_exact_dedup}
