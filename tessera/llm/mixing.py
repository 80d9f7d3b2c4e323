"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import WORD, table, text_of, written

#: floor(2**32 / golden ratio), odd: i * GOLDEN mod 2**32 is the golden-ratio sequence.
GOLDEN = 2654435769
#: First hex digits of a document's shuffle key that name its bucket of a source.
BUCKET_DIGITS = 3
#: Slots in a run that is ranked in one group, and cells that the unit interval is cut into.
RUN, CELLS = 8192, 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Words that each source is to give. sizes: source, source_size, one row a source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``total_share`` of all words; none gives over ``cap`` times its size, what is over goes
    to the rest by weight. Closed form of that resharing: the sources with the smallest
    cap per weight are full, all others get one amount per weight. The windows run over
    one row a source.
    """
    everything = W.partitionBy(F.lit(0))
    before = everything.orderBy("per_weight", "pos").rowsBetween(W.unboundedPreceding, -1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (((F.col("pos") - 1) % len(weights)) + 1).cast("int"))
    out = sizes.withColumn("pos", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())))
    out = out.withColumn("weight", w).withColumn("full", F.col("source_size") * float(cap))
    out = out.withColumn("per_weight", F.col("full") / F.col("weight"))
    budget = F.sum("source_size").over(everything) * float(total_share)
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("level", (budget - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / left)
    out = out.withColumn("open", F.col("per_weight") > F.col("level"))
    out = out.withColumn("level", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.struct("per_weight", "pos"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("full")).otherwise(F.least("full", F.col("level") * F.col("weight")))
    return out.select("source", "pos", "source_size", "weight", F.round(target, 6).alias("target"))


def _blocks_of(size: str, block: int) -> Column:
    return F.ceil(F.col(size) / block).cast("long")


def mix_plan(docs: DataFrame, block: int = 128, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None, **kinds) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The parts of a mix: (sources, spans, slots).

    sources: pos, source, source_size, target, quota (target in whole words).
    spans: one row per document and block of its source that it has words in: pos, block,
    bucket, rank (pos, bucket and rank tell a row of the input), row (the input's row_col), doc_id,
    size, first, last (words of the block, last exclusive); a document without words has one row
    without a block. Documents of a source are in order of md5 of the id, then id, size and a hash
    of the text; rows equal in all of these are alike.
    slots: slot, pos, source_rank, block, words. Read in slot order, taking from each slot's
    block its first ``words`` words, the slots are the mix.

    Point ``slot`` of the golden-ratio sequence, in the cumulated targets, names the slot's
    source; the slot's rank among those of its source names the block, in the source's
    shuffled stream of words, over again when it is at its end. Slots past a source's quota
    are void, and the few that the sequence leaves short come at the end, so each source
    gives exactly its quota and no document more than ceil(cap) times its words.
    """
    spark = docs.sparkSession
    text = text_of(text_col)
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    number = F.col(row_col) if row_col else F.lit(0).cast("long")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), F.xxhash64(text).alias("sign"), key.alias("key"), number.alias("row"))
    base = written(base.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    buckets = base.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    sources = source_targets(buckets.groupBy("source").agg(F.sum("n").alias("source_size")), **kinds)
    sources = sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    sources = written(sources)

    upto = W.partitionBy("pos").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.join(sources.select("pos", F.col("source").alias("s"), "source_size"), F.col("source").eqNullSafe(F.col("s")))
    starts = starts.select("source", "pos", "source_size", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start"))
    within = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "sign", "row").rowsBetween(W.unboundedPreceding, 0)
    placed = base.withColumn("upto", F.sum("size").over(within)).withColumn("rank", F.row_number().over(within)).alias("d")
    placed = placed.join(starts.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.bucket") == F.col("s.bucket")))
    placed = placed.select("pos", "d.bucket", "rank", "row", "doc_id", "size", (F.col("start") + F.col("upto") - F.col("size")).alias("lo"), (F.col("start") + F.col("upto")).alias("hi"))
    at = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block)))
    spans = placed.select("*", F.explode_outer(at).alias("block"))
    spans = spans.select("pos", "block", "bucket", "rank", "row", "doc_id", "size", F.greatest(F.col("lo") - F.col("block") * block, F.lit(0)).alias("first"), F.least(F.col("hi") - F.col("block") * block, F.lit(block)).alias("last"))

    # slots
    order = W.partitionBy(F.lit(0)).orderBy("pos")
    share = F.sum("quota").over(order.rowsBetween(W.unboundedPreceding, 0)) / F.sum("quota").over(W.partitionBy(F.lit(0)))
    lanes = sources.where("quota > 0").withColumn("hi", share).withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))
    blocks, left = _blocks_of("source_size", block), F.col("quota") % F.col("source_size")
    need = F.floor(F.col("quota") / F.col("source_size")) * blocks + F.ceil(left / block)
    lanes = lanes.select("pos", "source_size", "quota", "lo", "hi", blocks.alias("blocks"), need.cast("long").alias("need"))
    cells = lanes.select("pos", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    n = sources.agg(F.sum("quota")).first()[0] or 0
    points = spark.range(-(-n // block)).withColumn("point", (((F.col("id") % 2**31) * GOLDEN) % 2**32) / float(2**32))
    drawn = points.withColumn("cell", F.floor(F.col("point") * CELLS)).join(cells, "cell").where("lo <= point AND point < hi")
    drawn = drawn.select(F.col("id").alias("slot"), "pos", F.floor(F.col("id") / RUN).alias("run"))
    runs = drawn.groupBy("pos", "run").agg(F.count("*").alias("n"))
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("pos").orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranked = drawn.withColumn("r", F.row_number().over(W.partitionBy("pos", "run").orderBy("slot"))).join(runs.select("pos", "run", "before"), ["pos", "run"])
    ranked = ranked.select("slot", "pos", (F.col("before") + F.col("r") - 1).alias("source_rank")).join(lanes, "pos").where("source_rank < need")
    have = runs.groupBy("pos").agg(F.sum("n").alias("have"))
    short = lanes.join(have, "pos", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
    short = short.withColumn("source_rank", F.explode(F.sequence("have", F.col("need") - 1)))
    short = short.withColumn("slot", F.lit(-(-n // block)) + F.col("source_rank"))
    columns = ["slot", "pos", "source_rank", "source_size", "quota", "blocks"]
    slots = ranked.select(columns).unionByName(short.select(columns))
    slots = slots.withColumn("block", F.col("source_rank") % F.col("blocks"))
    begin = F.col("block") * block
    round_ = F.floor(F.col("source_rank") / F.col("blocks")) * F.col("source_size")
    words = F.least(F.lit(block), F.col("source_size") - begin, F.col("quota") - round_ - begin)
    return sources, spans, slots.select("slot", "pos", "source_rank", "block", words.alias("words"))


def _mixed(sources: DataFrame, spans: DataFrame, slots: DataFrame) -> DataFrame:
    """Per row of the input: pos, bucket, rank, row, doc_id, size, taken, n_slots, first_slot, last_slot,
    and starts, the slots that the row's times begin in."""
    uses = slots.groupBy("pos", "block").agg(F.array_sort(F.collect_list(F.struct("source_rank", "slot", "words"))).alias("uses"))  # at most ceil(cap) + 1
    zero = F.lit(0).cast("long")
    got = spans.join(uses, ["pos", "block"], "left")
    taken = F.aggregate("uses", zero, lambda a, x: a + F.greatest(F.least(x["words"], F.col("last")) - F.col("first"), zero))
    got = got.withColumn("taken", F.coalesce(taken, zero)).withColumn("in", F.transform(F.filter("uses", lambda x: x["words"] > F.col("first")), lambda x: x["slot"]))
    sums = [F.sum("taken").alias("taken"), F.coalesce(F.sum(F.greatest(F.size("in"), F.lit(0))), zero).cast("long").alias("n_slots"), F.min(F.array_min("in")).alias("first_slot"), F.max(F.array_max("in")).alias("last_slot"), F.min_by("in", "block").alias("starts")]
    return got.groupBy("pos", "bucket", "rank", "row", "doc_id", "size").agg(*sums)


def mix(docs: DataFrame, block: int = 128, **names) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken (words), n_slots,
    first_slot, last_slot (where the schedule has them; null if nothing is taken).

    One row per input row; other columns of ``docs`` are ignored. Null text has no words and
    size 0; null sources are one source, last in order; repeated rows are separate documents,
    told apart by nothing, so either may get a part that only one gets;
    an empty table gives an empty result. Hot sources are cut into buckets by key digits and
    blocks by number, so no task holds a source.
    """
    sources, spans, slots = mix_plan(docs, block, **names)
    got = _mixed(sources, spans, slots)
    return got.join(sources.select("pos", "source_size", "target"), "pos").select("doc_id", "size", "source_size", "target", "taken", "n_slots", "first_slot", "last_slot")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of docs as the mix takes them, in the order of the slots that they begin in, with all
    their columns: once for each whole time, and where it takes a part only, once more with the first
    words of the text, joined by spaces.

    Rows that the mix takes nothing of are not in it. Rows are told apart by their place in a written
    copy of docs, so null ids, ids that occur twice and repeated rows need no group of their own.
    """
    row, n = "__row", "__n"
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()))
    takes = _mixed(*mix_plan(docs, id_col=id_col, text_col=text_col, row_col=row, **settings)).where("taken > 0")
    takes = takes.select(F.col("row").alias(n), F.col("taken").alias("__taken"), F.col("size").alias("__size"), F.posexplode("starts").alias("__time", "__slot"))
    takes = takes.withColumn("__left", F.col("__taken") - F.col("__time") * F.col("__size"))
    rows = docs.join(takes, F.col(row) == F.col(n))
    words = F.slice(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), F.lit(1), F.col("__left").cast("int"))
    text = F.when(F.col("__left") >= F.col("__size"), F.col(text_col)).otherwise(F.array_join(words, " "))
    rows = rows.withColumn(text_col, text).sort("__slot", row)
    return rows.select([c for c in docs.columns if c != row])


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


ORACLE = {
    "op5_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS k,
         length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos
  FROM d GROUP BY source),
w AS (SELECT *, CASE (pos - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
c AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT first(level ORDER BY cap / weight, pos) AS level FROM c WHERE cap / weight > level),
t AS (
  SELECT source, source_size, round(CASE WHEN (SELECT level FROM l) IS NULL THEN cap ELSE least(cap, (SELECT level FROM l) * weight) END, 6) AS target FROM c),
q AS (
  SELECT doc_id, size, source_size, target, pos, floor(target + 0.5)::BIGINT AS quota,
         (sum(size) OVER (PARTITION BY pos ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING))::BIGINT AS hi
  FROM d JOIN (SELECT t.*, s.pos FROM t JOIN s ON t.source IS NOT DISTINCT FROM s.source) t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT DISTINCT pos, quota, source_size FROM q),
n AS (SELECT (sum(quota)::BIGINT + 127) // 128 AS n, sum(quota) AS total FROM u),
e AS (
  SELECT pos, quota, source_size, coalesce(lag(hi) OVER (ORDER BY pos), 0) AS lo, hi, blocks,
         (quota // source_size) * blocks + (quota % source_size + 127) // 128 AS need
  FROM (SELECT *, sum(quota) OVER (ORDER BY pos) / total AS hi, (source_size + 127) // 128 AS blocks FROM u, n WHERE quota > 0)),
p AS (SELECT i AS slot, ((i % 2147483648) * 2654435769) % 4294967296 / 4294967296.0::DOUBLE AS point FROM (SELECT unnest(range(n)) AS i FROM n)),
r AS (SELECT slot, e.*, row_number() OVER (PARTITION BY pos ORDER BY slot) - 1 AS source_rank FROM p JOIN e ON lo <= point AND point < hi),
v AS (
  SELECT slot, pos, source_rank, source_size, quota, blocks FROM r WHERE source_rank < need
  UNION ALL
  SELECT (SELECT n FROM n) + k, pos, k, source_size, quota, blocks
  FROM (SELECT e.*, unnest(range(coalesce(have, 0), need)) AS k FROM e LEFT JOIN (SELECT pos, count(*) AS have FROM r GROUP BY pos) USING (pos))),
b AS (
  SELECT slot, pos, source_rank // blocks * source_size + source_rank % blocks * 128 AS done, source_rank % blocks * 128 AS first,
         least(128, source_size - source_rank % blocks * 128, quota - source_rank // blocks * source_size - source_rank % blocks * 128) AS words FROM v),
x AS (
  SELECT q.doc_id, count(*) AS n_slots, min(slot) AS first_slot, max(slot) AS last_slot
  FROM q JOIN b ON q.pos = b.pos AND first < hi AND first + words > hi - size WHERE size > 0 GROUP BY q.doc_id)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (quota // source_size) * size + greatest(0, least(hi, quota % source_size) - (hi - size)) END AS taken,
       coalesce(n_slots, 0) AS n_slots, first_slot, last_slot
FROM q LEFT JOIN x USING (doc_id)
""",
}
QUERIES = {"op5_source_mixing": op5_source_mixing}
