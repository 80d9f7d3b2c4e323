"""How filters interact: what each removes at every place that it can have in an order."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table, text_of, written

#: Most filters: orders, and so rows, grow with the factorial.
MOST = 7
MARKS = ("alive", "removed", "redundant", "good_lost", "toxic_lost")


def lattice_edges(cells: DataFrame, filters: str) -> DataFrame:
    """Sums cells up along the edges (subset already applied, next filter) of the lattice of filters.

    cells: part, mask (bit i: fails filters[i]), good, toxic, n. Returns per part, subset (bits) and next (letter):
    alive (before the filter), removed, redundant (would be removed, but went before), good_lost, toxic_lost.
    A cell adds to len(filters) * 2**(len(filters) - 1) edges; cells number at most 4 * 2**len(filters) a part, so
    this costs the same for any number of documents. Sums are combined before the shuffle.
    """
    k = len(filters)
    edges = [(subset, i) for i in range(k) for subset in range(2**k) if not subset >> i & 1]
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("subset"), F.lit(2**i).alias("bit"), F.lit(filters[i]).alias("next")) for s, i in edges]))
    rows = cells.withColumn("e", each).select("part", "e.subset", "e.next", "good", "toxic", "n", (F.col("mask").bitwiseAND(F.col("e.subset")) == 0).alias("in"), (F.col("mask").bitwiseAND(F.col("e.bit")) != 0).alias("fails"))
    n, goes = F.col("n"), F.col("in") & F.col("fails")
    of = {"alive": F.col("in"), "removed": goes, "redundant": ~F.col("in") & F.col("fails"), "good_lost": goes & F.col("good"), "toxic_lost": goes & F.col("toxic")}
    return rows.groupBy("part", "subset", "next").agg(*[F.sum(F.when(of[m], n).otherwise(0)).alias(m) for m in MARKS])


def lattice_paths(spark: SparkSession, filters: str) -> DataFrame:
    """Every order of the filters as a path through the lattice: filter_order, step (from 1), and the edge
    (subset, next) that the step takes."""
    bit = {f: 2**i for i, f in enumerate(filters)}
    rows = [("".join(p), i + 1, sum(bit[f] for f in p[:i]), p[i]) for p in permutations(filters) for i in range(len(p))]
    return spark.createDataFrame(rows, "filter_order string, step int, subset int, next string")


def filter_audit(cells: DataFrame, filters: str) -> DataFrame:
    """All orders of the filters, step by step, for each part of cells (part, mask, good, toxic, n).

    Returns part, filter_order, step, and counts as long: kept (after the step), removed, redundant, good_lost and
    toxic_lost (here), unique_fails (fail this filter only), shapley (removed by this filter, over all orders).
    Edges are summed once and joined to the steps of the orders, so no order goes over documents.

    Every part has all orders and steps, zeros included; no cells give no rows. Filters are letters, each once,
    MOST at most.
    """
    k = len(filters)
    if not 0 < k <= MOST or len({*filters}) != k:
        raise ValueError(f"filters must be 1 to {MOST} different letters, not {filters!r}")
    edges = written(lattice_edges(cells, filters))
    # an order meets the edge from a subset of s filters in s! (k - 1 - s)! ways
    ways = F.array(*[F.lit(factorial(s) * factorial(k - 1 - s)) for s in range(k)])
    alone = F.when(F.bit_count("subset") == k - 1, F.col("removed"))
    of_filter = edges.groupBy("part", "next").agg(F.sum(F.col("removed") * ways[F.bit_count("subset")]).alias("shapley"), F.max(alone).alias("unique_fails"))
    steps = lattice_paths(cells.sparkSession, filters).join(edges, ["subset", "next"]).join(of_filter, ["part", "next"])
    long = lambda c: c.cast("long")
    return steps.select("part", "filter_order", "step", long(F.col("alive") - F.col("removed")).alias("kept"), *[long(F.col(c)).alias(c) for c in ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def failure_mask(conditions: list[Column]) -> Column:
    """Bit i is set where condition i holds; a null condition does not hold."""
    return sum((F.when(c, F.lit(2**i)).otherwise(0) for i, c in enumerate(conditions)), F.lit(0)).cast("int")


def later_copies(rows: DataFrame, id_col: str, key: str) -> DataFrame:
    """rows with later_copy: whether a row with a smaller id has the same key; nulls are the largest id.

    Least ids are combined before the shuffle. They meet the rows on key and id together, so that a key which a
    third of all rows have is dealt out by their ids.
    """
    order = F.struct(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col), F.lit(0)).alias("id"))
    least = rows.groupBy(key).agg(F.min(order).alias("o")).select(F.col(key).alias("__key"), F.col("o.none").alias("__none"), F.col("o.id").alias("__id"), F.lit(True).alias("__least"))
    on = (F.col(key) == F.col("__key")) & (F.col(id_col).isNull() == F.col("__none")) & (F.coalesce(F.col(id_col), F.lit(0)) == F.col("__id"))
    return rows.join(least, on, "left").withColumn("later_copy", F.col("__least").isNull()).drop("__key", "__none", "__id", "__least")


def text_conditions(text: Column) -> list[Column]:
    """When a text fails filters A to D: few words, repeated words, capitals, signs."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words)
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [n < 100, F.size(F.array_distinct(words)) * 100 < n * 80, capitals * 100 > F.char_length(text) * 10, text.rlike("[#$%&*|]")]


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """filter_audit of five filters on documents: A under 100 words, B distinct words under 80 %, C capitals over
    10 % of code points, D any of #$%&*|, E a copy of a smaller id's text.

    Texts are read once, to a row of facts each. Null text counts as empty, null part as the empty string; a null id
    is the largest and has no label; rows with equal id and text are no copies of each other. A document with
    several labels is good (quality 1) or toxic if one of them says so. An empty table gives an empty result; other
    columns are ignored.
    """
    text = text_of("text")
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_of(part_col).alias("part"), F.col(text_col).alias("text"))
    facts = written(base.select("id", "part", F.unhex(F.sha2(text, 256)).alias("key"), failure_mask(text_conditions(text)).alias("mask")))
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    judged = later_copies(facts, "id", "key").join(marks, "id", "left")
    mask = F.col("mask") + F.when(F.col("later_copy"), 16).otherwise(0)
    no = F.lit(False)
    cells = judged.groupBy("part", mask.alias("mask"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(F.count("*").alias("n"))
    return filter_audit(cells, "ABCDE")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = {
    "op11_filter_audit": r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
d AS (SELECT doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY t) AS e FROM w),
m AS (SELECT part, MAP {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, quality, toxic, count(*) AS n FROM d LEFT JOIN labels USING (doc_id) GROUP BY ALL),
x(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
st AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o),
z AS (SELECT part, filter_order, step, n, quality, toxic, f[filter_order[step]] AS fails, len(list_filter(range(1, step), lambda i: f[filter_order[i]])) > 0 AS gone,
  len(list_filter(map_values(f), lambda v: v)) = 1 AS one FROM m, st),
y AS (SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (fails AND one), 0)::BIGINT AS unique_fails, coalesce(sum(n) FILTER (NOT gone AND fails AND quality = 1), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (NOT gone AND fails AND toxic = 1), 0)::BIGINT AS toxic_lost FROM z GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley FROM y
""",
}
QUERIES = {"op11_filter_audit": op11_filter_audit}
