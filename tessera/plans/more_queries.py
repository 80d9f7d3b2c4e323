"""The rest of the queries: plate text, statistics, votes, trials, near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import hashing, plates
from ..functions.sampling import hash32, uniform, weighted_choice
from ..operators import merging, quality, stats, voting
from . import bindings as b
from .queries import FILES, H, _files, _measured, clean_report, query, shown

# plate text -----------------------------------------------------------------------------------

NUM_SQL = "translate(upper({}), 'OIJLGSZBQD', '0134652800')"
LET_SQL = "translate(upper({}), '0125864', 'OIZSBGL')"
DIG_SQL = "translate({}, 'ODQUCILT/|JZSGBAFEH', '0000011111125684884')"
LIST = lambda xs: "['" + "','".join(xs) + "']"
SIZES_SQL = "CASE WHEN kind = 'BIKE' THEN [8, 9] WHEN kind LIKE '%CAR%' THEN [7, 8] ELSE [7, 8, 9] END"


@query(f"WITH {b.PLATES} SELECT event_id, regexp_replace(upper(text || '-.a'), '[^A-Z0-9]', '', 'g') AS cleaned, {NUM_SQL.format('text')} AS numbers, {LET_SQL.format('text')} AS letters, {DIG_SQL.format('text')} AS digits, CASE WHEN length(text) >= 8 THEN substr(text, 1, 4) || '-' || substr(text, 5) WHEN length(text) = 7 THEN substr(text, 1, 3) || '-' || substr(text, 4) ELSE text END AS shown FROM p")
def plate_force_chars(spark, sf):
    t = F.col("text")
    return b.plates(spark, sf).select("event_id", plates.clean(F.concat(t, F.lit("-.a"))).alias("cleaned"), plates.as_number(t).alias("numbers"), plates.as_letter(t).alias("letters"), F.translate(t, *plates.VIDEO_TO_DIGIT).alias("digits"), plates.display(t).alias("shown"))


@query(f"WITH {b.PLATES} SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'CAR_RECT' WHEN event_id % 4 = 3 THEN 'UNKNOWN' WHEN length(top) <= 3 THEN 'CAR_SQUARE' ELSE 'BIKE' END AS layout FROM p")
def plate_layout(spark, sf):
    i = F.col("event_id")
    lines = F.when(i % 4 == 0, F.array(F.lit("-"), F.col("text"))).when(i % 4 == 3, F.array(F.lit("a"), F.lit("."))).otherwise(F.array("top", "text"))
    return b.plates(spark, sf).select("event_id", plates.layout(lines).alias("layout"))


EXTRACT_SQL = f"""x AS (SELECT *, {SIZES_SQL} AS sizes FROM p),
y AS (SELECT *, flatten([[substr(text, i, k) FOR i IN range(1, length(text) - k + 2)] FOR k IN sizes]) AS wins FROM x),
z AS (SELECT *, [w FOR w IN wins IF list_contains({LIST(plates.PROVINCES)}, {NUM_SQL.format('substr(w, 1, 2)')})] AS good FROM y),
e AS (SELECT event_id, kind, sizes, CASE WHEN list_contains(sizes, length(text)) THEN text ELSE coalesce([w FOR w IN good IF length(w) = list_max([length(g) FOR g IN good])][1], text) END AS got FROM z)"""


@query(f"WITH {b.PLATES}, {EXTRACT_SQL} SELECT event_id, got AS extracted FROM e")
def plate_extract(spark, sf):
    return b.plates(spark, sf).select("event_id", plates.extract(F.col("text"), F.col("kind")).alias("extracted"))


@query(f"""WITH {b.PLATES}, {EXTRACT_SQL}, v AS (SELECT event_id, list_contains(sizes, length(got)) AS fits, got, {NUM_SQL.format('substr(got, 1, 2)')} || {LET_SQL.format('substr(got, 3, 1)')} || {NUM_SQL.format('substr(got, 4)')} AS fixed FROM e)
SELECT event_id, fits AND list_contains({LIST(plates.PROVINCES)}, substr(fixed, 1, 2)) AS valid, CASE WHEN fits THEN fixed ELSE got END AS text FROM v""")
def plate_validate(spark, sf):
    return plates.validated(b.plates(spark, sf)).select("event_id", "valid", "text")


@query(f"""WITH {b.PLATES}, c AS (SELECT event_id, text, {DIG_SQL.format('substr(text, 1, 2)')} AS code FROM p),
d AS (SELECT *, CASE WHEN list_contains({LIST(plates.VIDEO_PROVINCES)}, code) THEN code ELSE coalesce(list_max([x FOR x IN {LIST(plates.VIDEO_PROVINCES)} IF contains(x, substr(code, 1, 1)) OR contains(x, substr(code, 2, 1))]), code) END AS province FROM c)
SELECT event_id, CASE WHEN length(text) BETWEEN 7 AND 10 THEN province || translate(translate(substr(text, 3, 1), '06852147U', 'DGBSZLATL'), 'U0O', 'LDD') ||
  CASE WHEN length(text) >= 8 THEN translate(substr(text, 4, 1), 'U', 'L') || {DIG_SQL.format('substr(text, 5)')} ELSE {DIG_SQL.format('substr(text, 4)')} END END AS corrected FROM d""")
def plate_smart_correct(spark, sf):
    return b.plates(spark, sf).select("event_id", plates.smart_correct(F.col("text")).alias("corrected"))


PATTERN_CASE = "CASE WHEN u * 1.0 < 0.6 THEN '##A#####' WHEN u < 0.8 THEN '##A####' WHEN u < 0.9 THEN '##AB###' WHEN u < 0.95 THEN '###A####' WHEN u < 0.98 THEN '##A##' ELSE '###A##' END"


@query(f"""WITH u AS (SELECT event_id, ('0x' || substr(md5('pattern' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM events), p AS (SELECT event_id, {PATTERN_CASE} AS pattern FROM u),
t AS (SELECT event_id, pattern, array_to_string([CASE WHEN pattern[i] = '#' THEN (('0x' || substr(md5('c' || event_id || '/' || (i - 1)), 1, 8))::BIGINT % 10)::VARCHAR ELSE {b.LETTER_LIST}[(('0x' || substr(md5('c' || event_id || '/' || (i - 1)), 1, 8))::BIGINT % 20 + 1)::INT] END FOR i IN range(1, length(pattern) + 1)], '') AS t FROM p)
SELECT event_id, pattern, CASE WHEN t[3] BETWEEN 'A' AND 'Z' THEN substr(t, 1, 3) || '-' || substr(t, 4) ELSE substr(t, 1, 2) || '-' || substr(t, 3) END AS plate FROM t""")
def plate_generate(spark, sf):
    names, weights = zip(*plates.PATTERNS, strict=True)
    e = b.table(spark, sf, "events").select("event_id", weighted_choice(uniform(F.col("event_id"), "pattern"), names, weights).alias("pattern"))
    pick = lambda c, i: F.when(c == "#", (hash32(F.concat(F.col("event_id"), F.lit("/"), i), "c") % 10).cast("string")).otherwise(F.substring(F.lit(plates.LETTERS), (hash32(F.concat(F.col("event_id"), F.lit("/"), i), "c") % 20 + 1).cast("int"), F.lit(1)))
    t = F.array_join(F.transform(F.split("pattern", ""), pick), "")
    e = e.withColumn("t", t)
    dash = F.when(F.substring("t", 3, 1).between("A", "Z"), 3).otherwise(2)
    return e.select("event_id", "pattern", F.concat(F.substring(F.col("t"), F.lit(1), dash), F.lit("-"), F.substring(F.col("t"), dash + 1, F.lit(100))).alias("plate"))


# statistics -----------------------------------------------------------------------------------

def _describe_sql(columns: dict[str, str], source: str, quartiles: bool = True) -> str:
    v = "round({}({}), 6)"
    more = (("median", 0.5), ("q1", 0.25), ("q3", 0.75)) if quartiles else ()
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max" + "".join(f", round(quantile_cont({c}, {q}), 6) AS {a}" for a, q in more) + f" FROM {source}" for n, c in columns.items())


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BOX_NUMBERS = {"width": "x2 - x1", "height": "y2 - y1", "area": "(x2 - x1) * (y2 - y1)", "aspect": "(x2 - x1) / (y2 - y1)", "cx": "(x1 + x2) / 2 / 640", "cy": "(y1 + y2) / 2 / 480", "area_ratio": "(x2 - x1) * (y2 - y1) / 307200"}


@query(_describe_sql({c: f"{c}::DOUBLE" for c in NUMERIC}, "lineitem"))
def describe_numeric(spark, sf):
    return stats.describe(b.table(spark, sf, "lineitem"), NUMERIC)


@query(f"WITH {b.BOXES} " + _describe_sql(BOX_NUMBERS, "b", False))
def describe_boxes(spark, sf):
    return stats.describe(_measured(spark, sf), list(BOX_NUMBERS), quartiles=False)


@query("SELECT round(avg((l_quantity < 10)::INT) * 100, 6) AS below, round(avg((l_quantity > 45)::INT) * 100, 6) AS above, CASE WHEN avg((l_quantity < 10)::INT) * 100 < 5 AND avg((l_quantity > 45)::INT) * 100 < 5 THEN 'Good' ELSE 'Needs Attention' END AS assessment FROM lineitem")
def pct_thresholds(spark, sf):
    x = b.table(spark, sf, "lineitem").agg(stats.percent(F.col("l_quantity") < 10).alias("below"), stats.percent(F.col("l_quantity") > 45).alias("above"))
    return shown(x.withColumn("assessment", F.when((F.col("below") < 5) & (F.col("above") < 5), "Good").otherwise("Needs Attention")))


CORR = "WITH c AS (" + " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 6) AS r FROM lineitem" for i, x in enumerate(NUMERIC) for y in NUMERIC[i + 1 :]) + ")"


@query(CORR + " SELECT * FROM c")
def corr_matrix(spark, sf):
    return stats.correlations(b.table(spark, sf, "lineitem"), NUMERIC)


@query(CORR + " SELECT a, b, r, CASE WHEN abs(r) > 0.7 THEN 'Strong' WHEN abs(r) > 0.5 THEN 'Moderate' ELSE 'Weak' END AS strength FROM c WHERE abs(r) > 0.3")
def corr_significant(spark, sf):
    return corr_matrix(spark, sf).where("abs(r) > 0.3").withColumn("strength", stats.strength(F.col("r")))


SCORES = f"""WITH {FILES}, s AS (SELECT dataset, count(*) AS n, avg((length < 800)::INT) * 100 AS blurry, avg((length < 300)::INT) * 100 AS small, avg((length > 5000)::INT) * 100 AS large, count(*) > count(DISTINCT hash) AS leaks FROM f GROUP BY dataset),
q AS (SELECT *, greatest(0, least(100, 100 - (CASE WHEN n < 1000 THEN least(20, (1000 - n) / 1000.0::DOUBLE * 40) ELSE 0 END + CASE WHEN blurry > 10 THEN least(15, blurry - 10) ELSE 0 END + CASE WHEN small > 5 THEN least(10, small - 5) ELSE 0 END + CASE WHEN large > 5 THEN least(10, large - 5) ELSE 0 END + CASE WHEN leaks THEN 10 ELSE 0 END))) AS score FROM s)"""


@query(SCORES + " SELECT dataset, round(score, 6) AS score, CASE WHEN score >= 90 THEN 'A+' WHEN score >= 85 THEN 'A' WHEN score >= 80 THEN 'A-' WHEN score >= 75 THEN 'B+' WHEN score >= 70 THEN 'B' WHEN score >= 65 THEN 'B-' WHEN score >= 60 THEN 'C+' WHEN score >= 55 THEN 'C' WHEN score >= 50 THEN 'C-' ELSE 'F' END AS grade FROM q")
def quality_score(spark, sf):
    s = _files(spark, sf).groupBy("dataset").agg(F.count("*").alias("n"), stats.percent(F.col("length") < 800).alias("blurry"), stats.percent(F.col("length") < 300).alias("small"), stats.percent(F.col("length") > 5000).alias("large"), (F.count("*") > F.countDistinct("hash")).alias("leaks"))
    s = s.withColumn("score", quality.score(*[F.col(c) for c in ("n", "blurry", "small", "large", "leaks")]))
    return s.select("dataset", F.round("score", 6).alias("score"), quality.grade(F.col("score")).alias("grade"))


@query(f"""WITH {FILES}, c AS (SELECT split, count(*) AS n FROM f GROUP BY split), r AS (SELECT split, n / sum(n) OVER () AS share FROM c), k AS (
SELECT 'size' AS name, CASE WHEN (SELECT count(*) FROM f) >= 1000 THEN 'PASS' ELSE 'WARNING' END AS status UNION ALL SELECT 'shares', CASE WHEN (SELECT bool_and(share > 0.05 AND share < 0.95) FROM r) THEN 'PASS' ELSE 'FAIL' END UNION ALL SELECT 'train', CASE WHEN (SELECT max(share) FROM r WHERE split = 'train') > 0.5 THEN 'PASS' ELSE 'WARNING' END)
SELECT name, status, round(avg((status = 'PASS')::INT) OVER () * 100, 6) AS pass_rate FROM k""")
def quality_checks(spark, sf):
    r = stats.shares(_files(spark, sf), "split")
    t = r.agg(F.sum("n").alias("n"), F.bool_and((F.col("share") > 0.05) & (F.col("share") < 0.95)).alias("ok"), F.max(F.when(F.col("split") == "train", F.col("share"))).alias("train"))
    checks = F.array(F.struct(F.lit("size").alias("name"), F.when(F.col("n") >= 1000, "PASS").otherwise("WARNING").alias("status")), F.struct(F.lit("shares").alias("name"), F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status")), F.struct(F.lit("train").alias("name"), F.when(F.col("train") > 0.5, "PASS").otherwise("WARNING").alias("status")))
    out = t.select(F.explode(checks).alias("c")).select("c.*")
    return out.withColumn("pass_rate", F.round(F.avg((F.col("status") == "PASS").cast("int")).over(W.partitionBy(F.lit(0))) * 100, 6))


# Augmentation pipelines and their weights.
PIPELINES = (("mild_color", 0.18), ("mild_geo", 0.18), ("blur_noise", 0.15), ("weather_light", 0.12), ("combo_light", 0.15), ("advanced", 0.15), ("rare_cases_light", 0.07))


@query(f"WITH c AS (SELECT CASE WHEN u < 0.18 THEN 'mild_color' WHEN u < 0.36 THEN 'mild_geo' WHEN u < 0.51 THEN 'blur_noise' WHEN u < 0.63 THEN 'weather_light' WHEN u < 0.78 THEN 'combo_light' WHEN u < 0.93 THEN 'advanced' ELSE 'rare_cases_light' END AS pipeline FROM (SELECT {H.format('c_custkey')} / 4294967296.0::DOUBLE AS u FROM customer)) SELECT pipeline, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM c GROUP BY pipeline")
def usage_shares(spark, sf):
    chosen = weighted_choice(uniform(F.col("c_custkey")), *zip(*PIPELINES, strict=True))
    return stats.shares(b.table(spark, sf, "customer").select(chosen.alias("pipeline")), "pipeline")


@query("SELECT n_name AS split, count(*) FILTER (c_custkey % 3 = 0) AS augmented, count(*) FILTER (c_custkey % 7 = 1) AS failed, round(count(*) FILTER (c_custkey % 3 = 0)::DOUBLE / greatest(1, count(*)), 6) AS ratio, round(count(*) FILTER (c_custkey % 3 = 0)::DOUBLE / greatest(1, count(*) FILTER (c_custkey % 3 = 0) + count(*) FILTER (c_custkey % 7 = 1)), 6) AS success FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def augmentation_stats(spark, sf):
    c = b.table(spark, sf, "customer").join(b.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    a = c.groupBy(F.col("n_name").alias("split")).agg(F.count("*").alias("copied"), F.count_if(F.col("c_custkey") % 3 == 0).alias("augmented"), F.count_if(F.col("c_custkey") % 7 == 1).alias("failed"))
    one = F.lit(1).cast("bigint")
    return a.select("split", "augmented", "failed", F.round(F.col("augmented") / F.greatest(one, "copied"), 6).alias("ratio"), F.round(F.col("augmented") / F.greatest(one, F.col("augmented") + F.col("failed")), 6).alias("success"))


LATENCY = "WITH s AS (SELECT l_returnflag AS format, count(*) AS runs, avg(l_extendedprice) AS mean, quantile_cont(l_extendedprice, 0.95) AS p95, quantile_cont(l_extendedprice, 0.99) AS p99, median(l_extendedprice) AS med FROM lineitem GROUP BY l_returnflag)"


def _latency(spark, sf):
    runs = b.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("format"), F.col("l_extendedprice").alias("value"))
    mean = runs.groupBy("format").agg(F.count("*").alias("runs"), F.avg("value").alias("mean"))
    return mean.join(stats.quantiles(runs, "format", {"p95": 0.95, "p99": 0.99, "med": 0.5}), "format")


@query(LATENCY + " SELECT format, runs, round(mean, 4) AS mean, round(p95, 4) AS p95, round(p99, 4) AS p99, round(med, 4) AS med, round(1000 / mean, 8) AS fps FROM s")
def latency_stats(spark, sf):
    s = _latency(spark, sf)
    return s.select("format", "runs", *[F.round(c, 4).alias(c) for c in ("mean", "p95", "p99", "med")], F.round(1000 / F.col("mean"), 8).alias("fps"))


@query(LATENCY + " SELECT format, round((SELECT mean FROM s WHERE format = 'A') / mean, 6) AS speedup FROM s")
def format_speedup(spark, sf):
    base = F.max(F.when(F.col("format") == "A", F.col("mean"))).over(W.partitionBy(F.lit(0)))  # three rows
    mean = b.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("format")).agg(F.avg("l_extendedprice").alias("mean"))
    return mean.select("format", F.round(base / F.col("mean"), 6).alias("speedup"))


@query("""WITH t AS (SELECT o_custkey AS study, o_orderkey AS trial, o_totalprice AS score FROM orders),
m AS (SELECT *, max(score) OVER (PARTITION BY study ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM t),
i AS (SELECT *, best_before IS NULL OR score > best_before AS improved FROM m), g AS (SELECT *, sum(improved::INT) OVER (PARTITION BY study ORDER BY trial) AS run FROM i)
SELECT study, trial, improved, (row_number() OVER (PARTITION BY study, run ORDER BY trial) - 1)::BIGINT AS stale, row_number() OVER (PARTITION BY study, run ORDER BY trial) - 1 >= 3 AS pruned FROM g""")
def hpo_convergence(spark, sf):
    t = b.table(spark, sf, "orders").select(F.col("o_custkey").alias("study"), F.col("o_orderkey").alias("trial"), F.col("o_totalprice").alias("score"))
    w = W.partitionBy("study").orderBy("trial")
    best = F.max("score").over(w.rowsBetween(W.unboundedPreceding, -1))
    t = t.withColumn("improved", best.isNull() | (F.col("score") > best)).withColumn("run", F.sum(F.col("improved").cast("int")).over(w))
    stale = F.row_number().over(W.partitionBy("study", "run").orderBy("trial")) - 1
    return t.select("study", "trial", "improved", stale.cast("bigint").alias("stale"), (stale >= 3).alias("pruned"))


@query("SELECT o_custkey AS study, first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS best_trial, round(max(o_totalprice), 4) AS best, count(*) AS trials, round(max(0.5 * (o_totalprice / 1000) + 0.3 * (o_totalprice / 2000) + 0.1 + 0.1), 9) AS fitness FROM orders GROUP BY o_custkey")
def hpo_best(spark, sf):
    p = F.col("o_totalprice")
    return b.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("study")).agg(F.min_by("o_orderkey", F.struct(-p, "o_orderkey")).alias("best_trial"), F.round(F.max(p), 4).alias("best"), F.count("*").alias("trials"), F.round(F.max(0.5 * (p / 1000) + 0.3 * (p / 2000) + 0.1 + 0.1), 9).alias("fitness"))


@query("""SELECT o_orderkey AS trial, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 32 END, CASE WHEN o_orderkey % 3 = 0 THEN 16 END, 8)::INT AS batch,
CASE WHEN coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 32 END, CASE WHEN o_orderkey % 3 = 0 THEN 16 END, 8) >= 24 AND (CASE WHEN o_orderkey % 2 = 0 THEN 768 ELSE 640 END) > 640 THEN 640 WHEN o_orderkey % 2 = 0 THEN 768 ELSE 640 END AS imgsz FROM orders""")
def layered_params(spark, sf):
    i = F.col("o_orderkey")
    batch = F.coalesce(F.when(i % 5 == 0, 32), F.when(i % 3 == 0, 16), F.lit(8))
    size = F.when(i % 2 == 0, 768).otherwise(640)
    return b.table(spark, sf, "orders").select(i.alias("trial"), batch.alias("batch"), F.when((batch >= 24) & (size > 640), 640).otherwise(size).alias("imgsz"))


@query("SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total, grouping(r_name)::INT + grouping(n_name)::INT AS level FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def star_rollup(spark, sf):
    c = b.table(spark, sf, "customer").join(b.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(b.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return c.rollup("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"), (F.grouping("r_name") + F.grouping("n_name")).cast("int").alias("level"))


# near duplicates ------------------------------------------------------------------------------

def _signs(spark, sf):
    """Signatures, and twins of them with one to three bits changed."""
    e = b.table(spark, sf, "embeddings").select(F.col("vec_id").cast("bigint").alias("id"), hashing.sign_bits(F.col("embedding")).alias("sign"))
    i = F.col("id")
    one = F.lit(1).cast("bigint")
    bit = lambda p: F.call_function("shiftleft", one, (i * p % 61).cast("int"))
    mask = bit(7).bitwiseOR(F.when(i % 3 > 0, bit(11)).otherwise(F.lit(0).cast("bigint"))).bitwiseOR(F.when(i % 3 > 1, bit(13)).otherwise(F.lit(0).cast("bigint")))
    return e.unionByName(e.select((i + 1_000_000).alias("id"), F.col("sign").bitwiseXOR(mask).alias("sign")))


SIGN_SQL = "(" + " + ".join(f"CASE WHEN embedding[{i + 1}] > 0 THEN {2**i}::UBIGINT ELSE 0::UBIGINT END" for i in range(64)) + ")"
MASK_SQL = "((1::UBIGINT << (id * 7 % 61)::INT) | CASE WHEN id % 3 > 0 THEN (1::UBIGINT << (id * 11 % 61)::INT) ELSE 0::UBIGINT END | CASE WHEN id % 3 > 1 THEN (1::UBIGINT << (id * 13 % 61)::INT) ELSE 0::UBIGINT END)"
NEAR_SQL = f"""WITH e AS (SELECT vec_id::BIGINT AS id, {SIGN_SQL} AS s FROM embeddings), t AS (SELECT id, s FROM e UNION ALL SELECT id + 1000000, xor(s, {MASK_SQL}) FROM e)"""


@query(NEAR_SQL + " SELECT x.id AS a, y.id AS b, bit_count(xor(x.s, y.s))::INT AS distance, round(1 - bit_count(xor(x.s, y.s)) / 64.0::DOUBLE, 6) AS similarity FROM t x JOIN t y ON x.id < y.id AND bit_count(xor(x.s, y.s)) <= 3")
def near_dupes(spark, sf):
    p = merging.with_copies(merging.near_pairs(_signs(spark, sf), "id", "sign"))
    return p.withColumn("similarity", F.round(1 - F.col("distance") / 64.0, 6))


@query()
def near_dupe_groups(spark, sf):
    return merging.near_groups(merging.near_pairs(_signs(spark, sf), "id", "sign"))


# votes ----------------------------------------------------------------------------------------

VOTES = "WITH v AS (SELECT user_id AS track, event_type AS text, sum(value) AS votes, min(event_id) AS first_seen, count(*) AS n FROM events GROUP BY ALL)"


@query(VOTES + ", r AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY round(votes, 6) DESC, first_seen) AS r FROM v) SELECT track, text, round(votes, 4) AS votes, first_seen, n FROM r WHERE r = 1")
def track_vote(spark, sf):
    return shown(voting.winner(voting.votes(b.reads(spark, sf))), 4)


@query("WITH r AS (SELECT user_id AS track, event_id AS frame, event_type AS text, value AS conf, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) SELECT track, frame, text, round(conf, 6) AS conf FROM r WHERE r = 1")
def track_best(spark, sf):
    return shown(voting.best_read(b.reads(spark, sf)).select("track", "frame", "text", "conf"))


@query("""WITH e AS (SELECT user_id AS track, event_id AS frame, event_type AS text, value FROM events), t AS (SELECT track, text, min(frame) AS first_seen FROM e GROUP BY ALL),
c AS (SELECT e.track, e.frame, t.text, t.first_seen, sum(x.value) AS votes FROM e JOIN t ON t.track = e.track AND t.first_seen <= e.frame JOIN e x ON x.track = e.track AND x.text = t.text AND x.frame <= e.frame GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY track, frame ORDER BY round(votes, 6) DESC, first_seen) AS r FROM c) SELECT track, frame, text AS leader, round(votes, 4) AS votes FROM r WHERE r = 1""")
def track_vote_running(spark, sf):
    return voting.running_winner(b.reads(spark, sf))


@query("SELECT user_id AS track, round(avg(value), 6) AS mean_conf, count(*) FILTER (value > 30) AS confident FROM events GROUP BY user_id")
def track_confidence(spark, sf):
    return shown(b.reads(spark, sf).groupBy("track").agg(F.avg("conf").alias("mean_conf"), F.count_if(F.col("conf") > 30).alias("confident")))


@query("SELECT user_id AS track, string_agg(event_type, '' ORDER BY (event_id * 31) % 480, event_id) AS joined FROM events GROUP BY user_id")
def ocr_line_order(spark, sf):
    r = b.table(spark, sf, "events").groupBy(F.col("user_id").alias("track")).agg(F.collect_list(F.struct(((F.col("event_id") * 31) % 480).alias("y"), F.col("event_id").alias("i"), F.col("event_type").alias("t"))).alias("l"))
    return r.select("track", F.array_join(F.transform(F.array_sort("l"), lambda x: x["t"]), "").alias("joined"))


@query()
def report_json(spark, sf):
    r = clean_report(spark, sf)
    rows = F.array_sort(F.collect_list(F.struct("split", F.struct(*[c for c in r.columns if c != "split"]).alias("r"))))
    return r.agg(F.to_json(F.map_from_entries(rows)).alias("report"))
