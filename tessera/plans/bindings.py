"""Projections of the driver's tables onto what the operators take, in whole-number arithmetic, and the
same projections in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.plates import LETTERS

WIDTH, HEIGHT = 640, 480


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _split(i: Column) -> Column:
    return F.when(i % 10 < 7, "train").when(i % 10 < 9, "val").otherwise("test")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of the events: a user's are those of an image. Some lie partly or wholly outside."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    part = lambda p, m, a=0: ((i * p) % m + a) / 1000.0
    return e.select(F.col("user_id").alias("image_id"), i.alias("box_id"), _split(F.col("user_id")).alias("split"), (i % 3).cast("int").alias("class_id"), part(7919, 1050).alias("xc"), part(6101, 1020).alias("yc"), part(4243, 480, 5).alias("w"), part(3571, 300, 2).alias("h"), "event_type", "value")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations within the unit square as clipped corners."""
    a = annotations(spark, sf_dir).where(g.in_unit(*[F.col(c) for c in ("xc", "yc", "w", "h")]))
    w, h = F.lit(float(WIDTH)), F.lit(float(HEIGHT))
    box = g.clip(g.to_corners(*[F.col(c) for c in ("xc", "yc", "w", "h")], w, h), w, h)
    return a.withColumns(dict(zip(("x1", "y1", "x2", "y2"), box, strict=True))).where("x2 > x1 AND y2 > y1")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).where(F.col("event_type").isin("signup", "error")).withColumn("gt_idx", F.col("box_id"))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).where(F.col("event_type").isin("click", "view", "purchase")).select("image_id", F.col("box_id").alias("det_idx"), (F.col("value") / 500.0).alias("conf"), "x1", "y1", "x2", "y2")


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations as label lines, with planted faults."""
    i = F.col("event_id")
    num = lambda p, m, a=0: F.concat(((((i * p) % m) + a) / 1000).cast("int").cast("string"), F.lit("."), F.lpad((((i * p) % m) + a) % 1000, 3, "0"))
    kind = F.when(i % 41 == 0, "x").when(i % 43 == 0, "0.0").otherwise((i % 3).cast("string"))
    xc = F.when(i % 47 == 0, "nan").otherwise(num(7919, 1050))
    line = F.when(i % 59 == 0, "").when(i % 37 == 0, F.concat_ws(" ", kind, xc, num(6101, 1020), num(4243, 480, 5))).otherwise(F.concat_ws(" ", kind, xc, num(6101, 1020), num(4243, 480, 5), num(3571, 300, 2), F.when(i % 53 == 0, "0.87")))
    return table(spark, sf_dir, "events").select(_split(F.col("user_id")).alias("split"), F.col("user_id").alias("stem"), i.alias("line_no"), line.alias("line"))


def plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made plate readings with letters that need repair."""
    i = F.col("event_id")
    text = F.translate(F.upper(F.md5(i.cast("string"))), "ABCDEF", "OSUZTG")
    kind = F.when(i % 3 == 0, "BIKE").when(i % 3 == 1, "CAR_RECT").otherwise("UNKNOWN")
    return table(spark, sf_dir, "events").select(i.alias("event_id"), F.substring(text, F.lit(1), (6 + i % 7).cast("int")).alias("text"), F.substring(text, F.lit(20), (2 + i % 3).cast("int")).alias("top"), kind.alias("kind"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("track"), F.col("event_id").alias("frame"), F.col("event_type").alias("text"), F.col("value").alias("conf"), F.col("ts").cast("timestamp").alias("ts"))


SPLIT = "CASE WHEN user_id % 10 < 7 THEN 'train' WHEN user_id % 10 < 9 THEN 'val' ELSE 'test' END"
ANNOTATIONS = f"""
a AS (SELECT user_id AS image_id, event_id AS box_id, {SPLIT} AS split, (event_id % 3)::INT AS class_id,
  ((event_id * 7919) % 1050) / 1000.0::DOUBLE AS xc, ((event_id * 6101) % 1020) / 1000.0::DOUBLE AS yc,
  ((event_id * 4243) % 480 + 5) / 1000.0::DOUBLE AS w, ((event_id * 3571) % 300 + 2) / 1000.0::DOUBLE AS h, event_type, value FROM events)"""
BOXES = ANNOTATIONS + f""",
b AS (SELECT * FROM (SELECT *, greatest(0.0::DOUBLE, xc * {WIDTH}::DOUBLE - w * {WIDTH}::DOUBLE / 2) AS x1, greatest(0.0::DOUBLE, yc * {HEIGHT}::DOUBLE - h * {HEIGHT}::DOUBLE / 2) AS y1,
  least({WIDTH}::DOUBLE, xc * {WIDTH}::DOUBLE + w * {WIDTH}::DOUBLE / 2) AS x2, least({HEIGHT}::DOUBLE, yc * {HEIGHT}::DOUBLE + h * {HEIGHT}::DOUBLE / 2) AS y2
  FROM a WHERE xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1 AND h BETWEEN 0 AND 1) WHERE x2 > x1 AND y2 > y1)"""
MATCH = BOXES + """,
gt AS (SELECT *, box_id AS gt_idx FROM b WHERE event_type IN ('signup', 'error')),
det AS (SELECT image_id, box_id AS det_idx, value / 500.0::DOUBLE AS conf, x1, y1, x2, y2 FROM b WHERE event_type IN ('click', 'view', 'purchase')),
p0 AS (SELECT gt.image_id, gt_idx, det_idx, conf,
  greatest(0.0::DOUBLE, least(gt.x2, det.x2) - greatest(gt.x1, det.x1)) * greatest(0.0::DOUBLE, least(gt.y2, det.y2) - greatest(gt.y1, det.y1)) AS i,
  (gt.x2 - gt.x1) * (gt.y2 - gt.y1) AS ga, (det.x2 - det.x1) * (det.y2 - det.y1) AS da FROM gt JOIN det USING (image_id)),
p AS (SELECT image_id, gt_idx, det_idx, conf, CASE WHEN ga + da - i > 0 THEN i / (ga + da - i) ELSE 0 END AS iou FROM p0)"""
#: Greedy matching in SQL: in each round, pairs that are the best of both their sides go.
GREEDY = MATCH + """,
q AS (SELECT image_id, gt_idx, det_idx, iou, row_number() OVER (PARTITION BY image_id ORDER BY iou DESC, gt_idx, det_idx) AS r FROM p WHERE iou >= 0.5),
f(image_id, r, gs, ds) AS (
  SELECT image_id, 0::BIGINT, []::BIGINT[], []::BIGINT[] FROM (SELECT DISTINCT image_id FROM q)
  UNION ALL
  SELECT f.image_id, q.r, CASE WHEN list_contains(gs, gt_idx) OR list_contains(ds, det_idx) THEN gs ELSE list_append(gs, gt_idx) END,
    CASE WHEN list_contains(gs, gt_idx) OR list_contains(ds, det_idx) THEN ds ELSE list_append(ds, det_idx) END
  FROM f JOIN q ON q.image_id = f.image_id AND q.r = f.r + 1),
z AS (SELECT image_id, last(gs ORDER BY r) AS gs, last(ds ORDER BY r) AS ds FROM f GROUP BY image_id),
m AS (SELECT image_id, unnest(gs) AS gt_idx, unnest(ds) AS det_idx FROM z)"""
_N = "(((event_id * {p}) % {m}) + {a})"
_NUM = "((" + _N + " // 1000)::VARCHAR || '.' || lpad((" + _N + " % 1000)::VARCHAR, 3, '0'))"
_KIND = "(CASE WHEN event_id % 41 = 0 THEN 'x' WHEN event_id % 43 = 0 THEN '0.0' ELSE (event_id % 3)::VARCHAR END)"
_XC = "(CASE WHEN event_id % 47 = 0 THEN 'nan' ELSE " + _NUM.format(p=7919, m=1050, a=0) + " END)"
LINES = f"""
l AS (SELECT {SPLIT} AS split, user_id AS stem, event_id AS line_no,
  CASE WHEN event_id % 59 = 0 THEN '' WHEN event_id % 37 = 0 THEN concat_ws(' ', {_KIND}, {_XC}, {_NUM.format(p=6101, m=1020, a=0)}, {_NUM.format(p=4243, m=480, a=5)})
  ELSE concat_ws(' ', {_KIND}, {_XC}, {_NUM.format(p=6101, m=1020, a=0)}, {_NUM.format(p=4243, m=480, a=5)}, {_NUM.format(p=3571, m=300, a=2)}, CASE WHEN event_id % 53 = 0 THEN '0.87' END) END AS line FROM events),
t AS (SELECT *, CASE WHEN line = '' THEN []::VARCHAR[] ELSE string_split(line, ' ') END AS tokens FROM l),
n AS (SELECT *, CASE WHEN tokens[1] LIKE '%.%' THEN NULL ELSE try_cast(tokens[1] AS INT) END AS class_id, try_cast(tokens[1] AS DOUBLE)::INT AS class_cut, try_cast(tokens[2] AS DOUBLE) AS xc, try_cast(tokens[3] AS DOUBLE) AS yc, try_cast(tokens[4] AS DOUBLE) AS w, try_cast(tokens[5] AS DOUBLE) AS h FROM t)"""
PLATES = """
p AS (SELECT event_id, substr(translate(upper(md5(event_id::VARCHAR)), 'ABCDEF', 'OSUZTG'), 1, (6 + event_id % 7)::INT) AS text,
  substr(translate(upper(md5(event_id::VARCHAR)), 'ABCDEF', 'OSUZTG'), 20, (2 + event_id % 3)::INT) AS top,
  CASE event_id % 3 WHEN 0 THEN 'BIKE' WHEN 1 THEN 'CAR_RECT' ELSE 'UNKNOWN' END AS kind FROM events)"""
LETTER_LIST = "['" + "','".join(LETTERS) + "']"
