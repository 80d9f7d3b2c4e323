"""Queries that plan geometric augmentations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import augment
from . import bindings as b
from .queries import H, query, shown

TRIES = 3
_U = lambda what: H.format(f"(img || '/' || k || '/{what}')") + " / 4294967296.0::DOUBLE"
#: Every attempt of every image, step by step on points; an image takes its first that passes. Here four boxes are an image.
PLAN_SQL = f"""{b.BOXES.lstrip()}, i AS (SELECT box_id // 4 AS img, box_id, x1, y1, x2, y2, box_id % 10 = 0 AS rare FROM b),
u AS (SELECT img, k, {_U('mirror')} < 0.5 AS mirror, radians(({_U('turn')} - 0.5) * {2 * augment.TURN}) AS t, {_U('scale')} * {augment.SCALE[1] - augment.SCALE[0]}::DOUBLE + {augment.SCALE[0]} AS s,
  ({_U('dx')} - 0.5) * {2 * augment.SHIFT} * 640 AS dx, ({_U('dy')} - 0.5) * {2 * augment.SHIFT} * 480 AS dy, ({_U('px')} - 0.5) * {augment.PERSPECTIVE} / 640 AS px, ({_U('py')} - 0.5) * {augment.PERSPECTIVE} / 480 AS py
  FROM (SELECT DISTINCT img FROM i), (SELECT unnest(range(1, {TRIES + 1})) AS k)),
c AS (SELECT img, box_id, rare, unnest([x1, x2, x1, x2]) - 320 AS x, unnest([y1, y1, y2, y2]) - 240 AS y FROM i),
s1 AS (SELECT c.img, k, box_id, rare, CASE WHEN mirror THEN -x ELSE x END AS x, y, u.* EXCLUDE (img, k) FROM c JOIN u USING (img)),
s2 AS (SELECT img, k, box_id, rare, px, py, s * (cos(t) * x - sin(t) * y) + dx AS x, s * (sin(t) * x + cos(t) * y) + dy AS y FROM s1),
s3 AS (SELECT img, k, box_id, rare, x / (1 + px * x + py * y) + 320 AS x, y / (1 + px * x + py * y) + 240 AS y FROM s2),
m AS (SELECT img, k, box_id, rare, min(x) AS a1, min(y) AS b1, max(x) AS a2, max(y) AS b2 FROM s3 GROUP BY ALL),
l AS (SELECT img, k, box_id, rare, greatest(0.0::DOUBLE, a1) AS x1, greatest(0.0::DOUBLE, b1) AS y1, least(640.0::DOUBLE, a2) AS x2, least(480.0::DOUBLE, b2) AS y2, (a2 - a1) * (b2 - b1) AS whole FROM m),
v AS (SELECT *, greatest(0.0::DOUBLE, x2 - x1) * greatest(0.0::DOUBLE, y2 - y1) / whole AS visible FROM l),
ok AS (SELECT * FROM v WHERE visible >= CASE WHEN rare THEN {augment.RARE_VISIBILITY} ELSE {augment.MIN_VISIBILITY} END),
p AS (SELECT img, k, count(*) AS n FROM ok GROUP BY ALL HAVING bool_and(x2 - x1 >= {augment.LEAST_SIDE} AND y2 - y1 >= {augment.LEAST_SIDE})),
a AS (SELECT img, min(k) AS k FROM p GROUP BY img)"""
PLAN_SQL = PLAN_SQL.replace(",\na AS (SELECT img, min(k)", ",\ntaken AS (SELECT img, min(k)")


def _plan(spark, sf):
    x = b.boxes(spark, sf).withColumn("image_id", F.floor(F.col("box_id") / 4))
    return augment.plan(x, b.WIDTH, b.HEIGHT, TRIES, rare=F.col("box_id") % 10 == 0)


@query(f"""WITH {PLAN_SQL} SELECT i.img AS image_id, coalesce(taken.k, {TRIES})::INT AS attempts, CASE WHEN taken.k IS NULL THEN {TRIES} ELSE taken.k - 1 END::INT AS failures, taken.k IS NOT NULL AS accepted, coalesce(n, 0) AS n_boxes
FROM (SELECT DISTINCT img FROM i) i LEFT JOIN taken USING (img) LEFT JOIN p ON p.img = i.img AND p.k = taken.k""")
def augment_plan(spark, sf):
    """Attempts and failures of each image until one passes the gate."""
    n = F.when(F.col("accepted"), F.size("placed")).otherwise(0).cast("bigint")
    return _plan(spark, sf).select("image_id", "attempts", "failures", "accepted", n.alias("n_boxes"))


@query(f"WITH {PLAN_SQL} SELECT ok.img AS image_id, box_id, ok.k::INT AS attempt, round(x1, 5) AS x1, round(y1, 5) AS y1, round(x2, 5) AS x2, round(y2, 5) AS y2, round(visible, 5) AS visible FROM ok JOIN taken ON ok.img = taken.img AND ok.k = taken.k")
def augmented_boxes(spark, sf):
    """Boxes after the accepted attempt."""
    return shown(augment.placed_boxes(_plan(spark, sf)), 5)
