"""Queries that evaluate detections: average precision by class and IoU threshold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching
from . import bindings as b
from .queries import query, shown

#: Each class and threshold apart: pairs in order, each taken if both sides are free; then the area under the envelope.
AP_SQL = b.MATCH.lstrip() + f""",
t AS (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in matching.THRESHOLDS)}]) AS t),
q AS (SELECT image_id, gt_idx % 3 AS class_id, t, gt_idx, det_idx, row_number() OVER (PARTITION BY image_id, gt_idx % 3, t ORDER BY iou DESC, gt_idx, det_idx) AS r FROM p, t WHERE iou >= t AND gt_idx % 3 = det_idx % 3),
f(image_id, class_id, t, r, gs, ds) AS (
  SELECT image_id, class_id, t, 0::BIGINT, []::BIGINT[], []::BIGINT[] FROM (SELECT DISTINCT image_id, class_id, t FROM q)
  UNION ALL
  SELECT f.image_id, f.class_id, f.t, q.r, CASE WHEN list_contains(gs, gt_idx) OR list_contains(ds, det_idx) THEN gs ELSE list_append(gs, gt_idx) END,
    CASE WHEN list_contains(gs, gt_idx) OR list_contains(ds, det_idx) THEN ds ELSE list_append(ds, det_idx) END
  FROM f JOIN q ON q.image_id = f.image_id AND q.class_id = f.class_id AND q.t = f.t AND q.r = f.r + 1),
m AS (SELECT image_id, class_id, t, unnest(last(ds ORDER BY r)) AS det_idx FROM f GROUP BY image_id, class_id, t),
h AS (SELECT d.det_idx % 3 AS class_id, t.t, d.image_id, d.det_idx, conf, m.det_idx IS NOT NULL AS hit FROM det d CROSS JOIN t LEFT JOIN m ON m.image_id = d.image_id AND m.det_idx = d.det_idx AND m.t = t.t),
c AS (SELECT class_id, t, hit, row_number() OVER w AS rank, sum(hit::INT) OVER (w ROWS UNBOUNDED PRECEDING) / row_number() OVER w AS precision FROM h WINDOW w AS (PARTITION BY class_id, t ORDER BY conf DESC, image_id, det_idx)),
e AS (SELECT *, max(precision) OVER (PARTITION BY class_id, t ORDER BY rank DESC ROWS UNBOUNDED PRECEDING) AS envelope FROM c),
n AS (SELECT class_id, count(*) AS truth FROM gt GROUP BY class_id),
ap AS (SELECT n.class_id, t.t, truth, coalesce((SELECT sum(envelope) FROM e WHERE hit AND e.class_id = n.class_id AND e.t = t.t), 0) / truth AS ap FROM n, t)"""


def _ap(spark, sf):
    classed = lambda df, i: df.withColumn("class_id", (F.col(i) % 3).cast("int"))
    return matching.mean_average_precision(classed(b.truth(spark, sf).drop("class_id"), "gt_idx"), classed(b.detections(spark, sf), "det_idx"))


@query(f"WITH RECURSIVE {AP_SQL} SELECT class_id::INT AS class_id, t AS iou_threshold, truth, round(ap, 6) AS ap FROM ap")
def class_ap(spark, sf):
    """Average precision of each class at ten IoU thresholds."""
    return shown(_ap(spark, sf))


@query(f"""WITH RECURSIVE {AP_SQL} SELECT coalesce(class_id::INT::VARCHAR, 'all') AS class, round(avg(ap) FILTER (t = 0.5), 6) AS ap50, round(avg(ap) FILTER (t = 0.75), 6) AS ap75, round(avg(ap), 6) AS ap50_95 FROM ap GROUP BY ROLLUP (class_id)""")
def mean_ap(spark, sf):
    """Each class's average precision at 0.5, 0.75 and over all thresholds, and the means over classes."""
    at = lambda t: F.avg(F.when(F.col("iou_threshold") == t, F.col("ap")))
    rows = _ap(spark, sf).rollup("class_id").agg(at(0.5).alias("ap50"), at(0.75).alias("ap75"), F.avg("ap").alias("ap50_95"))
    return shown(rows.select(F.coalesce(F.col("class_id").cast("string"), F.lit("all")).alias("class"), "ap50", "ap75", "ap50_95"))
