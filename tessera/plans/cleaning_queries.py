"""Queries that clean a dataset image by image. Four label lines are an image; some have one of their lines twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, quality
from ..sources import labels
from . import bindings as b
from .group_queries import PAIR_IOU
from .queries import IMAGE_ISSUES, query

CLEAN_SQL = f"""{b.LINES.lstrip()}, nn AS (SELECT line_no // 4 AS image_id, line_no, tokens, class_id, xc, yc, w, h FROM n UNION ALL SELECT line_no // 4, line_no + 100000000, tokens, class_id, xc, yc, w, h FROM n WHERE line_no % 24 = 0),
ln AS (SELECT *, xc * 640::DOUBLE - w * 640::DOUBLE / 2 AS x1, yc * 480::DOUBLE - h * 480::DOUBLE / 2 AS y1, xc * 640::DOUBLE + w * 640::DOUBLE / 2 AS x2, yc * 480::DOUBLE + h * 480::DOUBLE / 2 AS y2 FROM nn WHERE len(tokens) > 0),
li AS (SELECT *, CASE WHEN len(tokens) < 5 THEN 'invalid_label_format' WHEN class_id IS NULL OR xc IS NULL OR yc IS NULL OR w IS NULL OR h IS NULL THEN 'label_parsing_error'
  WHEN NOT (xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1 AND h BETWEEN 0 AND 1) THEN 'invalid_coordinates' WHEN (x2 - x1) * (y2 - y1) < 1000 THEN 'bbox_too_small' WHEN (x2 - x1) * (y2 - y1) > 100000 THEN 'bbox_too_large' END AS issue FROM ln),
ok AS (SELECT * FROM li WHERE issue IS NULL),
dup AS (SELECT DISTINCT y.image_id FROM ok x JOIN ok y ON x.image_id = y.image_id AND x.line_no < y.line_no AND {PAIR_IOU} >= 0.9),
nv AS (SELECT y.image_id, count(*) AS n_valid FROM ok y WHERE NOT EXISTS (SELECT 1 FROM ok x WHERE x.image_id = y.image_id AND x.line_no < y.line_no AND {PAIR_IOU} >= 0.9) GROUP BY 1),
cl AS (SELECT image_id, count(*) AS clipped FROM ok WHERE x1 < -1e-9 OR y1 < -1e-9 OR x2 > 640 + 1e-9 OR y2 > 480 + 1e-9 GROUP BY 1),
iss AS (SELECT image_id, issue FROM li WHERE issue IS NOT NULL UNION ALL SELECT image_id, 'unusual_aspect_ratio' FROM ok WHERE NOT ((x2 - x1) / (y2 - y1) BETWEEN 1.5 AND 6.0) UNION ALL SELECT image_id, 'duplicate_bbox' FROM dup),
im AS (SELECT i, CASE WHEN i % 10 < 7 THEN 'train' WHEN i % 10 < 9 THEN 'val' ELSE 'test' END AS split, {IMAGE_ISSUES} AS found FROM (SELECT DISTINCT event_id // 4 AS i FROM events)),
al AS (SELECT i AS image_id, split, CASE WHEN i % 31 = 0 THEN ['unreadable_image'] WHEN i % 23 = 0 THEN list_concat(found, ['missing_label']) ELSE list_concat(list_concat(found, coalesce(g.l, [])), CASE WHEN nv.n_valid IS NULL THEN ['no_valid_plates'] ELSE [] END) END AS issues,
  i % 31 <> 0 AND i % 23 <> 0 AS whole, coalesce(nv.n_valid, 0) AS n_valid, coalesce(clipped, 0) AS clipped, dup.image_id IS NOT NULL AS twins
  FROM im LEFT JOIN (SELECT image_id, list(issue) AS l FROM iss GROUP BY 1) g ON g.image_id = i LEFT JOIN nv ON nv.image_id = i LEFT JOIN cl ON cl.image_id = i LEFT JOIN dup ON dup.image_id = i),
k AS (SELECT *, NOT list_has_any(issues, ['unreadable_image', 'missing_label', 'no_valid_plates', 'invalid_label_format']) AND len(issues) <= 3 AS kept FROM al)"""


def _cleaned(spark, sf) -> DataFrame:
    i, n = F.col("image_id"), F.col("line_no")
    parsed = labels.parse_lines(b.label_lines(spark, sf))
    parsed = parsed.unionByName(parsed.where("line_no % 24 = 0").withColumn("line_no", n + 100_000_000)).withColumn("image_id", F.floor(F.when(n >= 100_000_000, n - 100_000_000).otherwise(n) / 4))
    ids = b.table(spark, sf, "events").select(F.floor(F.col("event_id") / 4).alias("image_id")).distinct()
    found = quality.image_issue_list((i * 37) % 300, (i * 53) % 256, (i * 29) % 90, i % 97 == 0)
    made = ids.select(i, F.when(i % 10 < 7, "train").when(i % 10 < 9, "val").otherwise("test").alias("split"), (i % 31 != 0).alias("readable"), (i % 23 != 0).alias("labelled"), found.alias("found"))
    return cleaning.clean_images(made, parsed, b.WIDTH, b.HEIGHT)


@query(f"""WITH {CLEAN_SQL} SELECT image_id, split, array_to_string(list_sort(issues), ',') AS issues, CASE WHEN whole THEN array_to_string(list_concat(list_transform(range(clipped), lambda x: 'clipped_bbox'), CASE WHEN twins THEN ['removed_duplicates'] ELSE [] END), ',') ELSE '' END AS fixed,
CASE WHEN whole THEN n_valid ELSE 0 END AS n_valid, kept, CASE WHEN kept THEN NULL WHEN list_contains(issues, 'unreadable_image') THEN 'corrupted' WHEN list_contains(issues, 'blurry') THEN 'blurry' WHEN list_has_any(issues, ['missing_label', 'invalid_label_format', 'no_valid_plates']) THEN 'mislabeled'
WHEN list_has_any(issues, ['bbox_too_small', 'bbox_too_large']) THEN 'size_issues' WHEN list_contains(issues, 'unusual_aspect_ratio') THEN 'aspect_ratio_issues' WHEN list_has_any(issues, ['too_dark', 'too_bright', 'low_contrast', 'uniform_color']) THEN 'poor_quality' ELSE 'invalid_bbox' END AS category FROM k""")
def cleaned_images(spark, sf):
    """Every image with its issues, what was mended, and the verdict."""
    return _cleaned(spark, sf).select("image_id", "split", F.array_join("issues", ",").alias("issues"), F.array_join("fixed", ",").alias("fixed"), "n_valid", "kept", "category")


@query(f"""WITH {CLEAN_SQL}, s2 AS (SELECT split, issues, kept FROM k UNION ALL SELECT 'all', issues, kept FROM k), c2 AS (SELECT split, issue, count(*) AS n FROM (SELECT split, unnest(issues) AS issue FROM s2) GROUP BY ALL),
w2 AS (SELECT split, first(issue ORDER BY n DESC, issue) AS worst FROM c2 GROUP BY split)
SELECT split, count(*) AS total, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS flagged, round(count(*) FILTER (kept)::DOUBLE / count(*), 6) AS cleaning_rate, round(sum(len(issues))::DOUBLE / count(*), 6) AS issues_per_image, any_value(worst) AS worst FROM s2 LEFT JOIN w2 USING (split) GROUP BY split""")
def image_cleaning_report(spark, sf):
    """Per split and over all: images kept and flagged, rates, commonest issue."""
    return quality.cleaning_summary(_cleaned(spark, sf))
