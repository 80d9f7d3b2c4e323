"""Cleaning by image: pixel issues, label lines, boxes and duplicates brought together in one verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import matching, quality

# Areas in pixels, aspect ratios, and the IoU from which two boxes of an image are one.
LEAST_AREA, MOST_AREA, NARROW, WIDE, SAME = 1000, 100_000, 1.5, 6.0, 0.9
NUMBERS = ("xc", "yc", "w", "h")


def line_verdict(area: Column, aspect: Column) -> Column:
    """What ends a label line, null if nothing does; and after it, as struct(issue, odd), if its aspect is unusual.
    Columns tokens, class_id, xc, yc, w, h; NaN counts as out of range."""
    numbers = [F.col(c) for c in NUMBERS]
    bad = F.col("class_id").isNull()
    out = F.lit(False)
    for c in numbers:
        bad, out = bad | c.isNull(), out | (c < 0) | (c > 1)
    size = F.when(area < LEAST_AREA, "bbox_too_small").when(area > MOST_AREA, "bbox_too_large")
    issue = F.when(F.size("tokens") < 5, "invalid_label_format").when(bad, "label_parsing_error").when(out, "invalid_coordinates").otherwise(size)
    return F.struct(issue.alias("issue"), (issue.isNull() & ~aspect.between(NARROW, WIDE)).alias("odd"))


def clean_images(images: DataFrame, lines: DataFrame, width: float, height: float, most: int = 3) -> DataFrame:
    """A row an image: image_id, split, issues (repeats counted), fixed, n_valid, kept, category (null if kept).

    images: image_id, split, readable, labelled, found (its pixel issues). lines: image_id, line_no, tokens, class_id, xc, yc,
    w, h of its label file; lines without tokens count for nothing. What is unreadable or has no label file has that issue
    only. Boxes that overlap another of their image by SAME are duplicates: one issue an image, and they go. An image
    without a valid box has no_valid_plates, lines or none. Images of any number of boxes: overlaps are found on a grid.
    """
    w, h = F.lit(float(width)), F.lit(float(height))
    box = g.to_corners(*[F.col(c) for c in NUMBERS], w, h)
    judged = lines.where(F.size("tokens") > 0).withColumns(dict(zip(matching.CORNERS, box, strict=True)))
    side = lambda a, b: F.col(a) - F.col(b)
    judged = judged.withColumn("v", line_verdict(side("x2", "x1") * side("y2", "y1"), F.try_divide(side("x2", "x1"), side("y2", "y1"))))
    valid = judged.where("v.issue IS NULL").select("image_id", "line_no", *matching.CORNERS)
    single = matching.suppress(valid, SAME, "image_id", "line_no").groupBy("image_id").agg(F.count("*").alias("n_valid"))
    codes = F.flatten(F.collect_list(F.array_compact(F.array("v.issue", F.when(F.col("v.odd"), "unusual_aspect_ratio")))))
    crossing = g.crossing(tuple(F.col(c) for c in matching.CORNERS), w, h)
    per = judged.groupBy("image_id").agg(codes.alias("codes"), F.count_if(F.col("v.issue").isNull()).alias("n"), F.count_if(F.col("v.issue").isNull() & crossing).cast("int").alias("clipped"))
    out = images.select("image_id", "split", "readable", "labelled", "found").join(per, "image_id", "left").join(single, "image_id", "left")
    none = F.array().cast("array<string>")
    n_valid = F.coalesce("n_valid", F.lit(0).cast("bigint"))
    twins, whole = F.coalesce(F.col("n") > n_valid, F.lit(False)), F.col("readable") & F.col("labelled")
    boxes = F.concat(F.coalesce("codes", none), F.when(twins, F.array(F.lit("duplicate_bbox"))).otherwise(none), F.when(n_valid == 0, F.array(F.lit("no_valid_plates"))).otherwise(none))
    issues = F.when(~F.col("readable"), F.array(F.lit("unreadable_image"))).when(~F.col("labelled"), F.concat("found", F.array(F.lit("missing_label")))).otherwise(F.concat("found", boxes))
    fixed = F.concat(F.array_repeat(F.lit("clipped_bbox"), F.coalesce("clipped", F.lit(0))), F.when(twins, F.array(F.lit("removed_duplicates"))).otherwise(none))
    out = out.select("image_id", "split", F.sort_array(issues).alias("issues"), F.when(whole, fixed).otherwise(none).alias("fixed"), F.when(whole, n_valid).otherwise(0).alias("n_valid"))
    out = out.withColumn("kept", quality.keep(F.col("issues"), most))
    return out.withColumn("category", F.when(~F.col("kept"), quality.category(F.col("issues"))))
