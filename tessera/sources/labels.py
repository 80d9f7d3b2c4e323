"""Box labels as text lines: class xc yc w h, with white space between and anything after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from ..functions import geometry as g

LABEL_LINES = "split string, stem string, line_no int, line string"


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """(split, stem, line_no, line) of all label files below path, one pass over whole files.

    Files of no bytes have no row in Spark; join the result to a file listing to keep them.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select("value", F.col("_metadata.file_path").alias("p"))
    parts = F.split(F.url_decode("p"), "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.txt$", "")
    return files.select(F.element_at(parts, -2).alias("split"), stem.alias("stem"), F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("line_no", "line"))


def parse_lines(lines: DataFrame, whole_class: bool = True) -> DataFrame:
    """Adds tokens, class_id, xc, yc, w, h; null where a token does not read.

    whole_class: a class such as 0.0 does not read; else it is cut to a whole number.
    """
    t = F.filter(F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " "), lambda x: x != "")
    lines = lines.withColumn("tokens", t)
    at = lambda i: F.get("tokens", F.lit(i))
    kind = at(0).try_cast("int") if whole_class else at(0).try_cast("double").cast("int")
    return lines.withColumns({"class_id": kind} | {n: at(i + 1).try_cast("double") for i, n in enumerate(("xc", "yc", "w", "h"))})


def readable() -> Column:
    return (F.size("tokens") >= 5) & F.col("class_id").isNotNull() & F.col("xc").isNotNull() & F.col("yc").isNotNull() & F.col("w").isNotNull() & F.col("h").isNotNull()


def valid_boxes(parsed: DataFrame, width: Column, height: Column) -> DataFrame:
    """Readable lines within the unit square, clipped to the image, not degenerate: x1, y1, x2, y2."""
    box = g.clip(g.to_corners(*[F.col(c) for c in ("xc", "yc", "w", "h")], width, height), width, height)
    out = parsed.where(readable() & g.in_unit(*[F.col(c) for c in ("xc", "yc", "w", "h")]))
    return out.withColumns(dict(zip(("x1", "y1", "x2", "y2"), box, strict=True))).where("x2 > x1 AND y2 > y1")


def clamped_boxes(parsed: DataFrame, width: Column, height: Column) -> DataFrame:
    """Readable lines as corners in whole-pixel bounds, degenerate ones dropped."""
    box = g.clamp_to_pixels(g.to_corners(*[F.col(c) for c in ("xc", "yc", "w", "h")], width, height), width, height)
    return parsed.where(readable()).withColumns(dict(zip(("x1", "y1", "x2", "y2"), box, strict=True))).where("x2 > x1 AND y2 > y1")


def line_issue() -> Column:
    """The issue of a parsed line, null if it has none; blank lines have none."""
    xywh = [F.col(c) for c in ("xc", "yc", "w", "h")]
    return (
        F.when(F.size("tokens") == 0, F.lit(None).cast("string"))
        .when(F.size("tokens") < 5, "invalid_label_format")
        .when(~readable(), "label_parse_error")
        .when(~g.in_unit(*xywh), "invalid_bbox_coords")
        .when((F.col("w") <= 0) | (F.col("h") <= 0), "degenerate_bbox")
    )


def until_first_error(parsed: DataFrame, by: list[str], order: str) -> DataFrame:
    """The lines of each file before the first that does not read; short and blank lines are skipped."""
    bad = F.when((F.size("tokens") >= 5) & ~readable(), 1).otherwise(0)
    upto = F.sum(bad).over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return parsed.withColumn("errors", upto).where((F.col("errors") == 0) & readable()).drop("errors")


def file_validity(parsed: DataFrame, by: list[str]) -> DataFrame:
    """Per file: n_lines and valid, true if every line reads; a blank line inside makes it invalid."""
    return parsed.groupBy(*by).agg(F.count("*").alias("n_lines"), F.bool_and(readable()).alias("valid"))


def render(class_id: Column, xc: Column, yc: Column, w: Column, h: Column, conf: Column | None = None) -> Column:
    """A label line; conf makes a sixth column."""
    values = [xc, yc, w, h] + ([conf] if conf is not None else [])
    return F.format_string("%d" + " %.6f" * len(values), class_id.cast("int"), *[v.cast("double") for v in values])
