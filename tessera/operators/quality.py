"""Flags, keep rules, categories, scores and grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Critical issues, the issues of each review category in order of priority, and grades.
CRITICAL = ("corrupted_image", "unreadable_image", "missing_label", "corrupted_label", "no_valid_plates", "invalid_label_format")
CATEGORIES = (
    ("corrupted", ("corrupted_image", "unreadable_image", "corrupted_label")),
    ("blurry", ("blurry",)),
    ("mislabeled", ("missing_label", "invalid_label_format", "no_valid_plates")),
    ("size_issues", ("bbox_too_small", "bbox_too_large")),
    ("aspect_ratio_issues", ("unusual_aspect_ratio",)),
    ("poor_quality", ("too_dark", "too_bright", "low_contrast", "uniform_color")),
)
GRADES = ((90, "A+"), (85, "A"), (80, "A-"), (75, "B+"), (70, "B"), (65, "B-"), (60, "C+"), (55, "C"), (50, "C-"))


def box_issue_list(area: Column, aspect: Column, least: float = 1000, most: float = 100_000, narrow: float = 1.5, wide: float = 6.0) -> Column:
    size = F.when(area < least, "bbox_too_small").when(area > most, "bbox_too_large")
    return F.array_compact(F.array(size, F.when(~aspect.between(narrow, wide), "unusual_aspect_ratio")))


def image_issue_list(blur: Column, brightness: Column, contrast: Column, uniform: Column, blurry: float = 100, dark: float = 30, bright: float = 220, flat: float = 20) -> Column:
    return F.array_compact(F.array(F.when(blur < blurry, "blurry"), F.when(brightness < dark, "too_dark").when(brightness > bright, "too_bright"), F.when(contrast < flat, "low_contrast"), F.when(uniform, "uniform_color")))


def with_early_exit(readable: Column, labelled: Column, issues: Column) -> Column:
    """What is wrong first hides the rest."""
    return F.when(~readable, F.array(F.lit("unreadable_image"))).when(~labelled, F.array(F.lit("missing_label"))).otherwise(issues)


def keep(issues: Column, most: int = 3) -> Column:
    """No critical issue and at most so many, repeats counted."""
    return ~F.arrays_overlap(issues, F.array(*[F.lit(x) for x in CRITICAL])) & (F.size(issues) <= most)


def category(issues: Column) -> Column:
    out = None
    for name, codes in CATEGORIES:
        hit = F.arrays_overlap(issues, F.array(*[F.lit(c) for c in codes]))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("invalid_bbox")


def grade(score: Column) -> Column:
    out = None
    for least, name in GRADES:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise("F")


def score(n: Column, blurry: Column, small: Column, large: Column, leaks: Column) -> Column:
    """100 less capped deductions: few images, percent blurry, percent of boxes too small or large, leaks."""
    cut = F.when(n < 1000, F.least(F.lit(20.0), (1000 - n) / F.lit(1000.0) * 40)).otherwise(0.0)
    for value, free, most in ((blurry, 10, 15), (small, 5, 10), (large, 5, 10)):
        cut = cut + F.when(value > free, F.least(F.lit(float(most)), value - free)).otherwise(0.0)
    cut = cut + F.when(leaks, 10.0).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - cut))


def issue_histogram(images: DataFrame, issues: str = "issues") -> DataFrame:
    """split, issue, n; split 'all' counts every image."""
    each = images.select("split", F.explode(issues).alias("issue"))
    return each.groupBy(F.expr("issue"), "split").count().unionByName(each.groupBy("issue").count().withColumn("split", F.lit("all"))).select("split", "issue", F.col("count").alias("n"))


def cleaning_summary(images: DataFrame) -> DataFrame:
    """Per split and over all: total, kept, flagged, rates, issues an image, commonest issue (ties to
    the first by name)."""
    def of(rows: DataFrame, issues: DataFrame, by: list[str]) -> DataFrame:
        total = rows.groupBy(*by).agg(F.count("*").alias("total"), F.count_if("kept").alias("kept"), F.sum(F.size("issues")).alias("n_issues"))
        worst = issues.groupBy(*by, "issue").count().groupBy(*by).agg(F.min_by("issue", F.struct(-F.col("count"), F.col("issue"))).alias("worst"))
        return (total.join(worst, by, "left") if by else total.withColumn("k", F.lit(1)).join(worst.withColumn("k", F.lit(1)), "k", "left")).select(*by, "total", "kept", (F.col("total") - F.col("kept")).alias("flagged"), F.round(F.col("kept") / F.col("total"), 6).alias("cleaning_rate"), F.round(F.col("n_issues") / F.greatest(F.lit(1), F.col("total")), 6).alias("issues_per_image"), "worst")

    each = images.select("split", F.explode("issues").alias("issue"))
    return of(images, each, ["split"]).unionByName(of(images, each, []).withColumn("split", F.lit("all")))


def boxes_ok(boxes: Column) -> Column:
    """All normalised boxes of an array lie in the unit square and have a size."""
    return F.forall(boxes, lambda x: x["xc"].between(0, 1) & x["yc"].between(0, 1) & (x["w"] > 0) & (x["w"] <= 1) & (x["h"] > 0) & (x["h"] <= 1))
