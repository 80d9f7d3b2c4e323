"""JSON reports of any shape: nested from tables, written to files, read back as VARIANT, taken apart into values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dataset import write_files

#: Levels of nesting that are taken apart; what lies deeper stays one JSON text.
DEPTH = 8


def as_report(kind: str, rows: DataFrame, by: list[str] | tuple[str, ...] = (), name: str = "report") -> DataFrame:
    """(kind, name, report): a table as one JSON object, nested by its ``by`` columns, the other columns innermost; one
    other column alone stands as a plain value. Without ``by`` the table has one row. For tables of summary size."""
    rest = [c for c in rows.columns if c not in by]
    value = F.col(rest[0]) if len(rest) == 1 and by else F.struct(*rest)
    out, left = rows.select(*by, value.alias("value")), list(by)
    while left:
        key = left.pop()
        entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), F.col("value"))), lambda x, y: F.when(x["key"] < y["key"], -1).when(x["key"] > y["key"], 1).otherwise(0))
        out = out.groupBy(*left).agg(F.map_from_entries(entries).alias("value"))
    return out.select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.to_json("value", {"ignoreNullFields": "false"}).alias("report"))


def write_reports(reports: DataFrame, root: str) -> None:
    """A file for each (kind, name, report): <kind>/<name>.json below root."""
    write_files(reports.select(F.concat("kind", F.lit("/"), "name", F.lit(".json")).alias("path"), F.col("report").alias("content")), root)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """(kind, name, report) of all JSON files below root: kind is the folder, report a VARIANT, null where a file is
    no JSON. No schema is asked for or found, so reports of different shapes come together."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    parts = F.split("_metadata.file_path", "/")
    return files.select(F.element_at(parts, -2).alias("kind"), F.regexp_replace(F.element_at(parts, -1), r"\.json$", "").alias("name"), F.try_parse_json("value").alias("report"))


def leaves(reports: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, name, path, number, text): every value of the reports, under its keys and places joined by dots. number is
    null for texts; text is null for numbers and JSON nulls."""
    spark, out = reports.sparkSession, []
    level = reports.where("report IS NOT NULL").select("kind", "name", F.lit("").alias("path"), F.col("report").alias("v"))
    nested = lambda c: F.schema_of_variant(c).rlike("^(OBJECT|ARRAY)<")
    for _ in range(depth):
        out.append(level.where(~nested("v")))
        inner = level.where(nested("v"))
        each = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select("pos", "key", F.col("value").alias("w")))
        step = F.coalesce("key", F.col("pos").cast("string"))
        level = each.select("kind", "name", F.concat_ws(".", F.nullif("path", F.lit("")), step).alias("path"), F.col("w").alias("v"))
    whole = reduce(DataFrame.unionByName, [*out, level])
    number = F.when(F.schema_of_variant("v").rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get("v", "$", "double"))
    return whole.select("kind", "name", "path", number.alias("number"), F.when(number.isNull(), F.try_variant_get("v", "$", "string")).alias("text"))


def first_metric(report: str | Column, *paths: str, default: float | None = 0.0) -> Column:
    """A number of a VARIANT by the first of the paths that it has and that reads as one."""
    return F.coalesce(*[F.try_variant_get(report, p, "double") for p in paths], F.lit(default).cast("double"))
