"""Queries that write files and read them back: datasets and reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.images import drawn
from ..operators import cleaning
from ..sources import dataset, images, reports, scratch
from ..sources.yaml_text import as_yaml
from . import bindings as b
from .queries import FILES, ORACLE, QUERIES, _files, query, shown

#: A supplier's image: grey, made by whole numbers.
ROWS, COLUMNS = 24, 32
FILES_SQL = f"""s AS (SELECT s_suppkey::BIGINT AS k, CASE WHEN s_suppkey % 10 < 7 THEN 'train' WHEN s_suppkey % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM supplier),
st AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'empty' WHEN k % 7 = 0 THEN 'corrupt' ELSE 'ok' END AS status, CASE WHEN k % 13 = 0 THEN 'missing' WHEN k % 5 = 0 THEN 'empty' ELSE 'text' END AS label FROM s),
px AS (SELECT k, ((x * x * (k % 5 + 1) + y * (13 + k % 50) + x * y) // 7 + k * 31) % (40 + k % 200) AS v FROM st, (SELECT unnest(range({ROWS})) AS y), (SELECT unnest(range({COLUMNS})) AS x) WHERE status = 'ok'),
m AS (SELECT k, avg(v) AS brightness, stddev_pop(v) AS contrast FROM px GROUP BY k)"""


def _written(spark, sf) -> str:
    """A dataset on disk: an image and a label file for each supplier, some of no bytes, some broken, some labels missing."""
    root = f"{scratch.folder(spark)}/dataset-{uuid.uuid4().hex}"
    k = F.col("k")
    value = lambda y, x: (F.floor((x * x * (k % 5 + 1) + y * (k % 50 + 13) + x * y) / 7) + k * 31) % (k % 200 + 40)
    s = b.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("k")).withColumn("split", F.when(k % 10 < 7, "train").when(k % 10 < 9, "val").otherwise("test"))
    png = dataset.as_png(drawn(ROWS, COLUMNS, value), F.lit(COLUMNS), F.lit(ROWS))
    image = F.when(k % 11 == 0, F.lit(b"")).when(k % 7 == 0, F.encode(F.lit("no image"), "utf-8")).otherwise(png)
    name = lambda kind, ext: F.concat(F.lit(f"{kind}/"), "split", F.lit("/img_"), k, F.lit(ext))
    dataset.write_files(s.select(name("images", ".png").alias("path"), image.alias("content")), root)
    line = F.concat((k % 3).cast("string"), F.lit(" 0.5 0.5 0.25 0.25"))
    text = F.when(k % 5 == 0, "").otherwise(F.concat(line, F.when(k % 2 == 0, F.concat(F.lit("\n"), line)).otherwise("")))
    dataset.write_files(s.where("k % 13 <> 0").select(name("labels", ".txt").alias("path"), F.encode(text, "utf-8").alias("content")), root)
    return root


@query(f"""WITH {FILES_SQL} SELECT st.split, 'img_' || st.k AS stem, status, CASE WHEN status = 'ok' THEN {COLUMNS} END AS width, CASE WHEN status = 'ok' THEN {ROWS} END AS height, label,
CASE label WHEN 'text' THEN 2 - k % 2 ELSE 0 END AS n_lines, round(brightness, 6) AS brightness, round(contrast, 6) AS contrast FROM st LEFT JOIN m USING (k)""")
def dataset_read_back(spark, sf):
    """A dataset written to files and read back: what decodes, what is empty or broken, and the labels beside it."""
    d = dataset.read_dataset(spark, _written(spark, sf))
    lines = F.when(F.col("label") == "text", F.size(F.split("text", "\n"))).otherwise(0)
    d = images.image_metrics(d.withColumn("n_lines", lines.cast("bigint")))
    return shown(d.select("split", "stem", "status", "width", "height", "label", "n_lines", "brightness", "contrast"))


@query(f"""WITH {FILES_SQL} SELECT split, status, label, count(*) AS n FROM st GROUP BY ALL HAVING split <> 'test'""")
def complete_splits(spark, sf):
    """Files by what is wrong with them, of the splits that have both folders: test has lost its labels."""
    root = _written(spark, sf)
    scratch.drop(spark, f"{root}/labels/test")
    return dataset.read_dataset(spark, root, skip_incomplete=True).groupBy("split", "status", "label").agg(F.count("*").alias("n"))


# reports ----------------------------------------------------------------------------------------

#: Reports by kind: the query that each is of, and the columns that it is nested by.
REPORTS = {"cleaning": ("clean_report", ["split"]), "issues": ("issue_histogram", ["split", "issue"]), "merge": ("merge_summary", []), "buckets": ("aspect_size_buckets", ["aspect", "size"])}
CLEANING = ("total", "kept", "flagged", "cleaning_rate", "issues_per_image", "worst")
MERGED = ("clean_added", "pseudo_added", "duplicates_skipped", "invalid_labels", "total")


def _values(name: str, by: str, columns: tuple[str, ...], table: str) -> str:
    """Each column of a table as rows of a report's values."""
    key = f"{by} || '.' || " if by else ""
    return " UNION ALL ".join(f"SELECT '{name}' AS kind, {key}'{c}' AS path, {'NULL::DOUBLE' if c == 'worst' else f'{c}::DOUBLE'} AS number, {c if c == 'worst' else 'NULL'}::VARCHAR AS text FROM {table}" for c in columns)


REPORT_SQL = f"""WITH r1 AS ({ORACLE['clean_report']}), r2 AS ({ORACLE['issue_histogram']}), r3 AS ({ORACLE['merge_summary']}), r4 AS ({ORACLE['aspect_size_buckets']})
{_values('cleaning', 'split', CLEANING, 'r1')} UNION ALL {_values('merge', '', MERGED, 'r3')}
UNION ALL SELECT 'issues', split || '.' || issue, n::DOUBLE, NULL FROM r2 UNION ALL SELECT 'buckets', aspect || '.' || size, n::DOUBLE, NULL FROM r4"""


def _reported(spark, sf) -> DataFrame:
    """Four reports of different shapes, written to files and read back."""
    root = f"{scratch.folder(spark)}/reports-{uuid.uuid4().hex}"
    for kind, (name, by) in REPORTS.items():
        reports.write_reports(reports.as_report(kind, QUERIES[name](spark, sf), by), root)
    return reports.read_reports(spark, root)


@query(REPORT_SQL)
def reports_read_back(spark, sf):
    """Every value of four reports, by its path, from files whose shape nobody says."""
    return reports.leaves(_reported(spark, sf)).select("kind", "path", "number", "text")


@query(f"""WITH r1 AS ({ORACLE['clean_report']}), r3 AS ({ORACLE['merge_summary']})
SELECT 'cleaning' AS kind, (SELECT total FROM r1 WHERE split = 'all')::DOUBLE AS total, (SELECT cleaning_rate FROM r1 WHERE split = 'all')::DOUBLE AS rate UNION ALL SELECT 'merge', total, 0 FROM r3 UNION ALL SELECT 'issues', -1, 0 UNION ALL SELECT 'buckets', -1, 0""")
def report_metrics(spark, sf):
    """Two metrics of each report by the first place where a report has them, else a default."""
    total, rate = reports.first_metric("report", "$.all.total", "$.total", default=-1.0), reports.first_metric("report", "$.all.cleaning_rate", "$.cleaning_rate", "$.rate")
    return _reported(spark, sf).select("kind", total.alias("total"), rate.alias("rate"))


# dataset descriptions ---------------------------------------------------------------------------

COUNTS_SQL = f"""{FILES}, c AS (SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS images, count(l.doc_id) AS labels FROM f LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id))"""
_HEAD = "'path: {at}' || chr(10) || 'train: {train}' || chr(10) || 'val: {val}' || chr(10) || 'test: {test}' || chr(10) || 'nc: 1' || chr(10) || 'names:' || chr(10) || '- license_plate' || chr(10)"
_SPLIT_DIRS = {k: f"images/{k}" for k in ("train", "val", "test")}


def _lines(*lines: str) -> str:
    return " || ".join(f"{x} || chr(10)" for x in lines)


@query(f"""WITH {COUNTS_SQL}
SELECT 'prepared' AS variant, {_HEAD.format(at='data/prepared', **_SPLIT_DIRS)} || {_lines("'statistics:'", "'  total: ' || images", "'  train: ' || train", "'  val: ' || val", "'  test: ' || test")} AS text FROM c
UNION ALL SELECT 'cleaned', {_HEAD.format(at='data/cleaned', **_SPLIT_DIRS)} || {_lines("'cleaning_info:'", "'  min_bbox_area: 1000'", "'  max_bbox_area: 100000'", "'  iou_threshold: 0.9'")}
UNION ALL SELECT 'augmented', {_HEAD.format(at='data/augmented', **_SPLIT_DIRS)} || {_lines("'metadata:'", "'  seed: 42'", "'  multiplier: 2.0'", "'  note: ''boxes: composed transforms'''")}
UNION ALL SELECT 'synthetic', {_HEAD.format(at='data/synthetic', train='images', val='images', test='images')}
UNION ALL SELECT 'pseudo', {_lines("'path: data/pseudo'", "'train: images/train'", "'nc: 1'", "'names:'", "'- license_plate'")}
UNION ALL SELECT 'optimal', {_HEAD.format(at='data/optimal', **_SPLIT_DIRS)} || {_lines("'metadata:'", "'  status: VALIDATED'", "'  statistics:'", "'    total_images: ' || images", "'    total_labels: ' || labels", "'    label_coverage: ''' || printf('%.1f%%', labels * 100.0 / images) || ''''", "'    splits:'", "'      train: ' || train", "'      val: ' || val", "'      test: ' || test", "'  notes:'", "'  - Enhanced validation performed'", "'  - Ready for training'")} FROM c""")
def dataset_yaml(spark, sf):
    """The dataset description as each step of the preparation writes it, with what the step knows."""
    f = _files(spark, sf).select("doc_id", "split").join(b.table(spark, sf, "labels").select("doc_id", F.lit(1).alias("has")).distinct(), "doc_id", "left")
    n = lambda s: F.count_if(F.col("split") == s).alias(s)
    counts = f.agg(n("train"), n("val"), n("test"), F.count("*").alias("images"), F.count("has").alias("labels"))
    text = lambda **fields: [F.lit(v).alias(k) if not hasattr(v, "alias") else v.alias(k) for k, v in fields.items()]

    def head(step: str, dirs: dict[str, str] = _SPLIT_DIRS) -> list:
        return text(path=f"data/{step}", **dirs, nc=1, names=F.array(F.lit("license_plate")))

    splits = F.struct("train", "val", "test")
    coverage = F.format_string("%.1f%%", F.col("labels") * 100.0 / F.col("images"))
    statistics = F.struct(*text(total_images=F.col("images"), total_labels=F.col("labels"), label_coverage=coverage, splits=splits))
    variants = {
        "prepared": [*head("prepared"), F.struct(F.col("images").alias("total"), "train", "val", "test").alias("statistics")],
        "cleaned": [*head("cleaned"), F.struct(*text(min_bbox_area=cleaning.LEAST_AREA, max_bbox_area=cleaning.MOST_AREA, iou_threshold=cleaning.SAME)).alias("cleaning_info")],
        "augmented": [*head("augmented"), F.struct(*text(seed=42, multiplier=2.0, note="boxes: composed transforms")).alias("metadata")],
        "synthetic": head("synthetic", dict.fromkeys(_SPLIT_DIRS, "images")),
        "pseudo": [c for c, keep in zip(head("pseudo"), (1, 1, 0, 0, 1, 1), strict=True) if keep],
        "optimal": [*head("optimal"), F.struct(*text(status="VALIDATED", statistics=statistics, notes=F.array(F.lit("Enhanced validation performed"), F.lit("Ready for training")))).alias("metadata")],
    }
    each = []
    for variant, fields in variants.items():
        d = counts.select(F.struct(*fields).alias("d"))
        each.append(d.select(F.lit(variant).alias("variant"), as_yaml(F.col("d"), d.schema["d"].dataType).alias("text")))
    return reduce(DataFrame.unionByName, each)
