import json
import os

from pyspark.sql import functions as F

from tessera.operators import cleaning
from tessera.sources import reports


def test_leaves_of_any_shape(spark, tmp_path):
    shapes = {"a/x.json": {"n": 1, "deep": {"list": [1.5, "two", None, {"k": True}]}, "empty": {}, "none": []}, "b/y.json": [1, [2, 3]], "b/z.json": "text", "c/big.json": {"v": 10**15, "é": "漢"}}
    for path, value in shapes.items():
        os.makedirs(tmp_path / os.path.dirname(path), exist_ok=True)
        (tmp_path / path).write_text(json.dumps(value))
    (tmp_path / "c" / "broken.json").write_text("{no json")
    (tmp_path / "c" / "other.txt").write_text("{}")
    got = reports.read_reports(spark, str(tmp_path))
    assert {(r.kind, r.name) for r in got.where("report IS NULL").collect()} == {("c", "broken")} and got.count() == 5
    values = {(r.kind, r.name, r.path): r.number if r.number is not None else r.text for r in reports.leaves(got).collect()}
    assert values == {("a", "x", "n"): 1, ("a", "x", "deep.list.0"): 1.5, ("a", "x", "deep.list.1"): "two", ("a", "x", "deep.list.2"): None, ("a", "x", "deep.list.3.k"): "true", ("b", "y", "0"): 1, ("b", "y", "1.0"): 2, ("b", "y", "1.1"): 3, ("b", "z", ""): "text", ("c", "big", "v"): 10**15, ("c", "big", "é"): "漢"}
    assert {(r.path, r.text) for r in reports.leaves(got.where("kind = 'a'"), depth=1).where("path = 'deep'").collect()} == {("deep", '{"list":[1.5,"two",null,{"k":true}]}')}


def test_metrics_by_the_first_place(spark):
    df = spark.createDataFrame([('{"results": {"metrics/mAP50": 0.5}}',), ('{"mAP50": "0.25"}',), ('{"mAP50": "none"}',), ("[]",)], "j string").select(F.try_parse_json("j").alias("r"))
    got = [x.m for x in df.select(reports.first_metric("r", "$.results['metrics/mAP50']", "$.mAP50", default=-1.0).alias("m")).collect()]
    assert got == [0.5, 0.25, -1.0, -1.0]


def test_reports_nest_by_keys(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", None)], "k string, l string, n int")
    one = lambda by, rows=df: json.loads(reports.as_report("kind", rows, by).first().report)
    assert one(["k", "l"]) == {"a": {"x": 1, "y": 2}, "b": {"x": None}}
    assert one(["l"], df.where("k = 'a'")) == {"x": {"k": "a", "n": 1}, "y": {"k": "a", "n": 2}}
    assert one([], df.agg(F.sum("n").alias("n"), F.count("*").alias("rows"))) == {"n": 3, "rows": 3}


def lines(spark, rows):
    def parts(text):
        t = text.split()
        num = lambda x, f: f(x) if x.replace(".", "").replace("-", "").isdigit() or x == "nan" else None
        return t, (int(t[0]) if t and t[0].isdigit() else None), *((num(t[k], float) if len(t) > k else None) for k in range(1, 5))

    return spark.createDataFrame([(i, n, *parts(t)) for n, (i, t) in enumerate(rows)], "image_id bigint, line_no bigint, tokens array<string>, class_id int, xc double, yc double, w double, h double")


def test_images_by_all_that_is_wrong(spark):
    good = "0 0.5 0.5 0.3 0.15"  # 192 x 72 pixels
    rows = [(1, good), (2, good), (2, "0 0.501 0.5 0.3 0.15"), (3, "0 0.5 0.5"), (3, good), (4, "0 0.5 0.5 0.01 0.01"), (5, "x 0.5 0.5 0.3 0.15"), (5, "0 1.5 0.5 0.3 0.15"), (5, "0 nan 0.5 0.3 0.15"), (6, good), (7, good), (8, "0 0.5 0.5 0.9 0.9"), (9, "0 0.5 0.5 0.2 0.26"), (10, "0 0.05 0.5 0.3 0.15"), (11, ""), (12, good), (99, good)]
    images = [(i, "train", i != 6, i != 7, ["blurry", "too_dark", "low_contrast"] if i == 12 else ["blurry"] if i == 7 else []) for i in range(1, 14)]
    df = spark.createDataFrame(images, "image_id bigint, split string, readable boolean, labelled boolean, found array<string>")
    got = {r.image_id: (r.issues, r.fixed, r.n_valid, r.kept, r.category) for r in cleaning.clean_images(df, lines(spark, rows), 640, 480).collect()}
    assert got == {
        1: ([], [], 1, True, None), 2: (["duplicate_bbox"], ["removed_duplicates"], 1, True, None), 3: (["invalid_label_format"], [], 1, False, "mislabeled"), 4: (["bbox_too_small", "no_valid_plates"], [], 0, False, "mislabeled"),
        5: (["invalid_coordinates", "invalid_coordinates", "label_parsing_error", "no_valid_plates"], [], 0, False, "mislabeled"), 6: (["unreadable_image"], [], 0, False, "corrupted"), 7: (["blurry", "missing_label"], [], 0, False, "blurry"),
        8: (["bbox_too_large", "no_valid_plates"], [], 0, False, "mislabeled"), 9: (["unusual_aspect_ratio"], [], 1, True, None), 10: ([], ["clipped_bbox"], 1, True, None), 11: (["no_valid_plates"], [], 0, False, "mislabeled"),
        12: (["blurry", "low_contrast", "too_dark"], [], 1, True, None), 13: (["no_valid_plates"], [], 0, False, "mislabeled"),
    }
    assert cleaning.clean_images(df.where("false"), lines(spark, rows), 640, 480).count() == 0


def test_yaml_reads_back(spark):
    from tessera.sources.config import parse_yaml
    from tessera.sources.yaml_text import as_yaml

    d = spark.range(1).select(F.struct(F.lit("a/b").alias("path"), F.lit("it's: so").alias("note"), F.lit("no").alias("flag"), F.lit("").alias("none"), F.lit(True).alias("on"), F.lit(None).cast("int").alias("gone"), F.struct(F.lit(2.5).alias("x"), F.array(F.lit("p"), F.lit("q r")).alias("l")).alias("inner"), F.array().cast("array<string>").alias("empty")).alias("d"))
    text = d.select(as_yaml(F.col("d"), d.schema["d"].dataType)).first()[0]
    assert text == "path: a/b\nnote: 'it''s: so'\nflag: 'no'\nnone: ''\non: true\ngone: null\ninner:\n  x: 2.5\n  l:\n  - p\n  - q r\nempty: []\n"
    assert parse_yaml("path: a/b\ninner:\n  x: 2.5\n")["inner"] == {"x": 2.5}
