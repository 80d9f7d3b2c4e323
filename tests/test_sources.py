import json
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.sources import images, json_labels, labels, sinks
from tessera.streaming import votes


def png(path, pixels):
    """Writes rows of (r, g, b) as a PNG file."""
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[y].astype(np.uint8).tobytes() for y in range(h))
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b""))


def test_label_files(spark, tmp_path):
    folder = tmp_path / "labels" / "train"
    folder.mkdir(parents=True)
    (folder / "a b.txt").write_text("0 0.5 0.5 0.3 0.1\n0 0.5 0.5 0.3\n0.0 0.5 0.5 0.3 0.1\n0 1.2 0.5 0.3 0.1\n0 nan 0.5 0.3 0.1\n0 0.5 0.5 0 0.1\n0 0.99 0.5 0.3 0.1 0.87\nx 0.5 0.5 0.3 0.1\n")
    lines = labels.read_label_lines(spark, str(tmp_path / "labels"))
    assert {(r.split, r.stem) for r in lines.collect()} == {("train", "a b")}
    parsed = labels.parse_lines(lines)
    ok = labels.valid_boxes(parsed, F.lit(640.0), F.lit(480.0)).orderBy("line_no").collect()
    assert [r.line_no for r in ok] == [0, 6] and ok[1].x2 == 640.0
    assert [r[0] for r in parsed.orderBy("line_no").select(labels.line_issue()).collect()] == [None, "invalid_label_format", "label_parse_error", "invalid_bbox_coords", "invalid_bbox_coords", "degenerate_bbox", None, "label_parse_error"]
    assert [r.line_no for r in labels.until_first_error(labels.parse_lines(lines, False), ["stem"], "line_no").orderBy("line_no").collect()] == [0, 2, 3, 4, 5, 6]
    assert not labels.file_validity(parsed, ["stem"]).first().valid


def test_json_labels(spark, tmp_path):
    coco = {"images": [{"id": 0, "file_name": "a.jpg", "width": 100, "height": 50}], "annotations": [{"image_id": 0, "bbox": [10, 10, 20, 10], "category_id": 1}, {"image_id": 0, "bbox": [1, 1, 0, 5], "category_id": 1}, {"image_id": 0}]}
    (tmp_path / "c.json").write_text(json.dumps(coco))
    rows = json_labels.coco_boxes(json_labels.read_coco(spark, str(tmp_path / "c.json"))).collect()
    assert len(rows) == 1 and rows[0].x2 == 30 and rows[0].xc == 0.2  # image id 0 counts
    shape = {"image": "a", "shapes": [{"shape_type": "rectangle", "points": [[30, 20], [10, 5]]}, {"shape_type": "polygon", "points": [[0, 0], [1, 1]]}, {"shape_type": "rectangle", "points": [[1, 1], [1, 9]]}]}
    (tmp_path / "s.json").write_text(json.dumps(shape))
    rows = json_labels.shape_boxes(json_labels.read_shapes(spark, str(tmp_path / "s.json")), F.lit(100.0), F.lit(50.0)).collect()
    assert [(r.class_id, r.x1, r.y1, r.x2, r.y2) for r in rows] == [(0, 10, 5, 30, 20)]


def test_images(spark, tmp_path):
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 256, (120, 150, 3))
    png(tmp_path / "noise.png", noise)
    png(tmp_path / "flat.png", np.full((120, 150, 3), 7))
    (tmp_path / "broken.png").write_bytes(b"no image")
    rows = {r.origin.rsplit("/", 1)[1]: r for r in images.image_metrics(images.read_images(spark, str(tmp_path))).collect()}
    grey = np.rint(noise @ np.array([0.299, 0.587, 0.114]))
    r = rows["noise.png"]
    assert abs(r.brightness - grey.mean()) < 1e-2 and abs(r.contrast - grey.std()) < 1e-2 and r.blur > 1000
    assert rows["flat.png"].low == rows["flat.png"].high and rows["flat.png"].blur == 0
    assert rows["broken.png"].width == -1 and rows["broken.png"].blur is None
    listed = images.manifest(images.list_files(spark, str(tmp_path)), "file:" + str(tmp_path))
    assert listed.count() == 3


def test_stream_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    rows = spark.range(100).select((F.col("id") % 5).alias("track"), F.col("id").alias("frame"), F.lit("t").alias("text"), F.lit(0.5).alias("conf"), F.current_timestamp().alias("ts"))
    rows.where("frame < 60").write.mode("append").parquet(src)
    votes.run_to_files(votes.read_stream(spark, src), out, ck)
    assert spark.read.parquet(out).count() == 60
    rows.where("frame >= 60").write.mode("append").parquet(src)
    votes.run_to_files(votes.read_stream(spark, src), out, ck)
    assert spark.read.parquet(out).select("frame").distinct().count() == spark.read.parquet(out).count() == 100


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("train", "a", 1, 0.5, 0.5, 0.25, 0.125), ("train", "a", 0, 0.25, 0.5, 0.1, 0.2), ("val", "b", 0, 0.5, 0.5, 1.0, 1.0)], "split string, stem string, line_no int, xc double, yc double, w double, h double")
    sinks.write_label_files(sinks.label_files(rows), str(tmp_path / "labels"))
    assert (tmp_path / "labels/train/a.txt").read_text() == "0 0.250000 0.500000 0.100000 0.200000\n0 0.500000 0.500000 0.250000 0.125000\n"
    back = labels.parse_lines(labels.read_label_lines(spark, str(tmp_path / "labels")))
    assert back.where(labels.readable()).count() == 3
    sinks.write_review(rows.withColumn("category", F.col("split")), str(tmp_path / "review"))
    assert (tmp_path / "review/category=val").is_dir()
    sinks.write_mapping(rows, str(tmp_path / "map"))
    assert spark.read.option("header", True).csv(str(tmp_path / "map")).columns == rows.columns
    assert sinks.data_yaml(rows, "/data", ["plate"]) == "path: /data\ntrain: images/train\nval: images/val\nnc: 1\nnames:\n  0: plate\n"
    assert sinks.copy_manifest(rows.select(F.lit("p").alias("path"), "split", F.col("stem").alias("name")), "/out").first().target == "/out/images/train/a"
