import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import matrices as m
from tessera.operators import augment
from tessera.sources import dataset


def put(root, path, content):
    at = os.path.join(root, path)
    os.makedirs(os.path.dirname(at), exist_ok=True)
    with open(at, "wb") as f:
        f.write(content)


def test_every_file_has_a_row(spark, tmp_path):
    root = str(tmp_path)
    good = dataset.png(bytes(range(12)), 4, 3)
    for path, content in {"images/train/a.PNG": good, "images/train/b.png": b"", "images/train/c.jpg": b"not an image", "train/images/d.png": good, "labels/train/a.txt": b"0 0.5 0.5 1 1\n", "labels/train/b.txt": b"", "labels/train/e.txt": b"x", "images/val/f.png": good, "images/train/.hidden.png": good, "images/train/notes.md": b"x", "val/readme": b"y"}.items():
        put(root, path, content)
    got = {(r.split, r.stem): (r.status, r.width, r.height, r.nChannels, r.data and bytes(r.data), r.label) for r in dataset.read_dataset(spark, root).collect()}
    pixels = (4, 3, 1, bytes(range(12)))
    assert got == {("train", "a"): ("ok", *pixels, "text"), ("train", "b"): ("empty", None, None, None, None, "empty"), ("train", "c"): ("corrupt", None, None, None, None, "missing"), ("train", "d"): ("ok", *pixels, "missing"), ("val", "f"): ("ok", *pixels, "missing")}
    assert {r.split for r in dataset.read_dataset(spark, root, skip_incomplete=True).collect()} == {"train"}
    assert dataset.listed(spark, root).where("kind = 'labels'").count() == 3
    assert dataset.listed(spark, f"{root}/none").count() == 0
    assert {(r.stem, r.text) for r in dataset.read_labels(spark, f"file://{root}").collect()} == {("a", "0 0.5 0.5 1 1\n"), ("b", ""), ("e", "x")}


def test_files_are_written_whole(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i % 3}/f{i}.txt", f"{i}") for i in range(20)], "path string, content string")
    for _ in range(2):  # again: the same files
        dataset.write_files(rows.repartition(4), f"file://{tmp_path}")
    found = {os.path.join(d, f): open(os.path.join(d, f)).read() for d, _, fs in os.walk(tmp_path) for f in fs}
    assert found == {f"{tmp_path}/d{i % 3}/f{i}.txt": f"{i}" for i in range(20)}


def test_transforms_compose():
    boxes = np.array([[1.0, 2.0, 4.0, 8.0]])
    assert m.moved(m.then(m.shift(1, 2), m.mirror(True)), boxes).tolist() == [[-5.0, 4.0, -2.0, 10.0]]
    assert np.allclose(m.moved(m.about(m.turn(90, 2), 1, 2), boxes), [[-11.0, 2.0, 1.0, 8.0]])
    assert np.allclose(m.moved(m.perspective(0, 0.5), boxes), [[1 / 5, 2 / 2, 4 / 2, 8 / 5]])
    a, b = m.then(m.turn(10, 1.2), m.shift(3, 4)), m.then(m.perspective(0.01, 0.02), m.mirror(True))
    point = np.array([2.0, 5.0, 1.0])
    assert np.allclose(m.then(a, b) @ point, b @ (a @ point))


def test_an_attempt_follows_a_failure_only(spark, monkeypatch):
    tried = []
    monkeypatch.setattr(augment, "transform", lambda key, k, w, h: tried.append(k) or (m.shift(0, 0) if k == 3 else m.shift(1000, 0)))
    box = np.array([[10.0, 10.0, 60.0, 60.0]])
    assert augment.first_passing(1, box, np.array([0.25]), 640, 480, 5)[0] == 3 and tried == [1, 2, 3]
    tried.clear()
    assert augment.first_passing(1, box, np.array([0.25]), 640, 480, 2) == (2, None, None) and tried == [1, 2]
    small = np.array([[10.0, 10.0, 60.0, 60.0], [10.0, 10.0, 25.0, 60.0]])  # a box under 20 pixels fails all
    assert augment.first_passing(1, small, np.array([0.25] * 2), 640, 480, 4)[1] is None


def test_plans_of_awkward_boxes(spark):
    rows = [(1, 1, 100.0, 100.0, 300.0, 200.0), (1, 1, 100.0, 100.0, 300.0, 200.0), (1, 2, None, 1.0, 2.0, 3.0), (2, 3, 5.0, 5.0, 5.0, 5.0), (None, 4, 100.0, 100.0, 300.0, 200.0)]
    boxes = spark.createDataFrame(rows, "image_id bigint, box_id bigint, x1 double, y1 double, x2 double, y2 double").withColumn("placed", F.lit("other"))
    got = {r.image_id: r for r in augment.plan(boxes, 640, 480).collect()}
    assert got.keys() == {1, 2, None} and not got[2].accepted and got[2].failures == got[2].attempts == 3
    assert got[1].accepted == (got[1].failures < got[1].attempts) and len(got[1].placed) == 2
    assert augment.plan(boxes.where("false"), 640, 480).count() == 0
    with pytest.raises(Exception):
        augment.plan(boxes.drop("x1"), 640, 480)


def test_quotas_are_met(spark):
    from tessera.operators import splits

    quota = splits.bin_quotas(200)
    assert sum(quota.values()) == 200 and quota["tiny"] == max(quota.values())
    df = spark.range(3000).select("id", (F.col("id") % 7 + 0.0).alias("w"), F.element_at(F.array(*map(F.lit, [*splits.BINS, "other"])), (F.col("id") % 6 + 1).cast("int")).alias("bin"))
    for parts in (1, 50):
        got = splits.weighted_sample(df, "id", "w", quota, parts=parts)
        rows = got.collect()
        assert {n: sum(r.bin == n for r in rows) for n in quota} == quota and len({r.id for r in rows}) == 200 and all(r.w > 0 for r in rows)
    heavy = splits.weighted_sample(df.withColumn("bin", F.lit("a")), "id", "w", {"a": 600}).agg(F.avg("w")).first()[0]
    assert heavy > 3.6  # a plain sample of rows with weight has 3.5
    assert splits.weighted_sample(df.where("id < 20"), "id", "w", quota).count() == df.where("id < 20 AND w > 0 AND bin <> 'other'").count()


def test_ranks_in_ranges_of_like_names(spark):
    from tessera.operators import splits

    names = spark.range(20_000).select(F.concat(F.lit("img"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(20_000)).cast("string"), 9, "0")).alias("name"))
    got = splits.ranked_in_ranges(names, ["name"], ranges=16).withColumn("want", F.substring("name", 4, 9).cast("bigint") + 1)
    assert got.where("rank <> want OR n <> 20000").count() == 0 and got.count() == 20_000
    sizes = sorted(r["count"] for r in names.repartitionByRange(16, "name").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]
    odd = spark.createDataFrame([("b", 1), (None, 1), ("a", 2), ("a", 2), (None, 2)], "name string, g int")
    assert sorted((r.g, r.rank, r.name) for r in splits.ranked_in_ranges(odd, ["name"], ["g"], 3).collect()) == [(1, 1, None), (1, 2, "b"), (2, 1, None), (2, 2, "a"), (2, 3, "a")]
    assert splits.ranked_in_ranges(odd.where("false"), ["name"]).count() == 0
