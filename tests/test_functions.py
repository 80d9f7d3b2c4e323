import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.functions import plates
from tessera.operators import matching, merging, quality, splits


def one(spark, column, **values):
    rows = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return rows.select(column).first()[0]


def test_score_and_grades(spark):
    s = quality.score(F.lit(24436), F.lit(10.11011011), F.lit(4.46902655), F.lit(8.05309735), F.lit(False))
    assert abs(one(spark, s) - 96.83679254) < 1e-6
    for value, letter in ((90, "A+"), (89.9, "A"), (84, "A-"), (75, "B+"), (70, "B"), (65, "B-"), (60, "C+"), (55, "C"), (50, "C-"), (49.9, "F")):
        assert one(spark, quality.grade(F.lit(value))) == letter


def test_split_sizes(spark):
    n = dict(splits.split_by_rank(spark.range(24704), "id").groupBy("split").count().collect())
    assert n == {"train": 17292, "val": 4941, "test": 2471}
    n = dict(splits.split_by_rank(spark.range(1000), "id").groupBy("split").count().collect())
    assert n == {"train": 700, "val": 199, "test": 101}  # 0.7 + 0.2 in doubles


def test_nearest_province_is_the_closest_match(spark):
    codes = [a + b for a in "0123456789AXZ" for b in "0123456789AXZ"]
    got = dict(spark.createDataFrame([(c,) for c in codes], "c string").select("c", F.when(F.col("c").isin(plates.VIDEO_PROVINCES), F.col("c")).otherwise(plates.nearest_province(F.col("c")))).collect())
    for c in codes:
        want = c if c in plates.VIDEO_PROVINCES else next(iter(difflib.get_close_matches(c, plates.VIDEO_PROVINCES, n=1, cutoff=0.5)), None)
        assert got[c] == want


def test_plates(spark):
    rect = F.lit("CAR_RECT")
    assert one(spark, plates.validate(F.lit("51a-12345"), rect)).asDict() == {"valid": True, "text": "51A12345"}
    assert one(spark, plates.validate(F.lit("S1A12345"), rect))["text"] == "51A12345"
    assert one(spark, plates.smart_correct(F.lit("51U12345"))) == "51L12345"
    assert one(spark, plates.smart_correct(F.lit("13A12345")))[:2] == "93"
    assert one(spark, plates.smart_correct(F.lit("123456"))) is None and one(spark, plates.smart_correct(F.lit("12345678901"))) is None
    for lines, kind in ((["51A-12345"], "CAR_RECT"), (["51D", "123.45"], "CAR_SQUARE"), (["59X1", "123.45"], "BIKE"), (["a", "-"], "UNKNOWN")):
        assert one(spark, plates.layout(F.array(*[F.lit(x) for x in lines]))) == kind


def test_extract_against_a_plain_model(spark):
    random.seed(5)
    texts = ["".join(random.choice("0159OISBAX-") for _ in range(random.randint(0, 14))) for _ in range(300)]
    rows = [(t, k) for t in texts for k in ("BIKE", "CAR_RECT", "UNKNOWN")]
    number = str.maketrans(*plates.TO_NUMBER)

    def model(text, kind):
        s = re.sub("[^A-Z0-9]", "", text.upper())
        sizes = {"BIKE": (8, 9), "CAR_RECT": (7, 8)}.get(kind, (7, 8, 9))
        if len(s) in sizes:
            return s
        best = None
        for n in sizes:
            for i in range(len(s) - n + 1):
                if s[i : i + 2].translate(number) in plates.PROVINCES and (best is None or n > len(best)):
                    best = s[i : i + n]
        return best or s

    got = spark.createDataFrame(rows, "t string, k string").select("t", "k", plates.extract(F.col("t"), F.col("k")).alias("x")).collect()
    assert [r["x"] for r in got] == [model(r["t"], r["k"]) for r in got]


def test_views_invert(spark):
    box = tuple(F.lit(float(v)) for v in (20, 30, 80, 60))
    for view in g.VIEWS:
        f = g.view_forward(F.lit(view), box, F.lit(200.0), F.lit(100.0))
        r = one(spark, g.view_inverse(F.lit(view), tuple(f[c] for c in ("x1", "y1", "x2", "y2")), F.lit(200.0), F.lit(100.0)))
        assert [round(v, 9) for v in r] == [20, 30, 80, 60], view


def test_greedy_against_a_loop(spark):
    random.seed(2)
    rows = [(i, a, b, round(random.random(), 1)) for i in range(40) for a in range(random.randint(1, 5)) for b in range(random.randint(1, 5))]
    got = {(r.image_id, r.gt_idx, r.det_idx) for r in matching.greedy(spark.createDataFrame(rows, "image_id bigint, gt_idx bigint, det_idx bigint, iou double")).collect()}
    want = set()
    for i in range(40):
        used_a, used_b = set(), set()
        for _, a, b in sorted((-v, a, b) for j, a, b, v in rows if j == i and v >= 0.5):
            if a not in used_a and b not in used_b:
                used_a.add(a), used_b.add(b), want.add((i, a, b))
    assert got == want


def test_merge_against_the_loop(spark):
    random.seed(3)
    rows = [(random.randint(0, 60), random.randint(0, 1), i, random.random() < 0.6) for i in range(300)]
    got = {r.pos: r.outcome for r in merging.merge_with_precedence(spark.createDataFrame(rows, "key int, prio int, pos int, valid boolean")).collect()}
    seen, want = set(), {}
    for key, _, pos, valid in sorted(rows, key=lambda r: (r[1], r[2])):
        want[pos] = "duplicate" if key in seen else "accepted" if valid else "invalid"
        if want[pos] == "accepted":
            seen.add(key)
    assert got == want


def test_star_groups_are_not_transitive(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path))
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (3, 6)], "a bigint, b bigint")
    assert sorted(tuple(r) for r in merging.star_groups(pairs).collect()) == [(1, 2), (3, 6), (4, 5)]


def test_near_pairs_against_all_pairs(spark):
    random.seed(4)
    signs = [random.getrandbits(63) for _ in range(60)]
    signs += [s ^ (1 << random.randint(0, 62)) ^ (1 << random.randint(0, 62)) for s in signs[:40]]
    rows = list(enumerate(signs))
    got = {(r.a, r.b) for r in merging.near_pairs(spark.createDataFrame(rows, "id bigint, sign bigint"), "id", "sign").collect()}
    assert got == {(i, j) for i, s in rows for j, t in rows if i < j and (s ^ t).bit_count() <= 3}


def test_fusion(spark):
    rows = [(1, 1, 0.0, 0.0, 10.0, 10.0, 3.0), (1, 2, 2.0, 0.0, 10.0, 10.0, 1.0), (1, 3, 50.0, 50.0, 60.0, 60.0, 2.0)]
    got = {r.head: r for r in matching.fuse(spark.createDataFrame(rows, "image_id bigint, box_id bigint, x1 double, y1 double, x2 double, y2 double, s double"), F.col("s")).collect()}
    assert got.keys() == {1, 3} and got[1].x1 == 0.5 and got[1].n == 2 and got[3].weight == 2.0


def test_yaml():
    from tessera.sources.config import parse_yaml

    text = "# data\npath: data\ntrain: images/train\nnc: 1\nnames:\n  0: plate\nsizes: [640, 768]\nuse:\n  - a\n  - 'b c'\nnested:\n  deep:\n    lr: 0.01\n    on: true\nlast: ~\n"
    assert parse_yaml(text) == {"path": "data", "train": "images/train", "nc": 1, "names": {"0": "plate"}, "sizes": [640, 768], "use": ["a", "b c"], "nested": {"deep": {"lr": 0.01, "on": True}}, "last": None}
    assert parse_yaml('{"nc": 1}') == {"nc": 1} and parse_yaml("") == {}
    with pytest.raises(ValueError):
        parse_yaml("no key here")


def test_methods_by_name():
    from tessera.functions.hashing import by_method
    from tessera.operators.matching import ensemble, fuse

    assert ensemble("fusion") is fuse
    for make in (by_method, ensemble):
        with pytest.raises(ValueError):
            make("other")


def test_one_failing_query_leaves_the_others(spark):
    from tessera.plans import queries

    got = queries.run_each(spark, "/root/testdata/sf0.001", ["split_counts", "no such query"])
    assert got["split_counts"].count() == 3 and got["no such query"]["error"].startswith("KeyError")


def test_ranks_and_quantiles(spark):
    import random

    from tessera.operators import splits, stats

    random.seed(3)
    values = [(k % 3, random.choice([0.0, 1.5, random.random() * 100])) for k in range(900)] + [(7, 2.0)] * 5 + [(8, None)]
    df = spark.createDataFrame(values, "metric int, value double")
    got = {r.metric: r for r in stats.quantiles(df, "metric", {"a": 0.1, "b": 0.5, "c": 0.99}, buckets=16).collect()}
    for k in (0, 1, 2, 7):
        have = sorted(v for m, v in values if m == k)
        for name, q in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
            at = (len(have) - 1) * q
            want = have[int(at)] + (have[min(len(have) - 1, int(at) + 1)] - have[int(at)]) * (at - int(at))
            assert abs(got[k][name] - want) < 1e-9
    rows = splits.ranked_in_buckets(df.where("value IS NOT NULL").withColumn("bucket", F.floor(F.col("value") / 10)), ["value"], "bucket", ["metric"]).collect()
    for k in (0, 1, 2, 7):
        mine = sorted((r["rank"], r.value) for r in rows if r.metric == k)
        assert [x for x, _ in mine] == list(range(1, len(mine) + 1)) and [v for _, v in mine] == sorted(v for _, v in mine) and all(r.n == len(mine) for r in rows if r.metric == k)
