import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import matching


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0.0, w) * max(0.0, h)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / union if union > 0 else 0.0


def some(n, seed, side=100.0, images=3):
    r = random.Random(seed)
    for i in range(n):
        x, y, w = r.uniform(-side / 5, side), r.uniform(-side / 5, side), r.choice([1, 2, 4, 8, r.uniform(0, side / 3)])
        h = w * r.choice([1, 1, 2, 0.5, r.uniform(0.2, 3)])
        if r.random() < 0.3:
            x, y = round(x / 4) * 4, round(y / 4) * 4
        yield i % images, i, r.randrange(5) / 4, *map(float, (x, y, x + w, y + h))


def frame(spark, rows, idx="box_id"):
    return spark.createDataFrame([*rows], f"image_id bigint, {idx} bigint, conf double, x1 double, y1 double, x2 double, y2 double")


@pytest.mark.parametrize("least", [0.2, 0.5, 0.9])
@pytest.mark.parametrize("side", [1.0, 100.0])
def test_close_pairs_against_all_pairs(spark, least, side):
    a, b = [*some(300, 1, side)], [*some(300, 2, side)]
    b += [(i, k + 1000, *rest) for i, k, *rest in a[:40]] + [(i, k + 2000, c, x, y, x + (u - x) * 2, v) for i, k, c, x, y, u, v in a[:40]]
    a += [(0, 900, 0.5, 1.0, 1.0, 1.0, 5.0), (0, 901, 0.5, None, 1.0, 2.0, 5.0), (None, 902, 0.5, 1.0, 1.0, 2.0, 5.0)]
    want = {(x[1], y[1]) for x in a if x[0] is not None and x[3] is not None for y in b if x[0] == y[0] and iou(x[3:], y[3:]) >= least}
    found = matching.close(frame(spark, a), frame(spark, b), least).select("box_id", "o_box_id").collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want) > 20


def greedy_plain(a, b, least):
    pairs = sorted((-iou(x[3:], y[3:]), x[1], y[1]) for x in a for y in b if x[0] == y[0] and iou(x[3:], y[3:]) >= least)
    gs, ds = set(), set()
    for _, g, d in pairs:
        if g not in gs and d not in ds:
            gs.add(g), ds.add(d)
            yield g, d


@pytest.mark.parametrize("most", [200_000, 30, 0])
def test_greedy_and_suppress_in_order_and_in_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(matching, "MOST_PAIRS", most)
    a, b = [*some(150, 5, 20.0)], [*some(150, 6, 20.0)]
    b += [(i, k + 1000, *rest) for i, k, *rest in a[:40]] + [(i, k + 2000, *rest) for i, k, *rest in a[:20]]
    got = matching.greedy(matching.close_pairs(frame(spark, a, "gt_idx"), frame(spark, b, "det_idx"), 0.3), 0.3)
    assert {(r.gt_idx, r.det_idx) for r in got.collect()} == {*greedy_plain(a, b, 0.3)}
    kept = []
    for x in sorted(b, key=lambda x: (-x[2], x[1])):
        if not any(k[0] == x[0] and iou(k[3:], x[3:]) >= 0.3 for k in kept):
            kept.append(x)
    found = matching.suppress(frame(spark, b), 0.3, score=F.col("conf"))
    assert sorted(r.box_id for r in found.collect()) == sorted(x[1] for x in kept)


def test_a_crowded_image(spark):
    began = time.time()
    r = F.xxhash64
    n = 20_000
    at = lambda s, m: F.pmod(r(F.col("id"), F.lit(s)), F.lit(m)).cast("double")
    boxes = spark.range(n).select("id", F.lit(1).alias("image_id"), F.col("id").alias("box_id"), at(1, 2000).alias("x1"), at(2, 2000).alias("y1"))
    boxes = boxes.select("*", (F.col("x1") + 24 + at(3, 8)).alias("x2"), (F.col("y1") + 24 + at(4, 8)).alias("y2")).withColumn("conf", F.lit(0.5)).drop("id")
    close = matching.close(boxes, boxes, 0.5)
    plan = close._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "__cx" in plan
    kept = matching.suppress(boxes, 0.5).count()
    assert 0 < kept < n
    shifted = boxes.select("image_id", F.col("box_id").alias("det_idx"), "conf", (F.col("x1") + 1).alias("x1"), "y1", (F.col("x2") + 1).alias("x2"), "y2")
    assert matching.greedy(matching.close_pairs(boxes.withColumnRenamed("box_id", "gt_idx"), shifted)).count() > 0.95 * n
    assert time.time() - began < 120


def test_chains_of_boxes(spark, monkeypatch):
    monkeypatch.setattr(matching, "MOST_PAIRS", 10)
    rows = [(1, i, 1.0, float(i), 0.0, i + 3.0, 10.0) for i in range(30)]  # each overlaps the next by half
    assert sorted(r.box_id for r in matching.suppress(frame(spark, rows), 0.5).collect()) == [*range(0, 30, 2)]


@pytest.mark.parametrize("block", [3, 512])
def test_boxes_in_order_as_on_a_grid(spark, monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    rows = [*some(400, 7, 12.0)] + [(0, 900, 0.5, 1.0, 1.0, 1.0, 5.0), (None, 901, 0.5, 1.0, 1.0, 2.0, 5.0), (None, 902, 0.5, 1.0, 1.0, 2.0, 5.0)]
    boxes = frame(spark, rows)
    seen = []
    monkeypatch.setattr(matching, "close", lambda *a, f=matching.close: seen.append(a) or f(*a))
    kept = lambda: sorted(r.box_id for r in matching.suppress(boxes, 0.4, score=F.col("conf")).collect())
    fused = lambda: sorted((r["head"], r.n) for r in matching.fuse(boxes, F.col("conf"), 0.4).collect())
    one, two = kept(), fused()
    assert not seen and len(one) < 350 and {901, 902, 900} <= {*one} and [h for h, _ in two] == one and sum(n for _, n in two) == len(rows)
    monkeypatch.setattr(matching, "MOST_BOXES", 150 if block == 3 else 1)
    assert kept() == one and fused() == two and (seen or block == 3)


@pytest.mark.parametrize("block", [1, 4, 512])
def test_boxes_of_one_id_stand_or_fall_together(spark, monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    rows = [(i, k % 150, (k % 150) % 3 / 2, *rest) for i, k, _, *rest in some(600, 11, 12.0)]  # four boxes of an id, all in one image
    assert all(len({x[0] for x in rows if x[1] == k}) == 1 for k in range(150))
    kept, groups = [], {}
    for x in rows:
        groups.setdefault((x[0], -x[2], x[1]), []).append(x)
    for node in sorted(groups):
        if not any(k[0] == x[0] and iou(k[3:], x[3:]) >= 0.4 for k in kept for x in groups[node]):
            kept += groups[node]
    want = sorted(x[:2] for x in kept)
    assert 10 < len(want) < 500
    found = lambda: sorted(tuple(r) for r in matching.suppress(frame(spark, rows), 0.4, score=F.col("conf")).collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)  # a batch ends inside an id
    try:
        assert found() == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(matching, "MOST_BOXES", 1)
    assert found() == want


def test_a_cluster_without_weight(spark):
    rows = [(1, 1, 0.0, 0.0, 0.0, 10.0, 10.0), (1, 2, 0.0, 0.0, 0.0, 10.0, 9.0), (1, 3, 0.5, 50.0, 0.0, 60.0, 10.0), (1, 4, 0.0, 50.0, 0.0, 60.0, 8.0)]
    got = {r["head"]: r for r in matching.fuse(frame(spark, rows), F.col("conf")).collect()}
    assert (got[1].n, got[1].weight, got[3].n, got[3].weight) == (2, 0.0, 2, 0.5)
    assert all(got[1][c] != got[1][c] for c in matching.CORNERS) and [got[3][c] for c in matching.CORNERS] == [50.0, 0.0, 60.0, 10.0]


def test_mean_average_precision_in_order_as_on_a_grid(spark, monkeypatch):
    gt, det = [*some(150, 8, 12.0)], [*some(300, 9, 12.0)] + [(None, 999, 0.5, 1.0, 1.0, 2.0, 5.0)]
    det += [(i, k + 1000, c / 2, x, y, u, v + 0.2) for i, k, c, x, y, u, v in gt[:60]] + [(i, k + 2000, c, x, y, u, v) for i, k, c, x, y, u, v in gt[:40]]
    classed = lambda df, i: df.withColumn("class_id", F.col(i) % 2)
    g, d = classed(frame(spark, gt, "gt_idx"), "gt_idx"), classed(frame(spark, det, "det_idx"), "det_idx")
    calls = []
    monkeypatch.setattr(matching, "greedy", lambda *a, f=matching.greedy: calls.append(a) or f(*a))
    got = lambda: {(r.class_id, r.iou_threshold): (r.truth, round(r.ap, 9)) for r in matching.mean_average_precision(g, d).collect()}
    one = got()
    assert not calls and len(one) == 20  # no pair goes through a shuffle for each threshold
    for c in (0, 1):
        for t in (0.5, 0.75):
            mine = lambda rows: [x for x in rows if x[1] % 2 == c]  # noqa: B023, E731
            hits = {b for _, b in greedy_plain(mine(gt), mine([x for x in det if x[0] is not None]), t)}
            flags = [x[1] in hits for x in sorted(mine(det), key=lambda x: (-x[2], x[0] is not None, x[0] or 0, x[1]))]
            precision = [sum(flags[: i + 1]) / (i + 1) for i in range(len(flags))]
            area = sum(max(precision[i:]) for i, hit in enumerate(flags) if hit)
            assert hits and one[c, t] == (75, round(area / 75, 9))
    monkeypatch.setattr(matching, "MOST_BOXES", 80)
    assert got() == one and calls


def test_average_precision_by_hand(spark):
    box = lambda k: (10.0 * k, 0.0, 10.0 * k + 8, 8.0)
    gt = [(1, k, 0.0, *box(k)) for k in range(4)]
    det = [(1, 10, 0.9, *box(0)), (1, 11, 0.8, 500.0, 0.0, 508.0, 8.0), (1, 12, 0.7, *box(1)), (1, 13, 0.6, 20.0, 0.0, 28.0, 5.0)]  # hit, miss, hit, IoU 0.625
    add = lambda df, c=0: df.withColumn("class_id", F.lit(c))
    g, d = add(frame(spark, gt, "gt_idx")), add(frame(spark, det, "det_idx"))
    other = add(frame(spark, gt[:1], "gt_idx"), 1)  # a class without detections
    got = {(r.class_id, r.iou_threshold): r.ap for r in matching.mean_average_precision(g.unionByName(other), d).collect()}
    at_60 = (1 + 3 / 4 + 3 / 4) / 4  # precisions 1, 1/2, 2/3, 3/4
    assert got[0, 0.6] == pytest.approx(at_60) and got[0, 0.65] == pytest.approx((1 + 2 / 3) / 4)
    assert got[0, 0.95] == got[0, 0.65] and got[1, 0.5] == 0 and len(got) == 20
    assert matching.mean_average_precision(g.where("false"), d).count() == 0
    assert {r.ap for r in matching.mean_average_precision(g, d.where("false")).collect()} == {0.0}


@pytest.mark.skip(reason="takes minutes: with so low a limit cells are cut many times; not confirmed yet")
def test_near_pairs_with_a_hot_band(spark, monkeypatch):
    from tessera.operators import merging

    r = random.Random(2)
    monkeypatch.setattr(merging, "HOT", 5)
    signs = [(r.getrandbits(20) << 44 | 0xBEEF) for _ in range(60)] + [r.getrandbits(64) for _ in range(20)]
    signs += [s ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for s in signs[:40]] + signs[:5]
    rows = [(i, s - 2**64 if s >> 63 else s) for i, s in enumerate(signs)]
    first = {}
    for i, s in enumerate(signs):
        first.setdefault(s, i)
    want = {(i, j, (signs[i] ^ signs[j]).bit_count()) for i in first.values() for j in first.values() if i < j and (signs[i] ^ signs[j]).bit_count() <= 3}
    want |= {(first[s], i, 0) for i, s in enumerate(signs) if first[s] != i}
    got = merging.near_pairs(spark.createDataFrame(rows, "id bigint, sign bigint"), "id", "sign").collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want) > 40


@pytest.mark.skip(reason="takes minutes; not confirmed yet")
def test_many_signatures_with_a_hot_band(spark):
    from tessera.operators import merging

    n = 300_000
    sign = F.shiftleft(F.xxhash64("id"), 16).bitwiseOR(F.lit(0xBEEF))  # all are alike in sixteen bits
    rows = spark.range(n).select("id", sign.alias("sign"))
    twins = rows.where("id % 1000 = 0").select((F.col("id") + n).alias("id"), F.col("sign").bitwiseXOR(F.lit(2**40 + 2**20)).alias("sign"))
    began = time.time()
    got = merging.near_pairs(rows.unionByName(twins), "id", "sign").where(F.col("b") == F.col("a") + n)
    assert got.count() == n // 1000 and time.time() - began < 200


def test_star_groups_of_a_chain(spark):
    from tessera.operators import merging

    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1000, 1002), (1001, 1003)], "a bigint, b bigint")
    began = time.time()
    got = {(r.head, r.member) for r in merging.star_groups(chain).collect()}
    assert got == {(i, i + 1) for i in range(0, 300, 2)} | {(1000, 1001), (1000, 1002)} and time.time() - began < 100


def test_copies_have_the_links_of_their_first(spark):
    from tessera.operators import merging

    r = random.Random(5)
    signs = [r.getrandbits(62) for _ in range(12)]
    signs += [s ^ (1 << r.randrange(62)) for s in signs * 2] + [0, 1, 3, 7, 15, 31, 0]
    signs += [r.choice(signs) for _ in range(60)]
    near = lambda i, j: (signs[i] ^ signs[j]).bit_count() <= 3
    want = {(i, j, (signs[i] ^ signs[j]).bit_count()) for j in range(len(signs)) for i in range(j) if near(i, j)}
    heads, groups = [], set()
    for j in range(len(signs)):
        head = min((h for h in heads if near(h, j)), default=None)
        heads.append(j) if head is None else groups.add((head, j))
    pairs = merging.near_pairs(spark.createDataFrame([*enumerate(signs)], "id bigint, sign bigint"), "id", "sign")
    got = merging.with_copies(pairs).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want)
    got = merging.near_groups(pairs).collect()
    assert {tuple(x) for x in got} == groups and len(got) == len(groups)
