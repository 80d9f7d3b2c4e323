"""More queries: scans, sinks as rows, validation, statistics, limits, unions, sampling, box effects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import hashing, plates
from ..functions.sampling import hash32, uniform
from ..operators import matching, quality, splits, stats
from ..sources import config, images, labels, sinks
from . import bindings as b
from .more_queries import VOTES
from .queries import AREA, ASPECT, BOX_ISSUES, CORNERS, FILES, H, IMAGE_ISSUES, MERGE, OK, UNIT, XYWH, _files, _image_issues, _measured, _merged, _pairs, _parsed, _size, query, shown

SPLIT_OF = "CASE WHEN {i} % 10 < 7 THEN 'train' WHEN {i} % 10 < 9 THEN 'val' ELSE 'test' END"


# scans ----------------------------------------------------------------------------------------

NAMES_SQL = """n AS (SELECT doc_id, source AS dataset, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END AS split, n_chars AS length,
  CASE doc_id % 7 WHEN 0 THEN 'JPG' WHEN 1 THEN 'png' WHEN 2 THEN 'bmp' WHEN 3 THEN 'tiff' WHEN 4 THEN 'webp' WHEN 5 THEN 'jpeg' ELSE 'txt' END AS e FROM documents)"""


def _listing(spark, sf) -> DataFrame:
    i = F.col("doc_id")
    e = F.element_at(F.array(*[F.lit(x) for x in ("JPG", "png", "bmp", "tiff", "webp", "jpeg", "txt")]), (i % 7 + 1).cast("int"))
    split = F.when(i % 10 < 7, "train").when(i % 10 < 9, "val").otherwise("test")
    return b.table(spark, sf, "documents").select(F.concat_ws("/", F.lit("raw"), F.col("source"), split, F.concat(F.lit("img"), i, F.lit("."), e)).alias("path"), F.col("n_chars").alias("length"))


@query(f"""WITH {NAMES_SQL}, s AS (SELECT * FROM (VALUES ('split', ['jpg', 'jpeg', 'png', 'bmp']), ('flat', ['jpg', 'jpeg', 'png', 'bmp', 'tiff']), ('evaluation', ['jpg', 'jpeg', 'png']), ('merge', ['jpg', 'png'])) v(scan, suffixes))
SELECT scan, split, count(*) AS n FROM n JOIN s ON list_contains(suffixes, lower(e)) GROUP BY scan, split""")
def scan_suffixes(spark, sf):
    """How many files each kind of scan finds in a split."""
    found = images.manifest(_listing(spark, sf), "raw", images.EXTENSIONS)
    kinds = F.explode(F.array_compact(F.array(*[F.when(F.col("ext").isin(*xs), F.lit(k)) for k, xs in images.SCANS.items()])))
    return found.select("split", kinds.alias("scan")).groupBy("scan", "split").agg(F.count("*").alias("n"))


@query(f"WITH {NAMES_SQL} SELECT 'raw/' || dataset || '/' || split || '/img' || doc_id || '.' || e AS path, row_number() OVER (ORDER BY 'raw/' || dataset || '/' || split || '/img' || doc_id || '.' || e) - 1 AS at FROM n WHERE e <> 'txt'")
def sorted_scan(spark, sf):
    """Files with their place in the order of paths."""
    found = images.manifest(_listing(spark, sf), "raw").select("path")
    return splits.ranked_in_ranges(found, ["path"]).select("path", (F.col("rank") - 1).alias("at"))


# The needed folders, and how many images are too few.
FOLDERS, FEWEST = tuple((k, s) for k in ("images", "labels") for s in ("train", "val", "test")), 100


@query(f"""WITH {FILES}, have AS (SELECT DISTINCT 'images' AS kind, split FROM f UNION ALL SELECT DISTINCT 'labels', {SPLIT_OF.format(i='doc_id')} FROM labels WHERE doc_id % 10 < 9),
m AS (SELECT 'issue' AS severity, 'missing ' || kind || '/' || split AS message FROM (SELECT unnest(['images', 'labels']) AS kind), (SELECT unnest(['train', 'val', 'test']) AS split) WHERE (kind, split) NOT IN (SELECT (kind, split) FROM have)),
w AS (SELECT 'warning' AS severity, 'few images in ' || split AS message FROM f GROUP BY split HAVING count(*) < 100)
SELECT severity, message, (SELECT count(*) FROM m) = 0 AS passed FROM (SELECT * FROM m UNION ALL SELECT * FROM w)""")
def validation_issues(spark, sf):
    """Missing folders are issues, small splits warnings; a dataset passes without issues."""
    f = _files(spark, sf).select("split")
    i = F.col("doc_id")
    lab = b.table(spark, sf, "labels").where("doc_id % 10 < 9").select(F.lit("labels").alias("kind"), F.when(i % 10 < 7, "train").when(i % 10 < 9, "val").otherwise("test").alias("split"))
    have = f.select(F.lit("images").alias("kind"), "split").unionByName(lab).distinct()
    issues = spark.createDataFrame(list(FOLDERS), "kind string, split string").join(have, ["kind", "split"], "left_anti").select(F.lit("issue").alias("severity"), F.format_string("missing %s/%s", "kind", "split").alias("message"))
    few = f.groupBy("split").count().where(F.col("count") < FEWEST).select(F.lit("warning").alias("severity"), F.format_string("few images in %s", "split").alias("message"))
    every = issues.unionByName(few)  # some rows
    return every.withColumn("passed", F.count_if(F.col("severity") == "issue").over(W.partitionBy(F.lit(0))) == 0)


@query(f"WITH {FILES} SELECT dataset, count(*) AS counted, count(DISTINCT doc_id % 997) AS files, count(*) = count(DISTINCT doc_id % 997) AS agree FROM f GROUP BY dataset")
def count_check(spark, sf):
    """Listed paths against distinct ones."""
    n = _files(spark, sf).groupBy("dataset").agg(F.count("*").alias("counted"), F.countDistinct(F.col("doc_id") % 997).alias("files"))
    return n.withColumn("agree", F.col("counted") == F.col("files"))


# sinks as rows --------------------------------------------------------------------------------

RENDER_SQL = "printf('%d %.6f %.6f %.6f %.6f', {c}, xc, yc, w, h)"


@query(f"WITH {b.LINES}, g AS (SELECT split, stem, string_agg(CASE WHEN {OK} AND {UNIT} THEN {RENDER_SQL.format(c='class_id')} END, chr(10) ORDER BY line_no) AS fixed, string_agg(line, chr(10) ORDER BY line_no) AS original FROM n GROUP BY split, stem) SELECT split, stem, coalesce(fixed, original) AS text FROM g")
def label_files_fixed(spark, sf):
    """Label files with what reads, class kept; the original where nothing does."""
    p = _parsed(spark, sf)
    ok = labels.readable() & g.in_unit(*[F.col(c) for c in XYWH])
    return sinks.fixed_files(p, F.when(ok, labels.render(F.col("class_id"), *[F.col(c) for c in XYWH])))


@query(f"WITH {b.ANNOTATIONS} SELECT split, image_id AS stem, string_agg(printf('%d %.6f %.6f %.6f %.6f %.6f', class_id, xc, yc, w, h, round(value / 500.0::DOUBLE, 6)), chr(10) ORDER BY box_id) AS text FROM a GROUP BY split, image_id")
def prediction_files(spark, sf):
    """Label files with the confidence as sixth column."""
    a = b.annotations(spark, sf).withColumnsRenamed({"image_id": "stem", "box_id": "line_no"})
    return sinks.label_files(a, F.col("class_id"), F.round(F.col("value") / 500.0, 6))


@query(f"WITH {b.ANNOTATIONS} SELECT image_id, box_id, {RENDER_SQL.format(c='0')} AS line FROM a WHERE value / 500.0::DOUBLE >= 0.1 AND NOT (w * 640 < 20 OR h * 480 < 20)")
def pseudo_label_lines(spark, sf):
    a = b.annotations(spark, sf).where((F.col("value") / 500.0 >= 0.1) & ~((F.col("w") * 640 < 20) | (F.col("h") * 480 < 20)))
    return a.select("image_id", "box_id", labels.render(F.lit(0), *[F.col(c) for c in XYWH]).alias("line"))


@query(f"WITH {FILES} SELECT dataset || '/' || doc_id || '.jpg' AS path, 'out/images/' || split || '/' || doc_id || '.jpg' AS target, CASE WHEN doc_id % 3 = 0 THEN 'symlink' ELSE 'copy' END AS action FROM f")
def copy_plan(spark, sf):
    name = F.concat(F.col("doc_id"), F.lit(".jpg"))
    f = _files(spark, sf).withColumn("name", name).withColumn("path", F.concat_ws("/", "dataset", "name"))
    return sinks.copy_manifest(f, "out", F.col("doc_id") % 3 == 0)


@query(MERGE + """, k AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY prio, pos) - 1 AS n FROM m)
SELECT printf('img_%08d', n) AS new_filename, CASE prio WHEN 0 THEN 'clean' ELSE 'pseudo' END AS source, doc_id || '.jpg' AS original_image, doc_id || '.txt' AS original_label FROM k WHERE outcome = 'accepted'""")
def lineage_mapping(spark, sf):
    m = splits.ranked_in_buckets(_merged(spark, sf).where("outcome = 'accepted'").withColumn("bucket", F.col("prio") * 2**40 + F.floor(F.col("pos") / 4096)), ["prio", "pos"], "bucket")
    return m.select(F.format_string("img_%08d", F.col("rank") - 1).alias("new_filename"), F.when(F.col("prio") == 0, "clean").otherwise("pseudo").alias("source"), F.concat("doc_id", F.lit(".jpg")).alias("original_image"), F.concat("doc_id", F.lit(".txt")).alias("original_label"))


@query(VOTES + ", r AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY round(votes, 6) DESC, first_seen) AS r FROM v) SELECT track AS Track_ID, text AS Plate, printf('%.2f', round(votes, 2)) AS Score FROM r WHERE r = 1")
def plates_table(spark, sf):
    """The rows of the CSV of final plates."""
    from ..operators import voting

    v = voting.winner(voting.votes(b.reads(spark, sf)))
    return v.select(F.col("track").alias("Track_ID"), F.col("text").alias("Plate"), F.format_string("%.2f", F.round("votes", 2)).alias("Score"))


@query(f"""WITH {FILES}, s AS (SELECT string_agg(split || ': images/' || split, chr(10) ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END) AS t, string_agg('"' || split || '":"images/' || split || '"', ',' ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END) AS j FROM (SELECT DISTINCT split FROM f))
SELECT 'map' AS variant, 'path: data' || chr(10) || t || chr(10) || 'nc: 1' || chr(10) || 'names:' || chr(10) || '  0: plate' || chr(10) AS text FROM s UNION ALL
SELECT 'list', 'path: data' || chr(10) || t || chr(10) || 'nc: 1' || chr(10) || 'names: [plate]' || chr(10) FROM s UNION ALL
SELECT 'json', '{{"path":"data",' || j || ',"nc":1,"names":["plate"]}}' FROM s""")
def dataset_descriptions(spark, sf):
    """The dataset description in three of its forms."""
    return sinks.descriptions(_files(spark, sf), "data", ["plate"])


@query(f"""WITH {b.BOXES}, j AS (SELECT *, {BOX_ISSUES} AS issues FROM b) SELECT box_id, CASE WHEN list_has_any(issues, ['bbox_too_small', 'bbox_too_large']) THEN 'size_issues' ELSE 'aspect_ratio_issues' END AS category,
'{{"box_id":' || box_id || ',"issues":["' || array_to_string(issues, '","') || '"]}}' AS item FROM j WHERE len(issues) > 1""")
def review_items(spark, sf):
    x = b.boxes(spark, sf).withColumn("issues", quality.box_issue_list(g.area(matching.box()), (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))))
    return x.where(F.size("issues") > 1).select("box_id", quality.category(F.col("issues")).alias("category"), F.to_json(F.struct("box_id", "issues")).alias("item"))


@query(f"""WITH {FILES}, {b.BOXES}, c AS (SELECT split, count(*) AS n FROM f GROUP BY split)
SELECT 'split' AS chart, split AS bin, round(n::DOUBLE / sum(n) OVER (), 6) AS value FROM c UNION ALL
SELECT 'length', least(19, length // 500)::VARCHAR, count(*)::DOUBLE FROM f GROUP BY ALL UNION ALL
SELECT 'aspect', least(19, floor({ASPECT} * 2))::INT::VARCHAR, count(*)::DOUBLE FROM b GROUP BY ALL UNION ALL
SELECT 'correlation', 'width/height', round(corr(x2 - x1, y2 - y1), 6) FROM b UNION ALL SELECT 'gauge', 'distinct', round(count(DISTINCT hash)::DOUBLE / count(*), 6) FROM f""")
def chart_tables(spark, sf):
    """What the charts show: chart, bin, value."""
    f, m = _files(spark, sf), _measured(spark, sf)
    row = lambda chart, bin_, value: [F.lit(chart).alias("chart"), bin_.cast("string").alias("bin"), value.cast("double").alias("value")]
    pie = stats.shares(f, "split").select(*row("split", F.col("split"), F.col("share")))
    length = f.groupBy(F.least(F.lit(19), F.floor(F.col("length") / 500)).alias("k")).count().select(*row("length", F.col("k"), F.col("count")))
    aspect = m.groupBy(F.least(F.lit(19), F.floor(F.col("aspect") * 2)).cast("int").alias("k")).count().select(*row("aspect", F.col("k"), F.col("count")))
    heat = m.agg(F.corr("width", "height").alias("r")).select(*row("correlation", F.lit("width/height"), F.round("r", 6)))
    gauge = f.agg((F.countDistinct("hash") / F.count("*")).alias("r")).select(*row("gauge", F.lit("distinct"), F.round("r", 6)))
    return pie.unionByName(length).unionByName(aspect).unionByName(heat).unionByName(gauge)


# filters --------------------------------------------------------------------------------------

CODES = ("corrupted_image", "blurry", "missing_label", "bbox_too_small", "unusual_aspect_ratio", "too_dark", "other")
MADE_SQL = "list_filter([" + ", ".join(f"CASE WHEN (event_id * {p}) % 11 < 2 THEN '{c}' END" for p, c in zip((3, 5, 7, 13, 17, 19, 23), CODES, strict=True)) + "], lambda x: x IS NOT NULL)"


@query(f"""WITH m AS (SELECT event_id, {MADE_SQL} AS l FROM events) SELECT event_id, CASE WHEN list_contains(l, 'corrupted_image') THEN 'corrupted' WHEN list_contains(l, 'blurry') THEN 'blurry' WHEN list_contains(l, 'missing_label') THEN 'mislabeled'
WHEN list_contains(l, 'bbox_too_small') THEN 'size_issues' WHEN list_contains(l, 'unusual_aspect_ratio') THEN 'aspect_ratio_issues' WHEN list_contains(l, 'too_dark') THEN 'poor_quality' ELSE 'invalid_bbox' END AS category FROM m WHERE len(l) > 0""")
def review_categories(spark, sf):
    """Every category, by its place in the order."""
    made = F.array_compact(F.array(*[F.when((F.col("event_id") * p) % 11 < 2, c) for p, c in zip((3, 5, 7, 13, 17, 19, 23), CODES, strict=True)]))
    return b.table(spark, sf, "events").select("event_id", made.alias("l")).where(F.size("l") > 0).select("event_id", quality.category(F.col("l")).alias("category"))


@query(f"WITH {b.ANNOTATIONS} SELECT box_id // 4 AS item, count(*) AS n, bool_and(xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1) AS boxes_ok FROM a GROUP BY 1")
def boxes_all_ok(spark, sf):
    """Whether all boxes of an item are within bounds."""
    a = b.annotations(spark, sf).groupBy(F.floor(F.col("box_id") / 4).alias("item")).agg(F.collect_list(F.struct(*XYWH)).alias("l"))
    return a.select("item", F.size("l").cast("bigint").alias("n"), quality.boxes_ok(F.col("l")).alias("boxes_ok"))


BOX_CORR = ("width", "height", "area", "aspect")


@query(f"WITH {b.BOXES}, v AS (SELECT x2 - x1 AS width, y2 - y1 AS height, {AREA} AS area, {ASPECT} AS aspect FROM b), c AS (" + " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 6) AS r FROM v" for i, x in enumerate(BOX_CORR) for y in BOX_CORR[i + 1 :]) + ") SELECT a, b, r, CASE WHEN abs(r) > 0.7 THEN 'Strong' WHEN abs(r) > 0.5 THEN 'Moderate' ELSE 'Weak' END AS strength FROM c WHERE abs(r) > 0.3")
def box_correlations(spark, sf):
    c = stats.correlations(_measured(spark, sf), list(BOX_CORR))
    return c.where("abs(r) > 0.3").withColumn("strength", stats.strength(F.col("r")))


@query(f"""WITH {b.BOXES}, c AS (SELECT box_id, greatest(0, trunc(x1 - 5)::INT) AS x1, greatest(0, trunc(y1 - 5)::INT) AS y1, least(640, trunc(x2 + 5)::INT) AS x2, least(480, trunc(y2 + 5)::INT) AS y2, CASE WHEN {ASPECT} < 2.0 THEN ['whole', 'square'] ELSE ['whole'] END AS kinds FROM b WHERE y2 - y1 > 20)
SELECT box_id, unnest(kinds) AS kind, x1, y1, x2, y2 FROM c""")
def crop_rows(spark, sf):
    """One row a crop; boxes that are likely square give two."""
    x = b.boxes(spark, sf).where("y2 - y1 > 20")
    crop = g.padded_crop(matching.box(), 5.0, *_size())
    square = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")) < 2.0
    kinds = F.explode(F.array_compact(F.array(F.lit("whole"), F.when(square, "square"))))
    return x.select("box_id", kinds.alias("kind"), *[c.alias(n) for c, n in zip(crop, CORNERS, strict=True)])


@query("SELECT event_id, coalesce(json_extract_string(props, '$.mAP50')::DOUBLE, json_extract_string(props, '$.k')::DOUBLE, value, 0)::DOUBLE AS metric FROM events")
def metric_fallbacks(spark, sf):
    """A metric by the first of its names that the result has, else the attribute, else 0."""
    e = b.table(spark, sf, "events").withColumn("value", F.coalesce("value", F.lit(0.0)))
    found = config.first_of(F.from_json("props", "map<string,string>"), "mAP50", "k", default=None)
    return e.select("event_id", F.coalesce(found, "value").alias("metric"))


@query("SELECT event_id, CASE WHEN event_id % 300 < 64 THEN 3 WHEN event_id % 300 < 128 THEN 2 ELSE 1 END AS scale, (event_id % 300) * CASE WHEN event_id % 300 < 64 THEN 3 WHEN event_id % 300 < 128 THEN 2 ELSE 1 END AS height FROM events")
def ocr_scale(spark, sf):
    h = F.col("event_id") % 300
    k = plates.read_scale(h)
    return b.table(spark, sf, "events").select("event_id", k.alias("scale"), (h * k).alias("height"))


# joins and statistics --------------------------------------------------------------------------

@query(f"WITH {b.MATCH}, x AS (SELECT image_id, gt_idx, max(iou) > 0.5 AS matched FROM p GROUP BY ALL) SELECT image_id, count(*) AS n, round(avg(matched::INT), 6) AS ratio, avg(matched::INT) >= 0.5 AS valid FROM x GROUP BY image_id")
def annotation_validity(spark, sf):
    """Images half of whose annotations a detection confirms."""
    x = matching.best_iou(_pairs(spark, sf))
    r = F.avg(F.col("matched").cast("int"))
    return x.groupBy("image_id").agg(F.count("*").alias("n"), F.round(r, 6).alias("ratio"), (r >= 0.5).alias("valid"))


@query(f"WITH {FILES}, s AS (SELECT split, count(*) AS n, avg(length) AS mean FROM f GROUP BY split) SELECT doc_id, split, n, round(length / mean, 6) AS relative FROM f JOIN s USING (split)")
def rows_with_split_stats(spark, sf):
    f = _files(spark, sf).select("doc_id", "split", "length")
    return f.join(f.groupBy("split").agg(F.count("*").alias("n"), F.avg("length").alias("mean")), "split").select("doc_id", "split", "n", F.round(F.col("length") / F.col("mean"), 6).alias("relative"))


@query(f"""WITH {FILES}, l AS (SELECT doc_id, 1 + doc_id % 3 AS boxes FROM labels), s AS (SELECT split, count(*) AS images, count(l.doc_id) AS labels, count(*) - count(l.doc_id) AS without_labels, coalesce(sum(boxes), 0)::BIGINT AS plates FROM f LEFT JOIN l USING (doc_id) GROUP BY split),
e AS (SELECT split, sum(boxes)::BIGINT AS seen FROM (SELECT split, boxes, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS r FROM f JOIN l USING (doc_id)) WHERE r <= 1000 GROUP BY split)
SELECT split, images, labels, without_labels, plates, round(plates::DOUBLE / images, 6) AS per_image, greatest(coalesce(seen, 0), floor(0.8::DOUBLE * labels))::BIGINT AS estimated FROM s LEFT JOIN e USING (split)""")
def basic_stats(spark, sf):
    """Images, labels and plates of each split, exact, and the estimate from the first 1000 label files."""
    l = b.table(spark, sf, "labels").select("doc_id", (1 + F.col("doc_id") % 3).alias("boxes"))
    f = _files(spark, sf).select("doc_id", "split").join(l, "doc_id", "left")
    n = F.count("boxes")
    s = f.groupBy("split").agg(F.count("*").alias("images"), n.alias("labels"), (F.count("*") - n).alias("without_labels"), F.coalesce(F.sum("boxes"), F.lit(0)).alias("plates"))
    seen = splits.first_of_each(f.where("boxes IS NOT NULL"), ["split"], ["doc_id"], 1000).groupBy("split").agg(F.sum("boxes").alias("seen"))
    estimate = F.greatest(F.coalesce("seen", F.lit(0).cast("bigint")), F.floor(F.col("labels") * 0.8))
    return s.join(seen, "split", "left").select("split", "images", "labels", "without_labels", "plates", F.round(F.col("plates") / F.col("images"), 6).alias("per_image"), estimate.alias("estimated"))


FIXED_SQL = f"""WITH {b.ANNOTATIONS}, x AS (SELECT image_id, split, CASE WHEN xc - w / 2 < -1e-9 OR yc - h / 2 < -1e-9 OR xc + w / 2 > 1 + 1e-9 OR yc + h / 2 > 1 + 1e-9 THEN 'bbox_clipped' END AS c, CASE WHEN class_id <> 0 THEN 'class_reset' END AS k FROM a WHERE image_id % 31 <> 0),
i AS (SELECT split, unnest([c, k]) AS issue FROM x)"""


@query(FIXED_SQL + " SELECT split, issue, count(*) AS n FROM i WHERE issue IS NOT NULL GROUP BY ALL")
def fixed_issue_histogram(spark, sf):
    """What was mended in the images that are kept."""
    a = b.annotations(spark, sf).where("image_id % 31 <> 0")
    one = F.lit(1.0)
    corners = tuple(F.col(c) + s * F.col(z) / 2 for c, z, s in (("xc", "w", -1), ("yc", "h", -1), ("xc", "w", 1), ("yc", "h", 1)))
    issues = F.array_compact(F.array(F.when(g.crossing(corners, one, one), "bbox_clipped"), F.when(F.col("class_id") != 0, "class_reset")))
    return a.select("split", F.explode(issues).alias("issue")).groupBy("split", "issue").agg(F.count("*").alias("n"))


@query("SELECT event_type AS pipeline, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(min(value), 6) AS min, round(max(value), 6) AS max FROM events WHERE value > 10 GROUP BY event_type")
def augment_quality_stats(spark, sf):
    """Quality of the augmentations that passed the gate."""
    v = F.col("value")
    e = b.table(spark, sf, "events").where(v > 10).groupBy(F.col("event_type").alias("pipeline"))
    return shown(e.agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")))


@query("SELECT n_name AS split, round(avg(c_acctbal), 6) AS mean_blur, round(stddev_pop(c_acctbal), 6) AS std_blur, round(avg(c_custkey % 640), 6) AS mean_width, round(avg(c_custkey % 480), 6) AS mean_height, avg(c_acctbal) < 4500 AS blurry FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def sample_image_stats(spark, sf):
    c = b.table(spark, sf, "customer").join(b.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    v, k = F.col("c_acctbal"), F.col("c_custkey")
    return shown(c.groupBy(F.col("n_name").alias("split")).agg(F.avg(v).alias("mean_blur"), F.stddev_pop(v).alias("std_blur"), F.avg(k % 640).alias("mean_width"), F.avg(k % 480).alias("mean_height"), (F.avg(v) < 4500).alias("blurry")))


@query(f"""WITH {b.ANNOTATIONS}, k AS (SELECT *, value / 500.0::DOUBLE AS conf, w * 640 < 20 OR h * 480 < 20 AS small FROM a)
SELECT count(DISTINCT image_id) AS processed, count(DISTINCT CASE WHEN conf >= 0.1 AND NOT small THEN image_id END) AS labeled, count(*) FILTER (conf >= 0.1 AND NOT small) AS total_boxes, count(*) FILTER (conf >= 0.1 AND small) AS skipped_small, round(coalesce(sum(conf) FILTER (conf >= 0.1 AND NOT small), 0) / greatest(1, count(*) FILTER (conf >= 0.1 AND NOT small)), 6) AS mean_conf FROM k""")
def pseudo_summary(spark, sf):
    a = b.annotations(spark, sf)
    conf, small = F.col("value") / 500.0, (F.col("w") * 640 < 20) | (F.col("h") * 480 < 20)
    good = (conf >= 0.1) & ~small
    return a.agg(F.countDistinct("image_id").alias("processed"), F.countDistinct(F.when(good, F.col("image_id"))).alias("labeled"), F.count_if(good).alias("total_boxes"), F.count_if((conf >= 0.1) & small).alias("skipped_small"), F.round(F.coalesce(F.sum(F.when(good, conf)), F.lit(0.0)) / F.greatest(F.lit(1).cast("bigint"), F.count_if(good)), 6).alias("mean_conf"))


@query("""WITH s AS (SELECT l_shipmode AS arm, count(*) AS runs, avg(l_extendedprice) AS ms, stddev_pop(l_extendedprice) AS std, avg(l_quantity) AS detections FROM (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'ensemble' ELSE 'tta' END AS l_shipmode FROM lineitem) GROUP BY 1)
SELECT arm, runs, round(ms, 4) AS mean_ms, round(std, 4) AS std_ms, round(detections, 6) AS detections, round((SELECT ms FROM s WHERE arm = 'single') / ms, 6) AS speedup FROM s""")
def ensemble_bench(spark, sf):
    k = F.col("l_linenumber") % 3
    s = b.table(spark, sf, "lineitem").groupBy(F.when(k == 0, "single").when(k == 1, "ensemble").otherwise("tta").alias("arm")).agg(F.count("*").alias("runs"), F.avg("l_extendedprice").alias("ms"), F.stddev_pop("l_extendedprice").alias("std"), F.avg("l_quantity").alias("detections"))
    base = F.max(F.when(F.col("arm") == "single", F.col("ms"))).over(W.partitionBy(F.lit(0)))  # three rows
    return s.select("arm", "runs", F.round("ms", 4).alias("mean_ms"), F.round("std", 4).alias("std_ms"), F.round("detections", 6).alias("detections"), F.round(base / F.col("ms"), 6).alias("speedup"))


@query("""SELECT o_custkey AS study, count(*) AS trials, first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS best_trial, first(o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS best_params,
array_to_string(list(round(o_totalprice, 2)::VARCHAR ORDER BY o_orderkey), ',') AS convergence, round(max(0.5 * (o_totalprice / 1000) + 0.3 * (o_totalprice / 2000) + 0.1 * (o_orderkey % 10 / 10.0) + 0.1 * (o_orderkey % 7 / 7.0)), 9) AS fitness FROM orders GROUP BY o_custkey""")
def study_best(spark, sf):
    """Best trial, its parameters, the scores in order, and the best weighted fitness of each study."""
    p, k = F.col("o_totalprice"), F.col("o_orderkey")
    best = F.struct(-p, k)
    scores = F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), F.round(p, 2).alias("p")))), lambda x: x["p"].cast("string"))
    fitness = 0.5 * (p / 1000) + 0.3 * (p / 2000) + 0.1 * (k % 10 / 10.0) + 0.1 * (k % 7 / 7.0)
    return b.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("study")).agg(F.count("*").alias("trials"), F.min_by(k, best).alias("best_trial"), F.min_by("o_orderpriority", best).alias("best_params"), F.array_join(scores, ",").alias("convergence"), F.round(F.max(fitness), 9).alias("fitness"))


@query("SELECT count(DISTINCT regexp_replace('scene' || conv_id || '_aug_' || turn, '_aug(_\\d+)?$', '')) AS scenes, count(*) AS files FROM conversations")
def scene_count(spark, sf):
    c = b.table(spark, sf, "conversations").select(splits.base_scene(F.concat(F.lit("scene"), F.col("conv_id"), F.lit("_aug_"), F.col("turn"))).alias("scene"))
    return c.agg(F.countDistinct("scene").alias("scenes"), F.count("*").alias("files"))


STYLE_SQL = f"CASE {H.format('event_id')} % 4 WHEN 0 THEN 'white' WHEN 1 THEN 'yellow' WHEN 2 THEN 'blue' ELSE 'red' END"
PLATE_BOX_SQL = f"""WITH r AS (SELECT event_id, {STYLE_SQL} AS style, ('0x' || substr(md5('x' || event_id), 1, 8))::BIGINT % 401 AS x, ('0x' || substr(md5('y' || event_id), 1, 8))::BIGINT % 151 AS y,
('0x' || substr(md5('noise' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.3 AS noise, ('0x' || substr(md5('blur' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.2 AS blur FROM events)"""


def _rendered(spark, sf) -> DataFrame:
    """Made plates of 400 x 150 on a background of 800 x 300: style, place, effects."""
    i = F.col("event_id")
    k = hash32(i) % 4
    style = F.when(k == 0, "white").when(k == 1, "yellow").when(k == 2, "blue").otherwise("red")
    return b.table(spark, sf, "events").select("event_id", style.alias("style"), (hash32(i, "x") % 401).alias("x"), (hash32(i, "y") % 151).alias("y"), (uniform(i, "noise") < 0.3).alias("noise"), (uniform(i, "blur") < 0.2).alias("blur"))


@query(PLATE_BOX_SQL + " SELECT event_id, style, noise, blur, printf('0 %.6f %.6f %.6f %.6f', round((x + 200) / 800.0::DOUBLE, 6), round((y + 75) / 300.0::DOUBLE, 6), 0.5::DOUBLE, 0.5::DOUBLE) AS label FROM r")
def rendered_plate_boxes(spark, sf):
    """The metadata and labels of rendered plates."""
    r = _rendered(spark, sf)
    half = F.lit(0.5)
    return r.select("event_id", "style", "noise", "blur", labels.render(F.lit(0), F.round((F.col("x") + 200) / 800.0, 6), F.round((F.col("y") + 75) / 300.0, 6), half, half).alias("label"))


@query(PLATE_BOX_SQL + " SELECT style, count(*) AS total, count(*) FILTER (noise) AS noisy, count(*) FILTER (blur) AS blurred FROM r GROUP BY style")
def generation_report(spark, sf):
    return _rendered(spark, sf).groupBy("style").agg(F.count("*").alias("total"), F.count_if("noise").alias("noisy"), F.count_if("blur").alias("blurred"))


# orders, limits, unions -------------------------------------------------------------------------

@query(f"WITH m AS (SELECT event_id, unnest({MADE_SQL}) AS issue FROM events), c AS (SELECT issue, count(*) AS n, min(event_id) AS first_seen FROM m GROUP BY issue) SELECT issue, n, row_number() OVER (ORDER BY n DESC, first_seen, issue) AS place FROM c")
def issues_in_order(spark, sf):
    """Issues by falling count, then by where they are seen first."""
    made = F.array_compact(F.array(*[F.when((F.col("event_id") * p) % 11 < 2, c) for p, c in zip((3, 5, 7, 13, 17, 19, 23), CODES, strict=True)]))
    c = b.table(spark, sf, "events").select("event_id", F.explode(made).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"), F.min("event_id").alias("first_seen"))
    return c.select("issue", "n", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("n"), "first_seen", "issue")).cast("bigint").alias("place"))  # a row a code


@query(f"WITH {FILES}, r AS (SELECT dataset, doc_id, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS r FROM f) SELECT dataset, string_agg(doc_id || '.jpg', ', ' ORDER BY doc_id) AS names FROM r WHERE r <= 3 GROUP BY dataset")
def head_names(spark, sf):
    """The first three names of each dataset, for a report."""
    f = splits.first_of_each(_files(spark, sf).select("dataset", "doc_id"), ["dataset"], ["doc_id"], 3)
    return f.groupBy("dataset").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: F.concat(x.cast("string"), F.lit(".jpg"))), ", ").alias("names"))


@query(f"WITH {FILES} SELECT doc_id FROM f WHERE split = 'val' ORDER BY doc_id LIMIT 100")
def bench_subset(spark, sf):
    """The first images of a benchmark: as many as its steps, one at least."""
    return _files(spark, sf).where("split = 'val'").select("doc_id").orderBy("doc_id").limit(max(1, 100))


@query(f"""WITH {FILES}, e AS (SELECT hash, min(doc_id) AS head FROM f GROUP BY hash HAVING count(*) > 1), n AS (SELECT substr(hash, 1, 3) AS k, min(doc_id) AS head FROM f GROUP BY 1 HAVING count(DISTINCT hash) > 1)
SELECT 'exact' AS kind, e.head, doc_id AS member FROM f JOIN e USING (hash) WHERE doc_id <> e.head UNION ALL SELECT 'near', n.head, doc_id FROM f JOIN n ON substr(hash, 1, 3) = k WHERE doc_id <> n.head""")
def duplicate_groups(spark, sf):
    """Members of exact and of near groups (here: of equal first digits), one list."""
    f = _files(spark, sf).select("doc_id", "hash")

    def groups(kind: str, key, several) -> DataFrame:
        heads = f.groupBy(key.alias("k")).agg(F.min("doc_id").alias("head"), several.alias("several")).where("several > 1")
        return f.withColumn("k", key).join(heads, "k").where("doc_id <> head").select(F.lit(kind).alias("kind"), "head", F.col("doc_id").alias("member"))

    return groups("exact", F.col("hash"), F.count("*")).unionByName(groups("near", F.substring("hash", 1, 3), F.countDistinct("hash")))


@query(f"WITH {FILES} SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN 'pseudo' ELSE 'clean' END AS source, CASE WHEN doc_id % 2 = 1 THEN 'train' ELSE split END AS split FROM f")
def pseudo_to_train(spark, sf):
    """Clean rows keep their split, pseudo-labelled ones go to train only."""
    f = _files(spark, sf).select("doc_id", "split")
    clean = f.where("doc_id % 2 = 0").select("doc_id", F.lit("clean").alias("source"), "split")
    return clean.unionByName(f.where("doc_id % 2 = 1").select("doc_id", F.lit("pseudo").alias("source"), F.lit("train").alias("split")))


# samples ----------------------------------------------------------------------------------------

@query(f"WITH {FILES}, r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY ('0x' || substr(md5('again' || doc_id), 1, 8))::BIGINT, doc_id) AS r FROM f) SELECT doc_id, split FROM r WHERE r <= 15")
def salted_sample(spark, sf):
    """Another sample of each split, by another salt."""
    return splits.sample(_files(spark, sf), "doc_id", ["split"], k=15, salt="again").select("doc_id", "split")


@query(f"""WITH {FILES}, s AS (SELECT split, count(*) AS n, floor(count(*) * 1.5::DOUBLE)::BIGINT - count(*) AS wanted FROM f GROUP BY split)
SELECT split, n, wanted, 3 * wanted AS most_attempts, CASE WHEN n > 0 THEN (wanted + n - 1) // n ELSE 0 END AS rounds FROM s""")
def augment_targets(spark, sf):
    """How many rows an augmentation adds to reach its multiple, and its budget of tries."""
    return splits.targets(_files(spark, sf), ["split"], 1.5, 3)


@query(f"WITH {FILES} SELECT doc_id, {H.format('doc_id')} % 5 AS fold FROM f")
def k_folds(spark, sf):
    """Folds by hash, the same whatever else is in the table."""
    return _files(spark, sf).select("doc_id", (hash32(F.col("doc_id")) % 5).alias("fold"))


@query(f"""WITH {b.ANNOTATIONS}, c AS (SELECT image_id, box_id, class_id FROM a WHERE class_id IN (0, 2)) SELECT image_id, count(*) AS n, count(*) FILTER (class_id = 0) AS first_class FROM c GROUP BY image_id""")
def class_filter(spark, sf):
    a = b.annotations(spark, sf).where(F.col("class_id").isin(0, 2))
    return a.groupBy("image_id").agg(F.count("*").alias("n"), F.count_if(F.col("class_id") == 0).alias("first_class"))


@query(f"""WITH {b.PLATES} SELECT event_id, CASE WHEN regexp_full_match(text, '[0-9]{{2}}[A-Z][0-9]{{4,5}}') THEN 'car' WHEN regexp_full_match(text, '[0-9]{{2}}[A-Z][A-Z0-9][0-9]{{4,5}}') THEN 'bike' WHEN regexp_full_match(text, '[0-9]{{2}}[A-Z]{{2}}[0-9]{{3,5}}') THEN 'special' ELSE 'none' END AS format FROM p""")
def plate_formats(spark, sf):
    return b.plates(spark, sf).select("event_id", plates.format_of(F.col("text")).alias("format"))


# boxes ------------------------------------------------------------------------------------------

@query(f"WITH {b.ANNOTATIONS} SELECT box_id, round(greatest(0, least(1, xc * 1.2 - 0.1)), 9) AS xc, round(greatest(0, least(1, yc * 1.2 - 0.1)), 9) AS yc, round(greatest(0.000001, least(1, w * 1.2 - 0.1)), 9) AS w, round(greatest(0.000001, least(1, h * 1.2 - 0.1)), 9) AS h FROM a")
def normalised_clip(spark, sf):
    """Normalised boxes, out of bounds by an augmentation, clipped; sizes stay positive."""
    moved = [F.col(c) * 1.2 - 0.1 for c in XYWH]
    return shown(b.annotations(spark, sf).select("box_id", *[v.alias(c) for v, c in zip(g.clip_unit(*moved), XYWH, strict=True)]), 9)


@query("""WITH f AS (SELECT event_id, (event_id * 7919) % 300 + 1 AS x1, (event_id * 6101) % 200 + 2 AS y1, (event_id * 7919) % 300 + 41 AS x2, (event_id * 6101) % 200 + 23 AS y2 FROM events)
SELECT event_id, ['flip_h', 'flip_v', 'rotate_90', 'rotate_180', 'rotate_270'][event_id % 5 + 1] AS view,
CASE event_id % 5 WHEN 0 THEN 640 - x2 WHEN 1 THEN x1 WHEN 2 THEN y1 WHEN 3 THEN 640 - x2 ELSE 640 - y2 END::DOUBLE AS x1, CASE event_id % 5 WHEN 0 THEN y1 WHEN 1 THEN 480 - y2 WHEN 2 THEN 480 - x2 WHEN 3 THEN 480 - y2 ELSE x1 END::DOUBLE AS y1,
CASE event_id % 5 WHEN 0 THEN 640 - x1 WHEN 1 THEN x2 WHEN 2 THEN y2 WHEN 3 THEN 640 - x1 ELSE 640 - y1 END::DOUBLE AS x2, CASE event_id % 5 WHEN 0 THEN y2 WHEN 1 THEN 480 - y1 WHEN 2 THEN 480 - x1 WHEN 3 THEN 480 - y1 ELSE x2 END::DOUBLE AS y2 FROM f""")
def view_boxes(spark, sf):
    """Fixed boxes of views, in the image."""
    i = F.col("event_id")
    view = F.element_at(F.array(*[F.lit(v) for v in ("flip_h", "flip_v", "rotate_90", "rotate_180", "rotate_270")]), (i % 5 + 1).cast("int"))
    x, y = (i * 7919) % 300, (i * 6101) % 200
    box = tuple(v.cast("double") for v in (x + 1, y + 2, x + 41, y + 23))
    return b.table(spark, sf, "events").select("event_id", view.alias("view"), g.view_inverse(view, box, *_size()).alias("r")).select("event_id", "view", "r.*")


MOVE_SQL = "x1 * 1.2::DOUBLE - 80 AS a1, y1 * 1.2::DOUBLE - 60 AS b1, x2 * 1.2::DOUBLE - 80 AS a2, y2 * 1.2::DOUBLE - 60 AS b2"


@query(f"""WITH {b.BOXES}, m AS (SELECT box_id, {MOVE_SQL} FROM b), c AS (SELECT box_id, greatest(0.0::DOUBLE, a1) AS x1, greatest(0.0::DOUBLE, b1) AS y1, least(640.0::DOUBLE, a2) AS x2, least(480.0::DOUBLE, b2) AS y2, (a2 - a1) * (b2 - b1) AS whole FROM m),
v AS (SELECT *, greatest(0.0::DOUBLE, x2 - x1) * greatest(0.0::DOUBLE, y2 - y1) / whole AS visible FROM c) SELECT box_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2, round(visible, 6) AS visible FROM v WHERE visible >= CASE WHEN box_id % 10 = 0 THEN 0.2 ELSE 0.25 END""")
def visible_boxes(spark, sf):
    """Boxes after scaling by 1.2 about the centre, clipped; those too little of which is left go."""
    moved = g.affine(matching.box(), 1.2, -80.0, -60.0)
    x = b.boxes(spark, sf).select("box_id", g.visible(moved, *_size()).alias("v")).select("box_id", "v.*")
    return shown(x.where(F.col("visible") >= F.when(F.col("box_id") % 10 == 0, 0.2).otherwise(0.25)))


@query("SELECT event_id, md5(event_type) AS hash, 'md5' AS method FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, substr(md5(strlen(event_type)::VARCHAR || event_type), 1, 16), 'fallback' FROM events WHERE event_id % 2 = 1")
def hash_methods(spark, sf):
    """Hashes by the method that is asked for."""
    e = b.table(spark, sf, "events")
    parts = [e.where(F.col("event_id") % 2 == k).select("event_id", hashing.by_method(m)(F.col("event_type")).alias("hash"), F.lit(m).alias("method")) for k, m in enumerate(("md5", "fallback"))]
    return parts[0].unionByName(parts[1])


QUOTA = splits.bin_quotas(200)


@query(f"""WITH {b.BOXES}, ar AS (SELECT box_id, (x2 - x1) / (y2 - y1) AS r, value FROM b), n AS (SELECT * EXCLUDE (r), CASE {' '.join(f"WHEN r >= {low} AND r < {high} THEN '{name}'" for name, (low, high, _) in splits.BINS.items())} END AS bin FROM ar),
k AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY round(-ln(({H.format("'bins' || box_id")} + 1) / 4294967297.0::DOUBLE) / value, 9), box_id) AS r FROM n WHERE value > 0)
SELECT bin, box_id, round(value, 6) AS weight FROM k JOIN (VALUES {', '.join(f"('{name}', {q})" for name, q in QUOTA.items())}) q(bin, quota) USING (bin) WHERE k.r <= quota""")
def weighted_bins(spark, sf):
    """200 boxes over the bins of aspect ratio by the bins' weights, in each by the boxes' confidence."""
    x = b.boxes(spark, sf).select("box_id", F.col("value").alias("weight"), splits.aspect_bin((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("bin"))
    return shown(splits.weighted_sample(x, "box_id", "weight", QUOTA, salt="bins").select("bin", "box_id", "weight"))
