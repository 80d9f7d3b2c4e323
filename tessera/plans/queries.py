"""Every operator as a query on the driver's tables, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import hashing
from ..operators import matching, merging, quality, splits, stats
from ..sources import images, json_labels, labels
from . import bindings as b

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def run_each(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame | dict[str, str]]:
    """Builds queries by name; one that fails gives its error and leaves the others alone."""
    out: dict[str, DataFrame | dict[str, str]] = {}
    for name in names:
        try:
            out[name] = QUERIES[name](spark, sf_dir)
        except Exception as e:  # noqa: BLE001  whatever a module raises is its result
            out[name] = {"error": f"{type(e).__name__}: {e}"}
    return out


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that engines agree."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


H = "('0x' || substr(md5({}::VARCHAR), 1, 8))::BIGINT"


def _size():
    return F.lit(float(b.WIDTH)), F.lit(float(b.HEIGHT))


XYWH = ("xc", "yc", "w", "h")
CORNERS = ("x1", "y1", "x2", "y2")


# files ---------------------------------------------------------------------------------------

FILES = "f AS (SELECT doc_id, source AS dataset, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END AS split, n_chars AS length, md5(text) AS hash FROM documents)"


def _files(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    return b.table(spark, sf, "documents").select("doc_id", F.col("source").alias("dataset"), F.when(i % 10 < 7, "train").when(i % 10 < 9, "val").otherwise("test").alias("split"), F.col("n_chars").alias("length"), hashing.content_hash(F.col("text")).alias("hash"), "text")


@query("""
WITH f AS (SELECT source AS dataset, CASE WHEN doc_id % 10 < 7 THEN 'train' ELSE 'val' END AS split, doc_id, n_chars AS length,
  CASE doc_id % 6 WHEN 0 THEN 'JPG' WHEN 1 THEN 'png' WHEN 2 THEN 'txt' WHEN 3 THEN 'jfif' WHEN 4 THEN 'webp' ELSE 'jpeg' END AS e FROM documents)
SELECT 'raw/' || dataset || '/' || split || '/img' || doc_id || '.' || e AS path, dataset, split, 'img' || doc_id || '.' || e AS name, 'img' || doc_id AS stem, lower(e) AS ext, length FROM f WHERE e <> 'txt' AND doc_id % 50 <> 0""")
def manifest_scan(spark, sf):
    i = F.col("doc_id")
    e = F.element_at(F.array(*[F.lit(x) for x in ("JPG", "png", "txt", "jfif", "webp", "jpeg")]), (i % 6 + 1).cast("int"))
    folder = F.when(i % 100 == 50, "__MACOSX").otherwise(F.col("source"))
    name = F.concat(F.when(i % 100 == 0, "ReadMe").otherwise("img"), i.cast("string"), F.lit("."), e)
    listing = b.table(spark, sf, "documents").select(F.concat_ws("/", F.lit("raw"), folder, F.when(i % 10 < 7, "train").otherwise("val"), name).alias("path"), F.col("n_chars").alias("length"))
    return images.manifest(listing, "raw")


@query(f"WITH {FILES} SELECT split, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM f GROUP BY split")
def split_counts(spark, sf):
    return stats.shares(_files(spark, sf), "split")


@query(f"WITH {FILES} SELECT doc_id, CASE WHEN length < 1024 THEN 'too_small' WHEN length > 20000 THEN 'too_large' ELSE 'ok' END AS size_check, CASE WHEN (SELECT count(*) FROM f) < 1000 THEN 'critical' WHEN (SELECT count(*) FROM f) < 3000 THEN 'low' ELSE 'good' END AS tier FROM f")
def file_predicates(spark, sf):
    f = _files(spark, sf)
    f = f.withColumn("one", F.lit(1)).join(f.agg(F.count("*").alias("n")).withColumn("one", F.lit(1)), "one")  # one row
    n = F.col("n")
    return f.select("doc_id", F.when(F.col("length") < 1024, "too_small").when(F.col("length") > 20000, "too_large").otherwise("ok").alias("size_check"), F.when(n < 1000, "critical").when(n < 3000, "low").otherwise("good").alias("tier"))


@query(f"WITH {FILES} SELECT dataset, count(*) AS n, count(DISTINCT hash) AS n_distinct, round(sum(length) / 1048576.0::DOUBLE, 1) AS mb, grouping(dataset)::INT AS is_total FROM f GROUP BY ROLLUP (dataset)")
def dataset_summary_rollup(spark, sf):
    return _files(spark, sf).rollup("dataset").agg(F.count("*").alias("n"), F.countDistinct("hash").alias("n_distinct"), F.round(F.sum("length") / 1048576.0, 1).alias("mb"), F.grouping("dataset").cast("int").alias("is_total"))


@query(f"WITH {FILES} SELECT hash, count(*) AS n, min(doc_id) AS first FROM f GROUP BY hash HAVING count(*) > 1")
def exact_dupes(spark, sf):
    return merging.exact_groups(_files(spark, sf), "hash", "doc_id")


@query()
def fallback_hashes(spark, sf):
    return _files(spark, sf).select("doc_id", hashing.fallback_hash(F.col("text")).alias("hash"))


@query(f"WITH {FILES} SELECT doc_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) - 1 AS counter, printf('%s_%08d', split, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) - 1) AS name FROM f")
def per_dataset_counter(spark, sf):
    n = splits.ranked_in_buckets(_files(spark, sf).withColumn("bucket", F.floor(F.col("doc_id") / 4096)), ["doc_id"], "bucket", ["dataset"]).withColumn("counter", F.col("rank") - 1)
    return n.select("doc_id", "dataset", "counter", F.format_string("%s_%08d", F.col("split"), F.col("counter")).alias("name"))


@query(f"WITH {FILES} SELECT doc_id, split FROM (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS r FROM f) WHERE r <= 66")
def first_n_per_split(spark, sf):
    return splits.first_of_each(_files(spark, sf).select("doc_id", "split"), ["split"], ["doc_id"], 66)


@query(f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {H.format('doc_id')}, doc_id) AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN r <= floor(n * 0.7::DOUBLE) THEN 'train' WHEN r <= floor(n * (0.7::DOUBLE + 0.2::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM r""")
def ordered_split(spark, sf):
    return splits.split_by_rank(b.table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(f"WITH r AS (SELECT doc_id, {H.format('doc_id')} / 4294967296.0::DOUBLE AS u FROM documents) SELECT doc_id, CASE WHEN u < 0.7::DOUBLE THEN 'train' WHEN u < 0.7::DOUBLE + 0.2::DOUBLE THEN 'val' ELSE 'test' END AS split FROM r")
def hashed_split(spark, sf):
    return splits.split_by_hash(b.table(spark, sf, "documents").select("doc_id"), F.col("doc_id"))


@query(f"WITH {FILES}, r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY {H.format('doc_id')}, doc_id) AS r FROM f) SELECT doc_id, split FROM r WHERE r <= 20")
def sample_k_per_split(spark, sf):
    return splits.sample(_files(spark, sf), "doc_id", ["split"], k=20).select("doc_id", "split")


@query(f"WITH {FILES}, r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY {H.format('doc_id')}, doc_id) AS r, count(*) OVER (PARTITION BY split) AS n FROM f) SELECT doc_id, split FROM r WHERE r <= floor(n * CASE WHEN split = 'train' THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END)")
def sample_ratio_per_split(spark, sf):
    return splits.sample(_files(spark, sf), "doc_id", ["split"], ratio=F.when(F.col("split") == "train", F.lit(0.2)).otherwise(F.lit(0.1))).select("doc_id", "split")


@query(f"""WITH c AS (SELECT DISTINCT conv_id FROM conversations), r AS (SELECT conv_id, row_number() OVER (ORDER BY {H.format('conv_id')}, conv_id) AS r, count(*) OVER () AS n FROM c)
SELECT conv_id, turn, regexp_replace('scene' || conv_id || '_aug_' || turn, '_aug(_\\d+)?$', '') AS scene, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM conversations JOIN r USING (conv_id)""")
def scene_split(spark, sf):
    c = b.table(spark, sf, "conversations").select("conv_id", "turn", splits.base_scene(F.concat(F.lit("scene"), F.col("conv_id"), F.lit("_aug_"), F.col("turn"))).alias("scene"))
    return splits.split_groups(c, "conv_id").select("conv_id", "turn", "scene", "split")


@query(f"""WITH {FILES}, r AS (SELECT doc_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY dataset) AS n FROM f)
SELECT dataset, unnest(range(pos, 100, n)) AS attempt, doc_id FROM r WHERE pos < 100""")
def round_robin_plan(spark, sf):
    return splits.round_robin(_files(spark, sf).select("dataset", "doc_id"), "doc_id", 100, ["dataset"]).select("dataset", F.col("attempt").cast("bigint").alias("attempt"), "doc_id")


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.doc_id IS NOT NULL AS has_image, l.doc_id IS NOT NULL AS has_label FROM (SELECT doc_id FROM documents) d FULL JOIN (SELECT doc_id + 7 AS doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def image_label_join(spark, sf):
    return merging.correspondence(b.table(spark, sf, "documents"), b.table(spark, sf, "labels").select((F.col("doc_id") + 7).alias("doc_id")), ["doc_id"])


@query("SELECT d.doc_id, l.quality, CASE WHEN l.doc_id IS NULL THEN 'no_label' WHEN l.quality = 0 THEN 'failed' ELSE 'valid' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
def image_label_left(spark, sf):
    j = b.table(spark, sf, "documents").select("doc_id").join(b.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.withColumn("reason", F.when(F.col("quality").isNull(), "no_label").when(F.col("quality") == 0, "failed").otherwise("valid"))


@query("SELECT CASE WHEN l.doc_id IS NULL THEN 'no_label' WHEN l.quality = 0 THEN 'failed' ELSE 'valid' END AS reason, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def rejection_counts(spark, sf):
    return image_label_left(spark, sf).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT doc_id, source FROM documents), c AS (SELECT doc_id, 0 AS rank, 'json' AS kind FROM labels WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 1, 'txt' FROM labels)
SELECT doc_id, source, rank, kind FROM w LEFT JOIN (SELECT doc_id, min(rank) AS rank, first(kind ORDER BY rank) AS kind FROM c GROUP BY doc_id) USING (doc_id)""")
def label_candidates(spark, sf):
    l = b.table(spark, sf, "labels").select("doc_id")
    c = l.where("doc_id % 3 = 0").select("doc_id", F.lit(0).alias("rank"), F.lit("json").alias("kind")).unionByName(l.select("doc_id", F.lit(1).alias("rank"), F.lit("txt").alias("kind")))
    return merging.first_candidate(b.table(spark, sf, "documents").select("doc_id", "source"), c, "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark, sf):
    return merging.not_done(b.table(spark, sf, "documents").select("doc_id"), b.table(spark, sf, "labels"), "doc_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def stem_difference(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id").exceptAll(b.table(spark, sf, "labels").select("doc_id")).distinct()


@query("""WITH f AS (SELECT substr(md5(text), 1, 3) AS name, CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END AS split FROM documents)
SELECT name, count(*) AS n, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM f GROUP BY name HAVING count(*) > 1""")
def split_leakage(spark, sf):
    return stats.leaks(_files(spark, sf).select(F.substring("hash", 1, 3).alias("name"), "split"))


MERGE = """WITH r AS (SELECT d.doc_id, d.doc_id % 2 AS prio, d.doc_id AS pos, md5(text) AS key, l.doc_id IS NOT NULL AS valid FROM documents d LEFT JOIN labels l USING (doc_id)),
o AS (SELECT *, min(CASE WHEN valid THEN prio * 1000000000 + pos END) OVER (PARTITION BY key) AS p FROM r),
m AS (SELECT *, CASE WHEN p IS NOT NULL AND prio * 1000000000 + pos > p THEN 'duplicate' WHEN NOT valid THEN 'invalid' ELSE 'accepted' END AS outcome FROM o)"""


def _merged(spark, sf):
    d = b.table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 2).alias("prio"), F.col("doc_id").alias("pos"), F.md5("text").alias("key"))
    l = b.table(spark, sf, "labels").select("doc_id", F.lit(True).alias("valid"))
    return merging.merge_with_precedence(d.join(l, "doc_id", "left").withColumn("valid", F.coalesce("valid", F.lit(False))))


@query(MERGE + " SELECT doc_id, outcome, CASE WHEN outcome = 'accepted' THEN printf('img_%08d', row_number() OVER (PARTITION BY outcome ORDER BY prio, pos) - 1) END AS name FROM m")
def merge_clean_pseudo(spark, sf):
    m = _merged(spark, sf).withColumn("bucket", F.col("prio") * 2**40 + F.floor(F.col("pos") / 4096))
    m = splits.ranked_in_buckets(m, ["prio", "pos"], "bucket", ["outcome"])
    return m.select("doc_id", "outcome", F.when(F.col("outcome") == "accepted", F.format_string("img_%08d", F.col("rank") - 1)).alias("name"))


@query(MERGE + " SELECT count(*) FILTER (outcome = 'accepted' AND prio = 0) AS clean_added, count(*) FILTER (outcome = 'accepted' AND prio = 1) AS pseudo_added, count(*) FILTER (outcome = 'duplicate') AS duplicates_skipped, count(*) FILTER (outcome = 'invalid') AS invalid_labels, count(*) FILTER (outcome = 'accepted') AS total FROM m")
def merge_summary(spark, sf):
    o, p = F.col("outcome"), F.col("prio")
    return _merged(spark, sf).agg(F.count_if((o == "accepted") & (p == 0)).alias("clean_added"), F.count_if((o == "accepted") & (p == 1)).alias("pseudo_added"), F.count_if(o == "duplicate").alias("duplicates_skipped"), F.count_if(o == "invalid").alias("invalid_labels"), F.count_if(o == "accepted").alias("total"))


@query(f"WITH {FILES} SELECT split, count(*) FILTER (doc_id % 4 <> 0) AS augmented, count(*) FILTER (doc_id % 4 = 0) AS synthetic, round(count(*) FILTER (doc_id % 4 = 0)::DOUBLE / count(*), 6) AS synthetic_share FROM f GROUP BY ROLLUP (split)")
def merge_stats(spark, sf):
    f = _files(spark, sf)
    both = f.where("doc_id % 4 <> 0").withColumn("origin", F.lit("augmented")).unionByName(f.where("doc_id % 4 = 0").withColumn("origin", F.lit("synthetic")))
    return both.rollup("split").agg(F.count_if(F.col("origin") == "augmented").alias("augmented"), F.count_if(F.col("origin") == "synthetic").alias("synthetic"), F.round(F.count_if(F.col("origin") == "synthetic") / F.count("*"), 6).alias("synthetic_share"))


@query("SELECT kind, split FROM (VALUES ('images', 'train'), ('images', 'val'), ('images', 'test'), ('labels', 'train'), ('labels', 'val'), ('labels', 'test')) r(kind, split) WHERE (kind, split) NOT IN (SELECT DISTINCT 'images', CASE WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'val' ELSE 'test' END FROM documents)")
def required_folders(spark, sf):
    wanted = spark.createDataFrame([(k, s) for k in ("images", "labels") for s in ("train", "val", "test")], "kind string, split string")
    return wanted.join(_files(spark, sf).select(F.lit("images").alias("kind"), "split").distinct(), ["kind", "split"], "left_anti")


# label text -----------------------------------------------------------------------------------

def _parsed(spark, sf, whole=True):
    return labels.parse_lines(b.label_lines(spark, sf), whole)


OK = "len(tokens) >= 5 AND class_id IS NOT NULL AND xc IS NOT NULL AND yc IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL"
UNIT = "NOT isnan(xc) AND xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1 AND h BETWEEN 0 AND 1"


@query(f"""WITH {b.LINES}, v AS (SELECT *, greatest(0::DOUBLE, xc * 640::DOUBLE - w * 640::DOUBLE / 2) AS x1, greatest(0::DOUBLE, yc * 480::DOUBLE - h * 480::DOUBLE / 2) AS y1, least(640::DOUBLE, xc * 640::DOUBLE + w * 640::DOUBLE / 2) AS x2, least(480::DOUBLE, yc * 480::DOUBLE + h * 480::DOUBLE / 2) AS y2 FROM n WHERE {OK} AND {UNIT})
SELECT stem, line_no, 0 AS class_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2, concat_ws(' ', '0', array_to_string(tokens[2:], ' ')) AS rewritten FROM v WHERE x2 > x1 AND y2 > y1""")
def label_lines_parse(spark, sf):
    v = labels.valid_boxes(_parsed(spark, sf), *_size())
    return shown(v.select("stem", "line_no", F.lit(0).alias("class_id"), *CORNERS, F.concat_ws(" ", F.lit("0"), F.array_join(F.slice("tokens", F.lit(2), F.size("tokens")), " ")).alias("rewritten")))


@query(f"""WITH {b.LINES}, v AS (SELECT stem, line_no, class_cut AS class_id, greatest(0::DOUBLE, least(639::DOUBLE, xc * 640::DOUBLE - w * 640::DOUBLE / 2)) AS x1, greatest(0::DOUBLE, least(479::DOUBLE, yc * 480::DOUBLE - h * 480::DOUBLE / 2)) AS y1, greatest(0::DOUBLE, least(639::DOUBLE, xc * 640::DOUBLE + w * 640::DOUBLE / 2)) AS x2, greatest(0::DOUBLE, least(479::DOUBLE, yc * 480::DOUBLE + h * 480::DOUBLE / 2)) AS y2 FROM n WHERE {OK.replace('class_id', 'class_cut')} AND NOT isnan(xc))
SELECT stem, line_no, class_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM v WHERE x2 > x1 AND y2 > y1""")
def label_lines_clamped(spark, sf):
    v = labels.clamped_boxes(_parsed(spark, sf, False).where(~F.coalesce(F.isnan("xc"), F.lit(False))), *_size())
    return shown(v.select("stem", "line_no", "class_id", *CORNERS))


ISSUE = f"CASE WHEN len(tokens) = 0 THEN NULL WHEN len(tokens) < 5 THEN 'invalid_label_format' WHEN NOT ({OK}) THEN 'label_parse_error' WHEN NOT ({UNIT}) THEN 'invalid_bbox_coords' WHEN w <= 0 OR h <= 0 THEN 'degenerate_bbox' END"


@query(f"WITH {b.LINES} SELECT stem, line_no, {ISSUE} AS issue FROM n")
def label_lines_issues(spark, sf):
    return _parsed(spark, sf).select("stem", "line_no", labels.line_issue().alias("issue"))


@query(f"WITH {b.LINES}, i AS (SELECT stem, {ISSUE} AS issue FROM n) SELECT count(*) FILTER (issue IS NOT NULL) AS bad_lines, count(DISTINCT stem) AS files, round(count(*) FILTER (issue IS NOT NULL) * 100.0::DOUBLE / count(DISTINCT stem), 6) AS error_rate FROM i")
def label_error_rate(spark, sf):
    i = label_lines_issues(spark, sf).agg(F.count("issue").alias("bad_lines"), F.countDistinct("stem").alias("files"))
    return i.withColumn("error_rate", F.round(F.col("bad_lines") * 100.0 / F.col("files"), 6))


@query(f"WITH {b.LINES}, e AS (SELECT *, sum(CASE WHEN len(tokens) >= 5 AND NOT ({OK.replace('class_id', 'class_cut')}) THEN 1 ELSE 0 END) OVER (PARTITION BY stem ORDER BY line_no) AS errors FROM n) SELECT stem, line_no FROM e WHERE errors = 0 AND {OK.replace('class_id', 'class_cut')}")
def label_prefix_until_error(spark, sf):
    return labels.until_first_error(_parsed(spark, sf, False), ["stem"], "line_no").select("stem", "line_no")


@query(f"WITH {b.LINES} SELECT split, stem, count(*) AS n_lines, bool_and({OK}) AS valid FROM n GROUP BY split, stem")
def label_file_valid(spark, sf):
    return labels.file_validity(_parsed(spark, sf), ["split", "stem"])


@query(f"WITH {b.LINES}, f AS (SELECT stem, first(w / h ORDER BY line_no) AS r FROM n WHERE {OK} AND h > 0 GROUP BY stem) SELECT round(coalesce(avg(r), 3.0), 6) AS mean, round(coalesce(stddev_pop(r), 0.5), 6) AS std, count(*) AS n FROM f")
def first_line_aspect(spark, sf):
    f = _parsed(spark, sf).where(labels.readable() & (F.col("h") > 0)).groupBy("stem").agg(F.min_by(F.col("w") / F.col("h"), "line_no").alias("r"))
    return f.agg(F.round(F.coalesce(F.avg("r"), F.lit(3.0)), 6).alias("mean"), F.round(F.coalesce(F.stddev_pop("r"), F.lit(0.5)), 6).alias("std"), F.count("*").alias("n"))


@query(f"WITH {b.ANNOTATIONS} SELECT box_id, 5 AS n_tokens, class_id, round(xc, 6) AS xc, round(yc, 6) AS yc, round(w, 6) AS w, round(h, 6) AS h FROM a")
def yolo_text_render(spark, sf):
    a = b.annotations(spark, sf)
    lines = a.select("split", F.col("image_id").alias("stem"), F.col("box_id").alias("line_no"), labels.render(F.col("class_id"), *[F.col(c) for c in XYWH]).alias("line"))
    return shown(labels.parse_lines(lines).select(F.col("line_no").alias("box_id"), F.size("tokens").alias("n_tokens"), "class_id", *XYWH))


# JSON -----------------------------------------------------------------------------------------

@query("""WITH x AS (SELECT event_id, user_id AS image_id, (event_id * 7919) % 600 AS x, (event_id * 6101) % 440 AS y, (event_id * 4243) % 40 AS w, (event_id * 3571) % 40 AS h FROM events)
SELECT image_id, 'u' || image_id || '.jpg' AS file_name, (event_id % 3)::INT AS class_id, x::DOUBLE AS x1, y::DOUBLE AS y1, (x + w)::DOUBLE AS x2, (y + h)::DOUBLE AS y2, round((x + x + w) / 2.0::DOUBLE / 640, 9) AS xc, round((y + y + h) / 2.0::DOUBLE / 480, 9) AS yc, round(w / 640.0::DOUBLE, 9) AS w, round(h / 480.0::DOUBLE, 9) AS h FROM x WHERE w > 0 AND h > 0""")
def coco_json_boxes(spark, sf):
    i = F.col("event_id")
    box = F.array(*[((i * p) % m).cast("double") for p, m in ((7919, 600), (6101, 440), (4243, 40), (3571, 40))])
    e = b.table(spark, sf, "events")
    text = e.groupBy("user_id").agg(F.to_json(F.struct(F.array(F.struct(F.col("user_id").alias("id"), F.concat(F.lit("u"), F.col("user_id"), F.lit(".jpg")).alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height"))).alias("images"), F.collect_list(F.struct(F.col("user_id").alias("image_id"), box.alias("bbox"), (i % 3).cast("int").alias("category_id"))).alias("annotations"))).alias("j"))
    return shown(json_labels.coco_boxes(text.select(F.from_json("j", json_labels.COCO).alias("c")).select("c.*")), 9)


@query("""WITH f AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'd' || doc_id || '.jpg' WHEN 1 THEN 'd' || doc_id || '.rf.ab.jpg' WHEN 2 THEN 'd' || doc_id || '.png' ELSE 'none' || doc_id || '.jpg' END AS name FROM documents)
SELECT name, doc_id AS id, 640 AS width, 480 AS height, CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS way FROM f WHERE doc_id % 4 < 3""")
def coco_image_match(spark, sf):
    d, i = b.table(spark, sf, "documents").select("doc_id"), F.col("doc_id")
    name = F.when(i % 4 == 0, F.concat(F.lit("d"), i, F.lit(".jpg"))).when(i % 4 == 1, F.concat(F.lit("d"), i, F.lit(".rf.ab.jpg"))).when(i % 4 == 2, F.concat(F.lit("d"), i, F.lit(".png"))).otherwise(F.concat(F.lit("none"), i, F.lit(".jpg")))
    return json_labels.match_images(d.select(name.alias("name")), d.select(i.alias("id"), F.concat(F.lit("d"), i, F.lit(".jpg")).alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height")))


@query("""WITH x AS (SELECT event_id, (event_id * 7919) % 600 AS a, (event_id * 6101) % 440 AS b, (event_id * 4243) % 600 AS c, (event_id * 3571) % 440 AS d FROM events WHERE event_id % 5 <> 0)
SELECT event_id::VARCHAR AS image, CASE WHEN event_id % 7 = 0 THEN 0 ELSE (event_id % 3)::INT END AS class_id, least(a, c)::DOUBLE AS x1, least(b, d)::DOUBLE AS y1, greatest(a, c)::DOUBLE AS x2, greatest(b, d)::DOUBLE AS y2, round((a + c) / 2.0::DOUBLE / 640, 9) AS xc, round((b + d) / 2.0::DOUBLE / 480, 9) AS yc, round(abs(a - c) / 640.0::DOUBLE, 9) AS w, round(abs(b - d) / 480.0::DOUBLE, 9) AS h FROM x WHERE a <> c AND b <> d""")
def shape_json_boxes(spark, sf):
    i = F.col("event_id")
    at = lambda p, m: ((i * p) % m).cast("double")
    shape = F.struct(F.when(i % 5 == 0, "polygon").otherwise("rectangle").alias("shape_type"), F.array(F.array(at(7919, 600), at(6101, 440)), F.array(at(4243, 600), at(3571, 440))).alias("points"), F.when(i % 7 != 0, (i % 3).cast("int")).alias("label_id"))
    text = b.table(spark, sf, "events").select(F.to_json(F.struct(i.cast("string").alias("image"), F.array(shape).alias("shapes"))).alias("j"))
    return shown(json_labels.shape_boxes(text.select(F.from_json("j", json_labels.SHAPES).alias("s")).select("s.*"), *_size()), 9)


@query("SELECT event_id, CASE WHEN props LIKE '%\"k\"%' THEN 'has_k' ELSE 'other' END AS kind, coalesce(json_extract_string(props, '$.k')::BIGINT, -1) AS k, coalesce(json_extract_string(props, '$.absent'), 'none') AS absent FROM events")
def json_dispatch(spark, sf):
    p = F.col("props")
    return b.table(spark, sf, "events").select("event_id", F.when(F.get_json_object(p, "$.k").isNotNull(), "has_k").otherwise("other").alias("kind"), F.coalesce(F.get_json_object(p, "$.k").cast("bigint"), F.lit(-1)).alias("k"), F.coalesce(F.get_json_object(p, "$.absent"), F.lit("none")).alias("absent"))


# boxes ----------------------------------------------------------------------------------------

AREA = "(x2 - x1) * (y2 - y1)"
ASPECT = "(x2 - x1) / (y2 - y1)"


def _measured(spark, sf):
    x = b.boxes(spark, sf)
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return x.withColumns({"width": w, "height": h, "area": w * h, "aspect": F.try_divide(w, h), "cx": (F.col("x1") + F.col("x2")) / 2 / b.WIDTH, "cy": (F.col("y1") + F.col("y2")) / 2 / b.HEIGHT, "area_ratio": w * h / (b.WIDTH * b.HEIGHT)})


@query(f"""WITH {b.BOXES} SELECT box_id, round(x2 - x1, 10) AS width, round(y2 - y1, 10) AS height, round({AREA}, 10) AS area, round({ASPECT}, 10) AS aspect, round((x1 + x2) / 2 / 640, 10) AS cx, round((y1 + y2) / 2 / 480, 10) AS cy, round({AREA} / 307200, 10) AS area_ratio,
CASE WHEN {AREA} < 1000 THEN 'small' WHEN {AREA} > 100000 THEN 'large' ELSE 'valid' END AS size_flag, {ASPECT} BETWEEN 1.5 AND 6.0 AS aspect_ok, round(least(1::DOUBLE, greatest(0.000001::DOUBLE, w)), 10) AS w_clipped FROM b""")
def box_metrics(spark, sf):
    m = _measured(spark, sf)
    flag = F.when(F.col("area") < 1000, "small").when(F.col("area") > 100_000, "large").otherwise("valid")
    return shown(m.select("box_id", "width", "height", "area", "aspect", "cx", "cy", "area_ratio", flag.alias("size_flag"), F.col("aspect").between(1.5, 6.0).alias("aspect_ok"), F.least(F.lit(1.0), F.greatest(F.lit(1e-6), F.col("w"))).alias("w_clipped")), 10)


BOX_ISSUES = f"list_filter([CASE WHEN {AREA} < 1000 THEN 'bbox_too_small' WHEN {AREA} > 100000 THEN 'bbox_too_large' END, CASE WHEN NOT ({ASPECT} BETWEEN 1.5 AND 6.0) THEN 'unusual_aspect_ratio' END], lambda x: x IS NOT NULL)"
IMAGE_ISSUES = "list_filter([CASE WHEN (i * 37) % 300 < 100 THEN 'blurry' END, CASE WHEN (i * 53) % 256 < 30 THEN 'too_dark' WHEN (i * 53) % 256 > 220 THEN 'too_bright' END, CASE WHEN (i * 29) % 90 < 20 THEN 'low_contrast' END, CASE WHEN i % 97 = 0 THEN 'uniform_color' END], lambda x: x IS NOT NULL)"


def _image_issues(i):
    found = quality.image_issue_list((i * 37) % 300, (i * 53) % 256, (i * 29) % 90, i % 97 == 0)
    return quality.with_early_exit(i % 31 != 0, i % 23 != 0, found)


@query(f"SELECT i AS image_id, array_to_string(CASE WHEN i % 31 = 0 THEN ['unreadable_image'] WHEN i % 23 = 0 THEN ['missing_label'] ELSE {IMAGE_ISSUES} END, ',') AS issues, (i * 37) % 300 >= 50 AND (i * 53) % 256 BETWEEN 30 AND 220 AND (i * 29) % 90 >= 20 AS augmentable FROM (SELECT DISTINCT user_id AS i FROM events)")
def image_flags(spark, sf):
    i = F.col("image_id")
    ids = b.table(spark, sf, "events").select(F.col("user_id").alias("image_id")).distinct()
    return ids.select(i, F.array_join(_image_issues(i), ",").alias("issues"), (((i * 37) % 300 >= 50) & ((i * 53) % 256).between(30, 220) & ((i * 29) % 90 >= 20)).alias("augmentable"))


BOX_CODES = ("bbox_too_small", "bbox_too_large", "unusual_aspect_ratio")


def _cleaned(spark, sf):
    """Images with all issues of theirs and their boxes', repeats included."""
    boxes = b.boxes(spark, sf)
    each = boxes.select("image_id", "split", quality.box_issue_list(g.area(matching.box()), (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("i"))
    n = each.groupBy("image_id", "split").agg(*[F.count_if(F.array_contains("i", c)).cast("int").alias(c) for c in BOX_CODES])
    out = n.select("image_id", "split", F.concat(_image_issues(F.col("image_id")), *[F.array_repeat(F.lit(c), F.col(c)) for c in BOX_CODES]).alias("issues"))
    return out.withColumn("issues", F.sort_array("issues")).withColumn("kept", quality.keep(F.col("issues")))


ALL_ISSUES = f"""WITH {b.BOXES}, e AS (SELECT image_id, split, {BOX_ISSUES} AS i FROM b), n AS (SELECT image_id AS i, split, flatten(list(i)) AS l FROM e GROUP BY ALL),
c AS (SELECT i AS image_id, split, list_sort(list_concat(CASE WHEN i % 31 = 0 THEN ['unreadable_image'] WHEN i % 23 = 0 THEN ['missing_label'] ELSE {IMAGE_ISSUES} END, l)) AS l FROM n),
k AS (SELECT *, NOT list_has_any(l, ['unreadable_image', 'missing_label']) AND len(l) <= 3 AS kept FROM c)"""


@query(ALL_ISSUES + """ SELECT image_id, split, array_to_string(l, ',') AS issues, kept, CASE WHEN kept THEN NULL WHEN list_contains(l, 'unreadable_image') THEN 'corrupted' WHEN list_contains(l, 'blurry') THEN 'blurry' WHEN list_contains(l, 'missing_label') THEN 'mislabeled'
WHEN list_has_any(l, ['bbox_too_small', 'bbox_too_large']) THEN 'size_issues' WHEN list_contains(l, 'unusual_aspect_ratio') THEN 'aspect_ratio_issues' ELSE 'poor_quality' END AS category FROM k""")
def clean_images(spark, sf):
    return _cleaned(spark, sf).select("image_id", "split", F.array_join("issues", ",").alias("issues"), "kept", F.when(~F.col("kept"), quality.category(F.col("issues"))).alias("category"))


ISSUES_SQL = f"""WITH {b.BOXES}, s AS (SELECT box_id, image_id, split, {BOX_ISSUES} AS issues FROM b),
k AS (SELECT *, len(issues) <= 1 AS kept FROM s)"""


def _boxes_judged(spark, sf):
    x = b.boxes(spark, sf)
    out = x.select("box_id", "image_id", "split", quality.box_issue_list(g.area(matching.box()), (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("issues"))
    return out.withColumn("kept", quality.keep(F.col("issues"), 1))


def _summary_sql(by: str) -> str:
    return f"SELECT {by} AS split, count(*) AS total, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS flagged, round(count(*) FILTER (kept)::DOUBLE / count(*), 6) AS cleaning_rate, round(sum(len(issues))::DOUBLE / count(*), 6) AS issues_per_image FROM k" + (" GROUP BY split" if by == "split" else "")


@query(ISSUES_SQL + f""", z AS ({_summary_sql('split')} UNION ALL {_summary_sql("'all'")}), u AS (SELECT split, unnest(issues) AS issue FROM k), c AS (SELECT split, issue, count(*) AS n FROM u GROUP BY ALL UNION ALL SELECT 'all', issue, count(*) FROM u GROUP BY issue),
w AS (SELECT split, first(issue ORDER BY n DESC, issue) AS worst FROM c GROUP BY split) SELECT z.*, worst FROM z LEFT JOIN w USING (split)""")
def clean_report(spark, sf):
    return quality.cleaning_summary(_boxes_judged(spark, sf))


@query(ISSUES_SQL + ", u AS (SELECT split, unnest(issues) AS issue FROM k) SELECT split, issue, count(*) AS n FROM u GROUP BY split, issue UNION ALL SELECT 'all', issue, count(*) FROM u GROUP BY issue")
def issue_histogram(spark, sf):
    return quality.issue_histogram(_boxes_judged(spark, sf))


@query(ISSUES_SQL + " SELECT box_id, CASE WHEN list_has_any(issues, ['bbox_too_small', 'bbox_too_large']) THEN 'size_issues' WHEN list_contains(issues, 'unusual_aspect_ratio') THEN 'aspect_ratio_issues' ELSE 'invalid_bbox' END AS category FROM k WHERE NOT kept")
def flag_category(spark, sf):
    return _boxes_judged(spark, sf).where("NOT kept").select("box_id", quality.category(F.col("issues")).alias("category"))


@query(f"""WITH {b.ANNOTATIONS}, r AS (SELECT *, CASE WHEN box_id % 5 = 0 THEN 640 ELSE 1 END AS k FROM a), s AS (SELECT *, CASE WHEN w * k > 1 OR h * k > 1 THEN k ELSE 1 END AS d FROM r)
SELECT box_id, round(w * k / d, 6) AS w, round(h * k / d, 6) AS h, xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1 AS boxes_ok, NOT (w * 640 < 20 OR h * 480 < 20) AS large_enough, value / 500.0::DOUBLE > 0.3 AS confident FROM s""")
def aug_box_gate(spark, sf):
    a = b.annotations(spark, sf)
    k = F.when(F.col("box_id") % 5 == 0, 640).otherwise(1)
    d = F.when((F.col("w") * k > 1) | (F.col("h") * k > 1), k).otherwise(1)
    w, h = F.col("w") * k / d, F.col("h") * k / d
    ok = F.forall(F.array(F.struct(*XYWH)), lambda x: x["xc"].between(0, 1) & x["yc"].between(0, 1) & (x["w"] > 0) & (x["w"] <= 1) & (x["h"] > 0) & (x["h"] <= 1))
    return shown(a.select("box_id", w.alias("w"), h.alias("h"), ok.alias("boxes_ok"), (~((F.col("w") * 640 < 20) | (F.col("h") * 480 < 20))).alias("large_enough"), (F.col("value") / 500.0 > 0.3).alias("confident")))


@query(f"""WITH {b.BOXES}, t AS (SELECT CASE WHEN {ASPECT} BETWEEN 0.8 AND 1.2 THEN 'square' WHEN {ASPECT} > 1.2 AND {ASPECT} <= 2.0 THEN 'landscape' WHEN {ASPECT} > 2.0 THEN 'wide' ELSE 'portrait' END AS aspect, CASE WHEN {AREA} / 307200 < 0.01 THEN 'tiny' WHEN {AREA} / 307200 < 0.05 THEN 'small' WHEN {AREA} / 307200 < 0.1 THEN 'medium' ELSE 'large' END AS size FROM b),
d AS (SELECT * FROM (VALUES ('square'), ('landscape'), ('wide'), ('portrait')) x(aspect), (VALUES ('tiny'), ('small'), ('medium'), ('large')) y(size))
SELECT d.aspect, d.size, count(t.aspect) AS n FROM d LEFT JOIN t ON d.aspect = t.aspect AND d.size = t.size GROUP BY ALL""")
def aspect_size_buckets(spark, sf):
    m = _measured(spark, sf).select(matching.aspect_bucket(F.col("aspect")).alias("aspect"), matching.size_bucket(F.col("area_ratio")).alias("size"))
    n = m.groupBy("aspect", "size").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(x, y) for x in ("square", "landscape", "wide", "portrait") for y in ("tiny", "small", "medium", "large")], "aspect string, size string")
    return every.join(n, ["aspect", "size"], "left").select("aspect", "size", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


# matching -------------------------------------------------------------------------------------

def _pairs(spark, sf):
    return matching.pairs(b.truth(spark, sf), b.detections(spark, sf))


@query(f"WITH {b.MATCH} SELECT image_id, gt_idx, det_idx, round(iou, 6) AS iou FROM p WHERE iou > 0")
def gt_pred_iou(spark, sf):
    return shown(_pairs(spark, sf).where("iou > 0").select("image_id", "gt_idx", "det_idx", "iou"))


@query("WITH RECURSIVE " + b.GREEDY.lstrip() + " SELECT image_id, gt_idx, det_idx FROM m")
def greedy_match(spark, sf):
    return matching.greedy(matching.close_pairs(b.truth(spark, sf), b.detections(spark, sf))).select("image_id", "gt_idx", "det_idx")


@query("WITH RECURSIVE " + b.GREEDY.lstrip() + " SELECT (SELECT count(*) FROM m) AS tp, (SELECT count(*) FROM det) - (SELECT count(*) FROM m) AS fp, (SELECT count(*) FROM gt) - (SELECT count(*) FROM m) AS fn, (SELECT count(*) FROM gt) AS total_gt, (SELECT count(*) FROM det) AS total_preds")
def match_totals(spark, sf):
    gt, det = b.truth(spark, sf), b.detections(spark, sf)
    m = matching.greedy(matching.close_pairs(gt, det))
    each = reduce(DataFrame.unionByName, [x.select(F.lit(k).alias("k")) for k, x in (("gt", gt), ("det", det), ("m", m))])
    n = lambda k: F.count_if(F.col("k") == k)
    return each.agg(n("m").alias("tp"), (n("det") - n("m")).alias("fp"), (n("gt") - n("m")).alias("fn"), n("gt").alias("total_gt"), n("det").alias("total_preds"))


@query(f"WITH {b.MATCH} SELECT image_id, gt_idx, round(max(iou), 6) AS best, max(iou) > 0.5 AS matched FROM p GROUP BY image_id, gt_idx")
def best_iou_per_annotation(spark, sf):
    return shown(matching.best_iou(_pairs(spark, sf)))


@query()
def box_nms(spark, sf):
    return matching.suppress(b.boxes(spark, sf), 0.5)


@query()
def box_fusion(spark, sf):
    """Views weigh 1, 1/2, 1/3 ... in turn."""
    return shown(matching.fuse(b.boxes(spark, sf), F.col("value") / (F.col("box_id") % 3 + 1)), 8)


def _errors(spark, sf):
    gt, det = b.truth(spark, sf), b.detections(spark, sf)
    return matching.errors(gt, det, matching.greedy(matching.close_pairs(gt, det)))


@query("WITH RECURSIVE " + b.GREEDY.lstrip() + " SELECT image_id, det_idx, round(conf, 6) AS conf FROM det WHERE (image_id, det_idx) NOT IN (SELECT (image_id, det_idx) FROM m) ORDER BY conf DESC, det_idx LIMIT 100")
def top_fp(spark, sf):
    return shown(matching.top(_errors(spark, sf)[0].select("image_id", "det_idx", "conf"), F.desc("conf"), 100, "det_idx"))


@query("WITH RECURSIVE " + b.GREEDY.lstrip() + f" SELECT image_id, gt_idx, round({AREA}, 4) AS area FROM gt WHERE (image_id, gt_idx) NOT IN (SELECT (image_id, gt_idx) FROM m) ORDER BY round({AREA}, 4) DESC, gt_idx LIMIT 100")
def top_fn(spark, sf):
    fn = _errors(spark, sf)[1].select("image_id", "gt_idx", F.round(g.area(matching.box()), 4).alias("area"))
    return matching.top(fn, F.desc("area"), 100, "gt_idx")


@query("WITH RECURSIVE " + b.GREEDY.lstrip() + " SELECT image_id, det_idx, round(conf, 6) AS conf FROM det JOIN m USING (image_id, det_idx) WHERE conf < 0.5 ORDER BY conf, det_idx LIMIT 100")
def top_low_conf(spark, sf):
    return shown(matching.top(_errors(spark, sf)[2].select("image_id", "det_idx", "conf"), F.asc("conf"), 100, "det_idx"))


@query(f"WITH {b.BOXES} SELECT image_id, count(*) AS n, round(avg(value / 500.0::DOUBLE), 6) AS mean_conf, round(min(value / 500.0::DOUBLE), 6) AS min_conf, round(max(value / 500.0::DOUBLE), 6) AS max_conf FROM b WHERE event_type IN ('click', 'view', 'purchase') GROUP BY image_id")
def detection_stats(spark, sf):
    return shown(b.detections(spark, sf).groupBy("image_id").agg(F.count("*").alias("n"), F.avg("conf").alias("mean_conf"), F.min("conf").alias("min_conf"), F.max("conf").alias("max_conf")))


@query()
def precision_recall(spark, sf):
    gt, det = b.truth(spark, sf), b.detections(spark, sf)
    return shown(matching.average_precision(det, matching.greedy(matching.close_pairs(gt, det)), gt).drop("hit"))


VIEW_SQL = """v AS (SELECT unnest(['original', 'flip_h', 'flip_v', 'rotate_90', 'rotate_180', 'rotate_270', 'scale_up', 'scale_down']) AS view)"""


@query(f"WITH {b.MATCH}, {VIEW_SQL} SELECT image_id, det_idx, view, round(x1, 4) AS x1, round(y1, 4) AS y1, round(x2, 4) AS x2, round(y2, 4) AS y2 FROM det, v")
def tta_inverse(spark, sf):
    d = b.detections(spark, sf).select("image_id", "det_idx", *CORNERS).withColumn("view", F.explode(F.array(*[F.lit(v) for v in g.VIEWS])))
    d = d.withColumn("f", g.view_forward(F.col("view"), matching.box(), *_size()))
    d = d.withColumn("r", g.view_inverse(F.col("view"), matching.box("f."), *_size()))
    return shown(d.select("image_id", "det_idx", "view", "r.*"), 4)


@query(f"WITH {b.MATCH}, {VIEW_SQL}, m AS (SELECT unnest([0, 1]) AS model) SELECT model, view, round(1.0::DOUBLE / (model + 1), 6) AS weight, count(*) AS n FROM det, v, m GROUP BY ALL")
def tta_grid(spark, sf):
    grid = F.explode(F.flatten(F.array(*[F.array(*[F.struct(F.lit(m).alias("model"), F.lit(v).alias("view")) for v in g.VIEWS]) for m in (0, 1)])))
    d = b.detections(spark, sf).select(grid.alias("x")).select("x.*")
    return d.groupBy("model", "view").agg(F.count("*").alias("n")).withColumn("weight", F.round(1.0 / (F.col("model") + 1), 6))


@query(f"WITH {b.BOXES} SELECT box_id, greatest(0, trunc(x1 - 5)::INT) AS x1, greatest(0, trunc(y1 - 5)::INT) AS y1, least(640, trunc(x2 + 5)::INT) AS x2, least(480, trunc(y2 + 5)::INT) AS y2, CASE WHEN {ASPECT} < 2.0 THEN 2 ELSE 1 END AS n_crops FROM b WHERE y2 - y1 > 20")
def padded_crops(spark, sf):
    x = b.boxes(spark, sf).where("y2 - y1 > 20")
    crop = g.padded_crop(matching.box(), 5.0, *_size())
    many = F.when((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")) < 2.0, 2).otherwise(1)
    return x.select("box_id", many.alias("n_crops"), *[c.alias(n) for c, n in zip(crop, CORNERS, strict=True)])
