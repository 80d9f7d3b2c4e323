"""Queries of operators that are asked for by name, and of statistics by dataset and sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import matching, merging, splits
from ..sources import images
from . import bindings as b
from .cleaning_queries import CLEAN_SQL, _cleaned
from .group_queries import PIXEL_SQL, _pictures
from .queries import FILES, H, ORACLE, _files, query, shown


@query(f"""WITH {b.ANNOTATIONS}, c AS (SELECT image_id, count(*) AS n FROM a GROUP BY 1) SELECT source AS dataset, count(*) AS images, sum(coalesce(n, 0))::BIGINT AS annotations, round(avg(coalesce(n, 0)), 6) AS per_image FROM documents LEFT JOIN c ON image_id = doc_id GROUP BY 1""")
def dataset_annotations(spark, sf):
    """Images of each dataset and how many annotations they have on average, images without any among them."""
    n = b.annotations(spark, sf).groupBy(F.col("image_id").alias("doc_id")).agg(F.count("*").alias("n"))
    d = b.table(spark, sf, "documents").select("doc_id", F.col("source").alias("dataset")).join(n, "doc_id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return shown(d.groupBy("dataset").agg(F.count("*").alias("images"), F.sum("n").alias("annotations"), F.avg("n").alias("per_image")))


@query(f"WITH {CLEAN_SQL}, f AS (SELECT split, 'clipped_bbox' AS fixed, sum(clipped)::BIGINT AS n FROM k WHERE kept AND whole GROUP BY 1 UNION ALL SELECT split, 'removed_duplicates', count(*) FILTER (twins) FROM k WHERE kept AND whole GROUP BY 1) SELECT * FROM f WHERE n > 0")
def kept_fixed_histogram(spark, sf):
    """What was mended in the images that are kept."""
    return _cleaned(spark, sf).where("kept").select("split", F.explode("fixed").alias("fixed")).groupBy("split", "fixed").agg(F.count("*").alias("n"))


@query(f"""WITH {FILES}, s AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY {H.format("'stats' || doc_id")}, doc_id) AS r, (doc_id * 37) % 300 AS blur FROM f)
SELECT split, count(*) AS n, round(avg(blur), 6) AS mean, round(stddev_pop(blur), 6) AS std, avg(blur) < 50 AS too_blurry FROM s WHERE r <= 50 GROUP BY split""")
def sampled_image_stats(spark, sf):
    """Sharpness of fifty images of each split, drawn by hash, and whether it is too low."""
    s = splits.sample(_files(spark, sf).select("doc_id", "split"), "doc_id", ["split"], k=50, salt="stats").withColumn("blur", F.col("doc_id") * 37 % 300)
    return shown(s.groupBy("split").agg(F.count("*").alias("n"), F.avg("blur").alias("mean"), F.stddev_pop("blur").alias("std"), (F.avg("blur") < 50).alias("too_blurry")))


@query(f"SELECT 'nms' AS method, image_id, count(*) AS n FROM ({ORACLE['box_nms']}) GROUP BY ALL UNION ALL SELECT 'fusion', image_id, count(*) FROM ({ORACLE['box_fusion']}) GROUP BY ALL")
def ensemble_methods(spark, sf):
    """How many boxes each method of an ensemble leaves of an image."""
    x = b.boxes(spark, sf)
    found = {"nms": matching.ensemble("nms")(x, 0.5), "fusion": matching.ensemble("fusion")(x, F.col("value") / (F.col("box_id") % 3 + 1))}
    return reduce(DataFrame.unionByName, [df.groupBy("image_id").agg(F.count("*").alias("n")).select(F.lit(m).alias("method"), "image_id", "n") for m, df in found.items()])


@query(f"WITH {PIXEL_SQL}, h AS (SELECT k, md5(unhex(string_agg(printf('%02x', v::INT), '' ORDER BY y, x))) AS hash FROM px GROUP BY k) SELECT 'md5' AS method, k, hash FROM h UNION ALL SELECT 'dhash', k, dhash FROM dh UNION ALL SELECT 'phash', k, phash FROM ph")
def image_hash_methods(spark, sf):
    """Images hashed by each method."""
    return reduce(DataFrame.unionByName, [images.image_hash(_pictures(spark, sf), m).select(F.lit(m).alias("method"), "k", "hash") for m in images.HASHES])


@query(f"""WITH {FILES}, p AS (SELECT dataset || '/' || doc_id || '.jpg' AS path, split, (doc_id % 700) || '.jpg' AS name, hash FROM f),
m AS (SELECT 'md5' AS key, 'copy' AS action, arg_min(split, path) AS split, arg_min(name, path) AS name, min(path) AS path FROM p GROUP BY hash), n AS (SELECT 'filename' AS key, 'symlink' AS action, arg_min(split, path) AS split, name, min(path) AS path FROM p GROUP BY name)
SELECT key, path, 'out/images/' || split || '/' || name AS target, action FROM (SELECT key, action, split, name, path FROM m UNION ALL SELECT key, action, split, name, path FROM n)""")
def transfer_plans(spark, sf):
    """Files that go to another place, once by content and copied, once by name and linked."""
    i = F.col("doc_id")
    f = _files(spark, sf).select(F.concat("dataset", F.lit("/"), i, F.lit(".jpg")).alias("path"), "split", F.concat(i % 700, F.lit(".jpg")).alias("name"), "hash")
    plans = {"md5": merging.transfer_plan(f, "out"), "filename": merging.transfer_plan(f, "out", "filename", "symlink")}
    return reduce(DataFrame.unionByName, [p.select(F.lit(k).alias("key"), "path", "target", "action") for k, p in plans.items()])
