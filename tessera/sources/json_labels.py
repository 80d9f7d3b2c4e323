"""Boxes from COCO-style JSON and from one shape JSON per image."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from ..functions import geometry as g

COCO = "images array<struct<id:bigint,file_name:string,width:int,height:int>>, annotations array<struct<image_id:bigint,bbox:array<double>,category_id:int>>"
SHAPES = "image string, shapes array<struct<shape_type:string,points:array<array<double>>,label_id:int>>"


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COCO).json(path, multiLine=True)


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHAPES).json(path, multiLine=True)


def clean_stem(name):
    """A file's stem without what follows .rf. in it."""
    return F.substring_index(F.regexp_replace(name, r"\.[^.]*$", ""), ".rf.", 1)


def match_images(files: DataFrame, images: DataFrame) -> DataFrame:
    """files (name) with the id, width and height of their COCO image (id, file_name, width, height).

    By name, else by clean stem with suffix, else by stem, else by the stem before .rf.; of equals
    the lowest id. Four equi-joins, not one join with OR, which would compare all pairs. Id 0 counts.
    """
    suffix = lambda c: F.regexp_extract(c, r"(\.[^.]*)$", 1)
    stem = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    ways = [
        (F.col("name"), F.col("file_name")),
        (F.concat(clean_stem(F.col("name")), suffix(F.col("name"))), F.col("file_name")),
        (stem(F.col("name")), stem(F.col("file_name"))),
        (clean_stem(F.col("name")), clean_stem(F.col("file_name"))),
    ]
    found = reduce(DataFrame.unionByName, [files.select("name", a.alias("k")).join(images.select(b.alias("k"), "id", "width", "height"), "k").select("name", "id", "width", "height", F.lit(i).alias("way")) for i, (a, b) in enumerate(ways)])
    first = W.partitionBy("name").orderBy("way", "id")
    return found.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def coco_boxes(coco: DataFrame) -> DataFrame:
    """image_id, file_name, class_id, corners and normalised box of each annotation with a size."""
    images = coco.select(F.explode("images").alias("i")).select("i.*")
    boxes = coco.select(F.explode("annotations").alias("a")).select("a.*").where("size(bbox) = 4 AND bbox[2] > 0 AND bbox[3] > 0")
    corners = g.from_top_left(*[F.get("bbox", F.lit(i)) for i in range(4)])
    out = boxes.join(images, boxes.image_id == images.id).withColumns(dict(zip(("x1", "y1", "x2", "y2"), corners, strict=True)))
    norm = g.from_corners(tuple(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.col("width"), F.col("height"))
    return out.withColumns(dict(zip(("xc", "yc", "w", "h"), norm, strict=True))).select("image_id", "file_name", F.coalesce("category_id", F.lit(0)).alias("class_id"), "x1", "y1", "x2", "y2", "xc", "yc", "w", "h")


def shape_boxes(shapes: DataFrame, width, height) -> DataFrame:
    """Rectangles of two points, their corners in order; those without area are dropped."""
    s = shapes.select("image", F.explode("shapes").alias("s")).where("s.shape_type = 'rectangle' AND size(s.points) = 2")
    at = lambda p, c: F.get(F.get("s.points", F.lit(p)), F.lit(c))
    box = g.ordered(at(0, 0), at(0, 1), at(1, 0), at(1, 1))
    out = s.withColumns(dict(zip(("x1", "y1", "x2", "y2"), box, strict=True))).where("x2 > x1 AND y2 > y1")
    norm = g.from_corners(tuple(F.col(c) for c in ("x1", "y1", "x2", "y2")), width, height)
    return out.withColumns(dict(zip(("xc", "yc", "w", "h"), norm, strict=True))).select("image", F.coalesce("s.label_id", F.lit(0)).alias("class_id"), "x1", "y1", "x2", "y2", "xc", "yc", "w", "h")
