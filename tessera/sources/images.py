"""Image files: listing, decoding, metrics and perceptual hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

# Suffixes of images.
EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "tiff", "webp", "jfif")
# Those that narrower scans take: of a split, of one folder, for evaluation, for merging.
SCANS = {"split": ("jpg", "jpeg", "png", "bmp"), "flat": ("jpg", "jpeg", "png", "bmp", "tiff"), "evaluation": ("jpg", "jpeg", "png"), "merge": ("jpg", "png")}


def manifest(files: DataFrame, root: str = "", extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """path, dataset, split, name, stem, ext, length of a listing (path, length): image files only.

    The dataset is the first folder below root; __MACOSX and names with README are left out.
    """
    rest = F.regexp_replace("path", "^" + root.rstrip("/").replace(".", r"\.") + "/*", "") if root else F.col("path")
    parts = F.split(rest, "/")
    name = F.element_at(parts, -1)
    out = files.select("path", F.get(parts, F.lit(0)).alias("dataset"), F.when(F.size(parts) > 1, F.element_at(parts, -2)).alias("split"), name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), "length")
    return out.where(F.col("ext").isin(*extensions) & (F.col("dataset") != "__MACOSX") & ~F.upper("name").contains("README")).distinct()


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files below root, without reading their content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images; width is -1 where decoding fails."""
    return spark.read.format("image").option("recursiveFileLookup", True).load(root).select("image.origin", "image.width", "image.height", "image.nChannels", "image.data")


METRICS = StructType([StructField(n, DoubleType()) for n in ("blur", "brightness", "contrast", "low", "high")] + [StructField("dhash", LongType()), StructField("phash", LongType())])


def _grey(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(float)
    return a[:, :, 0] if channels == 1 else np.rint(0.114 * a[:, :, 0] + 0.587 * a[:, :, 1] + 0.299 * a[:, :, 2])


def _resized(grey: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Means over a grid of areas."""
    ys = np.linspace(0, grey.shape[0], rows + 1)
    xs = np.linspace(0, grey.shape[1], columns + 1)
    tops, lefts = (np.minimum(x[:-1].astype(int), n - 1) for x, n in ((ys, grey.shape[0]), (xs, grey.shape[1])))
    rows_ = np.maximum(tops + 1, ys[1:].astype(int)) - tops
    columns_ = np.maximum(lefts + 1, xs[1:].astype(int)) - lefts
    if min(grey.shape[0] - rows, grey.shape[1] - columns) >= 0:  # areas side by side
        sums = np.add.reduceat(np.add.reduceat(grey, tops, axis=0), lefts, axis=1)
        return sums / rows_[:, None] / columns_[None, :]
    return np.array([[grey[a : a + h, c : c + w].mean() for c, w in zip(lefts, columns_, strict=True)] for a, h in zip(tops, rows_, strict=True)])


def _packed(bits: np.ndarray) -> int:
    return int.from_bytes(np.packbits(bits.ravel()).tobytes(), "big", signed=True)


def pixel_metrics(data: bytes, width: int, height: int, channels: int) -> tuple:
    """Blur (population variance of the Laplacian, borders mirrored), mean and deviation of grey,
    least and greatest byte of any channel, 9x8 gradient hash and 8x8 low-frequency cosine hash."""
    if not (data and width and width > 0):  # a missing number comes as NaN
        return (None,) * 7
    width, height, channels = int(width), int(height), int(channels)
    grey, raw = _grey(data, width, height, channels), np.frombuffer(data, np.uint8)
    p = np.pad(grey, 1, mode="reflect") if min(grey.shape) > 1 else np.pad(grey, 1, mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * grey
    small = _resized(grey, 8, 9)
    k = np.arange(32)
    cosine = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 64)
    low = (cosine @ _resized(grey, 32, 32) @ cosine.T)[:8, :8]
    return float(lap.var()), float(grey.mean()), float(grey.std()), float(raw.min()), float(raw.max()), _packed(small[:, 1:] > small[:, :-1]), _packed(low > np.median(low))


@F.pandas_udf(METRICS)
def _metrics(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for columns in batches:
        yield pd.DataFrame([pixel_metrics(*row) for row in zip(*columns, strict=True)], columns=METRICS.names).astype({"dhash": "Int64", "phash": "Int64"})


def image_metrics(images: DataFrame) -> DataFrame:
    """Adds the pixel metrics; put cheap filters before it, they then run first."""
    return images.withColumn("m", _metrics("data", "width", "height", "nChannels")).select(*[c for c in images.columns if c != "data"], "m.*")


def usable(length: Column, width: Column, height: Column, channels: Column, low: Column, high: Column) -> Column:
    """At least 1 KiB, sides of 100 to 3840, 1, 3 or 4 channels, and not all bytes alike: a grey area goes, one of
    another colour stays, and so does any image of one channel."""
    return (length >= 1024) & width.between(100, 3840) & height.between(100, 3840) & channels.isin(1, 3, 4) & ((channels == 1) | (low < high))


def adjusted(images: DataFrame, factor: float, offset: float) -> DataFrame:
    """Images with every byte times factor plus offset, cut to 0 to 255."""

    @F.pandas_udf("binary")
    def run(data: pd.Series) -> pd.Series:
        return data.map(lambda x: np.clip(np.floor(np.frombuffer(x, np.uint8) * factor + offset), 0, 255).astype(np.uint8).tobytes())

    return images.withColumn("data", run("data"))


#: How an image can be hashed: by its bytes, or by what it looks like.
HASHES = ("md5", "dhash", "phash")


def image_hash(images: DataFrame, method: str) -> DataFrame:
    """images without data, with hash: text of 32 hex digits (md5) or of 64 bits (dhash, phash; null for what has no pixels)."""
    if method not in HASHES:
        raise ValueError(f"no hash method {method}; there are {', '.join(HASHES)}")
    if method == "md5":
        return images.withColumn("hash", F.md5("data")).drop("data")
    kept = [c for c in images.columns if c != "data"]
    return image_metrics(images).select(*kept, F.lpad(F.bin(method), 64, "0").alias("hash"))
