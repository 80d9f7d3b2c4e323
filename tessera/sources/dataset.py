"""A detection dataset on disk as tables: every file of it, empty ones too, labels joined to decoded images."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType

from .images import EXTENSIONS

LISTED = "path string, split string, kind string, name string, stem string, ext string, length bigint"
SPLITS = ("train", "val", "test")


def store_of(path: str):
    """The store of a path, as pyarrow reaches it from driver and executors, and the path in it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if ":/" in path else (LocalFileSystem(), path)


class Folder(InputPartition):
    def __init__(self, split: str, kind: str, at: str):
        self.split, self.kind, self.at = split, kind, at


class FolderReader(DataSourceReader):
    """A partition for each images or labels folder of a split; tasks list them, so names do not go through the driver."""

    def __init__(self, root: str, skip: bool):
        self.root, self.skip = root.rstrip("/"), skip

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileType

        store, root = store_of(self.root)
        out: list[InputPartition] = []
        for split in SPLITS:
            # both layouts: <root>/<kind>/<split> and <root>/<split>/<kind>
            both = [(kind, at) for kind in ("images", "labels") for at in (f"{root}/{kind}/{split}", f"{root}/{split}/{kind}") if store.get_file_info(at).type == FileType.Directory]
            if not self.skip or {kind for kind, _ in both} == {"images", "labels"}:
                out += [Folder(split, kind, at) for kind, at in both]
        return out or [Folder("", "", "")]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSelector, FileType

        names = [x.split()[0] for x in LISTED.split(", ")]
        types = [pa.int64() if x.endswith("bigint") else pa.string() for x in LISTED.split(", ")]
        rows: list[tuple] = []
        if partition.at:
            store, _ = store_of(self.root)
            for f in store.get_file_info(FileSelector(partition.at, recursive=True)):
                if f.type == FileType.File and not f.base_name.startswith((".", "_")):
                    dot = f.base_name.rfind(".")
                    stem, ext = (f.base_name[:dot], f.base_name[dot + 1 :].lower()) if dot > 0 else (f.base_name, "")
                    rows.append((f.path, partition.split, partition.kind, f.base_name, stem, ext, f.size))
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


class DetectionFiles(DataSource):
    """``spark.read.format("detection_files").load(root)``: path, split, kind (images or labels), name, stem, ext and
    length of all files, those of no bytes among them, which Spark's own sources leave out. With the option
    ``skip_incomplete`` a split counts only if it has both folders."""

    @classmethod
    def name(cls) -> str:
        return "detection_files"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(self.options["path"], self.options.get("skip_incomplete", "false").lower() == "true")


def listed(spark: SparkSession, root: str, skip_incomplete: bool = False) -> DataFrame:
    spark.dataSource.register(DetectionFiles)
    return spark.read.format("detection_files").option("skip_incomplete", skip_incomplete).load(root)


def _plain(path):
    """A path without scheme, for joins of what different readers say."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def read_images(spark: SparkSession, root: str, skip_incomplete: bool = False) -> DataFrame:
    """split, stem, name, length, status, width, height, nChannels, data of every image file. status: ok, ``empty`` (no
    bytes) or ``corrupt`` (does not decode; no size and no data then)."""
    files = listed(spark, root, skip_incomplete).where(F.col("kind") == "images").where(F.col("ext").isin(*EXTENSIONS))
    pixels = spark.read.format("image").option("recursiveFileLookup", True).load(root).select(_plain("image.origin").alias("__at"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("nChannels"), F.col("image.data").alias("data"))
    out = files.join(pixels, _plain("path") == F.col("__at"), "left")
    status = F.when(F.col("length") == 0, "empty").when(F.coalesce("width", F.lit(-1)) < 0, "corrupt").otherwise("ok")
    good = lambda c: F.when(F.col("status") == "ok", F.col(c)).alias(c)
    return out.withColumn("status", status).select("split", "stem", "name", "length", "status", *[good(c) for c in ("width", "height", "nChannels", "data")])


def read_labels(spark: SparkSession, root: str, skip_incomplete: bool = False) -> DataFrame:
    """split, stem, length, text of every label file; the text of one of no bytes is empty."""
    files = listed(spark, root, skip_incomplete).where((F.col("kind") == "labels") & (F.col("ext") == "txt"))
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True).select(_plain(F.col("_metadata.file_path")).alias("__at"), F.col("value").alias("text"))
    return files.join(texts, _plain("path") == F.col("__at"), "left").select("split", "stem", "length", F.coalesce("text", F.lit("")).alias("text"))


def read_dataset(spark: SparkSession, root: str, skip_incomplete: bool = False) -> DataFrame:
    """The images of a dataset with their label text: read_images' columns, label and text. label: missing (no file),
    ``empty`` (one without text) or ``text``."""
    labels = read_labels(spark, root, skip_incomplete).select("split", "stem", "text")
    label = F.when(F.col("text").isNull(), "missing").when(F.trim("text") == "", "empty").otherwise("text")
    return read_images(spark, root, skip_incomplete).join(labels, ["split", "stem"], "left").withColumn("label", label)


def png(grey: bytes, width: int, height: int) -> bytes:
    """A grey image of 8 bits as a PNG file."""
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + grey[y * width : (y + 1) * width] for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


@F.pandas_udf(BinaryType())
def as_png(grey: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    return pd.Series([png(*x) for x in zip(grey, width, height, strict=True)])


def write_files(files: DataFrame, root: str) -> None:
    """Writes each row's content to its path below root, in a store that pyarrow reaches. A file gets its name when it
    is whole, so tasks can run twice."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        store, base = store_of(root)
        made: set[str] = set()
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{base}/{row['path']}"
                folder = at.rpartition("/")[0]
                if folder not in made:
                    store.create_dir(folder)
                    made.add(folder)
                beside = f"{folder}/.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(beside, compression=None) as f:
                    f.write(row["content"])
                store.move(beside, at)
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["n"])

    files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(put, "n bigint").agg(F.sum("n")).collect()
