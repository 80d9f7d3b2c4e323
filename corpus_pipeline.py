"""A corpus from documents to token ids, in stages that each work on all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import drop_path, scratch, table
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.mixing import mixed_documents
from tessera.llm.ngram_join import keep_one
from tessera.llm.pieces import encode_pieces
from tessera.llm.quality import keep_quality


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """With n_chars as the text now is."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(columns) if "n_chars" in columns else docs.select(columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects. Null text counts as empty, null sources and
    languages as groups of their own; rows without an id are judged, not learned from."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With each text less the blocks of lines that an earlier document has, null ids last. Every row stays;
    null text stays null, and n_chars is then null too."""
    return _counted(dedup_lines(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id. Texts without words are one
    group; a row without an id stays if nothing with one is like it; rows with the kept id stay all."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a row for each time that a document is taken, in the order of the
    schedule. Texts without words are never taken; null sources are one source, the last."""
    return _counted(mixed_documents(docs), docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, their number, and digests of them and of what they decode to. Null text counts
    as empty; an empty table gives an empty result in every stage."""
    return encode_pieces(docs, ids=True, decoded=False)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("encoding", encoding)]
#: The classifier is fitted by iteration and the join prunes by MinHash, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each is written and read again, and its table goes when the next is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            drop_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
