"""Phrases whose words keep company: collocations by counts of phrases and of their parts."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property, reduce
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import frugal, scratch, table, text_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What ends a piece, with the spaces after it (Java's expression).
PIECE_END = r"[.,;:!?\x0A-\x0D][.,;:!?\x0A-\x0D\x20]*"
#: Bytes of pieces whose phrases are counted at once, rows of partial counts in a hash bucket, memory of one database.
CHUNK, BUCKET_ROWS, MEMORY = 4 << 20, 2_000_000, "256MB"
#: Rows of counts that a task hands on at once.
ROWS = 50_000
#: Bits of the filter of frequent phrases, whatever their number: what a task gets has this size, 16 MB.
FILTER_BITS = 1 << 27
#: Score of a phrase whose words occur only in it, and the scale of all scores.
SCALE = 1_000_000
#: Parts that a language's candidates are dealt over when its best are sought.
DEAL = 256


def pieces(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, piece, words, m): each different piece of text once, its words joined by one space, their number, and how
    often it occurs. Copies and common lines become one row, with counts combined before the shuffle."""
    text = F.translate(text_of(text_col), UPPER + "\t", LOWER + " ")
    each = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text.alias("text"))
    each = each.withColumn("text", F.when(F.contains("text", F.lit("  ")), F.regexp_replace("text", " {2,}", " ")).otherwise(F.col("text")))
    each = each.select("lang", F.explode(F.split("text", PIECE_END)).alias("piece")).select("lang", F.trim("piece").alias("piece")).where("piece != ''")
    spaces = F.octet_length("piece") - F.octet_length(F.replace("piece", F.lit(" "), F.lit("")))
    found = each.groupBy("lang", "piece").agg(F.count("*").alias("m"))
    return found.select("lang", "piece", (spaces + 1).alias("words"), "m")


class Grams:
    """The phrases of k words of a chunk of pieces, as places of their first words, and hashes of phrases."""

    def __init__(self, chunk: pa.Table, column: str = "piece"):
        words = pc.split_pattern(chunk.column(column).combine_chunks(), " ")
        coded, lang = words.flatten().dictionary_encode(), chunk.column("lang").combine_chunks().dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(len(order))
        self.words, self.langs = coded.dictionary.take(order), lang.dictionary
        size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(size)), size)
        self.left = np.repeat(np.cumsum(size), size) - np.arange(len(self.row))  # words of the piece from each on
        self.word = rank[coded.indices.to_numpy(zero_copy_only=False)]
        self.lang = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.row]

    @cached_property
    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words and of the languages."""
        from xxhash import xxh3_64_intdigest as digest

        return tuple(np.array([digest(x) for x in a.to_pylist()], np.uint64) for a in (self.words, self.langs))

    def at(self, k: int) -> np.ndarray:
        """Where phrases of k words begin."""
        return np.nonzero(self.left >= k)[0]

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """Of phrases of k words in their language; the same in any chunk."""
        words, langs = self.digests
        out = langs[self.lang[at]]
        for j in range(k):
            out = (out ^ words[self.word[at + j]]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.word[at + j])) for j in range(k)]
        return pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]

    def summed(self, at: np.ndarray, k: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A place of each different phrase of k words among these, by language and words, and the sum of its pieces' m."""
        code, below = self.lang[at], len(self.langs)  # numbers the phrase so far
        for j in range(k):
            if below * len(self.words) >= 2**63:
                code, below = np.unique(code, return_inverse=True)[1], len(at)
            code, below = code * len(self.words) + self.word[at + j], below * len(self.words)
        order = np.argsort(code)
        code = code[order]
        first = np.nonzero(np.diff(code, prepend=-1))[0]
        return at[order[first]], np.add.reduceat(m[self.row[at[order]]], first) if len(at) else m[:0]


def passing(grams: Grams, k: int, bits: np.ndarray | None) -> np.ndarray:
    """Where phrases of k words begin, less those that have a shorter phrase in them which is surely not frequent."""
    at = grams.at(k)
    if bits is None:
        return at
    slots = np.uint64(len(bits) * 8)
    for j in (0, 1):
        h = grams.hashes(at + j, k - 1) % slots
        at = at[(bits[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


@contextmanager
def _database(folder: str | None):
    """A database in memory that goes on in ``folder`` when MEMORY is full; without a folder it has to fit."""
    import duckdb

    at = folder and os.path.join(folder, f"bucket-{uuid.uuid4().hex}")
    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "preserve_insertion_order": False, "temp_directory": at or ""})
    try:
        yield con
    finally:
        con.close()
        if at:
            shutil.rmtree(at, ignore_errors=True)


def _shared_folder(spark: SparkSession) -> str | None:
    """Where databases may spill: below the folder that all share, if that is a mounted one."""
    at = urlparse(scratch(spark))
    return at.path if at.scheme in ("", "file") else None


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of batches in tables of about ``size`` bytes, a row at least."""
    held, held_bytes = [], 0
    for batch in batches:
        step = max(1, int(len(batch) * size / max(1, batch.nbytes)))
        for at in range(0, len(batch), step):
            held.append(batch.slice(at, step))
            held_bytes += held[-1].nbytes
            if held_bytes >= size:
                yield pa.Table.from_batches(held)
                held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held)


def frequent_bits(counts: DataFrame, k: int, bits: int) -> np.ndarray:
    """A filter of ``bits`` bits in which each of these phrases of k words has its bit: no phrase of theirs is missed."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, CHUNK):
            grams = Grams(chunk, "phrase")
            h = np.unique(grams.hashes(grams.at(k), k) % np.uint64(bits))
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (h & np.uint64(63))).view(np.int64))], ["word", "mask"])

    found = counts.select("lang", "phrase").mapInArrow(frugal(slots), "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return out.view(np.uint8)


def counted(found: DataFrame, longest: int, least: int, bits: int = FILTER_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(lang, phrase, n) of phrases of 1 to ``longest`` words that occur ``least`` times or more, from pieces.

    Shorter phrases first. Each task takes the phrases of a bounded chunk of pieces, leaves out those with a shorter phrase
    in them that is not frequent, and sums the chunk's by numbers of its words; so a phrase that stands in a third of all
    pieces leaves the task as a row a chunk. Partial counts go to hash buckets of about ``bucket_rows`` rows, and a database
    in each bucket sums them, out of core where MEMORY is not enough. What is not frequent is known from a filter of a fixed
    number of ``bits`` that all tasks get: it never leaves out a frequent phrase, and where frequent phrases are too
    many for it, it leaves out less.
    """
    spark, kind = found.sparkSession, "lang string, phrase string, n bigint"
    folder, types, names = _shared_folder(spark), [pa.string(), pa.string(), pa.int64()], ["lang", "phrase", "n"]

    def of_length(k: int, known) -> DataFrame:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk in chunks(batches, CHUNK):
                grams = Grams(chunk)
                places, sums = grams.summed(passing(grams, k, known.value if known else None), k, chunk.column("m").to_numpy())
                for i in range(0, len(places), ROWS):
                    at = places[i : i + ROWS]
                    yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip([grams.langs.take(pa.array(grams.lang[at])), grams.phrases(at, k), pa.array(sums[i : i + ROWS])], types, strict=True)], names)

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = next(batches, None)
            if first is None:
                return
            with _database(folder) as con:
                con.register("t", pa.RecordBatchReader.from_batches(first.schema, chain([first], batches)))
                for batch in con.sql(f"SELECT lang, phrase, sum(n)::BIGINT AS n FROM t GROUP BY ALL HAVING sum(n) >= {int(least)}").to_arrow_reader(ROWS):
                    yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, types, strict=True)], names)

        parts = found.where(F.col("words") >= k).select("lang", "piece", "m").mapInArrow(frugal(partial), kind)
        return written(parts.repartition(buckets, "lang", "phrase").mapInArrow(frugal(total), kind))

    words = found.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // bucket_rows))
    out = []
    for k in range(1, longest + 1):
        known = spark.sparkContext.broadcast(frequent_bits(out[-1], k - 1, bits)) if out else None
        out.append(of_length(k, known))
        if known:
            known.unpersist()
    return reduce(DataFrame.unionByName, out)


def scored(counts: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, k, a, l, r, score) of every phrase of 2 words or more, by its lowest-scoring cut.

    Each candidate asks for the counts of the two parts of every cut; requests are shuffled to where the counts are and
    the answers go back to the candidate. A part is at least as common as the whole, so all are among ``counts``. Spark
    splits what many ask for, as answers are one row each.
    """
    words = F.split("phrase", " ")
    whole = counts.withColumn("w", words).where((F.size("w") > 1) & (F.col("n") >= least)).select("lang", "phrase", "w", F.col("n").alias("a"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    side = lambda name, part: F.struct(F.lit(name).alias("side"), F.array_join(part, " ").alias("part"))
    asked = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(side("l", F.slice("w", 1, F.col("k"))), side("r", F.slice("w", F.col("k") + 1, F.size("w") - F.col("k"))))).alias("q"))
    asked = asked.select("lang", "phrase", "a", "k", "q.side", "q.part")
    answers = asked.join(counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"])
    both = answers.groupBy("lang", "phrase", "a", "k").agg(*[F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in ("l", "r")])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = both.withColumn("top", (F.lit(SCALE).cast("decimal(8,0)") * (wide("a") * wide("a")).cast("decimal(30,0)")).cast("decimal(38,0)")).withColumn("under", (wide("l") * wide("r")).cast("decimal(38,0)"))
    both = both.withColumn("score", F.expr("top div under"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "b.k", "a", "b.l", "b.r", "b.score")


def not_inside(candidates: DataFrame, share: int = 50) -> DataFrame:
    """Without the candidates whose words lie inside a longer candidate that occurs at least share % as often."""
    w = F.split("phrase", " ")
    n = F.size(w)
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))))
    longer = candidates.where(n > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def best_per_lang(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each lang by score, count and phrase, with rank. Candidates are dealt over parts first, whose
    best alone meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(DEAL)))
    dealt = dealt.withColumn("rank", F.row_number().over(W.partitionBy("lang", "__part").orderBy(*order))).where(F.col("rank") <= most)
    ranked = dealt.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= most).drop("__part")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, most: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The phrases of 2 to ``longest`` words that occur ``least`` times or more and whose words belong together.

    A phrase that occurs a times, cut into parts that occur l and r times, scores floor(SCALE * a * a / (l * r)); its
    lowest-scoring cut counts, of equal ones the first. Phrases inside a longer one that occurs share % as often go.
    Returns the first ``most`` of each language: lang, rank, phrase, a, l, r, n (words of the language), score.

    Equal pieces are counted once, with their number. Null text counts as empty, null lang as ``und``; texts without
    words give nothing, and so does an empty table; other columns are ignored. Ties go by count, then by phrase in
    the order of its bytes. Arithmetic is exact while phrases occur under 10**15 times.
    """
    found = written(pieces(docs, text_col, lang_col))
    words = found.groupBy("lang").agg(F.sum(F.col("words") * F.col("m")).alias("n"))
    counts = counted(found, longest, least)
    kept = not_inside(scored(counts, longest, least), share)
    return best_per_lang(kept, most).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = {
    "op13_phrase_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, 1 AS k, unnest(w) AS phrase FROM w UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
u AS (SELECT lang, phrase, k, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp FROM (SELECT c.*, unnest(range(1, k)) AS cut FROM c)),
v AS MATERIALIZED (SELECT u.*, f.f AS l FROM u JOIN f ON f.lang = u.lang AND f.phrase = u.lp),
s AS MATERIALIZED (SELECT v.*, f.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * f.f) AS score FROM v JOIN f ON f.lang = v.lang AND f.phrase = v.rp),
b AS (SELECT lang, phrase, k, a, arg_min(l, (score, cut)) AS l, arg_min(r, (score, cut)) AS r, min(score)::BIGINT AS score FROM s GROUP BY ALL),
i AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
d AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT lang, rank, phrase, a, l, r.r, n, score FROM r JOIN t USING (lang) WHERE rank <= 2000
""",
}
QUERIES = {"op13_phrase_collocations": op13_phrase_collocations}
