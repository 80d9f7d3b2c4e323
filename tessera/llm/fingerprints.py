"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import WORD, table, text_of

#: Samples that one row computes at once; more are dealt over as many rows as needed, so that
#: the generated code stays small enough to be compiled.
LANE = 2
#: Rows of a bucket, about; buckets of a range; and segments of equal rows that the ids are cut into.
NEAR, FAR, SEGMENTS = 128, 4096, 256


#: Bits of a sample.
SIGN = 24
LN2 = float(np.log(2.0))


def _buckets(docs: DataFrame) -> Column:
    """A number for each row (id, sign) that rises with the order of rows, for NEAR rows or so.

    Ids are cut at their quantiles into SEGMENTS, each into equal widths, so dense, sparse and hashed
    ids are dealt alike. Null ids come last, dealt by their text's hash.
    """
    marks = F.percentile_approx("id", [k / SEGMENTS for k in range(SEGMENTS + 1)], 20_000)
    n, none, at = docs.agg(F.count("id"), F.count_if(F.col("id").isNull()), marks).first()
    width = 2 ** max(0, ((none or 1) // NEAR).bit_length())
    last = F.shiftrightunsigned(F.col("sign").bitwiseXOR(-(2**63)), 65 - width.bit_length()) if width > 1 else F.lit(0).cast("long")
    if not n:
        return last
    cuts = sorted({*at[1:-1]})
    each = max(1, -(-n // (NEAR * (len(cuts) + 1))))  # buckets of a segment
    low, high = [at[0], *cuts], [*cuts, at[-1] + 1]
    place = F.size(F.filter(F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>"), lambda x: x <= F.col("id")))
    pick = lambda xs: F.get(F.lit([float(x) for x in xs]), place)
    inside = F.floor((F.col("id") - pick(low)) / (pick(high) - pick(low)) * each)
    known = place.cast("long") * each + F.greatest(F.lit(0), F.least(F.lit(each - 1), inside))
    return F.when(F.col("id").isNotNull(), known).otherwise((len(cuts) + 1) * each + last)


def _next_in_order(docs: DataFrame) -> DataFrame:
    """docs (id, text) by bucket, with next_text: the text of the next row by id, then a hash of the
    text, then text; null ids last; after the last row the first. ``guest`` marks a copy, at its end,
    of the row after a bucket's last.

    No task sorts all rows. Only the first row of each bucket goes to the bucket before it, which is
    found in two steps, within a range of buckets and among ranges.
    """
    docs = docs.withColumn("sign", F.xxhash64("text"))
    docs = docs.withColumn("bucket", _buckets(docs))
    keys = [F.col("id").asc_nulls_last(), "sign", "text"]
    heads = docs.withColumn("n", F.row_number().over(W.partitionBy("bucket").orderBy(*keys))).where("n = 1").drop("n")
    used = docs.select("bucket").distinct().withColumn("range", F.floor(F.col("bucket") / FAR))
    ring = W.partitionBy(F.lit(0)).orderBy("range")
    first = used.groupBy("range").agg(F.min("bucket").alias("first"))
    first = first.select("range", F.coalesce(F.lead("first").over(ring), F.first("first").over(ring)).alias("beyond"))
    after = F.coalesce(F.lead("bucket").over(W.partitionBy("range").orderBy("bucket")), F.col("beyond"))
    before = used.join(first, "range").select(F.col("bucket").alias("here"), after.alias("bucket"))
    guests = heads.join(before, "bucket").select("id", "text", "sign", F.col("here").alias("bucket"))
    both = docs.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    order = W.partitionBy("bucket").orderBy("guest", *keys)
    return both.select("bucket", "guest", "id", "text", F.row_number().over(order).alias("rank"), F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"))


def _salt(k: int) -> int:
    """A number of 62 bits that differs in about half of them from another k's."""
    return int.from_bytes(hashlib.sha256(b"%d" % k).digest()[:8], "big") >> 2


def _chebyshev(f, low: float, high: float, degree: int) -> list[float]:
    """The polynomial, highest power first, that meets f at the Chebyshev points of an interval."""
    x = (low + high) / 2 + (high - low) / 2 * np.cos(np.pi * (2 * np.arange(degree + 1) + 1) / (2 * degree + 2))
    return [float(v) for v in np.polyfit(x, f(x), degree)]


#: -ln(q) / (1 - q) on [1/4, 1], and 2**-f on [0, 1]: Spark's own ln and exp take most of the time else.
_LOG = _chebyshev(lambda q: -np.log(q) / (1 - q), 0.25, 1.0, 7)
_EXP = _chebyshev(lambda f: 2.0**-f, 0.0, 1.0, 5)


def _poly(coefficients: list[float], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def _bits(x: str, at: int, n: int) -> Column:
    return F.shiftrightunsigned(F.col(x), at).bitwiseAND(2**n - 1)


def _samples(terms: DataFrame, keys: list[str]) -> DataFrame:
    """The samples of LANE numbers, the least over the terms of a group.

    By Ioffe's method: r and c of a term and a sample are Gamma(2, 1) distributed, b uniform; with x
    the log of the weight, t = floor(x / r + b), and the term with the least a = c exp(-r (t - b + 1))
    is drawn, as (term, t). A long holds a in its upper bits and a hash of (term, t) in the lowest
    SIGN, so the least long is the sample. The steps stand as columns of their own, without branches,
    so each is computed once.

    A Gamma(2, 1) number is -ln(u v) of two uniform ones. Their binary exponents are the places of the
    two lowest set bits of a hash, their mantissas are other bits of it, with q a quarter of the
    mantissas' product; so it is k ln 2 - ln q, with a polynomial for the latter.
    """
    js, carried = range(LANE), [*keys, "term", "x"]
    terms = terms.select(*carried, *[F.xxhash64(F.col("term").bitwiseXOR(_salt(j))).alias(f"h{j}") for j in js])
    terms = terms.select(*carried, *[f"h{j}" for j in js], *[F.xxhash64(f"h{j}").alias(f"y{j}") for j in js])

    def lowest(x: str, n: int) -> Column:
        """The n lowest bits of a hash, with two more set above them, but for the lowest one set."""
        z = F.col(x).bitwiseAND(2**n - 1).bitwiseOR(3 << n)
        return z.bitwiseAND(z - 1)

    def quarter(x: str, at: int, n: int) -> Column:
        one = lambda at: _bits(x, at, n) * 2.0**-n + (1 + 2.0 ** -(n + 1))
        return one(at) * one(at + n) * 0.25

    kinds = (("r", "h", 22, 10), ("c", "y", 24, 20))
    terms = terms.select(*carried, *[_bits(f"h{j}", 42, 22).alias(f"b{j}") for j in js], *[lowest(f"{y}{j}", n).alias(f"z{x}{j}") for x, y, n, _ in kinds for j in js], *[quarter(f"{y}{j}", n, m).alias(f"q{x}{j}") for x, y, n, m in kinds for j in js])
    gamma = lambda x, j: (F.bit_count(F.col(f"z{x}{j}").bitwiseXOR(F.col(f"z{x}{j}") - 1)) - 2) * LN2 + (1 - F.col(f"q{x}{j}")) * _poly(_LOG, F.col(f"q{x}{j}"))
    terms = terms.select(*carried, *[((F.col(f"b{j}") + 0.5) * 2.0**-22).alias(f"b{j}") for j in js], *[gamma(x, j).alias(f"{x}{j}") for x in "rc" for j in js])
    terms = terms.select(*carried, *[f"{x}{j}" for x in "brc" for j in js], *[F.floor(F.col("x") / F.col(f"r{j}") + F.col(f"b{j}")).alias(f"t{j}") for j in js])
    terms = terms.select(*carried, *[f"{x}{j}" for x in "ct" for j in js], *[F.least(F.col(f"r{j}") * (F.col(f"t{j}") - F.col(f"b{j}") + 1.0) * (1 / LN2), F.lit(58.0)).alias(f"e{j}") for j in js])
    least = []
    for j in js:
        e, whole = F.col(f"e{j}"), F.col(f"e{j}").cast("int")
        a = F.least(F.col(f"c{j}") * _poly(_EXP, e - whole), F.lit(7.9)) * 2.0**59
        a = F.call_function("shiftright", a.cast("long"), whole).bitwiseAND(-(2**SIGN))
        least.append(F.min(a.bitwiseOR(F.col("term").bitwiseXOR(F.col(f"t{j}")).bitwiseAND(2**SIGN - 1))).alias(f"s{j}"))
    return terms.groupBy(*keys).agg(*least)


def likeness(a: Column, b: Column) -> Column:
    """The share of samples in which two fingerprints (arrays) agree; two of no terms are alike."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a).cast("double")


def fingerprints(docs: DataFrame, samples: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints each text and its edited text (its last quarter replaced by the next text's start).

    The weight of a term (a word) is how often the text holds it; the share of equal samples
    of two fingerprints estimates the generalised Jaccard similarity of their weights, with a
    standard error of sqrt(J (1 - J) / samples).

    Returns per row: id, n_chars, edited_sha256, fingerprint and edited_fingerprint (six hex
    digits a sample), near_edited, near_next. The words up to the cut are counted once for
    both texts. Texts are dealt once, by ranges of ids; counting, sampling and comparing stay in
    those partitions.

    Null text counts as empty; a text without words has an empty fingerprint, alike only to
    another such. Null ids come last, rows with one id in order of a hash of their text; repeated
    rows each get a row. A single row is its own next. An empty table gives an empty result. Ids must
    be whole numbers or text that reads as such.
    """
    lanes = -(-samples // LANE)
    base = _next_in_order(docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")))
    n = F.char_length("text")
    q = F.floor(n / 4).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n - q)
    base = base.withColumn("n", n).withColumn("kept", kept).withColumn("new", F.substring(F.col("next_text"), F.lit(1), q))
    edited = F.concat("kept", "new")
    facts = base.select("bucket", "rank", "guest", "id", F.col("n").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"))

    # words before the cut, and the rests of either text
    head = F.regexp_replace("kept", r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]++\z", "")
    words = base.withColumn("head", F.char_length(head))
    find = lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))
    rest = lambda x: find(F.substring(x, F.col("head") + 1, F.lit(2**31 - 1)))
    parts = F.array(
        F.struct(F.lit(1).alias("a"), F.lit(1).alias("b"), find(F.substring(F.col("kept"), F.lit(1), F.col("head"))).alias("w")),
        F.struct(F.lit(1).alias("a"), F.lit(0).alias("b"), rest(F.col("text")).alias("w")),
        F.struct(F.lit(0).alias("a"), F.lit(1).alias("b"), rest(edited).alias("w")),
    )
    tokens = words.select("bucket", "rank", F.explode(parts).alias("p")).select("bucket", "rank", "p.a", "p.b", F.explode("p.w").alias("word"))
    terms = tokens.groupBy("bucket", "rank", F.xxhash64("word").alias("term")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # a weight that both texts give a term is sampled once, for both
    weight = lambda sides, n: F.struct(F.lit(sides).alias("sides"), F.ln(F.greatest(F.col(n), F.lit(1)).cast("double")).alias("x"))
    mine, other = F.when(F.col("a") > 0, weight(1, "a")), F.when(F.col("b") > 0, weight(2, "b"))
    terms = terms.select("bucket", "rank", "term", F.explode(F.when(F.col("a") == F.col("b"), F.array(weight(3, "a"))).otherwise(F.array_compact(F.array(mine, other)))).alias("w"))
    deal = F.array(*[F.struct(F.lit(i).alias("lane"), F.lit(_salt(LANE + i)).alias("salt")) for i in range(lanes)])
    terms = terms.select("bucket", "rank", "term", "w.sides", "w.x", F.explode(deal).alias("d"))
    terms = terms.select("bucket", "rank", "d.lane", "sides", F.col("term").bitwiseXOR(F.col("d.salt")).alias("term"), "x")
    least = _samples(terms, ["bucket", "rank", "lane", "sides"])
    of = lambda side: [F.min(F.when(F.col("sides").bitwiseAND(side) > 0, F.col(f"s{j}"))) for j in range(LANE)]
    low = lambda cs: F.array(*[c.bitwiseAND(2**SIGN - 1) for c in cs])
    least = least.groupBy("bucket", "rank", "lane").agg(low(of(1)).alias("a"), low(of(2)).alias("b"))
    signs = least.groupBy("bucket", "rank").agg(F.array_sort(F.collect_list(F.struct("lane", "a", "b"))).alias("s"))  # one a lane
    signs = signs.select("bucket", "rank", F.slice(F.flatten("s.a"), 1, samples).alias("mine"), F.slice(F.flatten("s.b"), 1, samples).alias("other"))

    none = F.array_repeat(F.lit(None).cast("long"), samples)
    out = facts.join(signs, ["bucket", "rank"], "left")
    out = out.withColumn("mine", F.coalesce("mine", none)).withColumn("other", F.coalesce("other", none))
    out = out.withColumn("theirs", F.lead("mine").over(W.partitionBy("bucket").orderBy("rank"))).where("NOT guest")
    text = lambda x: F.array_join(F.transform(x, lambda v: F.lower(F.lpad(F.hex(v), SIGN // 4, "0"))), "")
    return out.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        text(F.col("mine")).alias("fingerprint"),
        text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("mine"), F.col("other")).alias("near_edited"),
        likeness(F.col("mine"), F.col("theirs")).alias("near_next"),
    )


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {"op8_document_fingerprints": op8_document_fingerprints}
