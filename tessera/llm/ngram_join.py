"""Similarity join on word n-grams with Bayesian pruning of MinHash candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, table, text_of, written
from .components import components

#: Words of an n-gram, least similarity, and the posterior below which a pair is dropped.
WORDS, SIMILAR, TOLERANCE = 5, 0.8, 1e-4
#: MinHash values, those of a band, and those that one step compares.
HASHES, ROWS, STEP = 128, 4, 16
BANDS = HASHES // ROWS
#: Members of a bucket or a component that are compared with one another in one block.
BLOCK = 256


@cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, HASHES, dtype=np.uint64)


class Shingler:
    """Turns texts into sets of n-gram hashes; the hashes of words are kept in a bounded memo."""

    def __init__(self, n: int, most: int = 200_000):
        from xxhash import xxh3_64_intdigest

        self.n, self.most, self.memo, self.digest = n, most, {}, xxh3_64_intdigest

    def __call__(self, text: str) -> np.ndarray:
        """The sorted 64-bit hashes of a text's n-grams; of all its words if they are fewer than n."""
        words = text.encode(errors="surrogatepass").split()
        known, out = self.memo, []
        for w in words:
            h = known.get(w)
            if h is None:
                if len(known) >= self.most:
                    known.clear()
                h = known[w] = self.digest(w)
            out.append(h)
        h = np.array(out, np.uint64)
        if not len(h):
            return h
        n = min(self.n, len(h))
        grams = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):
            grams = (grams ^ h[j : len(h) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
        return np.unique(grams)


def minhash(grams: np.ndarray) -> np.ndarray:
    """HASHES values of 16 bits, of a set that is not empty."""
    a, b = _factors()
    best = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(grams), 256):
        best = np.minimum(best, (np.multiply.outer(grams[at : at + 256], a) + b).min(axis=0))
    return ((best * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.uint16)


@cache
def least_matches(similar: float, tolerance: float) -> list[int]:
    """After each step, the fewest equal values with which the posterior probability of
    similarity >= similar, from a uniform prior, is tolerance or more.

    With m of n equal the posterior is Beta(m + 1, n - m + 1), and its tail beyond s is the chance
    that Binomial(n + 1, s) is m or less.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = (1 - similar) ** (n + 1), 0
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * similar**m * (1 - similar) ** (n + 1 - m)
        out.append(m)
    return out


def missed(similar: float, least: list[int]) -> float:
    """The chance that a step drops a pair of this similarity."""
    step = [comb(STEP, k) * similar**k * (1 - similar) ** (STEP - k) for k in range(STEP + 1)]
    alive = {0: 1.0}
    for m in least:
        after: dict[int, float] = {}
        for k, p in alive.items():
            for j, q in enumerate(step):
                if k + j >= m:
                    after[k + j] = after.get(k + j, 0.0) + p * q
        alive = after
    return 1 - sum(alive.values())


@cache
def pruning(similar: float, tolerance: float) -> list[int]:
    """The fewest equal values after each step, so that all steps together and the bands miss a pair at the
    threshold with a chance under tolerance."""
    bands, each = (1 - similar**ROWS) ** BANDS, tolerance
    while missed(similar, least := least_matches(similar, each)) + bands >= max(tolerance, 2 * bands) and each > 1e-15:
        each /= 2
    return least


def surviving(a: np.ndarray, b: np.ndarray, band: int, same: bool, least: list[int]) -> np.ndarray:
    """Which pairs of two lists of signatures outlast every comparison step; only pairs that meet in
    no earlier band count, and of a list with itself those above the diagonal."""
    x, y = a.view(np.uint64), b.view(np.uint64)
    alive = np.triu(np.ones((len(a), len(b)), bool), 1) if same else np.ones((len(a), len(b)), bool)
    for k in range(band):
        alive &= x[:, None, k] != y[None, :, k]
    i, j = np.nonzero(alive)
    found = np.zeros(len(i), np.int32)
    for k, m in enumerate(least):
        at = slice(k * STEP, (k + 1) * STEP)
        found += (a[i, at] == b[j, at]).sum(axis=1, dtype=np.int32)
        on = found >= m
        if not on.all():
            i, j, found = i[on], j[on], found[on]
    out = np.zeros_like(alive)
    out[i, j] = True
    return out


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a square boolean matrix of links joins: (member, root)."""
    links = links | links.T
    seen, out = np.zeros(len(links), bool), []
    for i in range(len(links)):
        if seen[i]:
            continue
        seen[i] = True
        front = [i]
        while len(front):
            new = np.nonzero(links[front].any(axis=0) & ~seen)[0]
            seen[new] = True
            out += [(int(j), i) for j in new]
            front = new
    return out


def similarities(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Jaccard similarity of a[i] and b[j], for lists of places. Where the pairs are a large part of all,
    the sets are laid out as a matrix, a bounded range of values at a time."""
    if 8 * len(i) < len(a) * len(b) or len(a) * len(b) <= 16:
        common = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], float)
    else:
        full = np.zeros((len(a), len(b)), np.float32)
        values, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
        ends = np.cumsum([len(x) for x in [*a, *b]])[:-1]
        rows = np.split(place, ends)
        for at in range(0, len(values), 4096):
            dense = np.zeros((len(rows), 4096), np.float32)
            for k, r in enumerate(rows):
                dense[k, r[np.searchsorted(r, at) : np.searchsorted(r, at + 4096)] - at] = 1
            full += dense[: len(a)] @ dense[len(a) :].T
        common = full[i, j]
    sizes = np.array([len(x) for x in a])[i] + np.array([len(x) for x in b])[j]
    return common / np.maximum(sizes - common, 1)


def parts_of(alive: np.ndarray, same: bool) -> Iterator[tuple[list[int], list[int], np.ndarray]]:
    """Cuts the pairs of a boolean matrix into parts (rows, columns, matrix) that name members twice a
    pair at most: all rows and columns that have a pair if there are as many pairs, else row by row."""
    rows, columns = np.nonzero(alive.any(axis=1))[0], np.nonzero(alive.any(axis=0))[0]
    if not len(rows):
        return
    if 2 * alive.sum() >= len(rows) + len(columns):
        yield [int(x) for x in rows], [int(x) for x in columns], alive[np.ix_(rows, columns)]
        return
    for r in rows:
        columns = np.nonzero(alive[r])[0]
        yield [int(r)], [int(x) for x in columns], np.ones((1, len(columns)), bool)


def by_block(df: DataFrame, keys: list[str], run: Callable[[dict[str, list]], Iterator[tuple]], schema: str) -> DataFrame:
    """Runs a function on the rows of each key. Rows come sorted, so that one block at a time is in
    memory, and blocks of few rows cost no round trip of their own."""
    names = [x.split()[0] for x in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, rows = None, []

        def emitted(force: bool) -> Iterator[pa.RecordBatch]:
            if out and (force or len(out) >= 4096):
                for start in range(0, len(out), 4096):
                    columns = zip(*out[start : start + 4096], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
                out.clear()

        kinds = {"binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}
        types = [kinds[x.split()[1]] for x in schema.split(", ")]
        for batch in batches:
            for start in range(0, len(batch), 64):  # a batch of n-gram sets can be large
                for row in batch.slice(start, 64).to_pylist():
                    at = tuple(row[k] for k in keys)
                    if at != key and rows:
                        out.extend(run(rows))
                        yield from emitted(False)
                        rows = []
                    key = at
                    rows.append(row)
        if rows:
            out.extend(run(rows))
        yield from emitted(True)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(frugal(each), schema)


def in_blocks(df: DataFrame, group: list[str], node: str, size: str) -> DataFrame:
    """Deals each group's rows over pairs of chunks (c1 <= c2) of about BLOCK rows: any two rows of a
    group meet in one pair. mine: the row's chunk."""
    chunks = F.ceil(F.col(size) / BLOCK).cast("int")
    df = df.withColumn("chunks", chunks).withColumn("mine", F.pmod(F.xxhash64(node), F.col("chunks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return df.withColumn("c1", F.least("mine", "other")).withColumn("c2", F.greatest("mine", "other")).drop("chunks", "other")


def _halves(rows: list[dict]) -> tuple[list[dict], list[dict], bool]:
    c1, c2 = rows[0]["c1"], rows[0]["c2"]
    return [r for r in rows if r["mine"] == c1], [r for r in rows if r["mine"] == c2], c1 == c2


def similar_classes(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Joins documents whose n-gram sets have a Jaccard similarity of ``similar`` or more.

    Returns per input row: id, class_id, class_size, n_links, n_linked, group_id. A class is the
    documents with one set of n-grams (copies, but for white space); class_id is its smallest id.
    n_links: classes that this one is linked to; n_linked: their documents. group_id: smallest
    id of those that links connect.

    Classes meet in buckets of LSH bands, where MinHash values are compared step by step and
    pairs that are unlikely to reach the threshold dropped. Pairs that outlast all steps, and no
    others, are verified on the exact n-gram sets, each once, where they meet first. Buckets are
    dealt over blocks of bounded size. A block hands on a bit per pair and each member's set twice a
    pair at most, and gives counts and spanning edges rather than pairs; so large buckets neither
    meet in a task nor multiply rows, and the work grows with the links. A link at the threshold is
    missed with a probability under tolerance, or where the bands alone miss more, under twice
    theirs, (1 - similar**ROWS)**BANDS.

    Null text counts as empty. Texts of fewer than n words are one n-gram; those without words
    are one class without links. A null id counts as largest; repeated rows are copies of one
    another; other columns are ignored; an empty table gives an empty result. Ids must be whole
    numbers or text that reads as such.
    """
    least = pruning(similar, tolerance)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shingle = Shingler(words)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                nodes, signs = [], []
                for text in part.column(1).to_pylist():
                    grams = shingle(text)
                    nodes.append(xxh3_128_digest(grams.tobytes()))
                    signs.append(minhash(grams).tobytes() if len(grams) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes, pa.binary()), pa.array(signs, pa.binary())], ["id", "node", "sign"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        shingle = Shingler(words)
        for batch in batches:
            for at in range(0, len(batch), 64):
                grams = [shingle(t).tobytes() for t in batch.slice(at, 64).column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(map(xxh3_128_digest, grams), pa.binary()), pa.array(grams, pa.binary())], ["node", "grams"])

    def candidates(rows: list[dict]) -> Iterator[tuple]:
        """(part, side, at, node, class_size, mask) of the members of surviving pairs."""
        from xxhash import xxh3_128_digest

        a, b, same = _halves(rows)
        if not a or not b:
            return
        x = np.array([np.frombuffer(r["sign"], np.uint16) for r in a])
        y = x if same else np.array([np.frombuffer(r["sign"], np.uint16) for r in b])
        block = b"%d/%d/%d/" % (rows[0]["band"], rows[0]["c1"], rows[0]["c2"]) + rows[0]["key"]
        for k, (i, j, alive) in enumerate(parts_of(surviving(x, y, rows[0]["band"], same, least), same)):
            part = xxh3_128_digest(b"%d/" % k + block)
            for n, r in enumerate(i):
                yield part, 0, n, a[r]["node"], a[r]["class_size"], np.packbits(alive[n]).tobytes()
            for n, r in enumerate(j):
                yield part, 1, n, b[r]["node"], b[r]["class_size"], None

    def verify(rows: list[dict]) -> Iterator[tuple]:
        """(node, linked node or null, links, linked documents): edges have no counts, counts no edge."""
        a, b = ([r for r in rows if r["side"] == side] for side in (0, 1))
        a.sort(key=lambda r: r["at"]), b.sort(key=lambda r: r["at"])
        alive = np.array([np.unpackbits(np.frombuffer(r["mask"], np.uint8), count=len(b)) for r in a]).astype(bool)
        i, j = np.nonzero(alive)
        x, y = ([np.frombuffer(r["grams"], np.uint64) for r in side] for side in (a, b))
        on = similarities(x, y, i, j) >= similar
        i, j = i[on], j[on]
        place: dict[bytes, int] = {}
        for r in a + b:
            place.setdefault(r["node"], len(place))
        links = np.zeros((len(place),) * 2, bool)
        links[[place[a[k]["node"]] for k in i], [place[b[k]["node"]] for k in j]] = True
        nodes = list(place)
        for k, root in forest(links):
            yield nodes[k], nodes[root], 0, 0
        for these, mine, others, theirs in ((a, i, b, j), (b, j, a, i)):
            size = np.array([r["class_size"] for r in others])
            n, m = np.bincount(mine, minlength=len(these)), np.bincount(mine, size[theirs], len(these))
            for k in np.nonzero(n)[0]:
                yield these[k]["node"], None, int(n[k]), int(m[k])

    end = 2**63 - 1
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(end))
    base = docs.select(ident.alias("id"), text_of(text_col).alias("text"))
    signed = written(base.mapInArrow(frugal(sign), "id bigint, node binary, sign binary"))
    classes = written(signed.groupBy("node").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"), F.first("sign").alias("sign")))

    # candidates: classes that share a band
    width = ROWS * 2
    bands = F.array(*[F.struct(F.lit(k).alias("band"), F.substring("sign", k * width + 1, width).alias("key")) for k in range(BANDS)])
    banded = classes.where("sign IS NOT NULL").select("node", F.explode(bands).alias("b")).select("b.band", F.col("b.key").alias("key"), "node")
    live = banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = banded.join(live, ["band", "key"]).join(classes.select("node", "sign", "class_size"), "node")
    blocks = in_blocks(met, ["band", "key"], "node", "n").select("band", "key", "c1", "c2", "mine", "node", "sign", "class_size")
    parts = written(by_block(blocks, ["band", "key", "c1", "c2"], candidates, "part binary, side int, at int, node binary, class_size bigint, mask binary"))

    # exact verification of the pairs that survive
    members = parts.select("node").distinct().join(classes.select("node", "class_id"), "node")
    texts = base.join(members.select(F.col("class_id").alias("id")).distinct(), "id", "left_semi").select("text")
    grams = texts.mapInArrow(frugal(sets), "node binary, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))
    found = written(by_block(parts.join(grams, "node"), ["part"], verify, "a binary, b binary, n bigint, m bigint"))
    groups = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"), F.sum("m").alias("n_linked"))
    heads = groups.join(classes.select("node", "class_id"), "node").groupBy("root").agg(F.min("class_id").alias("group_id"))
    linked = counts.join(groups, "node").join(heads, "root").select("node", "n_links", "n_linked", "group_id")
    facts = classes.select("node", "class_id", "class_size").join(linked, "node", "left")
    none = lambda c: F.when(F.col(c) != end, F.col(c))
    zero = F.lit(0).cast("long")
    return (
        signed.select("id", "node")
        .join(facts, "node")
        .select(none("id").alias(id_col), none("class_id").alias("class_id"), "class_size", F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_linked", zero).alias("n_linked"), none("group_id").alias("g"), F.col("group_id").isNull().alias("alone"))
        .select(id_col, "class_id", "class_size", "n_links", "n_linked", F.when(F.col("alone"), F.col("class_id")).otherwise(F.col("g")).alias("group_id"))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of docs whose id is the smallest of its group; with one id several times, all of them.

    Rows with a null id stay if nothing with an id is like them.
    """
    first = similar_classes(docs, id_col=id_col, **settings).where(F.col("group_id").eqNullSafe(F.col(id_col))).select(F.col(id_col).alias("__id")).distinct()
    return docs.join(first, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op1_ngram_jaccard_join": op1_ngram_jaccard_join}
