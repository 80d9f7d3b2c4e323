"""Line dedup by pairwise alignment of documents that share rare lines."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, table, text_of, written

#: Words that an aligned block has at least, if not all of its lines are rare.
MIN_WORDS = 25
#: Documents that have a rare line at most, and words of shared rare lines that make two documents a pair.
RARE, LINK_WORDS = 10, 8
#: Pairs of one first document that a task gets, about.
DEAL = 256
KEY = "struct<none:boolean,id:bigint,sign:bigint>"


def line_facts(text: str, min_words: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Of the lines with words: numbers, hashes, word counts; and the hashes of the shortest runs
    of lines that have min_words words or more, from each line on."""
    from xxhash import xxh64_intdigest as digest

    at, hashes, words = [], [], []
    for i, line in enumerate(text.split("\n")):
        if parts := line.split():
            at.append(i)
            hashes.append(digest(" ".join(parts)) - 2**63)
            words.append(len(parts))
    runs, j, n = set(), 0, 0
    for i in range(len(hashes)):
        while j < len(hashes) and n < min_words:
            n += words[j]
            j += 1
        if n < min_words:
            break
        runs.add(hashes[i] if j == i + 1 else digest(b"".join((h + 2**63).to_bytes(8, "big") for h in hashes[i:j])) - 2**63)
        n -= words[i]
    return at, hashes, words, list(runs)


def heaviest_chain(places: list[int], weights: list[int]) -> list[int]:
    """Of different numbers with weights, those that rise from left to right and weigh most together, by their place."""
    rank = {x: k for k, x in enumerate(sorted(places), 1)}
    best: list[tuple[int, int]] = [(0, -1)] * (len(places) + 1)  # a tree of prefix maxima: weight so far, and the last place
    back = []
    for k, x in enumerate(places):
        r, top = rank[x] - 1, (0, -1)
        while r:
            top = max(top, best[r])
            r &= r - 1
        back.append(top[1])
        new, r = (top[0] + weights[k], k), rank[x]
        while r <= len(places):
            best[r] = max(best[r], new)
            r += r & -r
    r, top = len(places), (0, -1)
    while r:
        top = max(top, best[r])
        r &= r - 1
    chain, k = [], top[1]
    while k >= 0:
        chain.append(k)
        k = back[k]
    return chain[::-1]


def patience(a: list, b: list, weight: dict | None = None) -> list[tuple[int, int]]:
    """Aligned places of two sequences, in order.

    Between equal ends, values that both have once are put in the order that both share and that weighs most (by
    ``weight``, 1 where it says nothing), and the gaps between them are aligned likewise. A gap without such values
    goes by the rarest value that both have.
    """
    out, todo, weight = [], [(0, len(a), 0, len(b))], weight or {}
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 == i1 or j0 == j1:
            continue
        na, nb = Counter(a[i0:i1]), Counter(b[j0:j1])
        common = na.keys() & nb.keys()
        if not common:
            continue
        rarest = min(na[x] * nb[x] for x in common)
        if rarest == 1:
            place = {b[j]: j for j in range(j0, j1) if nb[b[j]] == 1}
            pairs = [(i, place[a[i]]) for i in range(i0, i1) if na[a[i]] == 1 and a[i] in place]
            chain = [pairs[k] for k in heaviest_chain([j for _, j in pairs], [weight.get(a[i], 1) for i, _ in pairs])]
        else:
            x = next(a[i] for i in range(i0, i1) if a[i] in common and na[a[i]] * nb[a[i]] == rarest)
            chain = [(a.index(x, i0, i1), b.index(x, j0, j1))]
        for i, j in chain:
            todo.append((i0, i, j0, j))
            out.append((i, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, i1, j0, j1))
    return sorted(out)


#: A run of lines: what it says, and its first and last place and one more.
Run = tuple[tuple[int, ...], int, int]


def common_runs(lines: list[int], count: dict[int, int], min_words: int) -> tuple[list[Run], list[Run]]:
    """The shortest runs of min_words words or more from every line on, and up to every line, of lines that count
    has words of. Any longer run is covered by those in it."""
    from_, upto, i, n = [], [], 0, 0
    for j, x in enumerate(lines):
        if x not in count:
            i, n = j + 1, 0
            continue
        n += count[x]
        while n - count[lines[i]] >= min_words:
            n -= count[lines[i]]
            i += 1
        if n >= min_words:
            upto.append((tuple(lines[i : j + 1]), i, j + 1))
    j, n = len(lines), 0
    for i in range(len(lines) - 1, -1, -1):
        if lines[i] not in count:
            j, n = i, 0
            continue
        n += count[lines[i]]
        while n - count[lines[j - 1]] >= min_words:
            j -= 1
            n -= count[lines[j]]
        if n >= min_words:
            from_.append((tuple(lines[i:j]), i, j))
    return from_[::-1], upto


def alignment(later: list[int], earlier: list[int], count: dict[int, int], min_words: int, rare: set[int]) -> list[tuple[int, int]]:
    """Aligned places of two documents' lines: common runs of min_words words and rare lines are anchors, weighed by
    their words, and the gaps between them are aligned by lines."""

    def anchors(lines: list[int]) -> list[Run]:
        single = [((x,), i, i + 1) for i, x in enumerate(lines) if x in rare and count.get(x, min_words) < min_words]
        return sorted(common_runs(lines, count, min_words)[0] + single, key=lambda r: (r[1], -r[2]))

    mine, theirs = anchors(later), anchors(earlier)
    weight = {run: sum(count[x] for x in run) for run, *_ in mine}
    out, i0, j0 = [], 0, 0
    for x, y in [*patience([r[0] for r in mine], [r[0] for r in theirs], weight), (None, None)]:
        (run, i, _), (_, j, _) = (mine[x], theirs[y]) if x is not None else (((), len(later), 0), ((), len(earlier), 0))
        if i >= i0 and j >= j0:
            out += [(i0 + p, j0 + q) for p, q in patience(later[i0:i], earlier[j0:j], count)]
        for k in range(len(run)):
            if i + k >= i0 and j + k >= j0:
                out.append((i + k, j + k))
                i0, j0 = i + k + 1, j + k + 1
    return out


def aligned_lines(later: list[int], words: list[int], earlier: list[int], min_words: int, rare: Iterable[int] = ()) -> list[int]:
    """Places in ``later`` that lie in blocks aligned with ``earlier``: lines that follow one another in both.

    From the alignment of the whole documents go blocks of min_words words or more, and of smaller blocks the rare lines.
    Passages that stand in another order are aligned after that, run by run of min_words words, until no such run
    that both have is left; so no common block of that length stays. A rare line outside all blocks stays.
    """
    count, rare, gone = dict(zip(later, words, strict=True)), {*rare}, set()
    pairs, start = alignment(later, earlier, count, min_words, rare), 0
    for k in range(1, len(pairs) + 1):
        if k == len(pairs) or pairs[k] != (pairs[k - 1][0] + 1, pairs[k - 1][1] + 1):
            block = [x for x, _ in pairs[start:k]]
            long = sum(words[x] for x in block) >= min_words
            gone.update(x for x in block if long or later[x] in rare)
            start = k
    for mine, theirs in zip(common_runs(later, count, min_words), common_runs(earlier, count, min_words), strict=True):
        there = {run for run, *_ in theirs}
        left = [r for r in mine if r[0] in there]
        while left := [r for r in left if not gone.issuperset(range(r[1], r[2]))]:
            wanted = {run for run, *_ in left}
            weight = {run: sum(count[x] for x in run) for run in wanted}
            moved = patience([r[0] for r in left], [r[0] for r in theirs if r[0] in wanted], weight)
            if not moved:
                break
            for x, _ in moved:
                gone.update(range(left[x][1], left[x][2]))
    return sorted(gone)


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", rare_docs: int = RARE, link_words: int = LINK_WORDS) -> DataFrame:
    """(key, lines): numbers of the lines to delete, of each document that loses some.

    Documents are paired by the hashes of their runs of lines with min_words words or more, which
    recur by copying only, however many documents have them, and by those of single lines that
    at most ``rare_docs`` documents have, if the pair's have ``link_words`` words together. Each hash links its
    documents to the first that has it; so a passage in n documents makes n - 1 pairs, and a document
    that is first for many is dealt over parts. Only line hashes go to the pairs. The two are
    aligned, and from the later one go the aligned blocks of min_words words, and rare lines of any length in aligned blocks.
    """
    names = ["key", "hashes", "words", "at", "runs"]

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                got = [line_facts(t, min_words) for t in part.column(1).to_pylist()]
                places, hashes, words, runs = ([g[i] for g in got] for i in range(4))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hashes, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int32())), pa.array(runs, pa.list_(pa.int64()))], names)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(1, 6)]
            gone = []
            for hashes, words, at, rare, other in zip(*cols, strict=True):
                gone.append([at[i] for i in aligned_lines(hashes, words, other, min_words, rare)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], ["key", "lines"])

    keyed = docs.select(document_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))
    lines = keyed.mapInArrow(frugal(facts), f"key {KEY}, hashes array<bigint>, words array<int>, at array<int>, runs array<bigint>")
    lines = written(lines.dropDuplicates(["key"]))
    runs = lines.select("key", F.explode("runs").alias("hash"), F.lit(link_words).alias("n"), F.lit(False).alias("line"))
    short = lines.select("key", F.explode(F.array_distinct(F.arrays_zip("hashes", "words"))).alias("l")).select("key", F.col("l.hashes").alias("hash"), F.col("l.words").alias("n"), F.lit(True).alias("line"))
    marks = runs.unionByName(short.where(F.col("n") < min_words))
    first = marks.groupBy("hash", "line").agg(F.min("key").alias("first"), F.count("*").alias("docs")).where((F.col("docs") > 1) & (~F.col("line") | (F.col("docs") <= rare_docs)))
    shared = marks.join(first, ["hash", "line"]).where("key > first")
    shared = shared.groupBy("key", "first").agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("line"), F.col("hash"))).alias("rare"), F.max("docs").alias("docs"))
    # a document that is the first for many is dealt over a power of two of parts, by how many share a hash of its
    parts = F.when(F.col("docs") > DEAL, F.length(F.bin(F.floor((F.col("docs") - 1) / DEAL)))).otherwise(0)
    shared = written(shared.withColumn("parts", F.call_function("shiftleft", F.lit(1).cast("bigint"), parts)).drop("docs"))
    rare = shared.groupBy("key").agg(F.flatten(F.collect_list("rare")).alias("rare"))
    linked = shared.where(F.col("n") >= link_words)
    pairs = linked.select("key", "first", "parts", F.pmod(F.xxhash64("key"), "parts").alias("part")).join(rare, "key").join(lines.select("key", "hashes", "words", "at"), "key")
    firsts = linked.select("first", "parts").distinct().withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    others = firsts.join(lines.select(F.col("key").alias("first"), F.col("hashes").alias("other")), "first")
    pairs = pairs.join(others, ["first", "parts", "part"]).select("key", "hashes", "words", "at", "rare", "other")
    gone = pairs.mapInArrow(frugal(align), f"key {KEY}, lines array<int>").select("key", F.explode("lines").alias("line"))
    return gone.groupBy("key").agg(F.collect_set("line").alias("lines"))


def document_key(id_col: str, text_col: str):
    """Orders documents: by id, null ids last, then by text. Rows equal in both are one document."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(text_of(text_col)).alias("sign"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", rare_docs: int = RARE, link_words: int = LINK_WORDS) -> DataFrame:
    """All of docs' columns, with the text less the blocks of lines that are aligned with an earlier document
    (long ones, and rare lines of documents that are paired), and n_removed: how many lines went. Lines compare without white space at their ends
    and with runs of it as one space; lines without words are never removed.

    Null text stays null and has no lines; texts that lose nothing stay as they are to the
    byte; a text that is wholly a copy becomes empty. Earlier means by id, null last, then by a
    hash of the text; rows that are equal in both are one document and get the same result. An
    empty table gives an empty result. A column n_removed of the input is replaced.
    """
    gone = dropped_lines(docs, min_words, id_col, text_col, rare_docs, link_words)
    key, lines = "__key", "__lines"
    out = docs.drop("n_removed").withColumn(key, document_key(id_col, text_col)).join(gone.select(F.col("key").alias(key), F.col("lines").alias(lines)), key, "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda _, i: ~F.array_contains(F.col(lines), i)), "\n")
    out = out.withColumn(text_col, F.when(F.col(lines).isNull(), F.col(text_col)).otherwise(kept)).withColumn("n_removed", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
    out = out.withColumn("n_removed", F.when(F.col(lines).isNull(), F.lit(0).cast("long")).otherwise(F.col("n_removed")))
    return out.select(*docs.drop("n_removed").columns, "n_removed")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return dedup_lines(docs.select("doc_id", "text")).withColumn("text_sha256", F.sha2(text_of("text"), 256))


QUERIES = {"op10_line_dedup": op10_line_dedup}
