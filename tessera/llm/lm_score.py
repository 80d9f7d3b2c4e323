"""Language-model scores by deleted interpolation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, frugal, table, text_of, written, written_at

#: Tokens of a shard, and requests that one bucket of counts takes, about.
SHARD, BUCKET = 2_000_000, 4_000_000
#: Levels per factor of two, and the most levels, of the ratios that weights are learned from.
FINE, LEVELS = 2, 127
#: Bytes of a key that go to its bucket, by kind (word, bigram). The bucket stands for the top bits, 8 and
#: more as the input grows.
SENT = (7, 6)
#: Hashes of the end of a text and of its start, which words cannot have but by chance.
END, START = 0x9AE16A3B2F90404F, 0xC949D7C7509E6557


def _pack(a: np.ndarray) -> bytes:
    """Compressed, byte by byte of the numbers: the upper bytes are mostly zero."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 3)


def _unpack(raw: bytes, kind) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _low_bytes(keys: np.ndarray, n: int) -> bytes:
    """The lowest n bytes of keys; hashes do not compress."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _from_low_bytes(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(raw, np.uint8).reshape(-1, n)
    return out.reshape(-1).view("<u8")


def _bigrams(tokens: np.ndarray, lens: np.ndarray, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token: the place of the word before it (-1 at a text's start) and the bigram's key."""
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[np.concatenate([[0], np.cumsum(lens)[:-1]])] = -1
    first = np.where(before < 0, np.uint64(START), vocab[before])
    key = (first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + vocab[tokens] * np.uint64(0xC2B2AE3D27D4EB4F)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    return before, (key ^ (key >> np.uint64(32)))


SHARDS = "shard string, ids array<bigint>, held array<boolean>, lens binary, tokens binary, vocab binary, n bigint, train bigint, texts bigint"


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs documents (id, text) by some SHARD tokens: ids, lengths, places in the shard's vocabulary."""
    import uuid

    from xxhash import xxh3_64_intdigest

    names = [x.split()[0] for x in SHARDS.split(", ")]

    def packed() -> pa.RecordBatch:
        held_ = np.array(held)
        n = np.array(lens)
        vocab = np.fromiter((END if w is None else xxh3_64_intdigest(w) for w in place), np.uint64, len(place))
        row = [uuid.uuid4().hex, ids, held, _pack(n.astype(np.uint32)), _pack(np.concatenate(tokens)), _pack(vocab), int(n.sum()), int(n[~held_].sum()), int((~held_).sum())]
        kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    ids, held, lens, tokens, place, size = [], [], [], [], {None: 0}, 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = text.as_py().encode(errors="surrogatepass").lower().split()
            for w in words:
                if w not in place:
                    place[w] = len(place)
            tokens.append(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)))
            tokens.append(np.zeros(1, np.uint32))
            ids.append(key)
            held.append(zlib.crc32(b"" if key is None else str(key).encode()) % 5 == 1)
            lens.append(len(words) + 1)
            size += lens[-1]
            if size >= SHARD:
                yield packed()
                ids, held, lens, tokens, place, size = [], [], [], [], {None: 0}, 0
    if ids:
        yield packed()


class Shard:
    """The arrays of one shard: kinds of words and of bigrams, each with its counts in training texts here."""

    def __init__(self, row: dict):
        self.held = np.array(row["held"], bool)
        self.lens = _unpack(row["lens"], np.uint32).astype(np.int64)
        self.tokens = _unpack(row["tokens"], np.uint32)
        self.vocab = _unpack(row["vocab"], np.uint64)
        self.train = np.repeat(~self.held, self.lens)
        self.before, keys = _bigrams(self.tokens, self.lens, self.vocab)
        self.kinds, self.at = np.unique(keys, return_inverse=True)
        self.pairs = np.bincount(self.at, self.train, len(self.kinds)).astype(np.uint32)
        self.order = np.argsort(self.vocab, kind="stable")
        self.words = np.bincount(self.tokens, self.train, len(self.vocab)).astype(np.uint32)


def _requests(bits: int):
    """Rows (kind, bucket, shard, keys, counts) that ask for the total counts of a shard's kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(row)
                for kind, keys, counts in ((0, s.vocab[s.order], s.words[s.order]), (1, s.kinds, s.pairs)):
                    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(2**bits + 1))
                    out = [(kind, b, row["shard"], _low_bytes(keys[i:j], SENT[kind]), _pack(counts[i:j])) for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if j > i]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)], ["kind", "bucket", "shard", "keys", "counts"])

    return run


def _totals():
    """Answers (kind, bucket, shard, places, totals, known): totals where they are more than the shard's
    own counts; known, in one answer of each bucket, how many kinds occur in training texts."""

    def answer(rows: list[dict]) -> Iterator[tuple]:
        keys = [_from_low_bytes(r["keys"], SENT[r["kind"]]) for r in rows]
        counts = [_unpack(r["counts"], np.uint32) for r in rows]
        kinds, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(kinds)).astype(np.int64)
        known, start = int((total > 0).sum()), 0
        for r, c in zip(rows, counts, strict=True):
            mine = total[at[start : start + len(c)]]
            start += len(c)
            more = np.nonzero(mine != c)[0]
            yield r["kind"], r["bucket"], r["shard"], _pack(np.diff(more, prepend=0).astype(np.uint32)), _pack(mine[more].astype(np.uint64)), len(c), known
            known = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*answer(rows), strict=True))
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["kind", "bucket", "shard", "places", "totals", "size", "known"])

        for batch in batches:
            for i in range(len(batch)):
                row = {k: batch.column(k)[i].as_py() for k in ("kind", "bucket", "shard", "keys", "counts")}
                if (row["kind"], row["bucket"]) != group and rows:
                    yield flush()
                    rows = []
                group = row["kind"], row["bucket"]
                rows.append(row)
        if rows:
            yield flush()

    return run


COUNTED = "ids array<bigint>, held array<boolean>, lens binary, words binary, pairs binary"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each token's count and its bigram's, from the shard's own counts and the answers, which follow its
    row by kind and bucket."""
    names = [x.split()[0] for x in COUNTED.split(", ")]

    def done(row: dict, answers: list[dict]) -> pa.RecordBatch:
        s = Shard(row)
        counts = {0: s.words[s.order].astype(np.int64), 1: s.pairs.astype(np.int64)}
        start = {0: 0, 1: 0}
        for a in answers:
            places = np.cumsum(_unpack(a["places"], np.uint32), dtype=np.int64) + start[a["kind"]]
            counts[a["kind"]][places] = _unpack(a["totals"], np.uint64).astype(np.int64)
            start[a["kind"]] += a["size"]
        words = np.empty_like(counts[0])
        words[s.order] = counts[0]
        values = [row["ids"], row["held"], row["lens"], _pack(words[s.tokens]), _pack(counts[1][s.at])]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    shard, answers = None, []
    for batch in batches:
        for i in range(len(batch)):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            if row["kind"] < 0:
                if shard is not None:
                    yield done(shard, answers)
                shard, answers = row, []
            else:
                answers.append(row)
    if shard is not None:
        yield done(shard, answers)


def _frequencies(row: dict) -> tuple[np.ndarray, ...]:
    """lens, starts, held; and of each token its count, its context's (-1 at a start), the bigram's."""
    lens = _unpack(row["lens"], np.uint32).astype(np.int64)
    words, pairs = _unpack(row["words"], np.int64), _unpack(row["pairs"], np.int64)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    context = np.empty(len(words), np.int64)
    context[1:] = words[:-1]
    context[starts] = -1
    return lens, starts, np.array(row["held"], bool), words, context, pairs


def _levels(ratio: np.ndarray) -> np.ndarray:
    """0 for none, else the level of a ratio of 1/2**8 or more."""
    with np.errstate(divide="ignore"):
        return np.where(ratio > 0, np.clip(np.floor(np.log2(ratio) * FINE) + 8 * FINE + 1, 1, LEVELS), 0).astype(np.int64)


def _deleted(total: int, texts: int, known: int):
    """(bucket, bigram level, word level, n) of training tokens, each with itself taken out of the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lens, _, held, c, context, pair = _frequencies(row)
                train = np.repeat(~held, lens)
                c, context, pair = c[train] - 1, np.where(context < 0, texts, context)[train] - 1, pair[train] - 1
                bucket = np.frexp(context.astype(float))[1]
                two = pair / np.maximum(context, 1) * (known + 1)
                one = c / max(1, total - 1) * (known + 1)
                cell = (bucket.astype(np.int64) * (LEVELS + 1) + _levels(two)) * (LEVELS + 1) + _levels(one)
                cells, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], ["cell", "n"])

    return run


def interpolation_weights(cells: np.ndarray, n: np.ndarray, rounds: int = 100) -> dict[int, tuple[float, float, float]]:
    """By expectation-maximisation, per context-frequency bucket: the weights of the bigram's, the
    word's and the uniform probability. Levels stand for the middle of their range."""
    value = lambda level: np.where(level > 0, 2.0 ** ((level - 0.5) / FINE - 8), 0.0)
    bucket, two, one = cells // (LEVELS + 1) ** 2, value(cells // (LEVELS + 1) % (LEVELS + 1)), value(cells % (LEVELS + 1))
    out = {}
    for k in np.unique(bucket):
        on = bucket == k
        parts = np.stack([two[on], one[on], np.ones(on.sum())], axis=1)
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = parts * w
            share /= share.sum(axis=1, keepdims=True)
            new = (share * n[on][:, None]).sum(axis=0) / n[on].sum()
            if np.abs(new - w).max() < 1e-9:
                break
            w = new
        w = np.maximum(w, 1e-6)
        out[int(k)] = tuple(w / w.sum())
    return out


def _scored(total: int, texts: int, known: int, weights: dict[int, tuple[float, float, float]]):
    table_ = np.tile([0.0, 0.9, 0.1], (80, 1))
    last = None
    for k in range(80):
        last = weights.get(k, last)
        if last is not None:
            table_[k] = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lens, starts, held, c, context, pair = _frequencies(row)
                context = np.where(context < 0, texts, context)
                w = table_[np.frexp(context.astype(float))[1]]
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * c / max(1, total) + w[:, 2] / (known + 1)
                p += np.where(context == 0, w[:, 0] * c / max(1, total), 0)  # no such context: its share goes to the word
                base = np.log10((c + 0.5) / (total + 0.5 * (known + 1)))
                add = lambda x: np.add.reduceat(x, starts)
                out = [row["ids"], held, lens, add((c > 0).astype(np.int64)), np.full(len(lens), total), add(base), add(np.log10(p))]
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every whole text: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A bigram model from the texts whose crc32(id as text) mod 5 is not 1: maximum-likelihood
    estimates of bigram and word, and the uniform one, mixed with weights of the bucket (power
    of two) of the context's count. Expectation-maximisation learns the weights on training
    counts from which each token in turn is deleted, so what it sees is held out. base_score
    is the smoothed word model's.

    Texts are packed in shards of token places. A shard asks for the total count of each
    kind of word and bigram that it has once, in buckets by hash; a frequent word is one
    request of each shard, so no key is hot. Only bounded histograms come to the driver. Words go
    by 64-bit hashes. Of a bigram's hash its bucket (the top ``bits``, 8 at least) and the lowest 48 bits
    go to be counted: 56 bits in all for the smallest inputs, more as the buckets grow with the input, so
    that the chance of two bigrams counting as one stays small.

    Ids must be whole numbers or text that reads as such. Null text counts as empty: an end only. Null ids count as the empty text for the split;
    repeated rows count each; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    shards, shards_path = written_at(base.mapInArrow(frugal(_sharded), SHARDS))
    n, total, texts = (int(x or 0) for x in shards.agg(F.sum("n"), F.sum("train"), F.sum("texts")).first())
    bits = min(20, max(8, (n // BUCKET).bit_length() + 2))
    asked = shards.mapInArrow(frugal(_requests(bits)), "kind int, bucket int, shard string, keys binary, counts binary")
    answers = asked.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(frugal(_totals()), "kind int, bucket int, shard string, places binary, totals binary, size bigint, known bigint")
    answers, answers_path = written_at(answers)
    known = int(answers.where("kind = 0").agg(F.sum("known")).first()[0] or 0)

    rows = shards.select("shard", F.lit(-1).alias("kind"), F.lit(-1).alias("bucket"), "ids", "held", "lens", "tokens", "vocab").unionByName(answers.select("shard", "kind", "bucket", "places", "totals", "size"), allowMissingColumns=True)
    counted = written(rows.repartition("shard").sortWithinPartitions("shard", "kind", "bucket").mapInArrow(frugal(_counted), COUNTED))
    drop_path(spark, shards_path)
    drop_path(spark, answers_path)

    cells = counted.mapInArrow(frugal(_deleted(total, texts, known)), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most 64 * 128 * 128
    weights = interpolation_weights(np.array([r[0] for r in cells], np.int64), np.array([r[1] for r in cells], float))
    out = counted.mapInArrow(frugal(_scored(total, texts, known, weights)), "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return out.withColumnRenamed("id", id_col)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op4_lm_scoring": op4_lm_scoring}
