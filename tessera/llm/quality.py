"""Quality classifier: document evidence combined with host and path posteriors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import frugal, table, text_of, written

FEATURES = ("upper", "marks", "symbols", "pipes", "digits", "repeats", "distinct", "lines", "length", "word_length", "lexical")
SURFACE = len(FEATURES) - 1
_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*@^~_=<>{}\\+"
#: Labelled rows that the document classifier is fitted on, about, where there are more.
SAMPLE = 20_000
#: Word hashes that have a weight, and the pseudo-counts of their document frequencies.
WORDS, PRIOR = 2**14, 2.0


def read(text: str) -> tuple[list[float], np.ndarray]:
    """The surface FEATURES of a text, shares by word or letter and logs of lengths, all 0 without words;
    and the hashes of its distinct words, a number below WORDS for each."""
    raw = text.encode(errors="surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * SURFACE, np.zeros(0, np.uint32)
    distinct = set(words)
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    found = [
        count(_UPPER) / len(raw),
        count(b"!?") / n,
        count(_SYMBOLS) / n,
        count(b"|\t") / n,
        count(b"0123456789") / len(raw),
        sum(map(eq, words, words[1:])) / n,
        np.log(len(distinct)) / np.log(n + 1),
        len(set(lines)) / len(lines),
        np.log(n),
        (len(raw) - n) / n,
    ]
    return found, np.fromiter(map(zlib.crc32, distinct), np.uint32, len(distinct)) % WORDS


def lexical_weights(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Of each word hash: the log ratio of its shares of good and of bad documents, with PRIOR in each."""
    n = np.full((2, WORDS), PRIOR)
    for words, good in zip(rows, y, strict=True):
        n[int(good), words] += 1  # once a document
    total = np.array([(y == k).sum() for k in (0, 1)]) + 2 * PRIOR
    return np.log(n[1] / total[1]) - np.log(n[0] / total[0])


def lexical(weights: np.ndarray, words: np.ndarray) -> float:
    """The mean weight of a document's words, 0 without words."""
    return float(weights[words].mean()) if len(words) else 0.0


def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """quality, surface features and word hashes (two bytes each) of (quality, text)."""
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            found = [read(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.list_(pa.float64())), pa.array([w.astype(np.uint16).tobytes() for _, w in found], pa.binary())], ["quality", "feats", "words"])


class Model:
    """Logistic regression on the features and the square roots of the surface ones.

    The lexical feature of each half of the sample comes from the weights of the other half, so the
    regression sees what it is worth for documents that the weights do not know.
    """

    def __init__(self, x: np.ndarray, words: list[np.ndarray], y: np.ndarray, ridge: float = 1.0, rounds: int = 30):
        self.words = lexical_weights(words, y)
        size = len(FEATURES) + SURFACE
        self.weights, self.mean, self.scale = np.zeros(size + 1), np.zeros(size), np.ones(size)
        if not len(y):
            return
        fold, lex = np.arange(len(y)) % 2, np.zeros(len(y))
        for k in (0, 1):
            other = lexical_weights([words[i] for i in np.nonzero(fold != k)[0]], y[fold != k])
            lex[fold == k] = [lexical(other, words[i]) for i in np.nonzero(fold == k)[0]]
        z = np.hstack([x, lex[:, None], np.sqrt(np.abs(x))])
        self.mean, self.scale = z.mean(axis=0), z.std(axis=0) + 1e-9
        z = np.hstack([(z - self.mean) / self.scale, np.ones((len(z), 1))])
        w = np.zeros(z.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            v = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve(z.T @ (z * v[:, None]) + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def log_odds(self, text: Column) -> Column:
        """The log odds of good quality of each text, within -12 and 12."""
        by_word, mean, scale, weights = self.words, self.mean, self.scale, self.weights

        def odds(text: str) -> float:
            x, words = read(text)
            z = np.array([*x, lexical(by_word, words), *np.sqrt(np.abs(x))])
            return float(min(12.0, max(-12.0, ((z - mean) / scale) @ weights[:-1] + weights[-1])))

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield pa.concat_arrays([pa.array([odds(t) for t in texts.slice(at, 256).to_pylist()], pa.float64()) for at in range(0, max(1, len(texts)), 256)])

        @F.arrow_udf(DoubleType())
        def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from frugal(run)(batches)

        return scores(text)


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.ln(p / (1 - p))


def _strength(groups: DataFrame, mean: str) -> float:
    """Of a Beta prior with the given means, by moments: how many documents it counts for. The spread
    of the groups' means beyond what sampling explains sets it, within 2 and 1e6."""
    spread = F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col(mean)) ** 2)
    noise = F.sum(F.col(mean) * (1 - F.col(mean)))
    size = F.sum("n") - F.sum(F.col("n") ** 2) / F.sum("n")
    v = groups.agg(spread.alias("spread"), noise.alias("noise"), size.alias("size"), F.avg(F.col(mean) * (1 - F.col(mean))).alias("binomial")).first()
    between = ((v["spread"] or 0) - (v["noise"] or 0)) / v["size"] if v["size"] else 0
    return float(min(1e6, max(2.0, (v["binomial"] or 0.25) / between - 1))) if between > 0 else 1e6


def fit(docs: DataFrame, labels: DataFrame, host: Column, path: Column, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model, DataFrame, float]:
    """(facts, model, paths, global mean). facts: id, host, path, log_odds of every document; paths:
    each path's and its host's sums of document probabilities over all documents, with the strength of
    their priors.

    Of the labelled documents, those whose id's hash is under a threshold are learned from; it is set
    from their number, so that about ``sample`` come to the driver, from whatever partitions.
    """
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"))
    ids = docs.select(F.col(id_col).alias("id"))
    n = marks.join(ids, "id", "left_semi").count()
    marks = marks.withColumn("at", F.pmod(F.xxhash64("id"), F.lit(2**31)))
    marks = marks.where(F.col("at") < int(2**31 * min(1.0, sample / max(1, n))))
    known = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(marks, "id").select("quality", "text")
    known = known.mapInArrow(frugal(evidence), "quality int, feats array<double>, words binary").toArrow()  # about ``sample``
    x = np.array(known["feats"].combine_chunks().flatten() if len(known) else [], float).reshape(len(known), SURFACE)
    y, raw = np.array(known["quality"].to_pylist(), float) > 0, known["words"].to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (y[i], x[i].tobytes(), raw[i]))  # reruns agree, and halves have both kinds
    model = Model(x[order], [np.frombuffer(raw[i], np.uint16) for i in order], y[order].astype(float))
    facts = docs.select(F.col(id_col).alias("id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), model.log_odds(text_of(text_col)).alias("log_odds"))
    facts = written(facts)
    p = 1 / (1 + F.exp(-F.col("log_odds")))
    paths = written(facts.groupBy("host", "path").agg(F.sum(p).alias("s"), F.count("*").alias("n")))
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    total = hosts.agg(F.sum("s"), F.sum("n")).first()
    mean = float(total[0] / total[1]) if total[1] else 0.5
    hosts = hosts.withColumn("mean", F.lit(mean))
    k = _strength(hosts, "mean")
    hosts = hosts.select("host", F.col("s").alias("hs"), F.col("n").alias("hn"), ((k * F.col("mean") + F.col("s")) / (k + F.col("n"))).alias("host_mean"), F.lit(k).alias("hk"))
    paths = paths.join(hosts, "host")
    k = _strength(paths, "host_mean")
    paths = paths.select("host", "path", "s", "n", "hs", "hn", "hk", "host_mean", F.lit(k).alias("pk"))
    return facts, model, paths, mean


def _judged(rows: DataFrame, log_odds: Column, paths: DataFrame, mean: float) -> DataFrame:
    """rows with host_posterior, path_posterior, score. A row's own evidence is taken out of its
    groups' sums, then goes in once: its odds under the path's prior instead of the global one."""
    paths = paths.withColumnsRenamed({"host": "__host", "path": "__path"})
    own = 1 / (1 + F.exp(-log_odds))
    rows = rows.withColumn("__l", log_odds).withColumn("__p", own).join(paths, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")))
    host = (F.col("hk") * mean + F.col("hs") - F.col("__p")) / (F.col("hk") + F.col("hn") - 1)
    rows = rows.withColumn("host_posterior", host)
    prior = (F.col("pk") * F.col("host_posterior") + F.col("s") - F.col("__p")) / (F.col("pk") + F.col("n") - 1)
    rows = rows.withColumn("path_posterior", prior)
    score = 1 / (1 + F.exp(-(F.col("__l") + _logit(F.col("path_posterior")) - _logit(F.lit(mean)))))
    return rows.withColumn("score", score)


def quality_scores(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The probability that each document is of good quality: id, host, path, doc_score,
    host_posterior, path_posterior, score, kept (score >= threshold).

    A logistic regression on a bounded sample of labelled rows (about ``sample``, chosen by a hash of
    the id) gives each document's own probability, from counts on its surface and from its words. Hosts are Beta distributed around the mean
    of all documents, paths around their host; each prior's strength comes from the spread of
    the groups, so a sparse site falls back to the global mean. Sums go over all documents and
    are combined before each shuffle.

    By default the host is the source and the path the language there. Null text counts as
    empty, null hosts and paths are groups of their own; ids that are null or without a label
    are scored but not learned from; repeated rows are scored alike and count each; without
    labels every document scores 0.5 and is kept; an empty table gives an empty result.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    facts, model, paths, mean = fit(docs, labels, host, path, sample, id_col, text_col)
    out = _judged(facts, F.col("log_odds"), paths, mean)
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("__p").alias("doc_score"), "host_posterior", "path_posterior", "score", (F.col("score") >= threshold).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """docs without the rows that quality_scores rejects, with all their columns."""
    host = F.coalesce(F.col("source") if host is None else host, F.lit(""))
    path = F.coalesce(F.col("lang") if path is None else path, F.lit(""))
    _, model, paths, mean = fit(docs, labels, host, path, sample)
    rows = docs.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"), model.log_odds(text_of("text")).alias("log_odds"))
    return _judged(rows, F.col("log_odds"), paths, mean).where(F.col("score") >= threshold).select("row.*")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op2_quality_classifier": op2_quality_classifier}
