"""Secret scans: a keyword automaton, anchored expressions near its hits, embedded checksums."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of

#: Kinds in order of their names' rank where spans begin together. The last two carry a checksum.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs have no keyword, so this one rule reads the whole text.
HEX = re.compile(r"[0-9a-f]{32,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc32(text: str) -> str:
    """The six base-62 digits of a text's CRC-32, as such tokens end with."""
    n, out = zlib.crc32(text.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = DIGITS[d] + out
    return out


@cache
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word in WORDS:  # in every case, so that texts need not be changed
        for letters in itertools.product(*[{c, c.upper()} for c in word]):
            a.add_word("".join(letters), (0, len(word) - 1))
    a.add_word("AKIA", (1, 3))
    for c in "pousr":
        a.add_word(f"gh{c}_", (3, 3))
    a.add_word("npm_", (4, 3))
    a.make_automaton()
    return a


RULES = {0: (ASSIGN, lambda m: len(m[1]) >= 8), 1: (ACCESS, lambda m: len(m[0]) >= 16), 3: (GITHUB, lambda m: base62_crc32(m[1]) == m[2]), 4: (NPM, lambda m: base62_crc32(m[1]) == m[2])}


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every secret, sorted; kinds by their place in KINDS.

    Matches of a kind are leftmost and do not overlap; one that its test rejects still takes
    its place, as it would for an expression that is run over the whole text.
    """
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    hits: dict[int, list[int]] = {}
    for end, (kind, back) in automaton().iter(text):
        hits.setdefault(kind, []).append(end - back)
    for kind, starts in hits.items():
        expression, test = RULES[kind]
        free = 0
        for start in sorted(starts):
            if start >= free and (m := expression.match(text, start)):
                free = m.end()
                if test(m):
                    out.append((start, kind, free))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets in every whole text: id, n_assign, n_access, n_hex, base_sha256, spans.

    spans names all of them as kind:start:end in code points, end exclusive, by start and then
    kind, comma-joined; base_sha256 is the digest of the same for the first three kinds. One
    row per input row, in one pass without a shuffle. Null text counts as empty; a text
    without secrets has counts of 0 and empty spans; null ids, repeated rows and very long texts
    pass like others; other columns are ignored.
    """
    names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                counts, digests, all_spans = [[], [], []], [], []
                for text in part.column(1).to_pylist():
                    spans = spans_of(text)
                    for k in range(3):
                        counts[k].append(sum(s[1] == k for s in spans))
                    digests.append(hashlib.sha256(joined([s for s in spans if s[1] < 3]).encode()).hexdigest())
                    all_spans.append(joined(spans))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(all_spans, pa.string())], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


QUERIES = {"op9_secret_scan": op9_secret_scan}
