"""SentencePiece (BPE) encoding and decoding by a prefix table.

Entry i of the table is the last token of the encoding of a text's first i characters. It is
unique, so it is found from left to right: of the vocabulary's matches that end at i, the one
that begins the text, or that may follow the entry where it begins. The ids are then read off
from the end. Two tokens may follow one another if merging their joint characters gives just
the two; that is computed once for a pair and kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from threading import Timer

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, table, text_of, trim

SPACE = "▁"
#: Entries that a memo may hold before it is emptied, and the longest chunk that is kept.
MEMO, LONGEST = 400_000, 40
#: Seconds after a task until a worker that has got no other gives its memos up.
IDLE = 2.0


class Pieces:
    """The encoder and decoder of one model (type BPE, identity normaliser, byte fallback)."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(model)
        norm = m.normalizer_spec
        if m.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models that keep the text as it is are supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.piece = [p.piece for p in m.pieces]
        self.score = {p.piece: p.score for p in m.pieces if p.type == 1}
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 1}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
        self.value = {i: b for b, i in self.byte.items()}
        self.end = next(i for i, p in enumerate(m.pieces) if p.piece == "</s>")
        self.control = {i for i, p in enumerate(m.pieces) if p.type == 3}
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == 2)
        self.find = ahocorasick.Automaton()
        for p in self.id:
            if self.merged(p) == [p]:  # others never come out of an encoding
                self.find.add_word(p, (p, len(p) - 1))
        self.find.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.chunks: dict[str, str | tuple[str, str]] = {}
        self.idle: Timer | None = None
        # no piece goes on past these, so a text may be cut there
        inner = {c for p in self.id for c in p[1:]}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            self.cut = re.compile("(?s).+")
        elif "\n" in inner | {p[0] for p in self.id}:
            self.cut = re.compile("(?s) *[^ ]+| +")
        else:
            self.cut = re.compile("\n| *[^ \n]+| +")

    def merged(self, text: str) -> list[str]:
        """The tokens that merging by score leaves, leftmost first among equals. For short texts."""
        parts, score = list(text), self.score.get
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: str, b: str) -> bool:
        """Whether b may come right after a in an encoding."""
        if len(self.pairs) >= MEMO:
            self.pairs.clear()
        got = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return got

    def tokens(self, text: str) -> list[str]:
        """Encodes one normalised text. A character without a piece is a token of its own."""
        last: list[str | None] = [None] * (len(text) + 1)
        known = self.pairs.get
        for end, (p, more) in self.find.iter(text):  # by end, the longest first
            if last[end + 1] is None:
                before = end - more
                if before:
                    a = last[before]
                    if a is None:  # no piece ended here
                        a = last[before] = text[before - 1]
                    if (ok := known((a, p))) is None:
                        ok = self.follows(a, p)
                    if not ok:
                        continue
                last[end + 1] = p
        out, i = [], len(text)
        while i:
            p = last[i] or text[i - 1]
            out.append(p)
            i -= len(p)
        return out[::-1]

    def ids(self, tokens: list[str]) -> list[int]:
        out = []
        for p in tokens:
            i = self.id.get(p)
            out += [i] if i is not None else [self.byte[b] for b in p.encode()] if self.byte else [self.unknown]
        return out

    def encode(self, text: str, end: bool = True) -> list[int]:
        """The ids of a whole text, without any cutting."""
        return (self.ids(self.tokens(self.normal(text))) if text else []) + [self.end] * end

    def normal(self, text: str) -> str:
        return (self.prefix + text).replace(" ", SPACE)

    def pieces_text(self, ids: list[int]) -> str:
        """The text of ids, bytes joined, before the prefix is taken off."""
        out, raw = [], bytearray()
        for i in ids:
            if i in self.value:
                raw.append(self.value[i])
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            if i not in self.control:
                out.append(" ⁇ " if i == self.unknown else self.piece[i].replace(SPACE, " "))
        return "".join(out) + raw.decode(errors="replace")

    def decode(self, ids: list[int]) -> str:
        text = self.pieces_text(ids)
        return text[1:] if self.prefix and text[:1] == " " else text

    def _chunk(self, chunk: str) -> str | tuple[str, str]:
        """The ids of a chunk, in which spaces stand for SPACE, joined; if they decode to another text, that too."""
        ids = self.ids(self.tokens(chunk.replace(" ", SPACE)))
        joined, back = " ".join(map(str, ids)), self.pieces_text(ids)
        got = joined if back == chunk else (joined, back)
        if len(chunk) <= LONGEST:
            if len(self.chunks) >= MEMO:
                self.chunks.clear()
            self.chunks[chunk] = got
        return got

    def digest(self, text: str) -> tuple[int, str, str]:
        """n ids, ids joined by spaces, with the end id; and what they decode to."""
        if not text:
            return 1, str(self.end), ""
        known, decoded = self.chunks.get, (self.prefix + text).replace(SPACE, " ")
        cut = self.cut.findall(decoded)
        found = [known(c) or self._chunk(c) for c in cut]
        try:
            joined = " ".join(found)
        except TypeError:  # some decode to another text
            joined = " ".join(f if isinstance(f, str) else f[0] for f in found)
            decoded = "".join(c if isinstance(f, str) else f[1] for c, f in zip(cut, found, strict=True))
        return joined.count(" ") + 2, f"{joined} {self.end}", decoded[1:] if self.prefix and decoded[:1] == " " else decoded

    def busy(self) -> None:
        """A task begins: the memos stay."""
        if self.idle:
            self.idle.cancel()

    def rest(self) -> None:
        """A task ends: Spark keeps the worker, but without another task soon it does not keep the memos."""
        self.idle = Timer(IDLE, self.forget)
        self.idle.daemon = True
        self.idle.start()

    def forget(self) -> None:
        self.chunks.clear()
        self.pairs.clear()
        trim()


@cache
def pieces(model: bytes) -> Pieces:
    return Pieces(model)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_pieces(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, decoded: bool = True) -> DataFrame:
    """Encodes every whole text and decodes it again: id, n_tokens, ids_sha256, decoded_sha256,
    and where asked for ``token_ids`` (array of int) and ``decoded`` (text).

    One output row per input row, in one pass without a shuffle. The end id alone is added.
    Null text counts as empty: one id, decoded to the empty text. Texts of any length take
    time in proportion to it; a word's ids are kept in a memo of bounded size. Other columns
    of ``docs`` are ignored; null ids and repeated rows pass as they are.
    """
    with open(model_path or default_model(), "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        p.busy()
        try:
            for batch in batches:
                for at in range(0, len(batch), 256):
                    part = batch.slice(at, 256)
                    n, a, b, lists, texts = [], [], [], [], []
                    for text in part.column(1).to_pylist():
                        count, joined, back = p.digest(text)
                        n.append(count)
                        a.append(hashlib.sha256(joined.encode()).hexdigest())
                        b.append(hashlib.sha256(back.encode()).hexdigest())
                        if ids:
                            lists.append(list(map(int, joined.split(" "))))
                        if decoded:
                            texts.append(back)
                    columns = [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                    if ids:
                        columns.append(pa.array(lists, pa.list_(pa.int32())))
                        names.append("token_ids")
                    if decoded:
                        columns.append(pa.array(texts, pa.string()))
                        names.append("decoded")
                    yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            p.rest()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids + ", decoded string" * decoded
    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(frugal(run), schema).withColumnRenamed("id", id_col)


def op7_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), ids=False, decoded=False)


QUERIES = {"op7_sentencepiece_codec": op7_sentencepiece_codec}
