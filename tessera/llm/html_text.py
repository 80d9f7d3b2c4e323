"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, table, text_of

SPACES = re.compile(r"[\x20\x09-\x0D]+")
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|title|object|canvas|select|xmp)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>|</[^a-zA-Z][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？¿¡]")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
#: A start of the first closes an open one of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Closing does not reach beyond these.
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a block's score is multiplied by if its elements, or words of their class, id or role, say that it is
#: beside the text; and if a name has such a word beside words of another kind, as in share-price. Both are evidence, not
#: a verdict: a block whose path scores enough in spite of it stays.
BESIDE, DOUBT = 0.05, 0.5
OUTSIDE = frozenset("nav footer aside form button fieldset dialog menu head".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer masthead comment comments disqus replies respond share sharing social related recommended recommendations login signup toolbar pagination pager copyright complementary contentinfo search skip".split()
)


#: Words that say what part of a page something is, not what it is about.
PARTS = frozenset(
    "a bar block body bottom box btn button buttons card center col column container content count cta data desktop entry feed fixed float form group header heading heads hidden icon icons id inline inner item items js label left link links list lists main media message messages meta mobile module more my name outer page pane panel post posts primary right row secondary section show site slot small static sticky tab table tag text theme thread title toggle tool tools top ui unit view wrap wrapper zone".split()
)


@dataclass(slots=True, eq=False)
class Element:
    """An open tag with what it passes on to what is in it. path: a number for the labels from the root to it."""

    tag: str
    label: str
    parent: Element | None
    number: int
    path: int
    outside: bool = False
    header: bool = False
    in_main: bool = False
    hidden: bool = False
    hinted: bool = False
    doubted: bool = False
    holds_main: bool = False


@dataclass
class Block:
    """A leaf of the page: its path, text, the length of link text, if its elements' names say that it lies beside the
    main text or may do so, if it is a heading or hidden, and the innermost element around it."""

    path: int
    text: str
    linked: int
    outside: bool
    heading: bool
    hidden: bool = False
    doubted: bool = False
    element: Element | None = None


def folded(text: str) -> str:
    return SPACES.sub(" ", text).strip(" ")


def hints_of(names: list[str]) -> tuple[bool, bool]:
    """Whether one of the names says that something lies beside the text, and whether one has a word that may say so."""
    sure = doubt = False
    for name in names:
        words = {x.lower() for x in NAME.findall(name)}
        if not HINTS.isdisjoint(words):
            plain = words <= HINTS | PARTS or "comment" in words or "comments" in words
            sure, doubt = sure or plain, doubt or not plain
    return sure, doubt


class Reader:
    """Reads a page into blocks. Open elements are found by their tag and place, never by going through them all, so the
    work does not grow with the depth."""

    def __init__(self) -> None:
        self.stack: list[Element] = [Element("", "", None, 0, 0)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.outer: list[int] = [0]  # places of elements that are not inline
        self.paths: dict[tuple[int, str], int] = {}
        self.found: list[tuple[Element, str, int]] = []
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.text:
            if text := folded("".join(self.text)):
                self.found.append((self.stack[self.outer[-1]], text, min(self.linked, len(text))))
            self.text.clear()
        self.linked = 0

    def say(self, raw: str) -> None:
        if raw:
            said = html.unescape(raw) if "&" in raw else raw
            self.text.append(said)
            if self.places["a"]:
                self.linked += len(folded(said))

    def last(self, tags) -> int:
        """The place of the innermost open element with one of the tags, 0 for none."""
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def pop_to(self, i: int) -> None:
        if self.outer[-1] >= i:
            self.flush()
        while len(self.stack) > i:
            o = self.stack.pop()
            self.places[o.tag].pop()
            if self.outer[-1] == len(self.stack):
                self.outer.pop()

    def end(self, tag: str) -> None:
        i = self.last((tag,))
        if i and (tag not in INLINE or i > self.outer[-1]):
            self.pop_to(i)
        elif tag == "p":
            self.flush()

    def start(self, tag: str, rest: str, number: int) -> None:
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            elif tag not in INLINE:
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            if self.stack[self.outer[-1]].tag == "p":  # an open p ends here
                self.pop_to(self.outer[-1])
            if tag in CLOSES:
                while (i := self.last(CLOSES[tag])) > self.last(SCOPE.get(tag, ())):
                    self.pop_to(i)
                    if tag != "tr":
                        break
        hidden, names = False, []
        if rest.strip(" /"):
            for k, v in ATTRIBUTE.findall(rest):
                k, v = k.lower(), v.strip("\"'")
                if k in ("class", "id", "role"):
                    names += v.split()
                elif k == "style":
                    hidden |= "display:none" in v.replace(" ", "").lower()
                else:
                    hidden |= k == "hidden" or (k == "aria-hidden" and v.lower() == "true")
        hinted, doubted = hints_of(names)
        if tag in ("html", "body", "main"):
            hinted = doubted = False
        if tag == "article":
            hinted, doubted = hinted and "comment" in " ".join(names).lower(), False
        parent = self.stack[self.outer[-1]]
        if tag in ("article", "main") and not hinted:
            o = parent
            while o is not None and not o.holds_main:
                o.holds_main, o = True, o.parent
        label = tag + "".join(sorted(f".{x}" for x in names))
        path = parent.path if tag in INLINE else self.paths.setdefault((parent.path, label), len(self.paths) + 1)
        self.places[tag].append(len(self.stack))
        if tag not in INLINE:
            self.outer.append(len(self.stack))
        in_main = parent.in_main or tag in ("article", "main")
        self.stack.append(Element(tag, label, parent, number, path, parent.outside or tag in OUTSIDE, parent.header or tag == "header", in_main, parent.hidden or hidden or tag == "head", hinted, doubted))


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, white space folded, references decoded.

    Broken markup is read as browsers read it where that matters for blocks: an open p ends at
    the next block, list items and table cells end at the next of their kind, ends without a start
    count for nothing. The work is linear in the page, however deep it is.
    """
    r, at = Reader(), 0
    for m in MARKUP.finditer(page):
        r.say(page[at : m.start()])
        at = m.end()
        if m["tag"] is not None:
            (r.end(m["tag"].lower()) if m["end"] else r.start(m["tag"].lower(), m["rest"], m.start()))
    r.say("" if page[at:].startswith("<!--") else page[at:])
    r.flush()
    out = []
    for e, text, linked in r.found:
        heading = e.tag in HEADINGS
        outside = e.outside or (e.header and not (heading and e.in_main))
        out.append(Block(e.path, text, linked, outside, heading, e.hidden, False, e))
    drop_wrong_hints(out)
    hinted: dict[int, bool] = {}
    doubted: dict[int, bool] = {}
    for e in elements_of(out):  # outer ones first
        hinted[id(e)] = (e.hinted and not e.holds_main) or (e.parent is not None and hinted[id(e.parent)])
        doubted[id(e)] = (e.doubted and not e.holds_main) or (e.parent is not None and doubted[id(e.parent)])
    for b in out:
        b.outside |= hinted[id(b.element)]
        b.doubted = doubted[id(b.element)] and not b.outside
    return out


def elements_of(blocks: list[Block]) -> list[Element]:
    """All elements that hold blocks, outer ones before inner ones."""
    seen: dict[int, Element] = {}
    for b in blocks:
        e = b.element
        while e is not None and id(e) not in seen:
            seen[id(e)], e = e, e.parent
    return sorted(seen.values(), key=lambda e: (e.parent is not None, e.number))


def summed_up(elements: list[Element], own: dict[int, float]) -> dict[int, float]:
    """own (by id) of each element with that of all that is in it."""
    out = {id(e): own.get(id(e), 0.0) for e in elements}
    for e in reversed(elements):
        if e.parent is not None:
            out[id(e.parent)] += out[id(e)]
    return out


def drop_wrong_hints(blocks: list[Block]) -> None:
    """Takes the hint from elements, outer ones first, that hold most of the page's text while less
    than a tenth of theirs lies without a hint: they hold the page, not something beside it."""
    elements = elements_of(blocks)
    if not any(e.hinted and not e.holds_main for e in elements):
        return
    own: dict[int, float] = defaultdict(float)
    for b in blocks:
        own[id(b.element)] += 0 if b.outside or b.hidden else max(0, len(b.text) - b.linked)
    held = summed_up(elements, own)
    nearest: dict[int, int] = {}  # of each element, the innermost hinted one around it
    under: dict[int, float] = defaultdict(float)
    for e in elements:
        nearest[id(e)] = id(e) if e.hinted and not e.holds_main else nearest.get(id(e.parent), 0)
        under[nearest[id(e)]] += own.get(id(e), 0)
    total, free = sum(own.values()), under[0]
    # elements with most of the text lie in one another, so each frees what has no hint within it
    for e in sorted((e for e in elements if e.hinted and not e.holds_main), key=lambda e: -held[id(e)]):
        if 2 * held[id(e)] <= total or 10 * free >= held[id(e)]:
            break
        e.hinted = False
        free += under[id(e)]


def evidence(b: Block) -> float:
    """What the names around a block leave of its score."""
    return BESIDE if b.outside else DOUBT if b.doubted else 1.0


def path_scores(blocks: list[Block], radius: int = 1) -> list[float]:
    """A score for each block, that of its tag path.

    A path's ratio is its text per node, times one more than its punctuation marks per node, less
    what is link text. Ratios are smoothed in page order by a Gaussian; the path's own ratio and the
    mean of its blocks' smoothed ones are fused by their geometric mean. Names that speak against a
    block leave a part of its score (evidence), and of what its neighbours get from it.
    """
    paths: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0, 0.0])
    for b in blocks:
        for i, v in enumerate((1, len(b.text), len(PUNCTUATION.findall(b.text)), b.linked)):
            paths[b.path][i] += v
    own = {p: n / k * (1 + marks / k) * max(0.0, 1 - linked / max(1.0, n)) for p, (k, n, marks, linked, _) in paths.items()}
    ratios = [own[b.path] * evidence(b) for b in blocks]
    kernel = [exp(-(d * d) / 2) for d in range(-radius, radius + 1)]
    for i, b in enumerate(blocks):
        near = [(kernel[d + radius], ratios[i + d]) for d in range(-radius, radius + 1) if 0 <= i + d < len(blocks)]
        paths[b.path][4] += sum(k * v for k, v in near) / sum(k for k, _ in near)
    return [sqrt(own[b.path] * paths[b.path][4] / paths[b.path][0]) * evidence(b) for b in blocks]


def main_blocks(page: str, strictness: float = 0.25, most: float = 0.8) -> list[str]:
    """The blocks of the main text, in page order.

    Content paths are those with a score of ``strictness`` times the mean score of the page's text
    (weighed by length, names and links) or more. The main text lies in the deepest element that has
    ``most`` of the content paths' scores. If that is the page's body, which tells nothing, it is the
    content paths and the headings beside them; else all that the element holds, short paragraphs and
    lists too, but for paths that are mostly links, and for blocks whose names speak against them while their path scores
    less than the mean (less than a content path, where the names are in doubt). The element is widened to
    an article or main around it, and the heading before it belongs to it.
    """
    blocks = [b for b in blocks_of(page) if not b.hidden]
    scores = path_scores(blocks)
    weights = [(len(b.text) - b.linked) * evidence(b) for b in blocks]
    if not sum(weights):
        return []
    mean = sum(s * w for s, w in zip(scores, weights, strict=True)) / sum(weights)
    least = strictness * mean
    content = {b.path for b, s in zip(blocks, scores, strict=True) if s >= least and s > 0}
    elements = elements_of(blocks)
    top, own = elements[0], defaultdict(float)
    of_path: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for b, s in zip(blocks, scores, strict=True):
        of_path[b.path][0] += b.linked
        of_path[b.path][1] += len(b.text)
        if b.path in content:
            own[id(b.element.parent or top)] += s
    held = summed_up(elements, own)
    # elements with most of the scores lie in one another: the last is the deepest
    root = [e for e in elements if held[id(e)] >= most * held[id(top)]][-1] if most > 0.5 else top
    chain = [root]
    while chain[-1].parent is not None:
        chain.append(chain[-1].parent)
    root = next((e for e in reversed(chain) if e.tag in ("article", "main")), root)
    names = {e.tag for e in chain} - {""}
    beside = {id(b.element.parent or top) for b in blocks if b.path in content}
    bare = names <= {"html", "body"}

    def inside(whole: Element) -> set[int]:
        out: set[int] = set()
        for e in elements:
            if e is whole or (e.parent is not None and id(e.parent) in out):
                out.add(id(e))
        return out

    here = inside(root)

    def kept(b: Block, score: float) -> bool:
        if id(b.element) not in here:
            return False
        if bare:
            return b.path in content or (b.heading and not b.outside and id(b.element.parent or top) in beside)
        linked, length = of_path[b.path]
        return 2 * linked <= length and (score >= mean if b.outside else score >= least if b.doubted else True)

    on = [kept(b, s) for b, s in zip(blocks, scores, strict=True)]
    if not bare and True in on:
        first = on.index(True)
        if first and blocks[first - 1].heading and not blocks[first].heading and not blocks[first - 1].outside and id(blocks[first - 1].element) in inside(root.parent or root):
            on[first - 1] = True
    return [b.text for b, k in zip(blocks, on, strict=True) if k]


def extract_text(page: str) -> str:
    return "\n\n".join(main_blocks(page))


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """The main text of every page: id, the columns of ``keep``, text, n_chars (code points).

    One row per input row, in one pass without a shuffle. Null html counts as empty; a page
    without main text has empty text and n_chars 0; null ids, repeated rows and pages of any
    length pass like others. Columns not in ``keep`` are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                texts = [extract_text(x) for x in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    kinds = [(f"c{i}", pages.schema[c].dataType.simpleString()) for i, c in enumerate((id_col, *keep))]
    names = [k for k, _ in kinds] + ["text", "n_chars"]
    schema = ", ".join(f"{k} {t}" for k, t in kinds) + ", text string, n_chars bigint"
    source = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate((id_col, *keep))], text_of(html_col).alias("html"))
    return source.mapInArrow(frugal(run), schema).toDF(id_col, *keep, "text", "n_chars")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html_extraction": op6_html_extraction}
