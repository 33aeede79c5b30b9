"""Main text of web pages: the best-scoring run of blocks, words for and tags against."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.llm.shipping import ship_package

# Fixed values of HTML: elements that start a block, that have no end tag, whose content is no text
# of the page, and that hold something other than the page's article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Raw elements run to the page's end if nothing ends them; the others are skipped only if ended.
RAW = "script|style|title|textarea|noscript|iframe|xmp"
EMBEDDED = frozenset("template object svg canvas audio video annotation annotation-xml".split())
OTHER = frozenset("nav header footer aside form button select menu dialog head label fieldset".split())
CONTENT = frozenset(("article", "main"))
#: Where an article may start; what a head can hold, which ends where anything else starts.
STARTS = CONTENT | {"h1"}
HEAD = frozenset("title base link meta style script noscript template".split())
#: Elements whose end tag may be left out, with those that end them; what holds such elements.
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "tbody", "tfoot"),
    "td": ("td", "th", "tr"), "th": ("td", "th", "tr"),
}
HOLDERS = frozenset("ul ol menu dl table".split())
#: Words of a class, id or role that mark an element as something other than the article.
MARKS = frozenset(
    "ad ads advert adverts alert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "contentinfo consent cookie cookies copyright disqus footer gdpr header masthead menu menubar "
    "nav navbar navigation newsletter notice notices pagination popup promo promoted related "
    "replies search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "warning widget complementary".split()
)
WRAPPERS = frozenset("content main article body wrapper container page site layout has with no".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)",
    re.I | re.S,
)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in EMBEDDED}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


class Block(NamedTuple):
    """A block's text, how many words stand in each context, the tags before it, in the article."""

    text: str
    contexts: dict[tuple[str, bool], int]
    tags: int
    inside: bool


class Weights(NamedTuple):
    """Scores of a word by context (place, innermost block, in a link) and the cost of a tag."""

    words: dict[tuple[str, str, bool], float]
    tag: float

    def of(self, place: str, block: str, link: bool) -> float:
        """A context that no labelled page showed counts for the article, unless it lies outside of
        it or, on a page that marks none, in a link."""
        against = place == "outside" or (place == "unmarked" and link)
        return self.words.get((place, block, link), -1.0 if against else 1.0)


def is_other(name: str, attributes: str) -> bool:
    """Does the element hold menus, adverts, notices or the like, by its name or its marks?

    A mark is the first or last part of a class, id or role, as in ``sidebar-left`` or
    ``post-comments``, unless that names a wrapper, as in ``content-with-sidebar``.
    """
    if name in OTHER:
        return True
    if name in CONTENT and not attributes or name in ("html", "body"):
        return False
    for m in _NAMED.finditer(attributes):
        for label in m[1].strip("\"'").lower().split():
            parts = [p for p in re.split(r"[-_]+", label) if p]
            if parts and parts[0] not in WRAPPERS and (parts[0] in MARKS or parts[-1] in MARKS):
                return True
    return False


class Skip:
    """An element left out: where it starts, its name, whether by its marks, its words, whether it
    ended, and where in it something starts that an article has."""

    def __init__(self, start: int, name: str, marked: bool) -> None:
        self.start, self.name, self.marked = start, name, marked
        self.words, self.ended, self.article = 0, False, start if name in CONTENT else -1


class Parsed(NamedTuple):
    blocks: list[Block]
    marked: bool
    skips: list[Skip]

    def share(self, skip: Skip) -> float:
        """Of all words of the page, those in this element."""
        words = sum(sum(b.contexts.values()) for b in self.blocks) + sum(s.words for s in self.skips)
        return skip.words / max(words, 1)


def page_blocks(html: str) -> tuple[list[Block], bool]:
    """The blocks of a page that are not within other elements, in page order; has it an article?

    An element that nothing ends is left out only up to an article, a main part or a first heading
    that starts in it, and not at all if it holds half the page's words without one. A form, or an
    element that is other by its marks alone, stays if it ends and holds half the words and one of
    these, or, by its marks, three quarters of the words of a page that marks no article: it wraps the
    text. Elements within one that stays are looked at again, to a depth of 8.
    """
    spare: dict[int, int] = {}
    page = _parse(html, spare)
    for _ in range(8):
        more = {}
        for skip in page.skips:
            share = page.share(skip)
            named = share > 0.5 and skip.article >= 0 and (skip.marked or skip.name == "form")
            wraps = named or share > 0.75 and skip.marked and not page.marked
            if not skip.ended and skip.article > skip.start:
                more[skip.start] = skip.article
            elif wraps or not skip.ended and skip.article < 0 and share > 0.5:
                more[skip.start] = skip.start
        if not more:
            break
        spare |= more
        page = _parse(html, spare)
    return page.blocks, page.marked


def _parse(html: str, spare: dict[int, int]) -> Parsed:
    """One pass over a page. ``spare`` names other elements by their start, and where to go on."""
    blocks: list[Block] = []
    skips: list[Skip] = []
    until = -1
    parts: list[str] = []
    contexts: dict[tuple[str, bool], int] = {}
    skipped, depth = "", 0
    links, articles, tags, kind, marked = 0, 0, 0, "body", False

    def close() -> None:
        nonlocal tags, contexts
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            blocks.append(Block(text, contexts, tags, articles > 0))
            tags = 0
        contexts = {}

    def text(piece: str) -> None:
        if skipped:
            skips[-1].words += len(piece.split())
        elif piece:
            parts.append(piece)
            key = (kind, links > 0)
            contexts[key] = contexts.get(key, 0) + len(piece.split())

    end, unended = 0, set()
    while m := _TOKEN.search(html, end):
        text(html[end : m.start()])
        end = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        if name in EMBEDDED and not closing and name not in unended:
            if name == "svg" and attributes.rstrip().endswith("/"):
                continue
            if stop := _ENDS[name].search(html, end):
                end = stop.end()
                continue
            unended.add(name)
        if skipped and m.start() == until:
            skipped, skips[-1].ended = "", True
        if skipped:
            if not closing and name in STARTS and skips[-1].article < 0:
                skips[-1].article = m.start()
            if skipped == "head" and name not in HEAD and name != "head":
                skipped = ""  # its end tag may be left out
            elif skipped == "p" and name in BLOCKS and not (closing and name == "p"):
                skipped = ""  # a paragraph ends where the next block starts
            elif skipped in SIBLINGS and depth == 1 and (
                name in SIBLINGS[skipped] if not closing else name in HOLDERS
            ):
                skipped = ""  # an item ends where the next one starts, or with its list or table
            else:
                if name == skipped and skipped not in SIBLINGS or skipped in SIBLINGS and name in HOLDERS:
                    depth += -1 if closing else 1
                elif closing and name == skipped and depth == 1:
                    depth = 0
                if not depth:
                    skipped, skips[-1].ended = "", True
                continue
            skips[-1].ended = True
        tags += 1
        by_name = name in OTHER
        other = not closing and (by_name or is_other(name, attributes))
        other = other and name not in VOID and spare.get(m.start()) != m.start()
        if name == "br":
            parts.append(" ")
        elif name == "a":
            links = 0 if closing else 1
        if name in BLOCKS:
            close()
            kind = "body" if closing else name
            if name in CONTENT and not other:
                articles = max(0, articles - 1) if closing else articles + 1
                links, marked = 0, True
        if other:
            close()
            skipped, depth, until = name, 1, spare.get(m.start(), -1)
            skips.append(Skip(m.start(), name, not by_name))
    text(html[end:])
    close()
    return Parsed(blocks, marked, skips)


def _places(blocks: list[Block], marked: bool) -> list[str]:
    """Of each block: inside the page's article, outside it, or on a page that marks none."""
    return [("inside" if b.inside else "outside") if marked else "unmarked" for b in blocks]


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run of the greatest positive sum, in one scan; the longest of ties."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best > 0 and i + 1 - start > bounds[1] - bounds[0]):
            best, bounds = total, (start, i + 1)
    return bounds


def main_text(html: str | None, weights: Weights) -> str:
    blocks, marked = page_blocks(html or "")
    scores = []
    for block, place in zip(blocks, _places(blocks, marked), strict=True):
        words = sum(n * weights.of(place, *c) for c, n in block.contexts.items())
        scores.append(words - weights.tag * block.tags)
    start, end = best_run(scores)
    return "\n".join(b.text for b in blocks[start:end])


def learn_weights(pages: DataFrame, html: str = "html", key: str = "page_id", sample: int = 2000) -> Weights:
    """Log-odds of the article's words in each context, from pages that mark their article.

    Learned from about ``sample`` of the pages that have an article or main tag, picked by a hash of
    their key. A tag costs a hundredth of
    what the weakest word of an article brings, over the tags that an article's block has.
    """
    ship_package(pages.sparkSession)
    labelled = pages.filter(F.col(html).rlike(r"(?i)</?(article|main)[\s/>]"))
    share = min(1.0, sample / max(labelled.count(), 1))
    picked = labelled.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[tuple, list[int]] = {}
        tags = [0, 0]
        for batch in batches:
            for page in batch.column(0).to_pylist():
                blocks, marked = page_blocks(page or "")
                for block, place in zip(blocks, _places(blocks, marked), strict=True):
                    if place == "unmarked":
                        continue
                    tags[0] += block.tags if block.inside else 0
                    tags[1] += block.inside
                    for c, n in block.contexts.items():
                        for k in ((place, *c), ("unmarked", *c)):
                            out.setdefault(k, [0, 0])[block.inside] += n
        rows = [(*k, *v) for k, v in out.items()] + [("tags", "", False, *tags)]
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "block", "link", "no", "yes"])

    counted = picked.select(html).mapInArrow(
        count, "place string, block string, link boolean, no long, yes long"
    )
    sums = counted.groupBy("place", "block", "link").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    words, tags = {}, 1.0
    for r in sums.collect():  # one row for each context: places x block elements x 2
        if r.place == "tags":
            tags = max(1.0, r.no / max(r.yes, 1))
        else:
            words[(r.place, r.block, r.link)] = max(-4.0, min(4.0, math.log((r.yes + 1) / (r.no + 1))))
    least = min([w for w in words.values() if w > 0], default=1.0)
    return Weights(words, least / (100 * tags))


def extract_text(
    pages: DataFrame, weights: Weights, key: Column | str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Rows (key, url, text, n_chars): the main text of each page, its blocks joined by newlines.

    White space within a block becomes one space, character references are decoded. A null page, and
    one without a run of blocks that scores above 0, has the empty text. Repeated rows, null keys
    and null urls are kept as they are; an empty table gives no rows; other columns are not read.
    """
    ship_package(pages.sparkSession)
    schema = pages.select(key, url).schema.add("text", "string").add("n_chars", "long")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, weights) for x in batch.column(2).to_pylist()]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(key, url, html).mapInArrow(extract, schema)
