"""Main text of web pages by tag-path ratios.

A page is read as blocks: runs of text between block tags, each with the path of block tags
from the root to it. Inline tags don't break a block and are no part of a path, so a stray <b>
changes nothing. What markup itself names as no article is left out while reading: scripts,
styles, forms, menus, headers, footers, sidebars, notices, adverts, comments (see SKIPPED,
NAMES and COMMENT_HEADINGS).

Of the rest, every path gets two ratios over its blocks: characters outside of links per
block, and punctuation per block. Along the page each is smoothed over neighbouring blocks with
a Gaussian, so that a short path amid long ones rises and a menu far from text falls; smoothed
ratios are averaged over a path's blocks and fused by their product, less the share of links.
Paths of at least SHARE of the best fused value are content paths. The page's article is the
element that holds them: an <article> or <main> with most of their text, or else the lowest
element that holds nearly all of it. In it, blocks of content paths stay, and so do headings,
items, cells and plain paragraphs, which may be short, unless their path is mostly links.

Null, empty and markup-free pages are fine: a text without tags is one block. Unclosed and
badly nested tags are closed as browsers close them. Repeated rows are read each; a page with
no content has an empty text. Pages are independent, so nothing is shuffled: a task's memory
is its largest page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fused value of a content path, as a share of the best; width of the smoothing in blocks; text that the article's element must hold; links of a path that is a menu.
SHARE, SIGMA, HELD, LINKED = 0.1, 1.0, 0.8, 0.6
#: Deeper elements count as beside the deepest, as in browsers.
DEPTH = 512

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SKIPPED = frozenset("script style textarea title iframe noembed noframes noscript template head svg canvas object audio video form button select datalist dialog menu nav header footer aside".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset("ol ul menu".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements that a </p>, a <p> or an end tag of another element doesn't reach beyond.
SCOPES = frozenset("table td th caption button object template".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption summary address".split())

#: Words of a class, id or role that name what is no article, whatever the element.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice notification alert popup modal overlay paywall "
    "newsletter subscribe subscription signup login nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar sidebars aside complementary widget widgets related recommended recommendations teaser "
    "share sharing social comment comments commentlist disqus discussion respond reply replies responses footer contentinfo colophon header masthead topbar toolbar search skip copyright".split()
)
#: Words beside them that say something about a whole page instead.
NEUTRAL = frozenset("with without has have no not wrap wrapper layout open closed enabled disabled off on".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies responses".split())
_HOLDERS = frozenset("html body article main".split())

# Quotes count after a = only; what is cut off in a tag or comment is none of the text.
_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<more>(?>[^>\"'=]+|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))|[=\"'])*+)(?:>|\Z)|</[^A-Za-z][^>]*+(?:>|\Z)", re.DOTALL)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])(?!\s*=\s*[\"']?until-found)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Headings that begin a page's comments, up to the end of the element they are in; and how a line of rights begins.
COMMENT_HEADINGS = frozenset("comments|comment|reader comments|user comments|leave a comment|leave a reply|responses|kommentare|kommentar|leserkommentare|commentaires|commentaire|comentarios|comentario".split("|"))
_RIGHTS = re.compile(r"©|\(c\)|copyright\b", re.IGNORECASE)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
_TABLES = frozenset(["table", "td", "th"])
_FREE = SCOPES | frozenset("body html article main tr tbody thead tfoot".split())
_NOWHERE: frozenset[str] = frozenset()
_BLOCKS = _TABLES | CLOSES_P | LEAVES


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    path: int
    skipped: bool
    above: "Element | None"
    depth: int
    paragraph: "Element | None"  # the open <p> that a block tag in here closes


@dataclass(slots=True)
class Block:
    element: Element
    text: str = ""
    linked: int = 0
    parts: list[str] = field(default_factory=list)


def named_away(tag: str, more: str) -> bool:
    """Whether an element's class, id or role says that it is no article."""
    if "=" not in more:
        return False
    for _, value in _NAMED.findall(more):
        for name in value.strip("\"'").split():
            words = [w.lower() for w in _WORDS.findall(name)]
            if tag in _HOLDERS:  # an article is a comment if it is called just that
                if tag == "article" and words and words[0] in COMMENTS | {"ad", "advert", "promo", "related", "sponsored", "teaser"}:
                    return True
            elif not NAMES.isdisjoint(words) and NEUTRAL.isdisjoint(words):
                return True
    return False


def _part_of_path(tag: str, more: str) -> str:
    """A tag as a path has it: generic containers with their first class, less digits."""
    if tag in ("div", "section", "td", "ul", "ol", "table", "article", "main") and (found := _NAMED.search(more)):
        name = re.sub(r"[\d_-]+", "", (found[2].strip("\"'").split() or [""])[0])
        return f"{tag}.{name}" if name else tag
    return tag


class Reader:
    """Blocks of a page in its order, without those of skipped elements."""

    def __init__(self, page: str):
        self.page, self.blocks = page, []
        self.here = Element("", 0, 0, False, None, 0, None)
        self.count, self.block, self.paths = 0, None, {}
        self._read()

    def _open(self, tag: str, more: str) -> None:
        self.count += 1
        up = self.here if self.here.depth < DEPTH else self.here.above
        skipped = up.skipped or tag in SKIPPED or named_away(tag, more) or bool(more and _HIDDEN.search(more))
        path = up.path if tag in INLINE else self.paths.setdefault((up.path, _part_of_path(tag, more)), len(self.paths) + 1)
        new = Element(tag, self.count, path, skipped, up, up.depth + 1, None if tag in SCOPES else up.paragraph)
        if tag == "p":
            new.paragraph = new
        self.here = new

    def _find(self, tags: frozenset[str], stop: frozenset[str]) -> Element | None:
        at = self.here
        while at.above is not None and at.tag not in stop:
            if at.tag in tags:
                return at
            at = at.above
        return None

    def _read(self) -> None:
        page, at = self.page, 0
        while True:
            token = _TOKEN.search(page, at)
            self._text(page[at : token.start()] if token else page[at:])
            if token is None:
                break
            at = token.end()
            if token["tag"] is None:
                continue
            tag, more = token["tag"].lower(), token["more"]
            if token["end"]:
                self._end(tag)
                continue
            self._start(tag, more)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
                if tag not in SKIPPED:
                    self._text(page[at : end.start()])
                at = end.end()
                self._end(tag)
        self._finish()

    def _start(self, tag: str, more: str) -> None:
        if tag not in INLINE and tag != "br":
            self._finish()
        if tag == "br":
            self._text(" ")
        if tag in CLOSES_P and self.here.paragraph is not None:
            self.here = self.here.paragraph.above
        if tag in SIBLINGS:
            before, stop = SIBLINGS[tag]
            while found := self._find(before, stop):
                self.here = found.above
        if tag not in VOID:
            self._open(tag, more)

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._finish()
        if self.here.tag == tag:
            self.here = self.here.above
            return
        stop = _BLOCKS if tag in INLINE else _NOWHERE if tag in _FREE else _TABLES
        if found := self._find(frozenset([tag]), stop):
            self.here = found.above

    def _text(self, text: str) -> None:
        if not text or self.here.skipped:
            return
        if self.block is None:
            if text.isspace():
                return
            at = self.here
            while at.tag in INLINE and at.above is not None:
                at = at.above
            self.block = Block(at)
        self.block.parts.append(text)
        at = self.here
        while at.tag in INLINE and at.above is not None:
            if at.tag == "a":
                self.block.linked += len(text)
                break
            at = at.above

    def _finish(self) -> None:
        block, self.block = self.block, None
        if block is not None:
            text = "".join(block.parts)
            block.text = " ".join((html.unescape(text) if "&" in text else text).split())
            block.parts = []
            if block.text:
                self.blocks.append(block)


def smoothed(values: np.ndarray) -> np.ndarray:
    """Each value with its neighbours, weighed by a Gaussian; at the ends, by what there is of it."""
    reach = int(np.ceil(3 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]
    return np.convolve(values, kernel)[reach : reach + len(values)] / weight


def content_paths(path: np.ndarray, chars: np.ndarray, linked: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By path: whether it is a content path, and its share of links. All arrays are by block, path is a number."""
    n = np.bincount(path)
    text, links = np.bincount(path, chars - linked), np.bincount(path, linked)
    ratios = [smoothed((total / n)[path]) for total in (text, np.bincount(path, marks) + n)]
    fused = np.prod([np.bincount(path, r) / n for r in ratios], axis=0) * (text / np.maximum(text + links, 1))
    return fused >= SHARE * max(fused.max(), 1e-9), links / np.maximum(text + links, 1)


def _article(blocks: list[Block], weight: np.ndarray) -> Element:
    """The element that holds the content paths' text (weight, by block)."""
    held: dict[int, float] = {}
    elements: dict[int, Element] = {}
    for block, w in zip(blocks, weight.tolist(), strict=True):
        at = block.element
        while at is not None:
            held[at.number] = held.get(at.number, 0.0) + w
            elements[at.number] = at
            at = at.above
    total = held[0]
    for tag in ("article", "main"):
        named = [e for e in elements.values() if e.tag == tag]
        best = max(named, key=lambda e: (held[e.number], e.number), default=None)
        if best is not None and 2 * held[best.number] >= max((held[e.number] for e in elements.values() if e.tag == "main"), default=0) and held[best.number] > 0:
            return best
    return max((e for e in elements.values() if e.tag not in LEAVES and held[e.number] >= HELD * total), key=lambda e: e.number)


def _inside(element: Element | None, outer: Element) -> bool:
    while element is not None and element is not outer:
        element = element.above
    return element is outer


def _without_comments(blocks: list[Block]) -> list[Block]:
    out, outer = [], None
    for block in blocks:
        if outer is not None and _inside(block.element, outer):
            continue
        outer = None
        if block.element.tag in _HEADINGS and re.sub(r"[\d\W]+", " ", block.text).strip().lower() in COMMENT_HEADINGS:
            outer = block.element.above
        else:
            out.append(block)
    return out


def main_text(page: str) -> str:
    blocks = _without_comments(Reader(page).blocks)
    if not blocks:
        return ""
    path = np.unique(np.array([b.element.path for b in blocks]), return_inverse=True)[1]
    chars = np.array([len(b.text) for b in blocks], float)
    linked = np.minimum(np.array([b.linked for b in blocks], float), chars)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in blocks], float)
    content, links = content_paths(path, chars, linked, marks)
    article = _article(blocks, (chars - linked) * content[path])
    named = article.tag in ("article", "main")
    out = []
    for block, p in zip(blocks, path.tolist(), strict=True):
        kept = named or block.element.tag in LEAVES or (content[p] and not _RIGHTS.match(block.text))
        if kept and links[p] <= LINKED and _inside(block.element, article):
            out.append(block.text)
    return " ".join(out)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names)

    names = ["id", "url", "text", "n_chars"]
    read = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("page"))
    kind = read.schema["id"].dataType.simpleString()
    return read.mapInArrow(run, f"id {kind}, url string, text string, n_chars long").toDF(id, url, "text", "n_chars")
