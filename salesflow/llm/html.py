"""Main text of web pages by removing site templates.

A page is parsed once into a tree. The hashes of its element subtrees (tag, attributes, text,
children), of the whole page whatever it marks, are counted per host by Spark, once per page, and
subtrees that recur on many pages of a host are template parts: they are deleted. So are elements whose role is not the article's: by tag
(nav, header, footer, aside, form, script, style, ...), by ARIA role, or by a whole word of their class
or id (menu, advert, cookie, comments, ...), unless they hold main content or most of the page's text. Inline
elements are never judged by name, and in marked main content a name that parts of an article have too
(related, social, notice, ...) counts only if most of the element's text is links. Where a page marks its main content (article, main,
``role=main``), the text is what lies inside; only boxes in it (div, section, list, table, ... with
less than half of its text) that recur are deleted there, never paragraphs, so pages that share
passages and copies of a page keep their article: pages of equal text count once. A header inside an
article is its heading, and stays.

What recurs is told by a number of pages, not by a share of the host: a section's template counts the
same on a small host and on a large one. Near copies of a page count as different pages.

Each page is one row all along: parsed to its blocks of text, the subtrees that recurrence may delete
with the blocks they hold, however deep, and the hashes of all its subtrees, written once; the counts
read the hashes only, and only pages whose main text has a subtree to judge take part in a join."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.urls import host_of
from salesflow.staging import stage

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_DROP = frozenset(
    "script style noscript template title head nav footer aside form button select textarea input iframe "
    "object embed svg canvas audio video dialog menu noembed noframes xmp".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar "
    "status".split()
)
_NAMES = re.compile(
    r"ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr"
    r"|notices?|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|side-bar|footer|site-header|page-header|masthead"
    r"|comments?|commentlist|replies|disqus|share|sharing|social|related|recommended|newsletter|subscribe|subscription"
    r"|signup|sign-up|login|popup|modal|overlay|widgets?|pagination|pager|toolbar|skip-link",
    re.I,
)
# of these names, those that parts of an article have as well
_OFTEN_OWN = re.compile(
    r"promo(?:tion)?s?|banner|notices?|share|sharing|social|related|recommended|widgets?|overlay|modal|popup", re.I
)
# an open element that a new one of these ends, as HTML lets end tags be left out
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
_P_ENDS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
_BOXES = frozenset("div section ul ol dl table figure details fieldset center".split())
_STOPS = frozenset(("table", "ul", "ol", "dl", "article", "section", "div", "body", "main", "td", "th", "select"))


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes = tag, attributes
        self.children: list[Element | str] = []

    def is_main(self) -> bool:
        return self.tag in _MAIN or self.attributes.get("role", "").lower() == "main"

    def is_dropped(self, in_main: bool) -> bool:
        """By its tag or role, whatever it holds."""
        if self.tag in _DROP or (self.tag == "header" and not in_main):
            return True
        if not self.attributes or self.tag in ("html", "body"):
            return False
        return self.attributes.get("role", "").lower() in _ROLES or "hidden" in self.attributes

    def is_named(self) -> bool:
        """Whether a whole word of class or id names another part than the article: ``cookie-notice``
        does, of two such words, but ``has-sidebar`` and ``comments-open`` tell about the page."""
        return any(True for _ in self._telling_names())

    def is_surely_named(self) -> bool:
        """Whether some such name is none that parts of an article have."""
        return any(not _OFTEN_OWN.fullmatch(word) for name in self._telling_names() for word in name)

    def _telling_names(self) -> Iterator[list[str]]:
        """The words of each class or id that names another part."""
        if not self.attributes or self.tag in ("html", "body") or self.tag in _INLINE or self.is_main():
            return
        for name in f"{self.attributes.get('class', '')} {self.attributes.get('id', '')}".split():
            words = [name] if _NAMES.fullmatch(name) else re.split("[_-]+", name.strip("_-"))
            if all(map(_NAMES.fullmatch, words)):
                yield words


def parse(page: str) -> Element:
    """The tree of a page, however malformed: tags that do not match are ignored, open ones end with
    their parent, a paragraph ends where a block begins."""
    root = Element("", {})
    stack = [root]
    at, end = 0, len(page)
    while at < end:
        found = _MARKUP.search(page, at)
        if found is None:
            stack[-1].children.append(page[at:])
            break
        if found.start() > at:
            stack[-1].children.append(page[at : found.start()])
        at = found.end()
        closing, tag, rest = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag in _VOID:
                if tag == "br":
                    stack[-1].children.append(Element("br", {}))
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if tag in _INLINE and stack[depth].tag not in _INLINE:
                    break  # an inline end tag does not close blocks
            continue
        _end_implied(stack, tag)
        attributes = {}
        if rest and rest.strip("/ \t\n\r"):
            for name, *values in _ATTRIBUTE.findall(rest):
                attributes.setdefault(name.lower(), entities.unescape("".join(values)))
        element = Element(tag, attributes)
        stack[-1].children.append(element)
        if tag in _VOID:
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            element.children.append(page[at : close.start() if close else end])
            at = close.end() if close else end
        else:
            stack.append(element)
    return root


def _end_implied(stack: list[Element], tag: str) -> None:
    ended = _ENDS.get(tag)
    if ended:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ended:
                del stack[depth:]
                if tag not in ("tr",):
                    break
            elif stack[depth].tag in _STOPS and stack[depth].tag not in ended:
                break
    if tag in _P_ENDS:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == "p":
                del stack[depth:]
                break
            if stack[depth].tag not in _INLINE:
                break


class Subtrees:
    """Hashes and letters of the element subtrees of a whole page, by the element's identity."""

    def __init__(self, root: Element) -> None:
        self.hashes: dict[int, int] = {}
        self.letters: dict[int, int] = {}
        self.shown: dict[int, int] = {}  # letters without those of elements dropped by tag or role
        self.links: dict[int, int] = {}  # letters inside links
        self.root = root
        elements: list[Element] = []
        todo = [root]
        while todo:
            node = todo.pop()
            elements.append(node)
            todo += [c for c in node.children if isinstance(c, Element)]
        for node in reversed(elements):  # children before their parents
            parts, n = [node.tag, *(f"{k}={v}" for k, v in sorted(node.attributes.items()))], 0
            for child in node.children:
                text = str(self.hashes[id(child)]) if isinstance(child, Element) else _SPACE.sub(" ", child).strip()
                n += self.letters[id(child)] if isinstance(child, Element) else len(text)
                parts.append(text)
            digest = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
            self.hashes[id(node)] = digest - (1 << 63)
            self.letters[id(node)] = n
            shown = (
                self.shown[id(c)] if isinstance(c, Element) else len("".join(c.split())) for c in node.children
            )
            inside = sum(self.links[id(c)] for c in node.children if isinstance(c, Element))
            self.links[id(node)] = n if node.tag == "a" else inside
            self.shown[id(node)] = 0 if node.is_dropped(True) else sum(shown)
        #: of the blocks that hold text, which are counted per host wherever on the page they stand
        self.counted = sorted(
            {self.hashes[id(e)] for e in elements if e is not root and e.tag not in _INLINE and self.letters[id(e)]}
        )

    def is_most(self, node: Element) -> bool:
        """Whether ``node`` holds most of the page's text."""
        return 2 * self.shown[id(node)] > self.shown[id(self.root)]

    def is_other_part(self, node: Element, in_main: bool) -> bool:
        """Whether its class or id, and in main content a second sign, tell that ``node`` is not the
        article's."""
        if not node.is_named() or self.is_most(node):
            return False
        return not in_main or node.is_surely_named() or 2 * self.links[id(node)] > self.letters[id(node)]

    def judged(self, node: Element, top: Element, in_main: bool) -> bool:
        """Whether recurrence may delete ``node``: any block, in main content only boxes with less
        than half of its text."""
        if node is top or not in_main:
            return node is not top and node.tag not in _INLINE
        return node.tag in _BOXES and 2 * self.letters[id(node)] < self.letters[id(top)]


@dataclass(frozen=True)
class Parsed:
    """Blocks of text in page order; the subtrees that recurrence may delete, each as its hash and
    the first block in it and the first one after it; the hashes of all subtrees of the whole page
    that hold text; whether the page marks its main content."""

    texts: list[str]
    judged: list[tuple[int, int, int]]
    counted: list[int]
    marked: bool


def read_page(page: str | None) -> Parsed:
    root = parse(page or "")
    subtrees = Subtrees(root)
    texts: list[str] = []
    judged: list[tuple[int, int, int]] = []
    words: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(words)).strip()
        words.clear()
        if text:
            texts.append(text)

    def walk(top: Element, in_main: bool) -> None:
        first: dict[int, int] = {}
        todo: list[tuple[bool, Element | str]] = [(True, top)]
        while todo:
            opens, node = todo.pop()
            if isinstance(node, str):
                words.append(entities.unescape(node))
                continue
            if node.tag not in _INLINE or node.tag in _VOID:
                flush()
            if not opens:
                if len(texts) > first.get(id(node), len(texts)):
                    judged.append((subtrees.hashes[id(node)], first[id(node)], len(texts)))
            elif node.tag not in _VOID and not node.is_dropped(in_main) and not subtrees.is_other_part(node, in_main):
                if subtrees.judged(node, top, in_main):
                    first[id(node)] = len(texts)
                todo.append((False, node))
                todo += [(True, c) for c in reversed(node.children)]
        flush()

    mains = _mains([root], subtrees)
    for top in mains or [root]:
        walk(top, bool(mains))
    return Parsed(texts, judged, subtrees.counted, bool(mains))


def without(texts: Iterable[str], judged: Iterable[tuple[int, int, int]], gone: set[int]) -> list[str]:
    """The blocks that stand in no subtree whose hash is in ``gone``."""
    texts = list(texts)
    depth = np.zeros(len(texts) + 1, dtype=np.int64)
    for digest, first, end in judged:
        if digest in gone:
            depth[first] += 1
            depth[end] -= 1
    return [t for t, d in zip(texts, np.cumsum(depth)[:-1], strict=True) if not d]


def _mains(tops: list[Element | str], subtrees: Subtrees) -> list[Element]:
    """Outermost elements of main content that are not inside a part that is dropped; articles in a
    ``main`` stand for it, so that what is beside them goes. Below an element whose class or id names
    another part, articles are teasers and the like, unless it holds most of the page's text or there
    is no main content elsewhere; a ``main`` always counts."""
    found: list[tuple[bool, Element]] = []  # in page order; whether it may be a teaser
    todo = [(False, e) for e in reversed(tops) if isinstance(e, Element)]
    while todo:
        aside, node = todo.pop()
        if node.is_main():
            if node.tag != "article":
                found += [(False, e) for e in _mains(node.children, subtrees) or [node]]
            else:
                found.append((aside, node))
            continue
        if node.is_dropped(False):
            continue
        if node.is_named():
            aside = aside or not subtrees.is_most(node)
        todo += [(aside, c) for c in reversed(node.children) if isinstance(c, Element)]
    return [e for aside, e in found if not aside] or [e for _, e in found]


def _read(pages: Column) -> Column:
    judged = "array<struct<hash:bigint,first:int,end:int>>"

    @F.pandas_udf(f"struct<texts:array<string>,judged:{judged},counted:array<bigint>,marked:boolean>")
    def parsed(batch: pd.Series) -> pd.DataFrame:
        rows = [read_page(page) for page in batch]
        spans = [[dict(zip(("hash", "first", "end"), s, strict=True)) for s in r.judged] for r in rows]
        return pd.DataFrame(
            {
                "texts": [r.texts for r in rows],
                "judged": spans,
                "counted": [r.counted for r in rows],
                "marked": [r.marked for r in rows],
            }
        )

    return parsed(pages.cast("string"))


def _text_without(parsed: Column, gone: Column) -> Column:
    """The blocks that are left, joined; ``gone``: hashes of the subtrees that go, or null."""

    @F.pandas_udf("string")
    def left(texts: pd.Series, judged: pd.Series, hashes: pd.Series) -> pd.Series:
        out = []
        for blocks, spans, some in zip(texts, judged, hashes, strict=True):
            spans = [(s["hash"], s["first"], s["end"]) for s in spans]
            out.append(" ".join(without(blocks, spans, set() if some is None else set(some))))
        return pd.Series(out, dtype=object)

    return left(parsed["texts"], parsed["judged"], gone)


def extract_text(
    pages: DataFrame,
    *,
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 5,
    min_pages_main: int = 8,
) -> DataFrame:
    """``pages`` without the html, with ``text``, the blocks of main text joined by one space, and
    ``n_chars``, its code points.

    A subtree is deleted if it stands on at least ``min_pages`` pages of its host (a box in marked
    main content: ``min_pages_main``); pages of equal text count as one. Null and empty html give an empty text. A null url, or one without a host, belongs
    to the host "". Repeated rows are extracted one by one. Columns named like a new one are
    replaced, all others kept."""
    names = {}
    for name in ("page", "host", "version", "parsed", "of", "deleted"):
        names[name] = f"_{name}"
        while names[name] in pages.columns:
            names[name] = f"_{names[name]}"
    page, host, version, parsed, of, gone = names.values()
    read = pages.withColumns(
        {host: host_of(F.col(url_col).cast("string")), parsed: _read(F.col(html_col))}
    ).drop(html_col)
    read = read.withColumns({page: F.monotonically_increasing_id(), version: F.xxhash64(F.col(parsed)["texts"])})
    read = stage(read, "parsed")
    mixed = F.size(F.col(parsed)["judged"]) > 0
    found = read.select(
        F.col(host).alias("host"), F.col(version).alias("version"), F.explode(F.col(parsed)["counted"]).alias("hash")
    )
    counted = found.distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    counted = counted.filter(F.col("n") >= min(min_pages, min_pages_main))
    template = stage(counted.select(F.col("host").alias("t_host"), "hash", "n"), "templates", compact=True)
    least = F.when(F.col(parsed)["marked"], min_pages_main).otherwise(min_pages)
    placed = read.filter(mixed).select(
        F.col(host).alias("host"),
        F.col(page).alias(of),
        least.alias("least"),
        F.explode(F.array_distinct(F.col(parsed)["judged"]["hash"])).alias("h"),
    )
    deleted = (
        placed.join(template, (F.col("host") == F.col("t_host")) & (F.col("h") == F.col("hash")))
        .filter(F.col("n") >= F.col("least"))
        .groupBy(of)
        .agg(F.collect_list("hash").alias(gone))  # at most the subtrees of one page
    )
    whole = read.filter(~mixed).withColumn("text", F.array_join(F.col(parsed)["texts"], " "))
    cut = read.filter(mixed).join(stage(deleted, "deleted", compact=True), F.col(page) == F.col(of), "left")
    cut = cut.withColumn("text", _text_without(F.col(parsed), F.col(gone))).drop(of, gone)
    out = whole.unionByName(cut).drop(host, version, parsed, page)
    return out.withColumn("n_chars", F.length("text").cast("long"))
