"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import slices

#: Every alternative matches once it has begun, so no place of a page is scanned twice; quotes count after an equals sign only.
_MARKUP = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?)*+)(?:>|\Z)|(?:[!?]|/[^a-zA-Z])[^>]*+(?:>|\Z))""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++)))?""")
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head title script style noscript template iframe object embed svg math canvas audio video map nav aside footer form button input select "
    "textarea dialog menu xmp noembed noframes".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: What a class or id may say about a part of a page that is not the article.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup social share sharing related recommended recommendations widget toolbar pagination pager login search skip".split()
)
#: Those of them that may be a part of a longer name inside an article without its text being something else.
AMBIGUOUS_WORDS = frozenset(
    "alert banner footer header login masthead menu nav navigation notice notices overlay pager pagination popup promotion recommended related search "
    "share sharing skip social toolbar widget".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond reader responses".split())
ARTICLE_WORDS = frozenset("article articlebody body content entry hentry main page post story text".split())
TEXT = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6".split())
BESIDE = TEXT | frozenset("ul ol dl figure table".split())
SHORT = 80  # characters below which a part of an article with an ambiguous name goes
LINKED = 0.25  # share of text in links from which a part counts as navigation
#: An element that one of these tags opens inside ends first.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
FENCES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
ENDS_P = BLOCK - {"option", "legend", "summary", "html", "body", "tbody", "td", "tfoot", "th", "thead", "tr"}
TAG_POINTS = {"article": 25.0, "main": 20.0, "section": 2.0, "div": 2.0, "td": 1.0, "blockquote": 1.0, "pre": 1.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "table": -1.0}


class Node:
    __slots__ = ("tag", "words", "names", "role", "parent", "children", "dropped", "suspect", "block", "link", "in_article", "points", "chars", "linked", "score")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str] = frozenset(), role: str = "", hidden: bool = False) -> None:
        self.tag, self.parent, self.names, self.role = tag, parent, names, role
        self.words = frozenset(w for name in names for w in _WORD.findall(name))
        self.children: list[Node | str] = []
        self.points = self.chars = self.linked = self.score = 0.0
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.link = self.block is not self and (tag == "a" or parent.link)
        self.in_article = bool(parent) and (parent.in_article or parent.tag == "article")
        self.suspect = False
        self.dropped = bool(parent and parent.dropped) or hidden or self._unwanted()

    def _unwanted(self) -> bool:
        if self.tag in DROPPED or self.role in DROPPED_ROLES:
            return True
        if self.tag in ("html", "body", "main"):
            return False
        if self.words & COMMENT_WORDS:
            return True
        if self.tag == "article" or self.words & ARTICLE_WORDS:
            return False
        said = self.words & DROPPED_WORDS
        if said and self.in_article and said <= AMBIGUOUS_WORDS and not self.names & said:
            self.suspect = True
            return False
        return bool(said) or self.tag == "header" and not self.in_article


def parse(page: str) -> Node:
    """A tree of the page's elements; text is decoded. Tags that HTML lets be left out are supplied, stray end tags skipped."""
    root = Node("html", None)
    path = [root]  # the open elements
    opened: dict[str, list[int]] = {}  # places in the path by tag
    at, end = 0, len(page)

    def leave(depth: int) -> None:
        while len(path) > depth:
            opened[path.pop().tag].pop()

    def nearest(tags: Iterable[str]) -> int:
        return max((places[-1] for t in tags if (places := opened.get(t))), default=0)

    while at < end:
        found = _MARKUP.search(page, at)
        text = page[at : found.start() if found else end]
        if text:
            path[-1].children.append(html.unescape(text))
        if not found:
            break
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["close"]:
            if depth := nearest((tag,)):
                leave(depth)
            continue
        if tag in ("html", "body"):
            if tag == "body" and (depth := nearest(("head",))):
                leave(depth)
            continue
        if tag in ENDS_P and (depth := nearest(("p",))) > nearest(("td", "th", "button", "object")):
            leave(depth)
        if tag in ENDS:
            while (depth := nearest(ENDS[tag])) > nearest(FENCES.get(tag, ("table",))):
                leave(depth)
        names, role, hidden = frozenset(), "", False
        if attrs := found["attrs"]:
            said = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
            if "class" in said or "id" in said:
                names = frozenset(f"{said.get('class', '')} {said.get('id', '')}".lower().split())
            role = said.get("role", "").lower()
            hidden = "hidden" in said or said.get("aria-hidden") == "true" or bool(_HIDDEN.search(said.get("style", "").lower()))
        child = Node(tag, path[-1], names, role, hidden)
        path[-1].children.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])[^>]*+(?:>|\\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        opened.setdefault(tag, []).append(len(path))
        path.append(child)
    return root


def _in_order(root: Node) -> list[Node]:
    """Elements that are not dropped, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.dropped:
            out.append(node)
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def score(root: Node) -> list[Node]:
    """Points of every container: each block of text passes its points for length and commas to its ancestors, fewer the
    farther they are; what lies in links counts against them."""
    nodes = _in_order(root)
    for node in nodes:
        own = "".join(c for c in node.children if isinstance(c, str)).strip()
        if own:
            block = node.block
            block.chars += len(own)
            block.linked += len(own) if node.link else 0
            block.points += own.count(",") + own.count("，") + own.count("、") + len(own) / 100
    for node in nodes:
        if node.chars:
            points = (1 + node.points) * (1 - node.linked / node.chars)
            holder, share = (node.parent if node.tag in ("p", "pre", "blockquote") or re.fullmatch("h[1-6]", node.tag) else node), 1.0
            while holder is not None and share > 0.1:
                holder.score += points * share
                holder, share = holder.parent, share / 2
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
    for node in nodes:
        if node.suspect and node.tag not in TEXT and (node.chars < SHORT or node.linked >= node.chars * LINKED):
            node.dropped = True
    for node in nodes:
        if node.score:
            extra = TAG_POINTS.get(node.tag, 0.0) + (10.0 if node.words & ARTICLE_WORDS else 0.0)
            node.score = max(0.0, (node.score + extra) * (1 - node.linked / max(1.0, node.chars)))
    return nodes


def main_parts(root: Node) -> list[Node]:
    """The best container, widened to the article that holds it, its headline, and those of its siblings that read like it."""
    nodes = score(root)
    scored = [n for n in nodes if n.score > 0 and n.tag in BLOCK]
    if not scored:
        return [root]
    best = max(scored, key=lambda n: n.score)
    holder = best
    while holder is not None and holder.tag not in ("article", "main"):
        holder = holder.parent
    if holder is not None:
        best = holder
    if best.parent is None:
        return [best]
    marked, least = best.tag in ("article", "main"), max(10.0, best.score * 0.2)

    def like(node: Node) -> bool:
        if node is best:
            return True
        if node.linked >= LINKED * max(1.0, node.chars):
            return False
        if marked and node.tag in TEXT:
            return node.tag == "h1" or node.chars >= SHORT
        return not marked and node.tag in BESIDE or node.score >= least and (best.tag != "article" or node.tag == "article")

    parts, above = [c for c in best.parent.children if isinstance(c, Node) and not c.dropped and like(c)], best.parent
    if not any(n.tag == "h1" for part in parts for n in _in_order(part)):
        while above.parent is not None:  # the headline stands above the container
            ahead = takewhile(lambda c, end=above: c is not end, above.parent.children)
            parts, above = [c for c in ahead if isinstance(c, Node) and c.tag == "h1" and not c.dropped] + parts, above.parent
    return parts


def blocks(parts: list[Node]) -> list[str]:
    """Text blocks in page order, white space folded, empty ones left out."""
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            if text := " ".join("".join(buffer).split()):
                out.append(text)
            buffer.clear()

    for part in parts:
        stack: list[Node | str | None] = [part]
        while stack:
            x = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                buffer.append(x)
            elif x.tag == "br":
                buffer.append(" ")
            elif not x.dropped:
                if x.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(x.children))
        flush()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(blocks(main_parts(parse(page)))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages(page_id, url, html)``, in one pass without a shuffle.

    A null or empty page, or one without an article, has an empty text; a table without rows gives one without rows. Null ids
    and urls are passed on; repeated rows give equal rows; other columns are not read. Malformed markup is read as browsers do: an
    element that is never closed ends with the page. Time and memory are linear in the page, however long or malformed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


def op10_html_text(spark: SparkSession, root: str) -> DataFrame:
    return extract(read_table(spark, root, "pages"))
