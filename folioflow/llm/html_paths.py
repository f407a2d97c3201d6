"""Main-text extraction by tag-path ratios.

Every text node hangs on a root-to-leaf path of block tags.  Per path the length
of text, its punctuation and its link text are added up over all its nodes, which
gives two ratios, characters and marks per node.  The ratios are smoothed over
neighbouring nodes of the same container, averaged by path again and fused to one
score; nodes whose path reaches a share of the page's best score are the text.

Nothing is kept or dropped for the element it is in, with three exceptions that
markup itself states: scripts, styles and the like have no text; navigation,
headers of the page, footers, asides, forms and hidden elements are not content;
a heading is smoothed with the first text after it, not with what comes before.
Two priors act on scores only.  Paths below an element whose class names consist
of such words as "comment" and "list" count ``DOUBT`` of their score.  The
smallest container with over half of the text selected at first (its article, if
it is in one) is the holder: scores inside it count ``BONUS`` times, but for paths
in doubt.

Time and memory are linear in the page, however deep it nests; nothing is cut,
and one page is the most that is held.  A null or empty page, or one without
text outside of links, gives an empty text.  Null ids and urls are kept, repeated
rows give repeated results, an empty table gives an empty result.  Paths that tie
at the threshold are all kept.  Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .store import bounded_batches
from .words import text_batches

# HTML element names, roles and class-name words.
RAW = frozenset(["script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "select", "button", "xmp", "noframes", "noembed"])
NEVER = frozenset(["head", "nav", "footer", "aside", "form", "dialog", "menu", "fieldset", "label", "datalist", "audio", "video", "map"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
CONTAINERS = frozenset(["article", "main", "section", "div", "center", "td", "dd", "details", "blockquote"])
BLOCK = (
    HEADINGS
    | CONTAINERS
    | frozenset(["address", "aside", "body", "caption", "dialog", "dir", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "head", "header", "hgroup", "hr", "html", "li", "menu", "nav", "ol", "p", "pre"])
    | frozenset(["summary", "table", "tbody", "tfoot", "th", "thead", "tr", "ul"])
)
CLOSES_P = BLOCK - {"html", "body", "head"}
#: An element that starts closes an open one of these tags, unless one of those holds it.
SAME_LEVEL = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
}
DOUBTFUL = frozenset(
    ["ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adslot", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs"]
    + ["masthead", "footer", "sidebar", "widget", "comment", "comments", "commentlist", "respond", "replies", "disqus", "notice", "cookie", "cookies", "consent", "gdpr", "newsletter", "subscribe", "signup", "login"]
    + ["share", "sharing", "social", "related", "recommended", "popup", "modal", "toolbar", "pagination", "pager", "copyright", "skip"]
)
NEUTRAL = frozenset(["area", "bar", "block", "body", "bottom", "box", "container", "content", "group", "inner", "item", "items", "left", "link", "links", "list", "message", "outer", "panel", "posts", "right", "section", "site", "text", "thread", "top", "wrap", "wrapper"])
ROLES = frozenset(["navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"])

# A tag ends at the first > outside of a quoted value; an unquoted value runs to white space or >.
ATTRIBUTE = r"[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s\"'>][^\s>]*+|(?=>)))?+"
TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[\s/=]++|{ATTRIBUTE})*+)(?:>|\Z)",
    re.S,
)
ATTR = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>][^\s>]*)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
MARK = re.compile(r"[.,;:!?。，！？،؟]")
SPACE = re.compile(r"\s+")

THRESHOLD = 0.25
BONUS = 4.0
DOUBT = 0.05
NEAR, OWN = 0.25, 0.5


@dataclass(eq=False, slots=True)
class Element:
    """A block element; ``path`` numbers its tag path, ``order`` its place in the page."""

    tag: str
    path: int
    never: bool
    doubtful: bool
    parent: Element | None
    order: int
    article: Element | None = None
    main: bool = False
    last: int = 0


@dataclass(slots=True)
class Node:
    """A block of text: ``linked`` of its characters are in links; ``near`` is 1
    over the levels to the container that it shares with the node before it, 0 if
    they share the body only; ``fenced``: something that is no content lies between."""

    element: Element
    text: str
    linked: int
    heading: bool
    near: float
    fenced: bool


def _doubtful(value: str) -> bool:
    """Whether some class name has nothing but words of the lists, and a telling one."""
    for name in value.split():
        parts = [x for x in re.split(r"[-_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if x]
        if any(x in DOUBTFUL for x in parts) and all(x in DOUBTFUL or x in NEUTRAL or x.isdigit() for x in parts):
            return True
    return False


def _said(attrs: str, tag: str) -> tuple[bool, bool]:
    """Whether attributes say that an element is no content, or that it may not be."""
    never = doubtful = False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            doubtful |= tag not in ("html", "body", "main") and _doubtful(value)
        elif name == "role":
            never |= value.lower() in ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            never = True
        elif name == "style":
            never |= bool(HIDDEN.search(value))
    return never, doubtful


class Page:
    """The elements and text nodes of a page, and the number of its paths."""

    def __init__(self, page: str):
        self.paths: dict[tuple[int, str, bool], int] = {}
        self.root = Element("", self._path(-1, "", False), False, False, None, 0)
        self.elements = [self.root]
        self.nodes: list[Node] = []
        self._stack, self._open = [self.root], {}
        self._parts: list[str] = []
        self._linked, self._links, self._low, self._depth, self._fence = 0, 0, 1, 0, False
        self._scan(page)
        self._close(1)
        self.root.last = len(self.elements) - 1

    def _path(self, parent: int, tag: str, doubtful: bool) -> int:
        return self.paths.setdefault((parent, tag, doubtful), len(self.paths))

    def _flush(self) -> None:
        if self._parts:
            text = SPACE.sub(" ", "".join(self._parts)).strip()
            top = self._stack[-1]
            if text:
                depth, shared = len(self._stack), min(self._low, len(self._stack))
                near = 0.0 if self._stack[shared - 1].tag in ("", "html", "body") else 1 / max(1, depth - shared, self._depth - shared)
                self.nodes.append(Node(top, text, min(self._linked, len(text)), top.tag in HEADINGS, near, self._fence))
                self._low, self._depth, self._fence = depth, depth, False
            self._parts.clear()
        self._linked = 0

    def _text(self, raw: str) -> None:
        if raw and not self._stack[-1].never:
            s = html.unescape(raw) if "&" in raw else raw
            self._parts.append(s)
            if self._links:
                self._linked += len(s.strip())

    def _close(self, upto: int) -> None:
        self._flush()
        for e in self._stack[upto:]:
            e.last = len(self.elements) - 1
            self._open[e.tag] -= 1
        del self._stack[upto:]
        self._low = min(self._low, upto)

    def _innermost(self, tags: tuple[str, ...], within: tuple[str, ...] = ()) -> int:
        """Where the innermost open element of these tags stands, 0 if none is open inside of ``within``."""
        if not any(self._open.get(t) for t in tags):
            return 0
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag in tags:
                return i
            if self._stack[i].tag in within:
                return 0
        return 0

    def _start(self, tag: str, attrs: str) -> None:
        if tag in CLOSES_P and self._stack[-1].tag == "p":
            self._close(len(self._stack) - 1)
        if tag in SAME_LEVEL and (i := self._innermost(*SAME_LEVEL[tag])):
            self._close(i)
        self._flush()
        if tag == "hr":
            return
        top = self._stack[-1]
        said, doubtful = _said(attrs, tag) if attrs.strip() else (False, False)
        never = top.never or said or tag in NEVER or tag == "header" and not (top.article or top.main)
        self._fence |= never and not top.never
        doubtful |= top.doubtful
        e = Element(tag, self._path(top.path, tag, doubtful), never, doubtful, top, len(self.elements), top.article, top.main or tag == "main")
        if tag == "article":
            e.article = e
        self.elements.append(e)
        self._stack.append(e)
        self._open[tag] = self._open.get(tag, 0) + 1

    def _scan(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            m = TOKEN.search(page, at)
            if not m:
                self._text(page[at:])
                return
            self._text(page[at : m.start()])
            at = m.end()
            if m["cdata"] is not None:
                self._text(m["cdata"])
            if not m["tag"]:
                continue
            tag = m["tag"].lower()
            if m["close"]:
                if tag == "a":
                    self._links = max(0, self._links - 1)
                elif tag in BLOCK or tag in NEVER:
                    if k := self._innermost((tag,)):
                        self._close(k)
                        self._links = 0
                    else:
                        self._flush()
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            elif tag == "a":
                self._links = 1
            elif tag == "br":
                self._parts.append(" ")
            elif tag in BLOCK or tag in NEVER:
                self._start(tag, m["attrs"])


def path_table(page: Page) -> dict[int, list[int]]:
    """Per path: characters, marks, characters in links and nodes."""
    sums: dict[int, list[int]] = {}
    for node in page.nodes:
        s = sums.setdefault(node.element.path, [0, 0, 0, 0])
        s[0] += len(node.text)
        s[1] += len(MARK.findall(node.text))
        s[2] += node.linked
        s[3] += 1
    return sums


def path_scores(page: Page) -> dict[int, float]:
    """The smoothed and fused ratios of every path with text."""
    raw = {}
    for p, (length, marks, linked, count) in path_table(page).items():
        plain = max(0.0, 1 - linked / length)
        raw[p] = (length / count * plain, (marks + 0.5) / count * plain)
    nodes = page.nodes
    after = [0] * len(nodes)  # the first node after each that is no heading, unless something is fenced off between
    for i in range(len(nodes) - 2, -1, -1):
        after[i] = 0 if nodes[i + 1].fenced else after[i + 1] if nodes[i + 1].heading else i + 1
    sums: dict[int, list[float]] = {}
    for i, node in enumerate(nodes):
        p = node.element.path
        if node.heading:
            near = [(after[i], 2 * NEAR)] if after[i] else []
        else:
            near = [(i - 1, NEAR * node.near)] if i else []
            near += [(i + 1, NEAR * nodes[i + 1].near)] if i + 1 < len(nodes) else []
        weight = OWN + sum(w for _, w in near)
        s = sums.setdefault(p, [0.0, 0.0, 0])
        for k in (0, 1):
            s[k] += (OWN * raw[p][k] + sum(w * raw[nodes[j].element.path][k] for j, w in near)) / weight
        s[2] += 1
    doubtful = {node.element.path for node in nodes if node.element.doubtful}
    scores = {}
    for p, (length, marks, count) in sums.items():
        # smoothing lifts a path that lies among content, never one made of links
        fused = math.sqrt(max(raw[p][0], length / count) * max(raw[p][1], marks / count)) if raw[p][0] > 0 else 0.0
        scores[p] = fused * (DOUBT if p in doubtful else 1.0)
    return scores


def holder(page: Page, picked: list[Node]) -> Element | None:
    """The smallest container with over half of the picked text, its article if it is in one."""
    held = [0] * len(page.elements)
    for node in picked:
        held[node.element.order] += len(node.text)
    half, found = sum(held) / 2, None
    for e in reversed(page.elements):  # children come after their parents
        if not found and held[e.order] > half and e.tag in CONTAINERS:
            found = e
        if e.parent:
            held[e.parent.order] += held[e.order]
    return found.article or found if found else None


def extract(text: str | None) -> str:
    """The main text of one page, a line for each block."""
    if not text:
        return ""
    page = Page(text)
    scores = path_scores(page)
    least = THRESHOLD * max(scores.values(), default=0.0)
    if least <= 0:
        return ""
    held = holder(page, [n for n in page.nodes if scores[n.element.path] >= least])

    def score(node: Node) -> float:
        inside = held is not None and held.order <= node.element.order <= held.last and node.element.doubtful <= held.doubtful
        return scores[node.element.path] * (BONUS if inside else 1.0)

    return "\n".join(n.text for n in page.nodes if score(n) >= least)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_batches(whole, "html"):
            texts = [extract(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    bounded_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(_run, "page_id long, url string, text string, n_chars long")
