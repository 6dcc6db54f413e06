"""Main text of web pages by tag-path ratios.

A page is read once into text nodes, each with its root-to-leaf path of tag
names.  For each path the length and the punctuation of its texts are summed
and divided by its number of nodes; running text scores high in both, menus
and captions in neither.  The two ratios of the nodes, in page order, are
smoothed, multiplied, and compared with a share of their standard deviation.
The nodes above it vote for the smallest container that holds nearly all of
their text.  Where articles or a main element enclose it, these are the main
text, whole; elsewhere it is what lies, in the smallest container that holds
all of the nodes' text, between the first and the last node whose own path is
above the threshold, with the headings right before it.  Only lists of links
are left out, and parts that their tag, role, class or id declares to be
something else.  A class, an id or a form may also stand round the whole page;
where it holds most of the text, or is the body, main or article element, it
declares nothing, nor does it on a heading, nor a name of which only a part
is one of those known ("related-work", "has-sidebar").
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Collection, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import as_texts, small_batches

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CONTAINERS = {"#root", "html", "body", "main", "article", "section", "div", "td", "center"}
ARTICLES = {"article", "main"}
LIST_ITEMS = {"li", "dt", "dd"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An opening tag ends these open elements, as far as the nearest of the barriers.
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIERS = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "main", "body"}
NOT_MAIN_TAGS = {"nav", "footer", "aside", "head", "button", "select", "dialog", "menu", "object", "map", *RAW}
NOT_MAIN_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
NOT_MAIN_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent",
    "gdpr", "notice", "notices", "alert", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "comment",
    "comments", "disqus", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "popup",
    "modal", "overlay", "widget", "toolbar", "pagination", "pager", "search", "replies"}
COMMENT_NAMES = {"comment", "comments", "disqus", "replies"}
KERNEL = np.exp(-np.arange(-2, 3) ** 2 / 2)
THRESHOLD = 0.5
COVER = 0.8
#: A part that its class, id or form tag declares to be something else is main
#: if it has more than this share of the text; readers' comments often have.
MOST = 0.5
#: Words that say nothing beside a name: "cookie-notice-box" is one, "share-prices" none.
NEUTRAL = {"area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "col", "column", "container", "content", "form", "global", "group", "header",
           "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "post", "posts", "primary", "right", "secondary", "section",
           "site", "top", "unit", "wrap", "wrapper"}
P, P_AND_HEADINGS = {"p"}, {"p", *HEADINGS}


class Node(NamedTuple):
    text: str
    path: int  # number of the path of tags round it
    block: int
    container: int  # the nearest container round it
    article: int  # the outermost article or main element, or 0
    doubt: int  # the nearest part round it that may be something else (0: none), or -1: it is


class Path(NamedTuple):
    """What matters of a path of tags."""
    link: bool  # in a link
    item: bool  # in a list inside the article
    ordered: bool  # that list is numbered
    last: str  # the last tag inside the article that is not inline


class Open(NamedTuple):
    """An open element, and how often tags are open since the last barrier and, inline ones, since the last block."""
    tag: str
    path: int
    container: int
    article: int
    doubt: int
    since_barrier: dict[str, int]
    since_block: dict[str, int]


def _named(value: str) -> set[str]:
    """The known names that a class or id consists of, beside neutral words and numbers."""
    out: set[str] = set()
    for token in value.split():
        parts = {part for part in re.split(r"[^a-z0-9]+", token) if part and not part.isdigit()}
        if parts <= NOT_MAIN_NAMES | NEUTRAL:
            out |= parts & NOT_MAIN_NAMES
    return out


def _declared(tag: str, rest: str, opened: dict[str, int]) -> float:
    """The share of the text up to which a tag says that it isn't part of the
    main text: 0 says nothing, 1 is always believed.  ``opened``: open elements by their tags."""
    in_article = opened.get("article", 0) + opened.get("main", 0) > 0
    if tag in NOT_MAIN_TAGS or tag == "header" and not in_article:
        return 1
    out = MOST if tag == "form" else 0
    if "=" not in rest:
        return 1 if re.search(r"(?<![\w-])hidden(?![\w-])", rest) else out
    # an article in an article may be a comment
    named = tag not in ("html", "body", "main") and tag not in HEADINGS and (tag != "article" or opened.get("article", 0) > 0)
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in NOT_MAIN_ROLES or name == "aria-hidden" and value == "true" or name == "hidden":
            return 1
        if name == "style" and "display:none" in value.replace(" ", ""):
            return 1
        if named and name in ("class", "id") and (names := _named(value)):
            # an id is also what links go to: a section or paragraph of an article may have any
            if name == "class" or not (in_article and tag in ("section", "p")) or names & COMMENT_NAMES:
                out = max(out, COVER if names <= COMMENT_NAMES else MOST)
    return out


class Page:
    """The text nodes of a page, in order, and the elements round them.

    Paths and elements are numbered as they open and know the one round them,
    and open tags are counted, so that a page takes time by its length, however deep it is."""

    def __init__(self, page: str):
        self.nodes: list[Node] = []
        self.numbers: dict[tuple[int, str], int] = {}
        self.paths = [Path(False, False, False, "")]
        self.inside = [0]  # of each element, the container round it
        self.share = [0.0]  # up to which share of the text it may be something else
        self.doubts = [0]  # the part round it that may be
        self._read(page)

    def _path(self, parent: int, tag: str) -> int:
        n = self.numbers.setdefault((parent, tag), len(self.paths))
        if n == len(self.paths):
            link, item, ordered, last = self.paths[parent]
            if tag in ARTICLES:
                item, last = False, ""
            elif tag not in INLINE:
                item, last = item or tag in LIST_ITEMS, tag
            self.paths.append(Path(link or tag == "a", item, tag == "ol" if tag in ("ul", "ol", "dl") else ordered, last))
        return n

    def _element(self, container: int, doubt: int, share: float) -> int:
        self.inside.append(container)
        self.share.append(share)
        self.doubts.append(max(doubt, 0))
        return len(self.inside) - 1

    def _read(self, page: str) -> None:
        stack = [Open("#root", 0, 0, 0, 0, {}, {})]
        opened: dict[str, int] = defaultdict(int)
        at, block = 0, 0

        def text(upto: int) -> None:
            raw = page[at:upto]
            if raw and not raw.isspace():
                top = stack[-1]
                self.nodes.append(Node(raw, top.path, block, top.container, top.article, top.doubt))

        def close(tags: Collection[str]) -> None:
            """Close the open elements up to the nearest of ``tags``, which is open."""
            while True:
                tag, *_, since_barrier, since_block = stack.pop()
                opened[tag] -= 1
                if tag not in BARRIERS:
                    since_barrier[tag] -= 1
                if tag in INLINE:
                    since_block[tag] -= 1
                if tag in tags:
                    return

        while m := TOKEN.search(page, at):
            text(m.start())
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag, closing, rest = tag.lower(), m["close"] or m["close2"], m["rest"] or m["rest2"] or ""
            if tag == "br":
                if self.nodes and not closing:
                    self.nodes.append(self.nodes[-1]._replace(text=" ", block=block, path=stack[-1].path))
                continue
            inline = tag in INLINE
            block += not inline
            if closing:
                # an inline end tag doesn't end blocks
                if (stack[-1].since_block if inline else opened).get(tag, 0) > 0:
                    close((tag,))
                continue
            if not inline and tag not in VOID:
                ends = IMPLIED_END.get(tag) or (P_AND_HEADINGS if tag in HEADINGS else P)
                if any(stack[-1].since_barrier.get(t, 0) > 0 for t in ends):
                    close(ends)
            if tag in VOID:
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if rest.endswith("/"):
                continue
            _, path, container, article, doubt, since_barrier, since_block = stack[-1]
            share = _declared(tag, rest, opened) if doubt >= 0 else 0.0
            if share or tag in CONTAINERS:
                number = self._element(container, doubt, share)
                if share:
                    doubt = -1 if share == 1 else number
                if tag in CONTAINERS:
                    container = number
                    article = article or (number if tag in ARTICLES else 0)
            opened[tag] += 1
            if tag in BARRIERS:
                since_barrier = {}
            else:
                since_barrier[tag] = since_barrier.get(tag, 0) + 1
            if inline:
                since_block[tag] = since_block.get(tag, 0) + 1
            else:
                since_block = {}
            stack.append(Open(tag, self._path(path, tag), container, article, doubt, since_barrier, since_block))
        text(len(page))

    def within(self, roots: set[int]) -> list[bool]:
        """Of each element, whether it is or is inside one of ``roots``."""
        out = [0 in roots]
        for e in range(1, len(self.inside)):
            out.append(e in roots or out[self.inside[e]])
        return out

    def summed(self, own: list[int], around: list[int]) -> list[int]:
        """Each element's number and those of all elements inside it, added up."""
        out = list(own)
        for e in range(len(out) - 1, 0, -1):
            out[around[e]] += out[e]
        return out


def _punctuation(text: str) -> int:
    return sum(map(text.count, ".,;:!?…。，、；：！？"))


def _smooth(values: np.ndarray) -> np.ndarray:
    """Weighted mean of each value and the two on either side."""
    return np.convolve(values, KERNEL, "same") / np.convolve(np.ones(len(values)), KERNEL, "same") if len(values) >= 5 else values


def _link_lists(page: Page, own: list[Node]) -> set[int]:
    """The blocks that are lists of links: made of links without marks only, and
    in a list, or with another such link in the block or in the one beside it.
    A numbered list in an article, as of references, is none."""
    marks: dict[int, int] = defaultdict(int)
    blocks: dict[int, list[Node]] = defaultdict(list)
    for n in own:
        marks[n.path] += _punctuation(n.text)
        blocks[n.block].append(n)
    out, row = set(), []  # row: link-only blocks in succession

    def end() -> None:
        if len(row) > 1 or row and len(blocks[row[0]]) > 1:
            out.update(row)
        row.clear()

    for b, nodes in blocks.items():
        if not all(page.paths[n.path].link and not marks[n.path] for n in nodes):
            end()
            continue
        path = page.paths[nodes[0].path]
        if path.item and not (path.ordered and nodes[0].article):
            out.add(b)
        elif path.item or path.last in HEADINGS | {"p", "blockquote", "figcaption"}:
            end()  # a reference, or a sentence or a heading that is a link
        else:
            row.append(b)
    end()
    return out


def _believed(page: Page, found: list[Node]) -> list[bool]:
    """Of each element, whether it is, or is inside, what its class, id or form
    declares: a part with no more of the text than that may have."""
    held = [0] * len(page.inside)
    for n in found:
        held[n.doubt] += len(n.text.strip())
    held = page.summed(held, page.doubts)
    out = [False]
    for e in range(1, len(held)):
        out.append(out[page.doubts[e]] or page.share[e] > 0 and held[e] <= page.share[e] * held[0])
    return out


def main_text(html_text: str) -> str:
    """The blocks of the main text, joined by an empty line; empty if there is none."""
    page = Page(html_text)
    found = [n._replace(text=html.unescape(n.text)) for n in page.nodes if n.doubt >= 0]
    gone = _believed(page, found)
    found = [n for n in found if not gone[n.doubt]]
    own = [n for n in found if not n.text.isspace()]
    if not own:
        return ""
    sums: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    for n in own:
        s = sums[n.path]
        s[0] += len(n.text)
        s[1] += _punctuation(n.text)
        s[2] += 1
    length = np.array([sums[n.path][0] / sums[n.path][2] for n in own])
    marks = np.array([sums[n.path][1] / sums[n.path][2] for n in own])
    score = _smooth(length) * (0.1 + _smooth(marks))
    threshold = THRESHOLD * score.std()
    chosen = (score >= threshold).tolist()
    # the deepest container with nearly all of the chosen nodes' text
    weight, depth = [0] * len(page.inside), [0]
    for n, c in zip(own, chosen, strict=True):
        weight[n.container] += len(n.text) * c
    weight = page.summed(weight, page.inside)
    for e in range(1, len(weight)):
        depth.append(depth[page.inside[e]] + 1)
    root = max((e for e in range(len(weight)) if weight[e] >= COVER * weight[0]), key=lambda e: (depth[e], weight[e]))
    inside = page.within({root})
    most = [n for n, c in zip(own, chosen, strict=True) if c]
    lists = _link_lists(page, own)
    kept = {n.block for n in own} - lists
    if all(n.article for n in most if inside[n.container]):
        inside = page.within({n.article for n in most if n.article})
    else:
        inside = page.within({max((e for e in range(len(weight)) if weight[e] == weight[0]), key=lambda e: depth[e])})
        kept &= _between(page, [n for n in own if inside[n.container] and n.block in kept], dict(zip(own, (length * (0.1 + marks) >= threshold).tolist(), strict=True)))
    blocks: dict[int, list[str]] = {}
    for n in found:
        if inside[n.container] and n.block in kept:
            blocks.setdefault(n.block, []).append(n.text)
    return "\n\n".join(t for b in blocks.values() if (t := " ".join("".join(b).split())))


def _between(page: Page, own: list[Node], selected: dict[Node, bool]) -> set[int]:
    """The blocks from the first to the last that hold a selected node, and the headings right before them."""
    order = list(dict.fromkeys(n.block for n in own))
    hold = {n.block for n in own if selected[n]}
    headings = {n.block for n in own if page.paths[n.path].last in HEADINGS}
    at = [i for i, b in enumerate(order) if b in hold]
    if not at:
        return set(order)
    first = at[0]
    while first and order[first - 1] in headings:
        first -= 1
    return set(order[first:at[-1] + 1])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: id, url, text and n_chars (code
    points).  Null or empty html gives the empty text; repeated rows and null
    ids stay."""
    small_batches(pages.sparkSession)
    source = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias(url_col), F.col(html_col).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t) for t in as_texts(batch.column("_html"))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return source.mapInArrow(run, source.drop("_html").schema.add("text", "string").add("n_chars", "long"))
