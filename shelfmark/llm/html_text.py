"""Main text of web pages by composite text density (Sun, Song and Liao, SIGIR 2011).

The page becomes a tree. For every node the characters per tag are adjusted by the share of link text (composite text
density). A node's density sum adds its children's densities. The node with the largest sum is the body of the article;
the least density on its path from the page's body is the threshold. From the body down, under every node that reaches
the threshold, the subtree with the largest sum is content; so are headings beside that path, which are too short to be
dense. Subtrees that are furniture by their element (navigation,
forms, scripts, ...) or by a telling word of class, id or role (comments, sidebar, ...) are no part of the tree, as their
text can be as dense as an article's. A word that can also stand at an article (share, related, ...) is a hint: such a
subtree is left out unless it holds more than half of the text that is left.

Blocks are joined in page order by newlines, white space inside a block becomes one space, character references are
decoded; br counts as white space. Null or empty html, and pages without text, give an empty text. Broken markup is read
as far as it goes: unclosed elements end with their block, stray end tags are ignored, and where a quote never ends,
quotes count as plain characters from there on. Time is linear in the page's length. Repeated rows give equal rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.common import added, free

# HTML element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
FURNITURE = frozenset("head nav footer aside form script style noscript iframe template textarea title button select option input svg canvas object embed audio video dialog menu fieldset".split())
#: Words of class, id or role that mark menus, adverts, comments and the like, and words that only hint at them.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent "
    "notice notices newsletter subscribe signup login comment comments disqus toolbar pagination pager contentinfo complementary".split()
)
HINTS = frozenset("promo alert popup modal reply replies respond share sharing social related recommended recommendations widget search".split())
#: Elements that end an open p, and elements that end an open one of their own kind.
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table div section article main body blockquote".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LISTS = ("ul", "ol", "dl", "table", "select")

MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME, REST = re.compile(r"[^\s/>]*"), re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")
ATTRIBUTE = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "children", "dropped", "hinted", "inside", "parent", "chars", "tags", "link_chars", "link_tags", "density", "total", "best")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children, self.hinted = tag, parent, [], False
        self.dropped = parent.dropped if parent else False
        self.inside = bool(parent) and (parent.inside or parent.tag in ("article", "main"))

    def judge(self, attributes: str) -> None:
        """Marks furniture: dropped by its element or a telling word, hinted at by others."""
        if self.tag in FURNITURE or self.tag == "header" and not self.inside:
            self.dropped = True
        elif self.tag not in ("body", "html", "article", "main"):
            for m in ATTRIBUTE.finditer(attributes) if attributes else ():
                words = set(WORD.findall((m[1] or m[2] or m[3] or "").lower()))
                self.dropped |= not words.isdisjoint(MARKS) or "header" in words and not self.inside
                self.hinted |= not words.isdisjoint(HINTS)


class Tree:
    """The open elements of a page while it is read. For each tag the depths at which it is open, so no step walks up the tree."""

    def __init__(self) -> None:
        self.root = Node("#root", None)
        self.open, self.depths = [self.root], defaultdict(list)

    def add(self, tag: str, attributes: str, stays: bool) -> None:
        if tag in CLOSES_P:
            self.close("p", SCOPE)
        elif tag in SAME:
            ends = max((t for t in SAME[tag] if self.depths[t]), key=lambda t: self.depths[t][-1] if tag != "tr" else t == "tr", default=None)
            if ends:
                self.close(ends, LISTS)
        top = self.open[-1]
        node = Node(tag, top)
        if not node.dropped:
            node.judge(attributes)
            top.children.append(node)
        if stays:
            self.depths[tag].append(len(self.open))
            self.open.append(node)

    def close(self, tag: str, within: Iterable[str] = ()) -> None:
        """Ends the innermost open element of this tag, unless one of `within` was opened inside it."""
        at = self.depths[tag][-1] if self.depths[tag] else 0
        if at and all(not self.depths[t] or self.depths[t][-1] < at for t in within):
            while len(self.open) > at:
                self.depths[self.open.pop().tag].pop()


def parse(page: str) -> Node:
    """The page's tree; children are nodes and texts (decoded, with their white space)."""
    tree, at, pos, end, quotes = Tree(), 0, 0, len(page), True

    def text(stop: int) -> None:
        top = tree.open[-1]
        if stop > at and not top.dropped:
            top.children.append(html.unescape(page[at:stop]))

    while m := MARKUP.search(page, pos):
        text(m.start())
        at, kind = m.start(), m[0]
        if kind in ("<!--", "<!", "<?"):
            mark = "-->" if kind == "<!--" else ">"
            found = page.find(mark, m.end())
            at = pos = found + len(mark) if found >= 0 else end
            continue
        name = NAME.match(page, m.end() - 1)
        close = REST.match(page, name.end()).end() if quotes else page.find(">", name.end())
        if quotes and not page.startswith(">", close):
            quotes, close = False, page.find(">", name.end())
        if close < 0:  # no tag ends any more: the rest is text
            break
        at = pos = close + 1
        tag, rest = name[0].lower(), page[name.end() : close]
        if kind[1] == "/":
            tree.close(tag)
        else:
            raw = tag in RAW
            tree.add(tag, rest, not raw and tag not in VOID and not rest.endswith("/"))
            if raw:
                ends = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, pos)
                at = pos = ends.end() if ends else end
    text(end)
    return tree.root


def measure(root: Node) -> list[Node]:
    """Fills the counts of every kept node; children before parents in the list."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        node.children = [c for c in node.children if isinstance(c, str) or not c.dropped]
        stack.extend(c for c in node.children if isinstance(c, Node))
    order.reverse()
    for node in order:
        texts, nodes = [c for c in node.children if isinstance(c, str)], [c for c in node.children if isinstance(c, Node)]
        node.chars = sum(len(" ".join(t.split())) for t in texts) + sum(c.chars for c in nodes)
        node.tags = sum(c.tags + 1 for c in nodes)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(c.link_chars for c in nodes)
        node.link_tags = sum(c.link_tags for c in nodes) + link
    return order


def without_hinted(root: Node) -> list[Node]:
    """measure(), after hinted subtrees that hold at most half of the text have gone."""
    order = measure(root)
    most = root.chars
    if any(n.hinted for n in order):
        for node in order:
            node.dropped |= node.hinted and 2 * node.chars <= most
        order = measure(root)
    return order


def densities(order: list[Node], body: Node) -> None:
    share = body.link_chars / max(body.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + share * c + math.e)
        node.density = c / t * max(0.0, math.log(max(c * t / (lc * lt), 1.0))) / base if c else 0.0
        inner = [x.density for x in node.children if isinstance(x, Node) and x.tag not in INLINE]
        node.total = sum(inner) if inner else node.density
        # the block node of the subtree with the largest sum: the outermost among equals, then the first
        node.best = max([node, *(x.best for x in node.children if isinstance(x, Node) and x.tag not in INLINE)], key=lambda x: x.total)


def content(body: Node) -> set[int]:
    """Identities of the nodes whose subtrees are content."""
    best = body.best
    threshold, node = best.density, best
    chosen: set[int] = set()
    while node is not body:
        if node.parent is not body:  # a heading is too short to be dense; it is content beside the path to the text
            chosen.update(id(x) for x in node.parent.children if isinstance(x, Node) and x.tag in HEADINGS)
        node = node.parent
        threshold = min(threshold, node.density)
    stack = [body]
    while stack:
        node = stack.pop()
        if id(node) in chosen or not node.chars or node.density < threshold:
            continue
        top = node.best
        chosen.add(id(top))
        if top is not node:
            stack.extend(c for c in node.children if isinstance(c, Node))
    return chosen


def blocks(root: Node, chosen: set[int]) -> list[str]:
    """Texts of the blocks of the chosen subtrees in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            out.append(text)

    stack: list = [(root, False)]
    while stack:
        item, on = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if on:
                line.append(item)
        else:
            on = on or id(item) in chosen
            if item.tag in ("br", "img", "wbr"):
                if on and item.tag == "br":
                    line.append(" ")
                continue
            block = item.tag not in INLINE
            if block:
                flush()
                stack.append((None, on))
            stack.extend((c, on) for c in reversed(item.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article's text of one page."""
    if not page:
        return ""
    root = parse(page)
    order = without_hinted(root)
    body = next((n for n in reversed(order) if n.tag == "body"), root)
    if not body.chars:
        return ""
    densities(order, body)
    return "\n".join(blocks(body, content(body)))


def extract(pages: DataFrame, text: str = "text", source: str = "html") -> DataFrame:
    """pages with the main text in place of the html, and of a column of that name."""
    own = free(pages, "_html")
    kept = pages.select(*[c for c in pages.columns if c not in (source, text)], pages[source].cast("string").alias(own))
    return added(kept, [own], f"`{text}` string", lambda rows: [[main_text(p) for p in rows]])


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every page."""
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.selectExpr("page_id", "url", "text", "cast(length(text) AS bigint) AS n_chars")
