"""Main text of web pages by composite text density.

A page is parsed into a tree, forgiving as browsers are. Elements that are never part of an article are cut:
by their tag (menus, footers, sidebars, forms, scripts, styles ...), by a class, id or role that says so
(adverts, notices, comments ...), or because they are hidden.

For every node the text density is its characters per tag. The composite density multiplies it by the
logarithm of (characters per link character x tags per link tag), whose base grows with the node's
share of link text and with the page's. A node's density sum is the sum of the composite densities of those children that
are or hold blocks: runs of bold or linked words inside a paragraph are part of it, not blocks beside it. The
node of the largest sum is the main subtree, and the smallest composite density on the path from it to the
body is the threshold: what hangs off that path is kept if its density reaches the threshold, or if it is a
heading, an ``article`` or a ``main``. If the main subtree lies in such an element, the outermost is the text, and of an
``article`` its siblings of that kind, too; in a ``main`` with an ``article`` around the subtree, the path ends at that
``article`` and what hangs off it inside of ``main`` is kept by the same rule.

Blocks are joined by one line feed in page order. Inside a block, white space becomes one space and character
references are decoded once.

Defined results. Null, empty and text-free pages: empty text. Cut-off pages and unclosed tags: read to the
end. Repeated rows are extracted each; other columns are kept or ignored by the caller's choice, but none may have the
name of a result column. Pages of any length are read whole, in time proportional to their length.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from hourstar.llm.batches import pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINERS = frozenset(("article", "main"))
# A start tag closes the open element of the first set that it finds before one of the second.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dd": (frozenset(("dd", "dt")), frozenset(("dl",))),
    "dt": (frozenset(("dd", "dt")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
}
# Start tags that do not close an open head; text that is not white space closes it, too.
HEAD_HOLDS = frozenset("html base basefont bgsound link meta title style script noscript noframes template".split())
P_SCOPE = frozenset("html body table td th caption button object".split())

CUT_TAGS = frozenset("head nav footer aside form button select input label dialog menu object embed canvas audio video annotation annotation-xml".split())
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead comment comments disqus reply replies respond discussion cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations widget toolbar pagination pager skip copyright "
    "contentinfo complementary search disclaimer hidden".split()
)
OUTER_CUT_TAGS = frozenset(("header",))  # outside of an article
OUTER_CUT_WORDS = frozenset(("header", "topbar"))
NOT_CUT = frozenset("no not has with without hide open".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<attributes>(?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/<>]*)(?P<attributes2>[^<>]*)(?:>|\Z)",
    re.S,
)
# Attributes one by one, so that what looks like one inside a quoted value is none.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"|'[^']*'""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "chars", "link_chars", "tags", "link_tags", "density", "holds_block", "total")

    def __init__(self, tag: str, attributes: str, parent: "Node | None"):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []


def parse(page: str) -> Node:
    root = Node("html", "", None)
    stack = [root]
    # Depths of the open elements by tag, and of all blocks, so that no end tag has to look for its element.
    depths: defaultdict[str, list[int]] = defaultdict(list)
    blocks_at: list[int] = []
    at, length = 0, len(page)

    def push(node: Node) -> None:
        depths[node.tag].append(len(stack))
        if node.tag in BLOCK:
            blocks_at.append(len(stack))
        stack.append(node)

    def pop() -> None:
        tag = stack.pop().tag
        depths[tag].pop()
        if tag in BLOCK:
            blocks_at.pop()

    def deepest(tags: frozenset[str] | tuple[str, ...]) -> int:
        if tags is BLOCK:
            return blocks_at[-1] if blocks_at else 0
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def close(targets: frozenset[str] | tuple[str, ...], limits: frozenset[str]) -> None:
        target = deepest(targets)
        if target > deepest(limits):
            while len(stack) > target:
                pop()

    def add(text: str) -> None:
        if stack[-1].tag == "head" and text.strip():
            pop()
        stack[-1].children.append(text)

    while at < length:
        match = _TAG.search(page, at)
        if match is None:
            add(page[at:])
            break
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        tag = match["tag"] or match["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["end"] or match["end2"]:
            if tag in BLOCK or tag in ("head", "button", "select"):
                close((tag,), frozenset())
            else:
                close((tag,), BLOCK)
            continue
        attributes = match["attributes"] or match["attributes2"] or ""
        if stack[-1].tag == "head" and tag not in HEAD_HOLDS:
            pop()
        if tag in RAW:
            ending = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if not attributes.endswith("/") or tag != "svg":
                at = ending.end() if ending else length
            stack[-1].children.append(Node(tag, attributes, stack[-1]))
            continue
        if tag == "html" or (tag == "body" and depths["body"]):
            continue
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in BLOCK:
            close(("p",), P_SCOPE)
        node = Node(tag, attributes, stack[-1])
        stack[-1].children.append(node)
        if tag not in VOID:
            push(node)
    return root


def says_cut(attributes: str, words: frozenset[str]) -> bool:
    for found in _ATTRIBUTE.finditer(attributes):
        if (found[1] or "").lower() not in ("class", "id", "role"):
            continue
        for name in (found[2] or found[3] or found[4] or "").lower().split():
            parts = re.split(r"[-_]+", name)
            if (parts[0] in words or parts[-1] in words or name in words) and not NOT_CUT.intersection(parts[:-1]):
                return True
    return False


def is_hidden(attributes: str) -> bool:
    for found in _ATTRIBUTE.finditer(attributes):
        name = (found[1] or "").lower()
        if name == "hidden" or name == "style" and _NO_DISPLAY.search(found[2] or found[3] or found[4] or ""):
            return True
    return False


def is_cut(node: Node, in_container: bool) -> bool:
    if node.tag in RAW or node.tag in CUT_TAGS:
        return True
    if node.tag in CONTAINERS or node.tag in ("html", "body"):
        return False
    if not in_container and (node.tag in OUTER_CUT_TAGS or says_cut(node.attributes, OUTER_CUT_WORDS)):
        return True
    return bool(node.attributes) and (says_cut(node.attributes, CUT_WORDS) or is_hidden(node.attributes))


def in_order(root: Node) -> list[Node]:
    """Nodes that are not cut, parents first; cut ones leave the tree."""
    out, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or node.tag in CONTAINERS
        node.children = [c for c in node.children if isinstance(c, str) or not is_cut(c, inside)]
        out.append(node)
        todo.extend((c, inside) for c in reversed(node.children) if not isinstance(c, str))
    return out


def measure(nodes: Sequence[Node]) -> None:
    for node in reversed(nodes):
        inner = [c for c in node.children if not isinstance(c, str)]
        own = sum(len(unescape(" ".join(c.split()))) for c in node.children if isinstance(c, str))
        node.chars = own + sum(c.chars for c in inner)
        node.tags = len(inner) + sum(c.tags for c in inner)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, 1 + sum(c.link_tags for c in inner)
        else:
            node.link_chars = sum(c.link_chars for c in inner)
            node.link_tags = sum(c.link_tags for c in inner)
    whole = nodes[0]
    share = whole.link_chars / max(1, whole.chars)
    for node in nodes:
        tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        plain = max(1, node.chars - node.link_chars)
        base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
        ratio = node.chars / links * tags / link_tags
        node.density = node.chars / tags * (math.log(ratio) / math.log(base + 1e-9) if ratio > 1 and base > 1 + 1e-6 else max(0.0, math.log(ratio or 1)))
    for node in reversed(nodes):
        parts = [c for c in node.children if not isinstance(c, str) and c.holds_block]
        node.holds_block = bool(parts) or node.tag in BLOCK
        node.total = sum(c.density for c in parts)


def kept(nodes: Sequence[Node]) -> list[Node | str]:
    """The roots of the text, in page order."""
    best = max(nodes, key=lambda n: n.total)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    path.reverse()
    top = next((k for k, n in enumerate(path) if n.tag in CONTAINERS), 0)
    if path[top].tag == "article":
        return [c for c in path[top - 1].children if not isinstance(c, str) and (c is path[top] or c.tag in CONTAINERS)]
    if path[top].tag == "main" and not any(n.tag == "article" for n in path[top:]):
        return [path[top]]
    before: list[Node | str] = []
    after: list[list[Node | str]] = []
    node = path[top]
    for below in path[top + 1 :]:
        out = before
        for child in node.children:
            if child is below:
                out = []
                after.append(out)
            elif isinstance(child, str) or child.tag in HEADINGS or child.tag in CONTAINERS or (child.chars and child.density >= threshold):
                out.append(child)
        node = below
        if node.tag in HEADINGS or node.tag == "article":
            break
    return [*before, node, *(c for out in reversed(after) for c in out)]


def blocks(roots: Sequence[Node | str]) -> list[str]:
    out, line = [], []

    def end() -> None:
        text = " ".join(unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    todo: list[Node | str | None] = list(reversed(roots))
    while todo:
        node = todo.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            line.append(node)
        elif node.tag == "br":
            line.append(" ")
        elif node.tag in BLOCK:
            end()
            todo.append(None)
            todo.extend(reversed(node.children))
        else:
            todo.extend(reversed(node.children))
    end()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    nodes = in_order(parse(page))
    measure(nodes)
    return "\n".join(blocks(kept(nodes))) if nodes[0].chars else ""


def extract(pages: DataFrame, *, html_col: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` of every row."""
    if clash := {"text", "n_chars"}.intersection(keep):
        raise ValueError(f"rename the columns {sorted(clash)}, the result has such")
    names = [f"kept_{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, group in pieces(batches, 0):
            texts = [main_text(page) for page in group]
            columns = [*piece.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "text", "n_chars"])

    rows = pages.select(pages[html_col].alias("html"), *[pages[c].alias(n) for c, n in zip(keep, names)])
    kinds = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in names]
    out = rows.mapInArrow(run, ", ".join([*kinds, "text string", "n_chars long"]))
    return out.withColumnsRenamed(dict(zip(names, keep)))
