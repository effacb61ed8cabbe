"""Main text of web pages by composite text density.

A page becomes a tree of elements; scripts, styles, menus, footers and hidden elements are cut off first.
Forms, headers and elements that name themselves menus, sidebars, notices, adverts or comments by a whole class
or id are cut off if they are not the main text: one that holds an article, a main or an h1 stays, and so does
one with half of the body's text in paragraphs, items, cells and headings or three quarters of all its text,
unless it stands beside an article or main with text. Readers' comments, articles of this name too, go whatever
their size if enough other text is there. A header in an article or main stays, and so does a form
there that holds a paragraph, item, cell or heading. Every node gets its characters per tag,
adjusted for links (composite text density). The node whose children's densities have the largest sum is
taken, and the least density on the path from it to the body is the threshold. The node stands for the article
it is in, or for the main if that has several articles or none is marked, or else for the block around it.
From there the highest ancestor, up to the main or else the body, is taken that has another child at least as
dense as the threshold, so main text spread over siblings is whole. Its text is returned whole, block by block;
only if such siblings were found, blocks around them that hold nothing as dense and are mostly links are left
out. Pages are parsed where they are; nothing is shuffled.

Defined cases: a null, empty or text-free page gives an empty text; markup may be unclosed, misnested or
cut off anywhere; equal sums take the deeper, then the earlier node; rows that share a key are separate
pages. Parsing, densities and text all walk the tree without recursion, so its depth is not limited.
"""

from __future__ import annotations

import functools
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title svg iframe object select xmp noembed".split())
_CUT = frozenset(
    "head nav footer aside button dialog menu audio video canvas map label fieldset".split()
)
#: What goes unless it is the main text, by its tag; other elements go by their names (``NAMED``).
HEADER, FORM, NAMED, COMMENTS = "header", "form", "named", "comments"
_MARKED = frozenset("article main".split())
_BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a begin tag ends when it is open and no barrier stands between.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead"),
}
_BARRIER = frozenset("ul ol dl table html body article section main div td th".split())
#: Parts of a class or id that say so; with them may stand ``_PLACES`` and numbers, and nothing else.
_NOISE = re.compile(
    r"nav(?:bar|igation)?|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|widget|ads?|advert\w*"
    r"|sponsor(?:ed)?|promo\w*|banner|cookies?|consent|gdpr|alert|notice|popup|modal|overlay|comments?(?:list|s)?|replies|respond"
    r"|disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|pagination|pager|toolbar",
    re.IGNORECASE,
)
#: Parts of a name that tell of readers' comments, unless another part says that the element merely has, lacks or counts them.
_COMMENTS = re.compile(r"comments?(?:list|s)?|replies|disqus", re.IGNORECASE)
_MERELY = frozenset("with without no has have show hide open closed enabled disabled count counter number link toggle".split())
#: Comments go if so many characters of text blocks stand outside of all comments.
_ELSEWHERE = 140
_PLACES = frozenset(
    "site main top bottom left right primary secondary global container wrapper wrap box block area section inner bar "
    "list links item items posts buttons icons form".split()
)
_TEXT_BLOCKS = frozenset("p pre blockquote li dd td h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# As browsers read them: a comment ends at --> or --!>, or at once; a quote begins a value only after an equals sign.
_TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)"
    r"((?>[\s/]+|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?)*+)(?:>|\Z))",
    re.DOTALL,
)
_ATTR = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>"'][^\s>]*))?)?""")
_SPACE = re.compile(r"\s+")


class Node:
    """An element; ``parts`` holds texts and elements in order."""

    __slots__ = (
        "tag", "parts", "parent", "order", "depth", "cut", "suspect", "chars", "tags", "links", "linked", "density", "sum"
    )

    def __init__(self, tag: str, parent: Node | None, order: int, cut: bool, suspect: str = ""):
        self.tag, self.parent, self.order, self.cut, self.suspect = tag, parent, order, cut, suspect
        self.depth = parent.depth + 1 if parent else 0
        self.parts: list[str | Node] = []
        self.chars = self.tags = self.links = self.linked = 0
        self.density = self.sum = 0.0


@functools.lru_cache(4096)
def _named(names: str) -> str:
    """``HEADER`` or ``NAMED`` if one of the classes or ids says as a whole that it is not main text, or ``COMMENTS``."""
    found = ""
    for name in names.lower().replace("side-bar", "sidebar").replace("side_bar", "sidebar").split():
        parts = [x for x in re.split("[-_]+", name) if x]
        if any(_COMMENTS.fullmatch(x) for x in parts) and not any(x in _MERELY for x in parts):
            return COMMENTS
        noise = {x for x in parts if _NOISE.fullmatch(x)}
        if noise and all(x in noise or x in _PLACES or x.isdigit() for x in parts):
            if not noise <= {"header", "masthead"}:
                return NAMED
            found = HEADER
    return found


def _noise(tag: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is cut in any case, and else as what it is cut if it is not the main text."""
    if tag in _CUT:
        return True, ""
    suspect = tag if tag in (HEADER, FORM) else ""
    if not attributes or tag in ("body", "html", "main") or tag in _HEADINGS:
        return False, suspect
    for name, *values in _ATTR.findall(attributes):
        value, name = "".join(values), name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, ""
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True, ""
        if name in ("class", "id"):
            suspect = suspect or _named(value)
            if tag == "article" and suspect != COMMENTS:
                suspect = ""
        elif name == "role" and tag != "article" and value.lower() in _ROLES:
            suspect = suspect or {"banner": HEADER, "form": FORM}.get(value.lower(), NAMED)
    return False, suspect


def _without_noise(nodes: list[Node]) -> list[Node]:
    """The nodes that stay when the suspects that are not the main text are cut off."""
    if not any(n.suspect for n in nodes):
        return nodes
    chars, marks = [n.chars for n in nodes], [False] * len(nodes)
    blocks, held = [0] * len(nodes), [False] * len(nodes)
    marked, body = False, 0
    for node in nodes:
        held[node.order] = node.tag in _TEXT_BLOCKS or node.parent is not None and held[node.parent.order]
        blocks[node.order] = chars[node.order] if held[node.order] else 0
    for node in reversed(nodes):
        k = node.order
        if chars[k]:
            own = node.tag in _MARKED and node.suspect != COMMENTS
            marks[k] |= own or node.tag == "h1"
            marked |= own
        if node.tag == "body":
            body = k
        if node.parent is not None:
            up = node.parent.order
            chars[up] += chars[k]
            marks[up] |= marks[k]
            blocks[up] += blocks[k]
    said = [n.suspect == COMMENTS and not marks[n.order] for n in nodes]
    for node in nodes[1:]:
        said[node.order] |= said[node.parent.order]
    elsewhere = sum(n.chars for n in nodes if held[n.order] and not said[n.order])
    inside, gone = [False] * len(nodes), [False] * len(nodes)
    for node in nodes[1:]:
        k, up = node.order, node.parent.order
        inside[k] = inside[up] or node.parent.tag in _MARKED
        gone[k] = gone[up]
        if gone[k] or not node.suspect:
            continue
        if not chars[k]:
            gone[k] = True
        elif node.suspect == COMMENTS and not marks[k] and elsewhere >= _ELSEWHERE:
            gone[k] = True
        elif marks[k] or inside[k] and (node.suspect == HEADER or node.suspect == FORM and blocks[k]):
            continue
        else:
            most = blocks[k] and 2 * blocks[k] >= blocks[body] or 4 * chars[k] >= 3 * chars[body]
            gone[k] = not most or marked and not inside[k]
        if gone[k]:
            node.parent.parts.remove(node)
    return [n for n in nodes if not gone[n.order]]


def parse(page: str) -> tuple[Node, list[Node]]:
    """The root of a page and all its kept nodes in page order."""
    root = Node("html", None, 0, False)
    nodes, top, at = [root], root, 0
    open_count: dict[str, int] = {}

    def close(to: Node) -> Node:
        """Close everything down to and with ``to``."""
        node = top
        while True:
            open_count[node.tag] -= 1
            if node is to:
                return node.parent
            node = node.parent

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            begin = len(page)
        if begin > at and not top.cut:
            part = html.unescape(page[at:begin])
            top.parts.append(part)
            top.chars += len(_SPACE.sub("", part))
        if begin == len(page):
            break
        m = _TAG.match(page, begin)
        if not m:
            if not top.cut:
                top.parts.append("<")
                top.chars += 1
            at = begin + 1
            continue
        at = m.end()
        ending, tag, attributes = m.group(1), (m.group(2) or "").lower(), m.group(3) or ""
        if not tag:
            continue
        if ending:
            if open_count.get(tag):
                node = top
                while node.tag != tag:
                    node = node.parent
                top = close(node)
            continue
        if tag in ("html", "head", "body") and open_count.get(tag):
            continue
        if tag == "html":
            continue
        if tag == "body" and open_count.get("head"):
            node = top
            while node.tag != "head":
                node = node.parent
            top = close(node)
        if tag in _BLOCKS and open_count.get("p"):
            top = _end(top, ("p",), close)
        if tag in _ENDS:
            top = _end(top, _ENDS[tag], close)
        if tag in _RAW:
            # Elsewhere a closing slash says nothing.
            if tag != "svg" or not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        if tag in _VOID:
            if not top.cut:
                top.parts.append(" " if tag in ("br", "hr", "img") else "")
            continue
        cut, suspect = (True, "") if top.cut else _noise(tag, attributes)
        node = Node(tag, top, len(nodes), cut, suspect)
        if not node.cut:
            top.parts.append(node)
            nodes.append(node)
        open_count[tag] = open_count.get(tag, 0) + 1
        top = node
    return root, _without_noise(nodes)


def _end(top: Node, tags: tuple[str, ...], close) -> Node:
    """End the nearest open element of ``tags``, unless a barrier stands between."""
    node = top
    while node.parent is not None:
        if node.tag in tags:
            return close(node)
        if node.tag in _BARRIER:
            return top
        node = node.parent
    return top


def measure(root: Node, nodes: list[Node]) -> None:
    """Characters (of its own so far), tags and their link shares below every node; densities and sums of densities."""
    for node in reversed(nodes):  # children come after their parents
        if node.tag == "a":
            node.linked, node.links = node.chars, node.links + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.links += node.links
            up.linked += node.linked
    body = next((n for n in nodes if n.tag == "body"), root)
    share = body.linked / body.chars if body.chars else 0.0
    for node in nodes:
        node.density = _density(node, share)
        if node.parent is not None:
            node.parent.sum += node.density


def _density(node: Node, share: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of characters and tags in links."""
    c, t = node.chars, max(node.tags, 1)
    if not c:
        return 0.0
    lc, lt, plain = max(node.linked, 1), max(node.links, 1), max(c - node.linked, 1)
    base = math.log(c / plain * lc + share * c + math.e)
    return max(c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, math.e)), 0.0) if node.linked else c / t


def best_node(nodes: list[Node]) -> Node:
    """The node of the largest sum; of equal sums the deeper, then the earlier one."""
    return max(nodes, key=lambda n: (n.sum, n.depth, -n.order))


def main_node(root: Node, nodes: list[Node]) -> tuple[Node, frozenset[Node]]:
    """The node that holds the largest sum and all as dense text beside it, and the link lists in it that do not belong.

    As dense is what is at least as dense as the least dense node on the path of the largest sum to the body.
    """
    body = next((n for n in nodes if n.tag == "body"), root)
    inside = [n for n in nodes if n.order >= body.order and n.chars]
    if not inside:
        return body, frozenset()
    best = best_node(inside)
    least, node = best.density, best
    while node is not body and node.parent is not None:
        least, node = min(least, node.density), node.parent
    least = min(least, body.density)
    chosen, last = _marked(best, body)
    up = top = chosen
    while up is not last and up.parent is not None:
        up, below = up.parent, up
        if any(isinstance(x, Node) and x is not below and x.density >= least and x.density for x in up.parts):
            top = up
    return top, _link_lists(chosen, top, least) if top is not chosen else frozenset()


def _marked(best: Node, body: Node) -> tuple[Node, Node]:
    """The article, main or block that ``best`` is a part of, and the last node up to which more text may belong to it."""
    path = [best]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    article = next((n for n in reversed(path) if n.tag == "article"), None)
    main = next((n for n in reversed(path) if n.tag == "main"), None)
    last = body if main is None or _holds("main", body, main) else main
    if article is None:
        return main or next((n for n in path if n.tag in _REGIONS), path[-1]), last
    # The main of several articles stands for them all.
    if main is not None and main.depth < article.depth and _holds("article", main, article):
        return main, last
    return article, last


def _holds(tag: str, node: Node, without: Node) -> bool:
    """Whether a subtree has text in an element of ``tag`` outside of one of its own subtrees."""
    stack = [node]
    while stack:
        for x in stack.pop().parts:
            if isinstance(x, Node) and x is not without and x.chars:
                if x.tag == tag:
                    return True
                stack.append(x)
    return False


def _link_lists(chosen: Node, top: Node, least: float) -> frozenset[Node]:
    """Blocks around the dense subtrees of ``top`` that hold no dense node, and most of whose text is links."""
    path, node = {chosen}, chosen
    while node is not top:
        node = node.parent
        path.add(node)
    outer, stack = [], [top]  # nodes that are not dense, or on the path; parents first
    while stack:
        for x in stack.pop().parts:
            if isinstance(x, Node) and x is not chosen and (x in path or not x.density or x.density < least):
                outer.append(x)
                stack.append(x)
    holds, lists = set(path), set()
    for x in reversed(outer):
        if x in holds or any(isinstance(y, Node) and (y in holds or y.density and y.density >= least) for y in x.parts):
            holds.add(x)
        elif x.tag in _BLOCKS and 2 * x.linked > x.chars:
            lists.add(x)
    # A list within a block that stays, such as a paragraph of little text, stays with it.
    return frozenset(x for x in lists if x.parent in holds or x.parent in lists)


_REGIONS = frozenset("section div body td blockquote html".split())


def text_of(node: Node, without: frozenset[Node] = frozenset()) -> str:
    """Blocks of a subtree, each with single spaces, joined by line feeds; some subtrees may be left out."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        joined = _SPACE.sub(" ", "".join(line)).strip()
        if joined:
            blocks.append(joined)
        line.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            line.append(x)
        elif x in without:
            flush()
        elif x.tag in _BLOCKS:
            flush()
            stack.append(None)
            stack.extend(reversed(x.parts))
        else:
            stack.extend(reversed(x.parts))
    flush()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root, nodes = parse(page)
    measure(root, nodes)
    return text_of(*main_node(root, nodes))


def extract(pages: DataFrame, key: str = "page_id", page: str = "html", carried: tuple[str, ...] = ("url",)) -> DataFrame:
    """``key``, the carried columns and the main ``text`` of every page."""
    cells = pages.select(F.struct(key, *carried).alias("row"), F.col(page).alias("html"))

    def cut(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    shape = cells.select("row", F.col("html").alias("text")).schema
    return cells.mapInArrow(cut, shape).select("row.*", "text")
