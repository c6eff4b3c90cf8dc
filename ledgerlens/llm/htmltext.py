"""Main text of web pages by a tree-structured graphical model over the DOM.

Block elements of a page are nodes of a tree; each is content, boilerplate, or a wrapper that may
hold both. Parent-child potentials say how likely an element of its kind (with hints in its class
and id) has a label inside a parent with a label; node potentials say how likely its looks are
(length and link share of its own text).
Both are counted on labelled pages. Messages pass from the leaves to the root and back, which
gives every node's exact marginal; text of nodes with a marginal of at least a half is kept.

Text is taken block by block: character references decoded, white space made one space, trimmed,
blocks in page order joined by one space. Scripts, styles, form controls and comments in markup
hold no text; what other elements hold (formulas, pictures, objects, noscript) is text like any.
Parsing takes time in proportion to the page, whatever its marks, and elements may lie as deep as they
like: a wrapper that holds nothing but one element says nothing of it and takes no part in the
messages, so a long chain of wrappers leaves its content as likely as it was. Defined results: null or empty html gives the empty string; pages without any tag
are judged as one block; rows that repeat are extracted each; an empty table gives no row.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .labelled_pages import labelled_pages

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
PLAIN = re.compile(r"""[^"'>]*""")
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose inside is no text of the page: scripts, styles, form controls, other documents.
RAW = frozenset({"script", "style", "template", "iframe", "textarea", "title", "noembed", "noframes", "select", "button"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
INLINE = frozenset({"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "math", "svg", "object", "noscript", "canvas", "audio", "video"})
#: Start tag: open elements that it ends, and those beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
ENDS_P = frozenset({"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"})
BUTTON_SCOPE = frozenset({"button", "table", "td", "th", "caption", "object", "html"})

OTHER_HINT = re.compile(r"(?:^|[-_ ])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|top|footer|foot|copyright|legal|sidebar|side|aside|widget|related|recommended|share|sharing|social|comments?|replies|discussion|disqus|respond|cookies?|consent|gdpr|notice|notification|alert|popup|modal|newsletter|subscribe|signup|login|search|form|pagination|pager|tags?)(?:$|[-_ ])", re.IGNORECASE)
CONTENT_HINT = re.compile(r"(?:^|[-_ ])(?:article|content|post|entry|story|main|body|text|page|blog)(?:$|[-_ ])", re.IGNORECASE)


class Node:
    __slots__ = ("blocks", "hint", "label", "link_chars", "parent", "tag")

    def __init__(self, tag: str, parent: int, hint: str, label: str | None):
        self.tag, self.parent, self.hint, self.label = tag, parent, hint, label
        self.blocks: list[int] = []  # places of its own blocks in the page's list
        self.link_chars = 0


class Tags:
    """The marks of a page in turn: where each begins and ends, its name ("" for comments and the
    like), whether it closes, and its attributes as they are written.

    Takes time in proportion to the page: what is looked for in vain is not looked for again. A
    tag ends at the first > outside quotes; from a tag on whose quotes never close, at the first >.
    """

    def __init__(self, page: str):
        self.page, self.ends, self.quoted = page, True, True

    def end(self, at: int) -> int:
        """The place of the > that ends a tag whose name stops at ``at``, or -1."""
        page = self.page
        if self.quoted:
            pos = at
            while (pos := PLAIN.match(page, pos).end()) < len(page):
                if page[pos] == ">":
                    return pos
                pos = page.find(page[pos], pos + 1) + 1
                if not pos:
                    break
            self.quoted = False
        return page.find(">", at)

    def __call__(self, at: int) -> tuple[int, int, str, bool, str] | None:
        page = self.page
        while self.ends and (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                stop = page.find("-->", at + 4)
                return at, len(page) if stop < 0 else stop + 3, "", False, ""
            closes = page.startswith("/", at + 1)
            name = NAME.match(page, at + 1 + closes)
            if name is None and page[at + 1 : at + 2] not in ("!", "?"):
                at += 1
                continue
            stop = page.find(">", at) if name is None else self.end(name.end())
            if stop < 0:
                self.ends = False  # no tag ends from here on
                break
            return (at, stop + 1, "", False, "") if name is None else (at, stop + 1, name[0].lower(), closes, page[name.end() : stop])
        return None


def parse(page: str) -> tuple[list[Node], list[list[str]]]:
    """Nodes, each after its parent, and the text pieces of each block in page order."""
    nodes, blocks = [Node("#root", -1, "", None)], []
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements with the node that text goes to
    opened: defaultdict[str, list[int]] = defaultdict(list)  # depths of the open elements of a tag
    outer: list[int] = []  # depths of those that are no inline elements
    block: list[str] | None = None
    links = 0

    def text(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        if block is None:
            if not piece.strip():
                return
            block = []
            blocks.append(block)
            nodes[stack[-1][1]].blocks.append(len(blocks) - 1)
        block.append(piece)
        if links:
            nodes[stack[-1][1]].link_chars += len(piece.strip())

    def close(depth: int) -> None:
        nonlocal block, links
        for tag, _ in stack[depth:]:
            opened[tag].pop()
            if tag == "a":
                links -= 1
            elif tag not in INLINE:
                block = None
                outer.pop()
        del stack[depth:]

    def last(tags: frozenset | set) -> int:
        """Depth of the innermost open element of the tags, or 0."""
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    at, n, tags = 0, len(page), Tags(page)
    while at < n:
        found = tags(at)
        if found is None:
            text(page[at:])
            break
        begin, stop, tag, closes, attributes = found
        if begin > at:
            text(page[at:begin])
        at = stop
        if not tag:
            continue
        if closes:
            depth = opened[tag][-1] if opened.get(tag) else 0
            if depth and not (tag in INLINE and outer and outer[-1] > depth):
                close(depth)
            elif tag == "p" and not depth:
                block = None
            continue
        alone = attributes.endswith("/")
        if tag in RAW:
            if not alone:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else n
            block = None if tag != "button" else block
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                block = None
            continue
        if tag in INLINE:
            if not alone:
                links += tag == "a"
                opened[tag].append(len(stack))
                stack.append((tag, stack[-1][1]))
            continue
        if tag in ENDS:
            goes, stops = ENDS[tag]
            stop = last(stops)
            cuts = [d[bisect_right(d, stop)] for t in goes if (d := opened.get(t)) and d[-1] > stop]
            if cuts:
                close(min(cuts))
        elif tag in ENDS_P:
            if opened.get("p") and opened["p"][-1] > last(BUTTON_SCOPE):
                close(opened["p"][-1])
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        names = f"{values.get('class', '')} {values.get('id', '')} {values.get('role', '')}".strip() if values else ""
        hint = "" if not names else "other" if OTHER_HINT.search(names) else "content" if CONTENT_HINT.search(names) else ""
        nodes.append(Node(tag, stack[-1][1], hint, values.get("y")))
        block = None
        if not alone:
            opened[tag].append(len(stack))
            outer.append(len(stack))
            stack.append((tag, len(nodes) - 1))
    return nodes, blocks


KINDS = {
    **dict.fromkeys(("article", "main"), "article"), **dict.fromkeys(("nav", "menu"), "nav"), **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), "heading"),
    **dict.fromkeys(("ul", "ol", "dl", "li", "dt", "dd"), "list"), **dict.fromkeys(("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), "table"),
    **dict.fromkeys(("p", "blockquote", "pre", "figure", "figcaption", "address"), "text"), **dict.fromkeys(("form", "fieldset", "legend"), "form"),
    "header": "header", "footer": "footer", "aside": "aside", "html": "page", "body": "page", "head": "head", "#root": "page",
}


def kind_of(node: Node) -> str:
    """What the parent-child potentials look at: the kind of element and its hint."""
    return f"{KINDS.get(node.tag, 'box')}/{node.hint}"


def looks_of(node: Node, blocks: list[str]) -> tuple[str, str]:
    """Length and link share of a node's own text, each as a class."""
    chars = sum(len(blocks[i]) for i in node.blocks)
    if not chars:
        return "none", "none"
    size = "short" if chars < 25 else "line" if chars < 80 else "some" if chars < 250 else "long"
    share = node.link_chars / chars
    return size, "plain" if share < 0.2 else "mixed" if share < 0.7 else "links"


#: Weight of one node's looks, and how many whole nodes the looks of a page count as at most.
EVIDENCE = (0.5, 4.0)
#: Labels of a node: boilerplate, content, or a wrapper that is neither but may hold both.
OTHER, CONTENT, WRAPPER = 0, 1, 2
LABELS = (OTHER, CONTENT, WRAPPER)


def labels_of(nodes: list[Node]) -> list[int]:
    """Labels of a labelled page: marks are inherited; what is not content but has some inside is
    a wrapper."""
    own = [0] * len(nodes)
    holds = [False] * len(nodes)
    for i, node in enumerate(nodes):
        own[i] = (own[node.parent] if i else 0) if node.label is None else int(node.label)
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i] or own[i] == CONTENT
    return [CONTENT if y == CONTENT else WRAPPER if inside else OTHER for y, inside in zip(own, holds, strict=True)]


def without_chains(nodes: list[Node]) -> tuple[list[Node], list[int]]:
    """The tree without wrappers that hold nothing but one element (plain boxes, or elements of
    their child's kind), and for each node its place in that tree (-1: left out)."""
    children = [0] * len(nodes)
    only = [0] * len(nodes)
    for i in range(1, len(nodes)):
        children[nodes[i].parent] += 1
        only[nodes[i].parent] = i
    kinds = [kind_of(node) for node in nodes]
    kept, place, above = [nodes[0]], [0] * len(nodes), [0] * len(nodes)
    for i in range(1, len(nodes)):
        node = nodes[i]
        above[i] = place[node.parent] if place[node.parent] >= 0 else above[node.parent]
        if children[i] == 1 and not node.blocks and kinds[i] in ("box/", kinds[only[i]]):
            place[i] = -1
            continue
        place[i] = len(kept)
        copy = Node(node.tag, above[i], node.hint, node.label)
        copy.blocks, copy.link_chars = node.blocks, node.link_chars
        kept.append(copy)
    return kept, place


class PageModel:
    """Potentials: of a node's label given its parent's, by kind, and of its looks."""

    def __init__(self, pages: list[str], prior: float = 0.2):
        edges, looks, totals = Counter(), Counter(), Counter()
        for page in pages:
            nodes, pieces = parse(page)
            blocks = ["".join(b) for b in pieces]
            labels = labels_of(nodes)
            nodes, place = without_chains(nodes)
            labels = [y for y, at in zip(labels, place, strict=True) if at >= 0]
            for node, label in zip(nodes[1:], labels[1:], strict=True):
                edges[kind_of(node), labels[node.parent], label] += 1
                for name, value in zip(("size", "links"), looks_of(node, blocks), strict=True):
                    looks[name, value, label] += 1
                totals[label] += 1
        general = Counter()
        for (_, a, b), n in edges.items():
            general[a, b] += n
        self.general = self._rows(general, [[1 / 3] * 3] * 3, prior)
        plain = {}
        for kind in {k.partition("/")[0] for k, _, _ in edges}:
            counts = Counter()
            for (k, a, b), n in edges.items():
                if k.partition("/")[0] == kind:
                    counts[a, b] += n
            plain[kind] = self._rows(counts, self.general, 10 * prior)
        # kinds with few examples lean on the same element without regard to hints
        self.edges = {kind: self._rows(Counter({(a, b): edges[kind, a, b] for a in LABELS for b in LABELS}), plain[kind.partition("/")[0]], 10 * prior) for kind in {k for k, _, _ in edges}}
        self.plain = plain
        self.looks = {(name, value): tuple((looks[name, value, y] + 2.0) / (totals[y] + 10.0) for y in LABELS) for name, value in {(n, v) for n, v, _ in looks}}

    @staticmethod
    def _rows(counts: Counter, toward, weight: float) -> list[list[float]]:
        """P(label | parent's label), drawn toward other rows by so many imagined examples."""
        out = []
        for a in LABELS:
            n = sum(counts[a, b] for b in LABELS)
            out.append([(counts[a, b] + weight * toward[a][b]) / (n + weight) for b in LABELS])
        return out

    def edge(self, node: Node) -> list[list[float]]:
        kind = kind_of(node)
        found = self.edges.get(kind)
        if found is None:
            # never seen with its hint: as without, moved by what the hint says
            move = {"other": (20.0, 1.0, 1.0), "content": (1.0, 4.0, 2.0), "": (1.0, 1.0, 1.0)}[node.hint]
            found = []
            for row in self.plain.get(kind.partition("/")[0], self.general):
                moved = [p * m for p, m in zip(row, move, strict=True)]
                found.append([p / sum(moved) for p in moved])
            self.edges[kind] = found
        return found

    def look(self, nodes: list[Node], blocks: list[str]) -> list[list[float]]:
        """Potentials of all nodes' looks. Looks within a page go together (a page of many short
        lines is no rarity), so what they say in all is held to that of a few nodes."""
        weight = min(EVIDENCE[0], EVIDENCE[1] / max(1, sum(1 for node in nodes if node.blocks)))
        known = {("none", "none"): (1.0, 1.0, 1.0)}
        out = []
        for node in nodes:
            seen = looks_of(node, blocks)
            if seen not in known:
                one, two = self.looks.get(("size", seen[0]), (1.0, 1.0, 1.0)), self.looks.get(("links", seen[1]), (1.0, 1.0, 1.0))
                known[seen] = tuple((a * b) ** weight for a, b in zip(one, two, strict=True))
            out.append(list(known[seen]))
        return out

    def marginals(self, nodes: list[Node], blocks: list[str]) -> list[float]:
        """P(content) of every node by sum-product messages up, then down; the root is a wrapper.

        Messages are scaled to sum to 1, so pages of any size stay within range."""
        n = len(nodes)
        looks = self.look(nodes, blocks)
        inside = [list(x) for x in looks]
        edges = [None, *(self.edge(node) for node in nodes[1:])]
        up: list = [None] * n
        for i in range(n - 1, 0, -1):  # a node comes after its parent
            x, y, z = inside[i]
            message = [e[0] * x + e[1] * y + e[2] * z for e in edges[i]]
            scale = message[0] + message[1] + message[2]
            up[i] = message = [m / scale for m in message]
            parent = inside[nodes[i].parent]
            x, y, z = parent[0] * message[0], parent[1] * message[1], parent[2] * message[2]
            scale = x + y + z
            parent[0], parent[1], parent[2] = x / scale, y / scale, z / scale
        belief: list = [None] * n
        belief[0] = [0.0, 0.0, 1.0]
        out = [0.0] * n
        for i in range(1, n):
            (a0, a1, a2), (b0, b1, b2), (c0, c1, c2) = edges[i]
            from_parent = belief[nodes[i].parent]
            x, y, z = (p / m for p, m in zip(from_parent, up[i], strict=True))
            own = inside[i]
            x, y, z = own[0] * (x * a0 + y * b0 + z * c0), own[1] * (x * a1 + y * b1 + z * c1), own[2] * (x * a2 + y * b2 + z * c2)
            scale = x + y + z
            belief[i] = [x / scale, y / scale, z / scale]
            out[i] = y / scale
        return out


@cache
def trained() -> PageModel:
    return PageModel(labelled_pages())


def extract(page: str, model: PageModel | None = None) -> str:
    """The main text of one page."""
    model = model or trained()
    nodes, pieces = parse(page)
    nodes, _ = without_chains(nodes)
    blocks = ["".join(b) for b in pieces]
    chances = model.marginals(nodes, blocks)
    if len(nodes) == 1:
        chances = [1.0]
    kept = sorted(i for node, p in zip(nodes, chances, strict=True) if p >= 0.5 for i in node.blocks)
    return " ".join(x for x in (" ".join(html.unescape(blocks[i]).split()) for i in kept) if x)


def _extract(model: PageModel):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [extract(page, model) if page else "" for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract_pages(pages: DataFrame, model: PageModel | None = None, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared.prepare(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).alias("html"))
    return rows.mapInArrow(_extract(model or trained()), "page_id long, url string, text string, n_chars long")
