"""Operator 4: main text of web pages by tree scoring.

A page becomes a tree of blocks.  Paragraph-like blocks score by length and commas, and pass their points to their ancestors (whole
to the parent, half to the next, a third beyond); an ancestor's points are discounted by its link density.  The container with most
points is kept; if it lies in an article (or else main), the outermost is kept as a whole, else the largest ancestor below the body whose other
blocks are no link lists, with the siblings of that which score alike or read like text; but for blocks beside the best container that are mostly
links, or copyright lines.  Subtrees that are never content (scripts, styles, forms, navigation, headers and footers of the page, asides, and
classes or ids that name menus, adverts, notices, comments and the like) are dropped first; inside an article names that content may have as well
(related, social, share, ...) count only for parts that are links or hold no sentence, and parts named discussion, reviews and the like go unless
they have a heading.  A part that its name alone drops comes back where hardly any text (a fifth) would be left without it.

Inside the kept part each block's white space becomes one space; blocks are joined by newlines.  Character references are decoded.  Null and
empty pages, and pages without text, give an empty text.  Rows are independent: null or repeated page_ids and extra columns
change nothing; an empty table gives an empty result.  Unclosed and stray tags are tolerated; nesting depth is not limited by recursion.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML's elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml select canvas audio video".split())
DROPPED = frozenset("nav aside form button menu dialog fieldset head footer".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SCORED = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset("div dl ol section table ul".split())
ENDS_P = BLOCKS - {"body", "html"}
#: Words in classes and ids of parts that are not content, and of parts that are.
UNLIKELY = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|alert|banner|breadcrumbs?|comments?|comment-?list|consent|cookies?|disqus|footer|gdpr|header|login|masthead|menu|modal|nav\w*|newsletter|notice|paywall|pager|pagination|popup|promo\w*|rail|recommend\w*|related|replies|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|tags|teaser|toolbar|widget)(?:$|[\s_-])", re.I)
DOUBTFUL = re.compile(r"(?:^|[\s_-])(?:header|recommend\w*|related|replies|share|sharing|social|tags|teaser|widget)(?:$|[\s_-])", re.I)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text)(?:$|[\s_-])", re.I)
#: Names of reader comments that chapters have as well: a part with a heading is a chapter.
VOICES = re.compile(r"(?:^|[\s_-])(?:discussions?|feedback|responses|reviews?)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_ENDS = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*\s*$", re.M)
_RIGHTS = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)|all rights reserved", re.I)


class Node:
    __slots__ = ("tag", "parent", "items", "dropped", "doubt", "named", "inner", "weight", "points", "text", "linked")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, weight: float = 0.0, doubt: bool = False, named: bool = False):
        self.tag, self.parent, self.dropped, self.weight, self.doubt, self.named = tag, parent, dropped, weight, doubt, named
        self.inner = tag in ("article", "main") or parent is not None and parent.inner  # inside an article
        self.items: list = []
        self.points, self.text, self.linked = 0.0, 0, 0


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _judge(tag: str, source: str, inside: Node) -> tuple[bool, float, bool, bool]:
    """Whether a subtree is dropped, how far its class and id speak for content, whether they leave it in doubt, and whether they alone drop it."""
    if tag in DROPPED:
        return True, 0, False, False
    if tag == "header":
        node: Node | None = inside
        while node is not None and node.tag not in ("article", "main", "section"):
            node = node.parent
        if node is None:
            return True, 0, False, False
    weight = 25.0 if tag in ("article", "main") else 0.0
    if not source:
        return False, weight, False, False
    a = _attributes(source)
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True, 0, False, False
    names = f"{a.get('class', '')} {a.get('id', '')}"
    likely = bool(LIKELY.search(names))
    if UNLIKELY.search(names) and tag not in ("body", "html", "article", "main") and not (likely and tag in ("section", "div") and "comment" not in names.lower()):
        strong = UNLIKELY.search(DOUBTFUL.sub(" ", DOUBTFUL.sub(" ", names)))
        return (True, 0, False, True) if strong or not inside.inner else (False, weight, True, False)
    return False, weight + 25.0 * likely, False, tag in ("section", "div", "ul", "ol") and bool(VOICES.search(names))


def parse(html: str) -> Node:
    """The tree of a page; items of a node are texts and nodes in order."""
    top = node = Node("#top", None)
    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        text = html[at : m.start() if m else end]
        if text:
            node.items.append(unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            other: Node | None = node
            while other is not None and other.tag != tag:
                if tag not in BLOCKS and other.tag in BLOCKS:  # a stray inline end tag closes no block
                    other = None
                    break
                other = other.parent
            if other is not None:
                node = other.parent or top
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag in ENDS_P or tag in ("li", "dd", "dt", "tr", "td", "th"):
            node = _close_implied(node, tag)
        if tag in VOID:
            if tag in ("br", "hr"):
                node.items.append("\n" if tag == "hr" else " ")
            continue
        if m[3].endswith("/") and tag not in BLOCKS:
            continue
        dropped, weight, doubt, named = (False, 0.0, False, False) if tag not in BLOCKS and not m[3] and tag not in DROPPED else _judge(tag, m[3], node)
        child = Node(tag, node, dropped, weight, doubt, named)
        node.items.append(child)
        node = child
    return top


_SAME = {"li": ("li", ("ul", "ol", "menu")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)), "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr",)), "th": ("td th", ("tr",))}


def _close_implied(node: Node, tag: str) -> Node:
    """The node after closing what a new block ends: an open paragraph, or the previous item of a list or row."""
    closes, stops = _SAME.get(tag, ("p", ()))
    closes = {*closes.split(), "p"}
    other: Node | None = node
    out = node
    while other is not None and other.tag not in stops:
        if other.tag in closes:
            out = other.parent or node
        elif other.tag in BLOCKS and other.tag not in ("p",):
            break
        other = other.parent
    return out


def _walk(top: Node) -> list[Node]:
    """Kept nodes, parents first."""
    out, stack = [], [top]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [x for x in reversed(node.items) if isinstance(x, Node) and not x.dropped]
    return out


def _text(node: Node) -> str:
    return text_of([node])


def _reads(node: Node) -> bool:
    """Whether a block beside the kept part is text of its own: hardly linked, no control in it, and a heading, a plain list or sentences."""
    if not node.text or node.linked >= 0.25 * node.text or any(x.dropped for n in _walk(node) for x in n.items if isinstance(x, Node)):
        return False
    text = _text(node)
    return not _RIGHTS.search(text) and (node.tag in HEADINGS or node.tag in ("ul", "ol", "dl") and not node.linked or bool(_ENDS.search(text)))


def _whole(node: Node) -> Node:
    """The outermost article around a node or that it is; else the outermost main; else its largest ancestor below the body in which nothing
    beside it is mostly links."""
    found = {}
    other: Node | None = node
    while other is not None:
        found[other.tag] = other
        other = other.parent
    if "article" in found or "main" in found:
        return found.get("article") or found["main"]
    while node.parent is not None and node.parent.tag not in ("body", "html", "#top"):
        beside, links = node.parent.text - node.text, node.parent.linked - node.linked
        if links > 0.3 * beside:
            break
        node = node.parent
    return node


def _drop_links(whole: Node, chosen: Node) -> None:
    """Drops blocks inside a node, beside the chosen one, that are mostly links; headings are no menu, linked or not."""
    around = set()
    other: Node | None = chosen
    while other is not None:
        around.add(id(other))
        other = other.parent
    nodes = _walk(whole)
    linked: dict[int, int] = {}
    for node in reversed(nodes):
        own = 0 if node.tag in HEADINGS else node.linked if node.tag == "a" else linked.get(id(node), 0)
        linked[id(node)] = own
        if node.parent is not None:
            linked[id(node.parent)] = linked.get(id(node.parent), 0) + own
    stack = [whole]
    while stack:
        node = stack.pop()
        for x in node.items:
            if isinstance(x, Node) and not x.dropped and x is not chosen:
                beside = id(x) not in around
                if x.tag in HOLDERS and beside and linked[id(x)] > 0.5 * x.text or beside and x.tag in BLOCKS and 0 < x.text < 200 and x.tag not in HEADINGS and _RIGHTS.search(_text(x)):
                    x.dropped = True
                else:
                    stack.append(x)


def _measure(nodes: list[Node]) -> dict[int, int]:
    """Text and linked text of nodes (parents first); the commas of each."""
    commas: dict[int, int] = {}
    for node in nodes:
        node.text = node.linked = 0
    for node in reversed(nodes):
        own = [x for x in node.items if isinstance(x, str)]
        node.text += sum(len(_SPACE.sub(" ", x).strip()) for x in own)
        commas[id(node)] = commas.get(id(node), 0) + sum(x.count(",") + x.count("，") + x.count("、") for x in own)
        if node.tag == "a":
            node.linked = node.text
        if node.parent is not None:
            node.parent.text += node.text
            node.parent.linked += node.linked
            if node.tag not in BLOCKS:
                commas[id(node.parent)] = commas.get(id(node.parent), 0) + commas[id(node)]
    return commas


def _weigh_names(top: Node) -> None:
    """Names are no verdict on most of a page: the largest part that its name alone drops comes back where hardly any text is left without it.

    Parts named like reader comments that chapters have as well go unless they have a heading or are most of the page."""
    order, stack = [], [(top, False)]
    while stack:
        node, gone = stack.pop()
        gone = gone or node.dropped
        order.append((node, gone))
        stack += [(x, gone) for x in node.items if isinstance(x, Node) and (not x.dropped or x.named)]
    size: dict[int, int] = {}
    heads: set[int] = set()
    for node, _ in reversed(order):
        size[id(node)] = size.get(id(node), 0) + sum(len(x.strip()) for x in node.items if isinstance(x, str))
        if node.parent is not None:
            size[id(node.parent)] = size.get(id(node.parent), 0) + size[id(node)]
            if node.tag in HEADINGS or id(node) in heads:
                heads.add(id(node.parent))
    total = size[id(top)]
    for node, gone in order:
        if node.named and not node.dropped and not gone and id(node) not in heads and 2 * size[id(node)] < total:
            node.dropped = True
    while True:
        lost = [n for n, _ in order if n.named and n.dropped and not _inside_dropped(n)]
        most = max(lost, key=lambda n: size[id(n)], default=None)
        if most is None or size[id(most)] <= 4 * (total - sum(size[id(n)] for n in lost)):
            return
        most.dropped = False


def _inside_dropped(node: Node) -> bool:
    other = node.parent
    while other is not None and not other.dropped:
        other = other.parent
    return other is not None


def best(top: Node) -> list[Node]:
    """The best container and its kept siblings, in page order."""
    _weigh_names(top)
    nodes = _walk(top)
    commas = _measure(nodes)
    doubts = [n for n in nodes if n.doubt and not (n.linked < 0.25 * n.text and _ENDS.search(_text(n)))]
    if doubts:
        for n in doubts:
            n.dropped = True
        nodes = _walk(top)
        commas = _measure(nodes)
    for node in nodes:
        bare = node.tag in BLOCKS and node.tag not in SCORED and any(isinstance(x, str) and len(x.strip()) >= 25 for x in node.items)
        if (node.tag in SCORED or bare) and node.text:
            points = (1 + commas[id(node)] + min(3.0, node.text / 100)) * (1 - node.linked / node.text)
            other, step = (node if bare else node.parent), 1
            while other is not None and step <= 4:
                other.points += points / step
                other, step = other.parent, step + 1
    for node in nodes:
        node.points = (node.points + (node.weight if node.points else 0)) * (1 - node.linked / node.text if node.text else 0)
    chosen = max((n for n in nodes if n.tag in BLOCKS or n is top), key=lambda n: n.points, default=top)
    if not chosen.points or chosen.parent is None:
        return [chosen]
    floor = max(10.0, chosen.points * 0.2)
    whole = _whole(chosen)
    if whole is not chosen:
        _drop_links(whole, chosen)
    out = []
    for other in whole.parent.items:
        if other is whole:
            out.append(other)
        elif isinstance(other, Node) and not other.dropped and other.text:
            if _reads(other) if not whole.inner else other.points >= floor and other.linked < 0.25 * other.text:
                out.append(other)
    return out


def text_of(nodes: list[Node]) -> str:
    """Blocks of the nodes, one a line."""
    lines, now = [], []

    def close() -> None:
        line = _SPACE.sub(" ", "".join(now)).strip()
        if line:
            lines.append(line)
        now.clear()

    stack: list = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            now.append(item)
        elif not item.dropped:
            if item.tag in BLOCKS:
                close()
                stack.append(None)
            stack += reversed(item.items)
    close()
    return "\n".join(lines)


def extract_one(html: str | None) -> str:
    return text_of(best(parse(html))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [extract_one(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
