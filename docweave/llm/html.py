"""Main text of web pages by composite text density.

A page is parsed to a tree; parts that are never article text (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments) are left
out first, by element, role and name. For every node of the rest the density is
its characters outside links per block. A node's density sum is the sum over
its children, where its own text counts like a child. The subtree of the
largest density sum is content. The path from it to the body gives two
thresholds, the least density and the least density sum on it; the subtrees of
largest sum within all nodes that reach both are content too, and so are
headings that stand before content. Elements such as article have no part in
that choice.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import table, text_or_empty

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never article text.
NEVER = frozenset(
    "head script style noscript template iframe object embed applet svg math canvas audio video map select button input textarea form fieldset"
    " nav menu header footer aside dialog noembed noframes title search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status".split())
#: Words of class and id names that mark a part as no article text.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|aside|widget|masthead|header|footer|topbar|toolbar|copyright|"
    r"comments?|commentlist|disqus|replies|respond|related|recommend\w*|share|sharing|social|newsletter|subscri\w*|signup|login|search|pagination|pager|skip)(?=$|[\s_-])"
)
#: Of these, the ones that hold lists of other people's or other pages' texts.
LISTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond|related|recommend\w*)(?=$|[\s_-])")
#: An open element of the key ends where one of the values begins.
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset("tr tbody tfoot thead".split()),
    "td": frozenset("td th tr tbody tfoot thead".split()),
    "th": frozenset("td th tr tbody tfoot thead".split()),
    "thead": frozenset(["tbody", "tfoot"]),
    "tbody": frozenset(["tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an implied end doesn't reach beyond.
SCOPE = frozenset("ul ol dl table select body html article section div td th".split())
ENDERS = frozenset().union(*ENDED_BY.values())
ENDS_P = BLOCK - frozenset("body html option optgroup tbody td tfoot th thead tr caption legend".split())
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "block", "bound", "parts", "skip", "chars", "own", "tags", "link_chars", "within", "density", "total", "best")

    def __init__(self, tag: str, parent: Node | None, skip: bool | str):
        self.tag, self.parent, self.skip = tag, parent, skip
        self.parts: list[Node | str] = []
        #: the nearest node, from this one upwards, that is a block, and the nearest that implied ends look at
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.bound = self if parent is None or tag in ENDED_BY or tag in SCOPE else parent.bound


def _skipped(tag: str, attributes: str) -> bool | str:
    """Whether an element is no article text; "name" if only a class or id name says so."""
    if tag in NEVER:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and tag != "main" and NAMES.search(value):
            return True if LISTS.search(value) else "name"
    return False


def parse(html: str) -> Node:
    """The tree of a page. Any text is a page: unknown, unclosed and stray tags are borne, at any depth."""
    root = node = Node("html", None, False)
    opened: Counter = Counter()
    at, size = 0, len(html)

    def rise(to: Node) -> Node:
        """Makes an ancestor the open node."""
        now = node
        while now is not to:
            opened[now.tag] -= 1
            now = now.parent
        return to

    while at < size:
        m = TOKEN.search(html, at)
        if m is None:
            node.parts.append(html[at:])
            break
        if m.start() > at:
            node.parts.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0:
                node = rise(_close(node, tag))
            continue
        if tag in ("html", "body"):  # these are there once
            if tag == "body" and not any(isinstance(x, Node) and x.tag == "body" for x in root.parts):
                node = Node("body", root, False)
                root.parts.append(node)
                opened.clear()
            continue
        node = rise(_imply_ends(node, tag))
        new = Node(tag, node, _skipped(tag, m[3]))
        if tag in ("article", "main") and not new.skip:
            # a wrapper's name, such as with-sidebar, counts less than the article in it
            up: Node | None = node
            while up is not None and (up.skip or up.tag not in ("article", "main")):
                if up.skip == "name":
                    up.skip = False
                up = up.parent
        node.parts.append(new)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            new.parts.append(html[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID:
            node = new
            opened[tag] += 1
    return root


def _close(node: Node, tag: str) -> Node:
    """The open node after an end tag whose element is open; one that doesn't end anything here is ignored."""
    up: Node | None = node
    while up is not None and up.tag != tag:
        # an inline end tag doesn't end the block around it
        if up.tag in BLOCK and tag not in BLOCK or up.tag in ("body", "html"):
            return node
        up = up.parent
    return up.parent if up is not None and up.parent is not None else node


def _imply_ends(node: Node, tag: str) -> Node:
    """The open node after the ends that a start tag implies."""
    if tag in ENDS_P and node.block.tag == "p" and node.block.parent is not None:
        node = node.block.parent
    if node.tag == "head" and tag in BLOCK:
        node = node.parent or node
    if tag not in ENDERS:
        return node
    up = node.bound
    while up is not None and up.parent is not None:
        if tag in ENDED_BY.get(up.tag, ()):
            node = up.parent
            up = node.bound
            continue
        if up.tag in SCOPE and up.tag not in ENDED_BY:
            break
        up = up.parent.bound
    return node


def _visible(parts) -> int:
    return len(WHITE.sub("", unescape(parts)))


def _count(root: Node) -> list[Node]:
    """Counts characters and tags of blocks, bottom up and without recursion; the nodes that count, parents first. Inline elements are part of the text around them."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [x for x in n.parts if isinstance(x, Node) and not x.skip]
    for n in reversed(order):
        n.own = sum(_visible(x) for x in n.parts if isinstance(x, str))
        n.chars, n.tags, n.link_chars, n.within = n.own, 0, 0, 0.0
        for k in n.parts:
            if isinstance(k, str) or k.skip:
                continue
            block = k.tag in BLOCK
            n.chars += k.chars
            n.tags += k.tags + block
            n.link_chars += k.link_chars
            if not block:
                n.own += k.own
                n.within += k.within
            else:
                n.within += k.density
        if n.tag == "a":
            n.link_chars, n.own = n.chars, 0
        # composite density: characters outside links per tag; its sum over the children, where a node's own text counts like a child
        n.density = (n.chars - n.link_chars) / max(n.tags, 1)
        n.total = n.own + n.within
    return order


def _rank(order: list[Node]) -> None:
    """For each node the subtree of largest density sum within it, bottom up; among equals the outermost."""
    for n in reversed(order):
        n.best = n
        for x in n.parts:
            if isinstance(x, Node) and not x.skip and x.best.total > n.best.total and x.best.tag in BLOCK:
                n.best = x.best


def content(body: Node) -> list[Node]:
    """The subtrees that are content, in page order, none within another.

    The subtree of the largest density sum is content. The threshold is the
    least density on the path from it to the body; within each node that
    reaches it the subtree of the largest sum is content too. Headings that
    stand before content among the children of a node belong to it.
    """
    order = _count(body)
    if not body.chars:
        return []
    _rank(order)
    best = up = body.best
    least, share = best.density, best.total
    while up is not body:
        up = up.parent
        least, share = min(least, up.density), min(share, up.total)
    marked = {id(n.best) for n in order if n.density >= least and n.best.total >= share and n.chars and n.tag in BLOCK}
    marked.add(id(best))
    # what contains content, bottom up
    holds = set(marked)
    for n in reversed(order):
        if any(isinstance(x, Node) and id(x) in holds for x in n.parts):
            holds.add(id(n))
    out, stack = [], [body]
    while stack:
        n = stack.pop()
        if id(n) in marked:
            out.append(n)
            continue
        later: list[Node] = []
        follows = False
        for x in reversed(n.parts):
            if isinstance(x, str) or x.skip:
                follows = follows and (isinstance(x, str) and not x.strip() or not isinstance(x, str))
                continue
            heading = x.tag in HEADINGS and follows
            if id(x) in holds or heading:
                later.append(x)
                if heading:
                    marked.add(id(x))
                follows = True
            elif x.chars:
                follows = False
        stack += later
    return out


def blocks(top: Node) -> list[str]:
    """The texts of a subtree's blocks, white space as single spaces, without empty ones."""
    out: list[str] = []
    now: list[str] = []

    def flush() -> None:
        text = WHITE.sub(" ", unescape("".join(now))).strip()
        if text:
            out.append(text)
        now.clear()

    stack: list = [top]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            now.append(x)
        elif not x.skip:
            if x.tag == "br":
                now.append(" ")
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(x.parts)
    flush()
    return out


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks joined by two line feeds. Null and empty pages, and pages without text, give an empty text."""
    if not html:
        return ""
    root = parse(html)
    body = next((x for x in root.parts if isinstance(x, Node) and x.tag == "body"), root)
    return "\n\n".join(b for top in content(body) for b in blocks(top))


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the column `out` for the main text in place of the html.

    Row by row over whole pages; nulls and empty pages give an empty text,
    repeated rows are treated alike, further columns stay (one named like
    `out` gives way).
    """
    kept = [c for c in pages.columns if c not in (html, out)]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], text_or_empty(F.col(f"`{html}`")).alias(html))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != html)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h.as_py()) for h in b[html]], pa.string())
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], texts], [*kept, out])

    return rows.mapInArrow(work, f"{fields}{', ' if kept else ''}`{out}` string")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    done = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
