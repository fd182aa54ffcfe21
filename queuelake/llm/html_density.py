"""Main text of a web page by composite text density.

The page becomes a tree.  Scripts, styles, comments and the elements that by
their tag, role, class or id are menus, headers, footers, sidebars, notices,
adverts, forms or reader comments are left out, unless one holds the article
itself.  Every block gets a density: characters per tag, weighed by the share of
characters and tags inside links.
The block whose children have the greatest sum of densities lies in the article.
The least density on the path from it to the body is the threshold.

With an article or main element around the block, that one stays as a whole;
blocks outside of it stay that reach the threshold.  Otherwise the article is
the outermost block on the path that holds prose of its own (bare text,
paragraphs, lists) beside the path, or else the densest block itself: all in it
stays, and of the blocks beside the path those that reach a quarter of the
threshold (``SPARSE``), so sections of unlike length stay together while
teasers, side columns and footers go, marked or not.  In both, lists of links go,
and so do divisions with several links below a quarter of the threshold.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from queuelake.llm.frames import map_batches

#: Element names of the HTML standard, by their part here.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
LEFT_OUT = set("head title script style noscript template iframe object svg canvas button select option textarea noembed noframes xmp math audio video map".split())
BESIDE_TAGS, FORM_TAGS = set("nav header footer aside".split()), set("form dialog menu".split())
HEAD_PARTS = set("base basefont bgsound link meta noframes noscript script style template title".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
#: What an opening tag closes besides, and the elements that bound the search.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
           "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SCOPE = set("html body article section main div table td th li ul ol blockquote aside nav header footer form button figure".split())

#: What prose stands in, and what only divides a page up.
PROSE = set("p pre blockquote ul ol dl li dt dd figure table".split())
DIVISIONS = {"div", "section"}
#: The share of the threshold below which a block is sparse.
SPARSE = 0.25
#: Least base of the density's logarithm: near 1, as without links, a few words
#: would count more than a page.
LEAST_BASE = 2.0

#: Words in a class, id or role that name what is not the article.
BOILERPLATE = set("""
ad ads advert adverts advertisement advertising adbox adslot adsbygoogle sponsor sponsored promo promotion banner
nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc
header masthead footer footnotes colophon copyright legal
sidebar aside rail widget widgets related recommended recommendations
notice notices cookie cookies consent gdpr modal popup overlay alert newsletter subscribe subscription paywall signup login
comment comments commentlist respond reply replies disqus discussion
share sharing social toolbar search form hidden complementary contentinfo
""".split())

#: Those of them for reader comments; words that turn a name's meaning around;
#: and last words of a name that only say which part of the thing it is.
COMMENTS_WORDS = set("comment comments commentlist respond reply replies disqus discussion".split())
NEGATED = set("no not non has have with without hide".split())
PARTS = set("""
area list lists wrapper wrap container box bar block section panel slot unit item items inner outer group row col
left right top bottom primary secondary thread links buttons icons posts articles stories news
frame tools
""".split())
#: How an element is left out: by a name, or by one of the tags for what stands
#: beside an article, unless it holds the article; as reader comments, unless
#: there is no other text; as what is never text.
BY_NAME, BESIDE, COMMENTS, NEVER = 1, 2, 3, 4

_TOKEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "items", "out", "own", "chars", "tags", "link_chars", "link_tags", "density", "sum", "parent")

    def __init__(self, tag: str, parent: "Node | None", out: int = 0):
        self.tag, self.parent, self.out = tag, parent, out
        self.items: list[Node | str] = []
        self.own = self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _named(name: str) -> int:
    """How a class, id or role leaves out: by its last word but for PARTS
    (site-footer, sidebarLeft), so neither no-sidebar nor related-work does."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not NEGATED.isdisjoint(words):
        return 0
    while len(words) > 1 and (words[-1] in PARTS or len(words[-1]) == 1):
        words.pop()
    if not words or words[-1] not in BOILERPLATE:
        return 0
    return COMMENTS if words[-1] in COMMENTS_WORDS else BY_NAME


def _left_out(tag: str, attributes: str) -> int:
    if tag in LEFT_OUT:
        return NEVER
    out = BESIDE if tag in BESIDE_TAGS else BY_NAME if tag in FORM_TAGS else 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return out
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in ("class", "id", "role"):
            for token in html.unescape(m[2] or m[3] or m[4] or "").split():
                out = max(out, _named(token))
        elif name == "style" and _NOT_SHOWN.search(html.unescape(m[2] or m[3] or m[4] or "")) or name == "hidden" or name == "aria-hidden" and (m[2] or m[3] or m[4]) == "true":
            out = max(out, BY_NAME)
    return out


def parse(page: str) -> Node:
    """The tree of a page; open elements are closed as the standard implies,
    and a page that breaks off closes them all."""
    root = Node("html", None)
    stack = [root]
    open_tags: Counter[str] = Counter()
    at = 0

    def close(names: set[str], bounds: set[str]) -> None:
        if not any(open_tags[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                open_tags.subtract(n.tag for n in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            if stack[-1].tag == "head" and text.strip():
                close({"head"}, set())
            stack[-1].items.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in ("html", "body"):  # what follows belongs to the body
                continue
            close({tag}, SCOPE - {tag} if tag in INLINE or tag == "p" else set())
            continue
        if tag in ("html", "body") and open_tags[tag] or tag == "head" and stack[-1].tag != "html":
            continue
        if tag == "body" or stack[-1].tag == "head" and tag not in HEAD_PARTS:
            close({"head"}, set())
        if tag in CLOSES_P:
            close({"p"}, SCOPE)
            if tag in HEADINGS:
                close(HEADINGS, SCOPE)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        node = Node(tag, stack[-1], _left_out(tag, m[3] or ""))
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>|\\Z", re.I).search(page, at)
            if not node.out:
                node.items.append(page[at : end.start()])
            at = end.end()
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            stack.append(node)
            open_tags[tag] += 1
    _spare(root)
    return root


def _spare(root: Node) -> None:
    """Takes back what would leave out the article: elements that hold a main
    element and, where every article is left out or the page has none, those
    that hold most of the page's text outside of links, and those around the
    first article if most of that text is left out."""
    nodes, hid, linked, todo = [], {}, {}, [root]
    while todo:
        node = todo.pop()
        if node.out == NEVER:
            continue
        nodes.append(node)
        node.own = sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        above = node.parent
        hid[node] = max(node.out, hid[above] if above else 0)
        linked[node] = node.tag == "a" or above is not None and linked[above]
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    if not any(hid.values()):
        return
    for least in (COMMENTS, NEVER):  # comments count where nothing else does
        plain = {n: 0 if linked[n] or hid[n] >= least else n.own for n in nodes}
        total = sum(plain.values())
        if total:
            break
    seen = sum(x for n, x in plain.items() if not hid[n])
    main = {n: n.tag == "main" for n in nodes}
    for node in reversed(nodes):
        if node.parent:
            plain[node.parent] += plain[node]
            main[node.parent] |= main[node]
    stands = any(plain[n] for n in nodes if n.tag in ARTICLE and (not hid[n] or n.tag == "main" and hid[n] < least))
    for node in nodes:
        if 0 < node.out < least and (main[node] or 2 * plain[node] > total and not stands):
            node.out = 0
    if 2 * seen <= total and not stands:
        node = next((n for n in nodes if n.tag == "article" and hid[n] == BY_NAME), None)
        while node is not None:
            node.out = 0
            node = node.parent


def _nodes(root: Node) -> list[Node]:
    """The nodes that are not left out, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.out:
            continue
        out.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def weigh(root: Node) -> list[Node]:
    """Densities and density sums of every node that is not left out."""
    nodes = _nodes(root)
    for node in reversed(nodes):
        node.chars += node.own
        for x in node.items:
            if isinstance(x, Node) and not x.out:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.chars if x.tag == "a" else x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
    body = next((n for n in nodes if n.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.chars:
            plain = max(node.chars - node.link_chars, 1)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            inside = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
            node.density = node.chars / max(node.tags, 1) * math.log(max(inside, 1.0) + 1e-9, max(base, LEAST_BASE)) if inside > 1 else 0.0
    for node in nodes:
        node.sum = sum(x.density for x in node.items if isinstance(x, Node) and not x.out and x.tag not in INLINE)
    return nodes


def _many_links(node: Node) -> bool:
    """Several links that hold most of the text, as in an unmarked menu."""
    return node.link_tags > 2 and 2 * node.link_chars > node.chars


def _own_prose(node: Node, path: set[int]) -> bool:
    """Whether a node of the path holds prose beside the path itself."""
    return any(
        bool(x.strip()) if isinstance(x, str) else x.tag in INLINE | PROSE and not x.out and x.chars > 0 and id(x) not in path and not _many_links(x)
        for x in node.items
    )


def _content(root: Node) -> list[Node | str | None]:
    """The article's subtrees and bare texts in page order; None ends a block."""
    nodes = weigh(root)
    blocks = [n for n in nodes if n.tag not in INLINE and n.chars]
    best = max(blocks, key=lambda n: n.sum, default=None)
    if best is None:
        return []
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    body = next((i for i, n in enumerate(path) if n.tag == "body"), len(path) - 1)
    threshold = min(n.density for n in path[: body + 1])
    on_path, above = set(map(id, path)), set()
    # what is the article as a whole, and the other articles of the page
    article = next((n for n in reversed(path) if n.tag in ARTICLE), None)
    whole, todo = [best, article or next(n for n in reversed(path) if n is best or _own_prose(n, on_path))], [root]
    while todo:
        node = todo.pop()
        if node.tag in ARTICLE and node.chars and not _many_links(node):
            whole.append(node)
        else:
            todo.extend(x for x in node.items if isinstance(x, Node) and not x.out)
    for node in whole:
        while node is not None and id(node) not in above:
            above.add(id(node))
            node = node.parent
    wholes = set(map(id, whole))
    beside = threshold if article else SPARSE * threshold
    out: list[Node | str | None] = []
    walk: list[tuple[Node | str | None, bool]] = [(root, False)]
    while walk:
        x, inside = walk.pop()
        if x is None or isinstance(x, str):
            out.append(x)
        elif x.out:
            continue
        elif id(x) in on_path or id(x) in above:
            inside = inside or id(x) in wholes
            ends = [(None, inside)] if x.tag not in INLINE else []
            walk.extend([*ends, *((y, inside) for y in reversed(x.items)), *ends])
        elif x.tag in INLINE or x.tag in HEADINGS:  # short by nature
            out.append(x)
        elif inside:
            gone = x.tag in DIVISIONS and x.link_tags > 1 and x.density < SPARSE * threshold
            if not gone and (not _many_links(x) or x.parent is best and x.tag not in DIVISIONS):
                out.append(x)
        elif x.density >= beside:
            out.append(x)
    return out


def _blocks(node: Node | str | None, out: list[list[str]]) -> None:
    """Texts of ``node``, a list for each block; inline elements join in."""
    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            out.append([])
        elif isinstance(x, str):
            out[-1].append(x)
        elif x.tag == "br":
            out[-1].append(" ")
        elif not x.out:
            if x.tag not in INLINE:
                out.append([])
                todo.append(None)
            todo.extend(reversed(x.items))


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, white space within one made one
    space, joined by line ends; empty without any text."""
    out: list[list[str]] = [[]]
    for node in _content(parse(page or "")):
        _blocks(node, out)
    lines = (" ".join("".join(x).split()) for x in out)
    return "\n".join(x for x in lines if x)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty html has the empty text.  Repeated rows give a row each; a
    page that breaks off ends there; other columns are not read; an empty table
    gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long")
