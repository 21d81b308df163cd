"""Main-text extraction from HTML by composite text density.

The page is read into a tree by the rules of tag soup (void elements, implied ends, raw text). Elements and roles that
are never the article (menus, headers of the page, footers, asides, forms, scripts, styles, hidden parts) go by name.
Of all other nodes the composite text density is computed as published (Sun, Song and Liao 2011): characters per tag,
times the logarithm of (characters / link characters) (tags / link tags) to the base
ln(characters / other characters * link characters + (page's link characters / page's characters) * characters + e),
where a count of none is one. A node's density sum adds its children's densities. The subtree of the largest sum holds the article.
A class or id made of noise words is a weak signal: densities count in sums by their part of other characters and a
quarter of such ones, and such a subtree is left out unless the largest sum is inside it all the same.

The subtree is widened to the element that the text belongs to: a parent with paragraphs of its own, or an article or
main element around it. The threshold is the smallest density on its path to the body. By it, blocks of links inside
that are less dense are left out, and subtrees of the same element and class beside it that are as dense are taken in,
as are the headings that lead to it.

Defined results: a null or empty page has an empty text; pages without tags are one block; a page is read whole;
equal pages give equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows

#: Element names, by what the reader does with them (fixed values of the HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption legend option br".split())
ENDS_P = BLOCKS - frozenset("br td th tr tbody thead tfoot caption body html option legend summary".split())
DROPPED = frozenset("head script style title noscript template nav header footer aside form button select textarea input iframe svg math object embed canvas audio video menu dialog noembed noframes xmp".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
#: Words in class or id that mark what isn't the article, and words that only join them (fixed values).
NOISE = frozenset("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist respond disqus replies form search toolbar pagination pager skip hidden copyright legal".split())
JOINING = frozenset("site page main top bottom left right primary secondary global mobile desktop sticky fixed inner outer wrapper wrap container content box block bar area section list item items link links button buttons icon icons group slot unit text sub post posts article articles story stories user reader thread policy media 1 2 3 4 5 6 7 8 9".split())
#: Elements that close an open one of these kinds below the given ancestors (fixed values of the HTML standard).
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)), "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",))}
SCOPE = frozenset("html body table td th caption button article section main div".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
TOKEN_LOOSE = re.compile(r"</?[a-zA-Z][^>]*$")
ATTRIBUTE = re.compile(r"""(?i)(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = re.compile(r"[\s ]+")
HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")


#: Elements whose own header is part of what they hold.
SECTIONS = frozenset("article main section".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WEAK = 0.25  # what characters that a class or id calls noise count for in density sums


class Node:
    __slots__ = ("name", "parent", "items", "dropped", "named", "kind", "at", "chars", "tags", "link_chars", "link_tags", "doubted", "density", "sum")

    def __init__(self, name: str, parent: Node | None, dropped: bool = False, kind: str = ""):
        self.name, self.parent, self.dropped, self.kind, self.at = name, parent, dropped, kind, 0
        self.named = False  # its class or id says noise
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = self.doubted = 0
        self.density = self.sum = 0.0


def named_noise(value: str) -> bool:
    """A token is noise as a whole word, or as a compound of noise words and words that only join them."""
    for token in value.lower().split():
        words = [w for w in re.split("[_-]+", token) if w]
        if any(w in NOISE for w in words) and all(w in NOISE or w in JOINING for w in words):
            return True
    return False


def noise(name: str, attributes: str, parent: Node) -> tuple[bool, bool, str]:
    """Whether an element is noise by itself, whether its class or id says so, and its class."""
    if name in DROPPED:
        node: Node | None = parent
        while name == "header" and node is not None and node.name not in SECTIONS:
            node = node.parent
        if name != "header" or node is None:
            return True, False, ""
    if not attributes or name in ("html", "body"):
        return False, False, ""
    named, kind = False, ""
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            named = named or named_noise(value)
            kind = value if key == "class" else kind
        if key == "role" and value.lower() in DROPPED_ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDDEN.search(value):
            return True, False, ""
    return False, named, kind


def tree(html: str) -> Node:
    """The page's elements and texts (character references still in); what is dropped has no items."""
    root = here = Node("html", None)
    at, n = 0, len(html)

    def close(names: tuple[str, ...], stop: frozenset | tuple[str, ...]) -> Node:
        node = here
        while node.parent is not None and node.name not in stop:
            if node.name in names:
                return node.parent
            node = node.parent
        return here

    while at < n:
        m = TOKEN.search(html, at)
        text = html[at : m.start() if m else n]
        if m is None:
            text = TOKEN_LOOSE.sub("", text)
        if text and not here.dropped:
            here.items.append(text)
        if m is None:
            break
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA[") and not here.dropped:
                here.items.append(m[0][9:-3].replace("&", "&amp;").replace("<", "&lt;"))
            continue
        name = name.lower()
        if m[1]:
            node = here
            while node.parent is not None and node.name != name:
                node = node.parent
            if node.parent is not None:
                here = node.parent
            elif name == "p" and not here.dropped:
                here.items.append(Node("p", here))
            continue
        if name in ("html", "body") or name == "head":
            if name == "head":
                here.items.append(node := Node("head", here, True))
                here = node
            elif name == "body":
                while here.parent is not None and here.name == "head":
                    here = here.parent
                if here is root:
                    here.items.append(node := Node("body", here))
                    here = node
            continue
        if here.name == "head" and name not in ("meta", "title", "link", "base", "script", "style", "noscript", "template"):
            here = here.parent
        if name in ENDS_P:
            here = close(("p",), SCOPE)
        if name in CLOSES:
            here = close(*CLOSES[name])
        attributes = m[3]
        own, named, kind = noise(name, attributes, here) if not here.dropped else (True, False, "")
        node = Node(name, here, own, kind)
        node.named = named
        if not here.dropped:
            here.items.append(node)
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            if not node.dropped:
                node.items.append(html[at : end.start() if end else n])
            at = end.end() if end else n
        elif name not in VOID:
            here = node
    return root


def measure(root: Node) -> tuple[Node, list[Node]]:
    """Fills in every node's figures, children first; the body (or root) and all nodes that count, in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        node.at = len(order)
        node.chars = node.tags = node.link_chars = node.link_tags = node.doubted = 0
        node.density = node.sum = 0.0
        order.append(node)
        stack.extend(x for x in reversed(node.items) if isinstance(x, Node))
    for node in reversed(order):
        for x in node.items:
            if isinstance(x, str):
                node.chars += len(x.strip())
            elif not x.dropped:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags + (x.name == "a")
        if node.name == "a":
            node.link_chars = node.chars
    body = next((x for x in order if x.name == "body"), root)
    ratio = body.link_chars / max(1, body.chars)
    inside: set[Node] = set()
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, ratio)
        if node.named or node.parent in inside:
            inside.add(node)
            node.doubted = node.chars
    for node in reversed(order):
        if node not in inside:
            node.doubted = sum(x.doubted for x in node.items if isinstance(x, Node) and not x.dropped)
        if node.parent is not None:
            node.parent.sum += node.density * (1 - (1 - WEAK) * node.doubted / max(1, node.chars))
    return body, order


def density(chars: int, tags: int, link_chars: int, link_tags: int, ratio: float) -> float:
    """Composite text density; ratio: the page's link characters of its characters."""
    if not chars:
        return 0.0
    other, tags, link_chars, link_tags = max(1, chars - link_chars), max(1, tags), max(1, link_chars), max(1, link_tags)
    base = math.log(chars / other * link_chars + ratio * chars + math.e)
    return chars / tags * math.log(max(1.0, chars / link_chars * tags / link_tags), base)


def above(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def densest(order: list[Node]) -> Node:
    """The node of the largest density sum; of equals the one with most text, then the innermost."""
    return max((x for x in order if x.sum), key=lambda x: (x.sum, x.chars, x.at), default=order[0])


def own_text(node: Node) -> int:
    """Characters outside links of the node's own text and paragraphs."""
    return sum(len(x.strip()) if isinstance(x, str) else x.chars - x.link_chars if x.name == "p" and not x.dropped else 0 for x in node.items)


def content(root: Node) -> tuple[set[Node], float]:
    """The subtrees that hold the article, and the threshold: the smallest density from the densest of them up to the body."""
    body, order = measure(root)
    best = densest(order)
    spared = set(above(best))
    if any(x.named for x in order):
        for node in order:
            if node.named and node not in spared:
                node.dropped = True
        body, order = measure(root)
        best = densest(order)
    for node in above(best):  # to the element that the text belongs to
        if node.name in ("article", "main"):
            best = node
            break
        if node in (body, root):
            best = node if own_text(node) > 0.1 * best.chars else best
            break
        if own_text(node):
            best = node
    if best is root:
        return {root}, root.density
    path = [x for x in above(best) if x.at >= body.at]
    threshold = min(x.density for x in path)
    chosen = {best}
    for x in best.parent.items if best is not body and best.parent is not None else ():
        if isinstance(x, Node) and not x.dropped and (x.name, x.kind) == (best.name, best.kind) and x.density >= threshold:
            chosen.add(x)
    title = [x for x in order if x.name == "h1" and 2 * x.link_chars <= x.chars]
    if not any(best in above(x) for x in title):
        chosen.update(x for x in title if x.at < best.at)
    for node in path[:-1]:  # a heading right before what holds the article
        before: Node | None = None
        for x in node.parent.items if node.parent is not None else ():
            if x is node:
                break
            before = x if isinstance(x, Node) and not x.dropped else None if isinstance(x, str) and x.strip() else before
        if before is not None and before.name in HEADINGS and 2 * before.link_chars <= before.chars:
            chosen.add(before)
    return chosen, threshold


def blocks(root: Node, chosen: set[Node], threshold: float) -> list[str]:
    """Texts of the blocks below the chosen nodes, in page order. Inside them, a block of links that is under the threshold is noise."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    stack: list[tuple[Node | str | None, bool]] = [(root, False)]
    while stack:
        x, inside = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if inside:
                line.append(x)
        elif not x.dropped:
            block = x.name in BLOCKS
            if inside and block and x.name != "p" and 2 * x.link_chars > x.chars and x.link_tags > 1 and x.density < threshold:
                continue
            inside = inside or x in chosen
            if block:
                flush()
                stack.append((None, inside))
            stack.extend((y, inside) for y in reversed(x.items))
    flush()
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = tree(html)
    return "\n".join(blocks(root, *content(root)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def make():
        def run(part: pa.RecordBatch) -> list:
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            return [part.column(0), part.column(1), texts, list(map(len, texts))]

        return run

    picked = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), pages[html_col].cast("string").alias("html"))
    return map_rows(picked, "id long, url string, text string, n_chars long", make, "html").withColumnRenamed("id", id_col)
