"""Main text of web pages by tag-path ratios.

Each text node of a page has a path of tags from the root. For every path the text length and the
punctuation of its nodes are summed and divided by the number of nodes; the two ratios, smoothed over
the page's sequence of nodes and fused, are thresholded at a share of their weighted mean. Selected
paths show where the article is; all blocks of that part of the page are its text, but for the
kinds of elements that are never part of an article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racecast.llm.common import text_column

SMOOTHING = 1.0
SHARE = 0.3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""",
    re.S,
)
MARK = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
SPACE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、…]")

# Elements whose content is never text of an article; raw ones end only at their own end tag.
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg object annotation annotation-xml".split())
APART = frozenset(
    "nav aside footer form button select option input label dialog menu head canvas audio video map datalist".split()
)
# Elements inside a block: their tags don't end it, and they are no part of the path.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike"
    " strong sub sup time tt u var wbr br ruby rt rp bold nobr picture source"
    " math semantics mi mo mn ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover"
    " mmultiscripts mtable mtr mtd mstyle mpadded mphantom mfenced menclose merror annotation annotation-xml".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A new element of the first kind ends an open one of the second within the same container.
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
    "tbody": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tfoot tr td th", "table"),
}
SIBLINGS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in SIBLINGS.items()}
# Words of class, id and role values that name parts beside the article.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|advertorial|adslot|adbox|banner|sponsor|sponsored|"
    r"promo|promotion|promoted|promos|comment|comments|commentlist|discussion|disqus|replies|reply|respond|sidebar|"
    r"side|aside|menu|menubar|nav|navbar|navigation|breadcrumb|breadcrumbs|pagination|pager|header|masthead|topbar|"
    r"footer|foot|copyright|colophon|notice|notices|cookie|cookies|consent|gdpr|popup|modal|overlay|newsletter|subscribe|"
    r"subscription|signup|signin|login|share|sharing|social|related|recommended|recommendations|trending|widget|"
    r"widgets|toolbar|search|contentinfo|complementary|alert|disclaimer|legal|skip|paywall|tags|tagcloud)(?:$|[\s_-])",
    re.I,
)
OF_ARTICLE = re.compile(r"(?:[a-z]+[_-])?(?:header|masthead|head|tags|legal|alert|side|search)(?![a-z])", re.I)
ROLE_MAIN = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Node:
    """A block of text: its path, the elements around it, and whether it lies in a part set apart.

    ``holders`` says which elements of the page are an article or its main part.
    """

    __slots__ = ("path", "around", "parts", "apart", "holders", "linked", "length")

    def __init__(self, path: str, around: tuple[int, ...], apart: bool, holders: dict[int, str]):
        self.path, self.around, self.apart, self.holders = path, around, apart, holders
        self.parts: list[str] = []
        self.linked = self.length = 0


def beside(tag: str, rest: str, in_article: bool) -> bool:
    """Whether an element is of a kind that is never part of an article."""
    if tag in APART or (tag == "header" and not in_article):
        return True
    if not rest or tag in ("body", "html", "main", "article"):
        return False
    if HIDDEN.search(rest):
        return True
    names = [CAMEL.sub("-", m[1].strip("\"'")) for m in MARK.finditer(rest)]
    if in_article:  # an article's own header holds its title
        names = [OF_ARTICLE.sub(" ", n) for n in names]
    return any(BESIDE.search(n) for n in names)


def blocks(html: str) -> list[Node]:
    """The page's text nodes by block, in page order."""
    out: list[Node] = []
    stack: list[tuple[str, int, bool]] = []  # tag, number of the element, whether it is set apart
    path, links, articles, number = "", 0, 0, 0
    node: Node | None = None
    holders: dict[int, str] = {}
    low: str | None = None

    def add(text: str) -> None:
        nonlocal node
        if node is None:
            if not text.strip():
                return
            node = Node(path, tuple(n for _, n, _ in stack), bool(stack) and stack[-1][2], holders)
            out.append(node)
        node.parts.append(text)
        n = len(text) - text.count(" ")
        node.length += n
        if links:
            node.linked += n

    def pop(count: int) -> None:
        nonlocal path, articles, node
        for _ in range(count):
            articles -= stack.pop()[0] == "article"
        path = "/".join(t for t, _, _ in stack)
        node = None

    at = 0
    while True:
        found = TOKEN.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text:
            add(unescape(text) if "&" in text else text)
        if not found:
            return out
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag, rest = tag.lower(), found[3]
        if found[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                if stack and stack[-1][0] == tag:
                    pop(1)
                continue
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    pop(len(stack) - depth)
                    links = 0
                    break
            else:
                node = None
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                low = html.lower() if low is None else low
                end = low.find(f"</{tag}", at)
                at = len(html) if end < 0 else end
            continue
        if tag in INLINE:
            if tag == "br":
                if node is not None:
                    node.parts.append(" ")
            elif tag == "a":
                links += 1
            elif node is None and tag not in VOID and rest and (stack and not stack[-1][2]) and beside(tag, rest, True):
                number += 1
                stack.append((tag, number, True))
                path = "/".join(t for t, _, _ in stack)
            continue
        node = None
        if tag in PARAGRAPH_ENDS:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    pop(len(stack) - depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        if tag in SIBLINGS:
            ended, bounds = SIBLINGS[tag]
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in bounds:
                    break
                if stack[depth][0] in ended:
                    pop(len(stack) - depth)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                    depth = len(stack)
        if tag in VOID or rest.endswith("/") and tag not in PARAGRAPH_ENDS:
            continue
        number += 1
        apart = bool(stack) and stack[-1][2] or beside(tag, rest, articles > 0)
        stack.append((tag, number, apart))
        articles += tag == "article"
        if tag in ("article", "main") or rest and ROLE_MAIN.search(rest):
            holders[number] = "article" if tag == "article" else "main"
        path = "/".join(t for t, _, _ in stack)
        links = 0


def smoothed(values: np.ndarray, width: float) -> np.ndarray:
    """Gaussian smoothing over neighbours, which at the ends are what there is."""
    reach = np.arange(-int(3 * width), int(3 * width) + 1)
    kernel = np.exp(-(reach**2) / (2 * width**2))
    if len(values) < 2:
        return values
    padded = np.pad(values, int(3 * width), mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def scores(nodes: list[Node]) -> np.ndarray:
    """Fused tag-path ratio of each node, smoothed over the page."""
    paths = {p: k for k, p in enumerate(dict.fromkeys(n.path for n in nodes))}
    of = np.array([paths[n.path] for n in nodes])
    length = np.array([n.length - n.linked for n in nodes], float)
    marks = np.array([sum(len(PUNCTUATION.findall(p)) for p in n.parts) for n in nodes], float)
    count = np.bincount(of)
    text = (np.bincount(of, length) / count)[of]
    punctuation = (np.bincount(of, marks) / count)[of]
    return smoothed(text, SMOOTHING) * (1 + smoothed(punctuation, SMOOTHING))


def only_links(node: Node) -> bool:
    return node.linked >= 0.8 * node.length


def whole(nodes: list[Node], inner: int, around: tuple[int, ...], path: str) -> int:
    """The element of the article that ``inner`` is a part of; 0 is the page.

    Without an <article> or main part around it, what stands beside an element is of the same article
    as long as there are no parts set apart, unless with a title, and no blocks of links only.
    """
    holders, place = nodes[0].holders, around.index(inner)
    for kind in ("article", "main"):
        for element in around[: place + 1]:
            if holders.get(element) == kind:
                return element
    tags = path.split("/")
    for step in range(place - 1, -2, -1):
        parent = around[step] if step >= 0 else 0
        others = [n for n in nodes if inner not in n.around and (not parent or parent in n.around)]
        plain = [n for n in others if not n.apart]
        outer = step < 0 or tags[step] in ("body", "html")
        titled = not outer and any("h1" in n.path.split("/") for n in plain)
        if len(plain) < len(others) and not titled or any(only_links(n) for n in plain):
            break
        inner = parent
    return inner


def content(nodes: list[Node]) -> list[Node]:
    """The nodes of the article.

    Nodes set apart are left out first, so that a long notice can't outweigh a short article. The
    paths whose mean score reaches SHARE of the text-weighted mean are content paths. The article is
    the element that the smallest one with nearly all text of content paths is a part of (see
    ``whole``), and all its nodes belong to it.
    """
    every = [n for n in nodes if n.length]
    nodes = [n for n in every if not n.apart]
    if not nodes:
        return []
    score = scores(nodes)
    paths = {p: k for k, p in enumerate(dict.fromkeys(n.path for n in nodes))}
    of = np.array([paths[n.path] for n in nodes])
    weight = np.array([n.length - n.linked for n in nodes], float)
    if not weight.sum():
        return []
    mean = float((score * weight).sum() / weight.sum())
    chosen = (np.bincount(of, score) / np.bincount(of) >= SHARE * mean)[of]
    total = weight[chosen].sum()
    inside: dict[int, float] = {}
    depth: dict[int, int] = {0: 0}
    for n, w, c in zip(nodes, weight, chosen):
        if c:
            for d, element in enumerate(n.around, 1):
                inside[element] = inside.get(element, 0.0) + w
                depth[element] = d
    article = max((e for e, w in inside.items() if w >= 0.95 * total), key=lambda e: depth[e], default=0)
    if article:
        only = sum(c for n, c in zip(nodes, chosen) if article in n.around)
        if only == 1:  # a single block: what stands beside it under its parent is of the same article
            around = next(n.around for n, c in zip(nodes, chosen) if c and article in n.around)
            place = around.index(article)
            article = around[place - 1] if place else 0
    if article:
        inmost = next(n for n in nodes if article in n.around)
        article = whole(every, article, inmost.around, inmost.path)
        if article in inmost.holders:
            return [n for n in nodes if article in n.around]
    found = [(n, c) for n, c in zip(nodes, chosen) if not article or article in n.around]
    # Blocks of links only, where the path is no content path, are lists of links.
    return [n for n, c in found if c or not only_links(n)]


def main_text(html: str) -> str:
    """The article's blocks, white space as single spaces, joined by empty lines; empty if none."""
    texts = (SPACE.sub(" ", "".join(n.parts)).strip() for n in content(blocks(html)))
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns of every row with ``text`` and ``n_chars`` of its main text.

    Whole pages are read, each by itself; NULL and empty html give an empty text. Repeated rows give
    the same text, an empty table an empty one. Other columns are not read.
    """
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [main_text(h) for h in text_column(part, "_html")]
                columns = [part.column(c) for c in names]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "text", "n_chars"])

    chosen = pages.select(*(F.col(c) for c in names), F.col(html).alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_html")
    return chosen.mapInArrow(run, f"{schema}, text string, n_chars long")
