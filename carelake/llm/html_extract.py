"""Main text of web pages by the line-block distribution.

Markup is stripped into lines, one per block element, in page order, each with the element it stands in. Lines of
menus, adverts, notices, forms, comments and the like count as empty. Text lengths are summed over windows of
``WINDOW`` lines; a surge is a window with text after one without, a dive the next window
without text. The container is the smallest element around all stretches with a heavy window; all its text is kept, and
the page's first-level headings. An article's mark is a weight: marked text is taken unless the container of the
heavy text outside holds more.

What is boilerplate is told by tags, roles and names. A name is a whole class or id whose parts (at hyphens) are all
boilerplate words or neutral ones (``cookie-notice``, ``site-footer``; not ``search-tree`` or ``entry-header``). Names of
paragraphs and other text elements only tell adverts and notices, and headers within an article that hold a heading belong to it.

Cases: null or empty html gives an empty text. Repeated rows and null ids give one result each;
an empty table gives an empty result; other columns are not read. Unclosed tags end with
their parent or the page; a page whose quotes don't close is read with tags ending at the next ``>``. Time is linear in
the page's length. All work stays in the scan's task, one page at a time.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: A line with more of its text in links than this is a menu line.
LINK_SHARE = 0.7
#: Outside a marked article, a stretch must hold so many characters in one window.
SURGE_CHARS = 80

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")  # not the end of a value, as in href=/
_OPENS = re.compile(r"<[!?/a-zA-Z]")
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?![\w-])", re.I)
#: Words of boilerplate names: of adverts and notices, of everything else, and neutral words beside them.
_ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion cookie cookies "
    "consent notice notices alert alerts popup modal newsletter subscribe".split())
_NAMES = _ADVERTS | frozenset(
    "banner sidebar menu menus nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments commentlist "
    "disqus feedback reactions discussion reply replies respond responses related share sharing social widget widgets toolbar "
    "pagination pager login signup search".split())
_NEUTRAL = frozenset(
    "site page main top bottom left right box bar list lists link links block container wrapper inner outer area section "
    "panel slot unit item items button buttons icons form reader readers user global primary secondary widget group row".split())
_HEADERS = frozenset("header masthead banner".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
_RAW = frozenset("script style textarea title template noscript iframe svg math select object".split())
_DROP = frozenset("nav footer aside form dialog menu button fieldset head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split())
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre td th dd dt figcaption summary address".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACED = frozenset("br td th img".split())
_NEVER = frozenset("html body article main".split())
#: How an element stands: text, boilerplate, boilerplate unless it holds a heading of the article.
KEEP, GONE, HEADER = 0, 1, 2


def _named(value: str, words: frozenset) -> set[str]:
    """The boilerplate words of a class or id attribute."""
    found: set[str] = set()
    for name in value.lower().split():
        parts = [x for x in re.split(r"[-_]+", name) if x]
        if all(x in words or x in _NEUTRAL for x in parts):
            found.update(x for x in parts if x in words)
    return found


def _standing(tag: str, attrs: str, in_article: bool) -> int:
    if tag in _DROP:
        return GONE
    if tag == "header":
        return KEEP if in_article else GONE
    if not attrs:
        return KEEP
    standing = KEEP
    for m in _ATTR.finditer(attrs):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id"):
            if tag not in _NEVER or tag == "article" and in_article:
                words = _named(value, _ADVERTS if tag in _TEXT else _NAMES)
                if words - _HEADERS or words and not in_article:
                    return GONE
                standing = HEADER if words else standing
        elif name == "role":
            if value.lower() in _ROLES and tag not in _NEVER:
                return GONE
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            if tag not in ("html", "body"):
                return GONE
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return GONE
    return standing


@dataclass
class Node:
    """An element: where it stands, and the range of the lines in it."""

    tag: str
    parent: int
    standing: int
    article: bool
    first: int
    last: int = 0
    heading: bool = False


def parse(html: str) -> tuple[list[Node], list[tuple[str, float, int]]]:
    """Elements in page order, and lines: (text, share of it in links, element). One pass."""
    nodes = [Node("", -1, KEEP, False, 0)]
    lines: list[tuple[str, float, int]] = []
    stack = [0]
    places: defaultdict[str, list[int]] = defaultdict(list)  # tag -> places on the stack
    blocks: list[int] = []  # places of block elements on the stack
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(htmllib.unescape("".join(parts)).split())
        if text:
            lines.append((text, min(1.0, linked / max(1, len(text))), stack[-1]))
        parts.clear()
        linked = 0

    def add(s: str) -> None:
        nonlocal linked
        parts.append(s)
        if places["a"]:
            linked += len(s)

    def pop_to(place: int) -> None:
        """Close the elements from a place of the stack on."""
        while len(stack) > place:
            node = nodes[stack.pop()]
            node.last = len(lines)
            places[node.tag].pop()
            if node.tag in _BLOCK:
                blocks.pop()

    at, n, pattern = 0, len(html), _TAG
    last_end = html.rfind(">")
    while at < n:
        opens = _OPENS.search(html, at)
        i = opens.start() if opens else n
        if i > at:
            add(html[at:i])
        if html.startswith("<!--", i):
            end = html.find("-->", i + 4)
            at = end + 3 if end >= 0 else n
            continue
        if i > last_end:  # no tag ends any more
            add(html[i:])
            break
        m = pattern.match(html, i)
        if m is None and html[i + 1] not in "!?":
            if pattern is _TAG and _PLAIN_TAG.match(html, i):  # a quote that never closes
                pattern = _PLAIN_TAG
                m = pattern.match(html, i)
            else:
                at = i + 2  # not a tag
                add(html[i:at])
                continue
        if m is None:
            at = html.find(">", i) + 1
            continue
        at = m.end()
        tag, attrs = m.group(2).lower(), m.group(3)
        if m.group(1):  # closing
            if places[tag]:
                place = places[tag][-1]
                if tag in _BLOCK or tag != "a" and blocks and blocks[-1] >= place:
                    flush()
                pop_to(place)
            continue
        closed = _CLOSED.search(attrs) is not None
        if tag in _RAW and not closed:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if tag in _BLOCK:
            flush()
            for close in ("p",) if tag not in ("li", "dt", "dd", "tr") else ("p", tag):
                # an open paragraph or item ends here, unless a container lies between
                if places[close] and blocks[-1] <= places[close][-1]:
                    pop_to(places[close][-1])
        elif tag in _SPACED:
            parts.append(" ")
        if tag in _VOID or closed:
            continue
        up = nodes[stack[-1]]
        standing = _standing(tag, attrs, up.article)
        if standing != KEEP:
            flush()
        node = Node(tag, stack[-1], standing, up.article or tag in ("article", "main") and standing == KEEP, len(lines))
        if tag in _HEADING:
            k = stack[-1]
            while k >= 0 and not nodes[k].heading:
                nodes[k].heading = True
                k = nodes[k].parent
        places[tag].append(len(stack))
        if tag in _BLOCK:
            blocks.append(len(stack))
        stack.append(len(nodes))
        nodes.append(node)
    flush()
    pop_to(1)
    nodes[0].last = len(lines)
    return nodes, lines


def line_blocks(lengths: list[int], window: int = WINDOW) -> list[int]:
    """Sum of the lengths of each line and the ``window - 1`` lines after it."""
    total, out = sum(lengths[:window]), []
    for i, x in enumerate(lengths):
        out.append(total)
        total += (lengths[i + window] if i + window < len(lengths) else 0) - x
    return out


def stretches(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, dive) line ranges: from the first line with text to before ``window`` empty ones."""
    blocks, out, start = line_blocks(lengths, window), [], None
    for i, b in enumerate(blocks):
        if start is None and lengths[i] > 0:
            start = i
        elif start is not None and b == 0:
            out.append((start, i))
            start = None
    if start is not None:
        out.append((start, len(lengths)))
    return out


def container(nodes: list[Node], at: list[int], first: int, last: int) -> Node:
    """The smallest element that holds the lines ``first`` to ``last``, not counting text elements."""
    k = at[first]
    while k and (nodes[k].last <= last or nodes[k].tag not in _BLOCK or nodes[k].tag in _TEXT or nodes[k].tag == "li"):
        k = nodes[k].parent
    return nodes[k]


def choose(nodes: list[Node], at: list[int], lengths: list[int], inside: list[bool]) -> list[int]:
    """The lines that are text. ``at``: each line's element."""
    outside = [0 if m else x for x, m in zip(lengths, inside, strict=True)]
    blocks = line_blocks(outside)
    heavy = [i for a, b in stretches(outside) if max(blocks[a:b]) >= SURGE_CHARS
             for i in range(a, b) if outside[i] * WINDOW >= SURGE_CHARS]
    body = container(nodes, at, heavy[0], heavy[-1]) if heavy else None
    marked = sum(lengths) - sum(outside)
    if marked and (body is None or marked >= sum(outside[body.first:body.last])):
        return [i for i, x in enumerate(lengths) if x and inside[i]]
    if body is None:
        return [i for i, x in enumerate(lengths) if x]
    return [i for i, x in enumerate(lengths) if x and (body.first <= i < body.last or nodes[at[i]].tag == "h1")]


def extract_text(html: str | None) -> str:
    nodes, lines = parse(html or "")
    gone: list[bool] = []
    for x in nodes:  # parents come first
        gone.append(x.parent >= 0 and gone[x.parent] or x.standing == GONE or x.standing == HEADER and not x.heading)
    at = [x[2] for x in lines]
    inside = [nodes[k].article for k in at]
    lengths = [0 if gone[k] or share > LINK_SHARE and not m else len(text)
               for (text, share, k), m in zip(lines, inside, strict=True)]
    return "\n".join(lines[i][0] for i in choose(nodes, at, lengths, inside))


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
