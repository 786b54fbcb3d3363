"""Main-text extraction by tag-path ratios.

A page is read as a sequence of text nodes, each with its root-to-leaf tag
path (tag names with their class and id). Per path the text length, the
punctuation and the number of nodes are summed; the ratios text per node and
punctuation per node are smoothed over the paths in page order (Gaussian), and
fused by their product weighted with the share of characters outside links.
Paths whose fused ratio reaches the threshold (:func:`content_nodes`) are
content, as are the headings before the first of them with the text that
follows them, back to the last link. The main element is the smallest one that
holds all content (or the ``article`` or ``main`` element around it); its text
without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and comments is the result. Class, id and role names drop an element
where they say what it is: the last part of a name counts as its head, so a
``share-price`` is a price. Names that may stand for either (``WEAK``: tags,
share, reviews, ...) only support a low ratio: such an element in the main one stays
if most of its characters lie on content paths.

Defined results: null, empty or text-free pages give an empty text; broken
markup (unclosed or stray tags, tags inside scripts, comments without an end)
is read as browsers do as far as nesting matters, a tag that never ends is text; reading takes time
linear in the page, however deep or broken it is; repeated rows are extracted
each; other columns play no part.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import pieces

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
DROPPED = frozenset(
    "script style noscript template iframe object embed svg canvas audio video head title nav header footer aside menu "
    "form button select option textarea input fieldset legend dialog".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body"}
SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div main body html td th blockquote".split())
# Parts of class, id and role names. SIDE marks what is not the
# article, ALWAYS even beside a name of MAIN; MODIFIERS start names that speak
# of another element. AMBIGUOUS names mark one only at the end of a name or before a
# word of HEADS; alone, those of WEAK leave the choice to the ratios.
SIDE = re.compile(
    r"(?:adv|banner|promo\w*|nav\w*|menu\w*|sidebar\w*|side|foot|footer\w*|header\w*|masthead|consent|notices?|notification\w*|alerts?|overlay|"
    r"signup|login|subscri\w*|reply|replies|respond|responses?|reviews?|discussion|feedback|share|sharing|social\w*|related|recommend\w*|"
    r"widgets?|toolbar|pager|skip|legal|copyright|disclaimer|hidden|contentinfo|complementary|search\w*|teasers?|tags|byline)"
)
ALWAYS = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|breadcrumbs?|cookies?|gdpr|popups?|modal|newsletter|comments?|commentlist|commentary|disqus\w*|pagination|navigation|navbar)"
)
MAIN = re.compile(r"(?:article\w*|content|main|posts?|entry|story|body|text)")
AMBIGUOUS = re.compile(r"(?:share|sharing|hidden|search\w*|tags|reviews?|related|recommend\w*|legal|skip|side|feedback|teasers?|byline)")
WEAK = re.compile(r"(?:share|sharing|tags|reviews?|related|recommend\w*|legal|skip|feedback|teasers?|byline)")
HEADS = frozenset(
    "area bar block box button buttons container content count form icon icons inner item items link links list "
    "main outer panel post posts row section story stories text title widget wrap wrapper articles".split()
)
MODIFIERS = frozenset("has with no without is not js".split())
SMOOTH = 1.0
THRESHOLD = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
INNER = HEADINGS | {"p", "li", "td", "tr", "blockquote"}
_COMMENT_END = re.compile(r"--!?>")
_OPEN = re.compile(r"</?([A-Za-z][^\s/>]*)")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LONG_REFERENCE = re.compile(r"&#(?:([xX])0*+([0-9a-fA-F]{9,})|0*+([0-9]{9,}));?")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"\s+")
_PUNCT = re.compile(r"[.,;:!?。，、；：！？…]")


def side_kind(names: str) -> str:
    """What class, id and role names say of an element: "side" (besides the
    article), "weak" (perhaps) or nothing."""
    side = main = weak = False
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", names).lower().split():
        parts = [p for p in re.split(r"[-_:.]+", name) if p]
        if not parts or parts[0] in MODIFIERS:
            continue
        if any(ALWAYS.fullmatch(p) for p in parts):
            return "side"
        if len(parts) == 1 and WEAK.fullmatch(name):
            weak = True
        elif any(
            SIDE.fullmatch(p) and (not AMBIGUOUS.fullmatch(p) or all(x in HEADS or SIDE.fullmatch(x) for x in parts[i + 1 :]))
            for i, p in enumerate(parts)
        ):
            side = True
        elif any(MAIN.fullmatch(p) for p in parts):
            main = True
    return "" if main else "side" if side else "weak" if weak else ""


def is_side(names: str) -> bool:
    """Whether the names alone mark something besides the article."""
    return side_kind(names) == "side"


class Node:
    """An element: its parent, depth, tag, path number (elements of one
    root-to-leaf path share it), whether it is outside the article, in a link
    or in a heading, and the outermost element of a weak name around it."""

    __slots__ = ("depth", "dropped", "heading", "link", "parent", "path", "tag", "weak")

    def __init__(self, tag: str, parent: Node | None, attrs: str = "", paths: dict[tuple[int, str, str], int] | None = None):
        self.tag, self.parent = tag, parent
        mark, aside, kind = "", tag in DROPPED, ""
        if attrs and attrs != "/":
            a = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
            mark = " ".join(x for x in (a.get("class", ""), a.get("id", "")) if x)
            said = " ".join(x for x in (mark, a.get("role", "")) if x)
            if said and tag not in ("html", "body", "main"):
                kind = side_kind(said)
            style = a.get("style", "").replace(" ", "").lower()
            if kind == "side" or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
                aside = True
        paths = {} if paths is None else paths
        self.path = paths.setdefault((parent.path if parent else -1, tag, mark), len(paths))
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or bool(parent and parent.link)
        self.heading = tag in HEADINGS or bool(parent and parent.heading)
        self.dropped = aside or bool(parent and parent.dropped)
        self.weak: Node | None = parent.weak if parent and parent.weak else self if kind == "weak" else None


def _tag_ends(page: str):
    """A function from a place after a tag's name to whether the tag ends,
    that is whether a ``>`` outside closed quotes follows."""
    marks = [m.start() for m in re.finditer("[>\"']", page)]
    ends = [False] * (len(marks) + 1)
    after: dict[str, int] = {}  # the next mark of a kind
    for i in range(len(marks) - 1, -1, -1):
        c = page[marks[i]]
        ends[i] = c == ">" or (c in after and ends[after[c] + 1])
        after[c] = i
    return lambda at: ends[bisect_left(marks, at)]


def _tags(page: str):
    """(text before, tag match or None) in page order; a comment, a
    declaration or the page's end gives None."""
    at, seen, n, last, ends = 0, 0, len(page), page.rfind(">"), None
    while True:
        lt = page.find("<", seen)
        if lt < 0:
            break
        if page.startswith("<!--", lt):
            end = _COMMENT_END.search(page, lt + 4)
            yield page[at:lt], None
            at = seen = end.end() if end else n
            continue
        if lt > last:
            break
        if page[lt + 1 : lt + 2] in ("!", "?") or (page[lt + 1 : lt + 2] == "/" and not page[lt + 2 : lt + 3].isalpha()):
            yield page[at:lt], None
            at = seen = page.index(">", lt) + 1
            continue
        name = _OPEN.match(page, lt)
        if not name or (ends and not ends(name.end())):
            seen = name.end() if name else lt + 1
            continue
        tag = _TAG.match(page, lt)
        if not tag:
            ends = ends or _tag_ends(page)
            seen = lt + 1
            continue
        at = seen = max(tag.end(), (yield page[at:lt], tag) or 0)
    yield page[at:], None


def read(page: str) -> list[tuple[Node, str | None]]:
    """(element, text) in page order; text None marks the edge of a block."""
    paths: dict[tuple[int, str, str], int] = {}
    root = Node("html", None, "", paths)
    stack = [root]
    held: Counter[str] = Counter()  # open elements by tag
    out: list[tuple[Node, str | None]] = []
    n = len(page)

    def cut(i: int) -> None:
        held.subtract(x.tag for x in stack[i:])
        del stack[i:]

    def close(tags: set[str] | frozenset[str], within: frozenset[str]) -> None:
        if not any(held[t] > 0 for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                cut(i)
                return
            if stack[i].tag in within:
                return

    found = _tags(page)
    skip = None
    while True:
        try:
            before, m = found.send(skip)
        except StopIteration:
            break
        skip = None
        if before:
            out.append((stack[-1], before))
        if m is None:
            continue
        tag, attrs = m[2].lower(), m[3]
        if tag in BLOCKS:
            out.append((stack[-1], None))
        if m[1]:
            if held[tag] > 0:
                close({tag}, frozenset({"td", "th", "article", "main", "table"}) if tag not in BLOCKS else frozenset())
            continue
        if tag in ("html", "body"):
            if tag == "body":
                cut(1)
                stack.append(Node("body", root, attrs, paths))
                held["body"] += 1
            continue
        if tag in CLOSES_P:
            close({"p"}, SCOPE - {"p"})
        if tag in SAME:
            close(SAME[tag], frozenset({"ul", "ol", "dl", "table", "select"}) if tag != "option" else frozenset({"select"}))
        if tag in VOID:
            continue
        node = Node(tag, stack[-1], attrs, paths)
        if tag in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{tag}\b", re.I).search(page, m.end())
            close_at = page.find(">", end.end()) if end else -1
            if tag in ("textarea", "title"):
                out.append((node, page[m.end() : end.start() if close_at >= 0 else n]))
            skip = close_at + 1 if close_at >= 0 else n
            continue
        stack.append(node)
        held[tag] += 1
    return out


def decode(text: str) -> str:
    """Character references decoded; one beyond all code points is U+FFFD."""
    return html.unescape(_LONG_REFERENCE.sub("\ufffd", text)) if "&" in text else text


def _gauss(x: np.ndarray) -> np.ndarray:
    k = np.exp(-0.5 * (np.arange(-2, 3) / SMOOTH) ** 2)
    weight = np.convolve(np.ones(len(x)), k)[2:-2]
    return np.convolve(x, k)[2:-2] / weight


def content_nodes(nodes: list[tuple[Node, str]]) -> list[bool]:
    """Which text nodes lie on content paths.

    Per path (in page order): text per node and punctuation per node, each
    smoothed; their product, weighted by the share of text outside links and
    by the punctuation's spread over the path's nodes, is the fused ratio. The
    threshold is ``THRESHOLD`` standard deviations of the fused ratios, and
    never above the largest of them.
    """
    order: dict[int, int] = {}
    for node, _ in nodes:
        order.setdefault(node.path, len(order))
    k = len(order)
    length, punct, number, linked, squares = (np.zeros(k) for _ in range(5))
    for node, text in nodes:
        i, c, p = order[node.path], len(text), len(_PUNCT.findall(text))
        length[i] += c
        punct[i] += p
        squares[i] += c * c
        number[i] += 1
        linked[i] += c * node.link
    spread = np.sqrt(np.maximum(0, squares / number - (length / number) ** 2))
    text_ratio, punct_ratio = _gauss(length / number), _gauss((punct + 1) / number)
    fused = text_ratio * punct_ratio * (1 - linked / np.maximum(length, 1)) * (1 + np.log1p(spread))
    limit = min(THRESHOLD * float(fused.std()), 0.99 * float(fused.max()))
    good = fused >= limit if fused.max() > 0 else np.zeros(k, dtype=bool)
    return [bool(good[order[node.path]]) for node, _ in nodes]


def with_headings(nodes: list[tuple[Node, str]], good: list[bool]) -> list[bool]:
    """``good`` and the headings before the first content, with the text from
    there on, as far as no link comes between."""
    first = start = next((i for i, ok in enumerate(good) if ok), 0)
    for i in range(first - 1, -1, -1):
        if nodes[i][0].link:
            break
        if nodes[i][0].heading:
            start = i
    return [ok or start <= i < first for i, ok in enumerate(good)]


def main_element(nodes: list[tuple[Node, str]], good: list[bool]) -> Node | None:
    """The smallest block that holds all content nodes, or the outermost
    article or main element around it."""
    shared: Node | None = None
    seen: set[int] = set()  # elements that hold an earlier content node
    for (node, _), ok in zip(nodes, good, strict=True):
        if not ok:
            continue
        x: Node | None = node
        while x is not None and id(x) not in seen:
            seen.add(id(x))
            x = x.parent
        if shared is None:
            shared = node
        elif x is not None and x.depth < shared.depth:
            shared = x
    if shared is None:
        return None
    named, x = None, shared
    while x is not None:
        named, x = (x if x.tag in ("article", "main") else named), x.parent
    if named is not None:
        return named
    while shared.parent is not None and (shared.tag not in BLOCKS or shared.tag in INNER):
        shared = shared.parent
    return shared


def extract(page: str | None) -> str:
    items = [(node, text if text is None else decode(text)) for node, text in read(page or "") if text is None or not node.dropped]
    nodes = [(node, _SPACE.sub(" ", text)) for node, text in items if text and not text.isspace()]
    sure = [x for x in nodes if x[0].weak is None] or nodes
    if not sure:
        return ""
    main = main_element(sure, with_headings(sure, content_nodes(sure)))
    if main is None:
        return ""
    balance: Counter[int] = Counter()  # characters on content paths less others, by weak element
    if len(sure) < len(nodes):
        for (node, text), ok in zip(nodes, content_nodes(nodes), strict=True):
            if node.weak is not None:
                balance[id(node.weak)] += len(text) if ok else -len(text)
    inside: dict[int, bool] = {id(main): True}

    def within(node: Node) -> bool:
        way = []
        x: Node | None = node
        while x is not None and id(x) not in inside:
            way.append(id(x))
            x = x.parent
        got = x is not None and inside[id(x)]
        inside.update(dict.fromkeys(way, got))
        return got

    def stays(node: Node) -> bool:
        return within(node) and (node.weak is None or sure is nodes or balance[id(node.weak)] > 0)

    return _SPACE.sub(" ", "".join(" " if text is None else text for node, text in items if text is None or stays(node))).strip()


def _run(batches):
    for batch in batches:
        for part in pieces(batch, 64):
            texts = [extract(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(body).cast("string").alias("html"))
    return own.mapInArrow(_run, "page_id long, url string, text string, n_chars long")
