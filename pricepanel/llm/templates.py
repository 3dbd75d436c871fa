"""Main text of web pages: site templates are found by counting element subtrees per host.

Every page is parsed into a light element tree; each container's subtree gets
a hash of its tags and text, counted once per page and host in Spark (partial
counts first, so a hot host is no hot key).  Subtrees on many different pages
of their host are deleted first, whatever share of a big host those are and
whatever they are called.  What recurs too seldom to be counted goes by tag,
role or class name, and then what stands outside the article; each page says
how many parts each of the three took.  Paragraph-like elements inside the
article are never deleted for recurring; other subtrees inside it must recur
in different articles, and what holds an article is not counted, so copies of
an article or a page keep its text.

Defined results: a form that holds an article or the main heading is the page
itself and stays; a null page is empty and has the empty text; a null url
counts as one host; equal pages of a host count as one; tags may be missing,
unclosed or cut off anywhere.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import cut, ship
from pricepanel.llm.columns import text_slices

#: A subtree is a template when it is on at least so many different pages of its host,
#: or in so many different articles if it stands inside one.
MIN_PAGES = 5
#: Template keys that are sent to every task; more than that are joined by page.
BROADCAST_KEYS = 200_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|([^\s=/"'<>]+)""")
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

#: Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag of the values ends open elements of the key.
ENDS = {
    "p": BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
#: An element of the key is not ended from inside these.
LIMITS = {
    "li": {"ul", "ol", "menu"},
    "dt": {"dl"},
    "dd": {"dl"},
    "tr": {"table"},
    "td": {"table"},
    "th": {"table"},
    "option": {"select"},
}
_LIMITS = {tag: LIMITS.get(tag, BLOCK - {tag}) for tag in ENDS}
_ENDED_BY = {name: [tag for tag in ENDS if name in ENDS[tag]] for name in BLOCK | {"option"}}
#: Elements that are no part of an article's text.
DROPPED = (RAW | set(
    "head nav footer aside button select dialog menu svg math canvas audio video object map search datalist".split()
))
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: What makes a form more than a form.
_PAGE_PARTS = {"article", "main", "h1"}
#: Why an element goes.
BY_NAME, BY_COUNT = 1, 2
#: Words of class and id names that say the same.
NAMES = set(
    "nav navbar navigation menu footer sidebar sidenav aside ad ads advert adverts advertisement advertising "
    "adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup share sharing social comment comments respond replies reply disqus "
    "breadcrumb breadcrumbs related recommended widget pagination pager masthead skiplink".split()
)
#: Names that hold an article in spite of a word above.
CONTENT = {"article", "main"}
#: Elements with text of their own; inside an article they are not deleted for recurring.
PARAGRAPHS = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd td th tr figcaption caption tbody table ul ol dl".split())


class Element:
    __slots__ = ("tag", "children", "dropped", "content", "parent", "key", "holds")

    def __init__(self, tag: str, parent: Element | None, dropped: int = 0, content: bool = False):
        self.tag, self.parent = tag, parent
        self.children: list[Element | str] = []
        self.dropped, self.content = dropped, content
        self.key = 0
        #: Tags of _PAGE_PARTS below.
        self.holds: frozenset[str] = frozenset()


def _dropped(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    for name, value, flag in _ATTRIBUTE.findall(attributes):
        name = (name or flag).lower()
        value = value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id") and tag not in ("main", "body", "html"):
            if tag == "article":
                # Only a whole name counts here: "comment", but not "has-comments".
                if NAMES & set(value.lower().split()):
                    return True
            elif any(_is_chrome(token, in_article) for token in value.split()):
                return True
    return False


def _is_chrome(token: str, in_article: bool) -> bool:
    """Whether one class or id name speaks of a part that is no article text."""
    words = [w.lower() for w in _WORDS.findall(token)]
    if words[:1] and words[0] in ("has", "with", "no", "without"):
        return False
    if "header" in words and not in_article and not {"article", "post", "entry", "story"} & set(words):
        return True
    return not NAMES.isdisjoint(words)


def parse(page: str) -> Element:
    """The element tree of a page; script and style contents are left out."""
    root = node = Element("", None)
    at, articles = 0, 0
    # Open elements by tag, so that a tag without a counterpart costs no walk up the tree.
    count: dict[str, int] = {}

    def close(last: Element) -> None:
        nonlocal node, articles
        while True:
            articles -= node.content
            count[node.tag] -= 1
            done, node = node is last, node.parent
            if done:
                return

    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            break
        if token.start() > at:
            node.children.append(page[at : token.start()])
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            if count.get(name):
                top = node
                while top.tag != name:
                    top = top.parent
                close(top)
            continue
        for tag in _ENDED_BY.get(name, ()):
            if count.get(tag):
                top, limits = node, _LIMITS[tag]
                while top is not root and top.tag != tag and top.tag not in limits:
                    top = top.parent
                if top.tag == tag:
                    close(top)
        attributes = token[3]
        made = Element(name, node, BY_NAME * _dropped(name, attributes, articles > 0), name in CONTENT)
        node.children.append(made)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID and not attributes.endswith("/"):
            node = made
            articles += made.content
            count[name] = count.get(name, 0) + 1
    if at < len(page):
        node.children.append(page[at:])
    return root


def _hashed(root: Element, host: int) -> list[tuple[Element, bool]]:
    """Set ``key`` and ``holds`` of every element, children first; (element, whether it is inside an article)."""
    order: list[tuple[Element, bool]] = []
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        order.append((node, inside))
        inside = inside or node.content
        stack.extend((c, inside) for c in node.children if isinstance(c, Element))
    for node, _ in reversed(order):
        parts = [node.tag]
        for child in node.children:
            if isinstance(child, Element):
                parts.append(f"\x01{child.key}")
                if child.holds or child.tag in _PAGE_PARTS:
                    node.holds |= child.holds | (_PAGE_PARTS & {child.tag})
            elif text := " ".join(child.split()):
                parts.append(text)
        node.key = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"), host & (2**64 - 1))
        if node.tag == "form" and not node.holds:
            node.dropped = BY_NAME
    return order


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def _countable(node: Element, inside: bool) -> bool:
    """Containers and blocks, whatever they are called; not what holds an article, nor an article's paragraphs."""
    if node.tag not in BLOCK or node.tag in ("html", "body") or node.content:
        return False
    return node.holds.isdisjoint(CONTENT) and not (inside and node.tag in PARAGRAPHS)


def subtree_keys(page: str, host: int) -> list[tuple[int, int]]:
    """Keys of the subtrees to count, each with the key of the article, or else the page, that it stands in."""
    out: dict[tuple[int, int], None] = {}
    root = parse(page)
    order = _hashed(root, host)
    around: dict[int, int] = {id(root): root.key}
    for node, inside in order:
        if node is not root:
            around[id(node)] = node.key if node.content else around[id(node.parent)]
        if _countable(node, inside):
            out[_signed(node.key), _signed(around[id(node)])] = None
    return list(out)


def _roots(root: Element) -> list[Element]:
    """The articles of the page that are not inside dropped parts, else its main parts, else all of it."""
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.dropped:
                continue
            if node.tag == tag:
                found.append(node)
            else:
                stack.extend(c for c in reversed(node.children) if isinstance(c, Element))
        if found:
            return found
    return [root]


def _taken(root: Element, roots: list[Element]) -> tuple[int, int, int]:
    """Uppermost parts that go by count, by name, and for being outside ``roots``."""
    kept = {id(r) for r in roots}
    above = {id(root)}
    for node in roots:
        while node is not None and id(node) not in above:
            above.add(id(node))
            node = node.parent
    counts, stack = [0, 0, 0], [(root, root in roots)]
    while stack:
        node, inside = stack.pop()
        inside = inside or id(node) in kept
        if node.dropped:
            counts[0 if node.dropped == BY_COUNT else 1] += 1
        elif inside or id(node) in above:
            stack.extend((c, inside) for c in node.children if isinstance(c, Element))
        else:
            counts[2] += 1
    return counts[0], counts[1], counts[2]


def main_text(page: str, host: int, templates: set[int] | frozenset[int]) -> tuple[str, int, int, int]:
    """Blocks of the article in page order, one per line; parts that went by count, by name, and as outside it."""
    root = parse(page)
    order = _hashed(root, host)
    if templates:
        for node, inside in order:
            if _countable(node, inside) and _signed(node.key) in templates:
                node.dropped = BY_COUNT
    roots = _roots(root)
    blocks: list[str] = []
    current: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(current).split()):
            blocks.append(text)
        current.clear()

    stack: list = list(reversed(roots))
    while stack:
        node = stack.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            current.append(html.unescape(node))
        elif not node.dropped:
            if node.tag == "br" or node.tag in ("td", "th"):
                current.append(" ")
            block = node.tag in BLOCK and node.tag not in ("td", "th")
            if block:
                flush()
                stack.append(None)
            stack.extend(reversed(node.children))
    flush()
    return "\n".join(blocks), *_taken(root, roots)


def _host(url: str | None) -> str:
    found = re.search(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "", re.I)
    return found[1].lower() if found else ""


def _host_key(url: str | None) -> int:
    return _signed(xxhash.xxh64_intdigest(_host(url).encode()))


def _chosen(pages: DataFrame, html_col: str, url: str, id_col: str) -> DataFrame:
    return pages.selectExpr(
        f"cast(`{id_col}` as long) AS page_id", f"cast(`{url}` as string) AS url", f"`{html_col}` AS html"
    )


def _keys(pages: DataFrame) -> DataFrame:
    """(page_id, host, subtrees, places) of every page: keys of its subtrees and of what they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            hosts, subtrees, places = [], [], []
            for url, page in zip(part.column("url").to_pylist(), part.column("html").to_pylist()):
                host = _host_key(url)
                keys = subtree_keys(page or "", host)
                hosts.append(host)
                subtrees.append([k for k, _ in keys])
                places.append([p for _, p in keys])
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), pa.array(hosts, pa.int64()), pa.array(subtrees, many), pa.array(places, many)],
                names=["page_id", "host", "subtrees", "places"],
            )

    return pages.mapInArrow(run, "page_id long, host long, subtrees array<long>, places array<long>")


_TEXTS = (
    "page_id long, url string, text string, n_chars long, n_templates long, n_named long, n_outside long"
)


def _texts(pages: DataFrame, shared) -> DataFrame:
    """``shared``: a broadcast set of template keys, or None where each row has its own list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html"):
            own = None if shared is not None else part.column("templates").to_pylist()
            found = []
            for r, (url, page) in enumerate(zip(part.column("url").to_pylist(), part.column("html").to_pylist())):
                keys = shared.value if own is None else frozenset(own[r] or ())
                text, *taken = main_text(page or "", _host_key(url), keys)
                text = text.encode("utf-8", "replace").decode()
                found.append((text, len(text), *taken))
            texts, *counts = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    part.column("url"),
                    pa.array(texts, pa.string()),
                    *[pa.array(c, pa.int64()) for c in counts],
                ],
                names=["page_id", "url", "text", "n_chars", "n_templates", "n_named", "n_outside"],
            )

    return pages.mapInArrow(run, _TEXTS)


def template_keys(keys: DataFrame) -> DataFrame:
    """Keys of subtrees that recur across many pages of their host."""
    rows = keys.select("host", F.explode(F.arrays_zip("subtrees", "places")).alias("k"))
    return (
        rows.select("host", F.col("k.subtrees").alias("key"), "k.places")
        .distinct()
        .groupBy("host", "key")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= MIN_PAGES)
        .select("key")
        .distinct()
    )


def extract(
    pages: DataFrame, html_col: str = "html", url: str = "url", id_col: str = "page_id", broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, and the parts that each step took."""
    spark = pages.sparkSession
    ship(spark)
    chosen = _chosen(pages, html_col, url, id_col)
    keys = cut(_keys(chosen))
    templates = cut(template_keys(keys))
    if templates.count() <= broadcast_keys:
        found = frozenset(r["key"] for r in templates.toLocalIterator())
        return _texts(chosen, spark.sparkContext.broadcast(found))
    by_page = (
        keys.select("page_id", F.explode("subtrees").alias("key"))
        .join(templates, "key", "left_semi")
        .groupBy(F.col("page_id").alias("_page"))
        .agg(F.collect_set("key").alias("templates"))
    )
    joined = chosen.join(by_page, F.col("page_id").eqNullSafe(F.col("_page")), "left").drop("_page")
    return _texts(joined, None)
