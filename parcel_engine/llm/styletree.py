"""HTML extraction by a site style tree.

Pages of one host are merged into a tree of style nodes: a node is the path of tags and classes
that leads to it. A node's importance comes from what its pages have there, with m pages:

* presentation: the entropy, to the base m, of the distribution of the child tags it appears with;
* content: one minus the mean entropy, to the base m, of its blocks of text. A block that n of the
  m pages share has the entropy log(n) / log(m): 0 if it is one page's own, 1 if all have it.

``PRESENTATION`` of the first and the rest of the second make the importance, of all pages of the
host, also of those that mark their article. Nodes that one or two pages have cannot be compared
and have ``NEUTRAL``. Markup only shifts it, page by page: listed tags, roles and class or id names
lower it by ``MARKED``, names with a listed word among others by ``HINTED``; what ``article`` or
``main`` hold gains ``INSIDE``, and in a page that has them text elsewhere loses ``OUTSIDE``. A node
below ``IMPORTANCE`` is cut from the page, with its branch. Names do not lower a node that holds an
article, or most of the text of a page without one. Hidden elements are never read.

Defined cases: null and empty html give an empty text; unclosed and stray tags are read as a
browser would, roughly; an unclosed comment, script or style runs to the end; nesting of any depth
takes memory in proportion to the page; pages of a host that say the same count once; a null url or one
without a host belongs to the host "". Null ids and repeated pages return one row each. Columns other
than page_id, url and html are ignored and do not return.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import staged

PRESENTATION = 0.1
IMPORTANCE = 0.4
NEUTRAL = 0.8
#: What markup takes from the importance of a node, or adds to it.
MARKED = -0.7
HINTED = -0.5
INSIDE = 0.2
OUTSIDE = -0.45
#: Pages that must have a node before it is compared.
LEAST_PAGES = 3

# Kinds of markup.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "math", "xmp", "noembed", "noframes"}
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul br caption".split()
)
CLOSES_P = BLOCK - {"br", "body", "html", "head", "option", "optgroup", "legend", "caption"}
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
NOISE_TAGS = set("nav header footer aside form button select dialog menu search object audio video canvas".split()) | RAW
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer comment comments disqus replies respond share sharing social related recommended recommendations "
    "pagination pager toolbar login signup masthead topbar hidden".split()
)
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}

#: A name that starts with one of these speaks of something else on the page.
MODIFIERS = set("has no not with without category tag".split())
#: Elements that may wrap whole pages, so that they count as names do.
WRAPPERS = {"form"}

_TAG = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@dataclass(eq=False)
class Node:
    tag: str
    path: int  #: hash of the tags and classes that lead here
    above: Node | None = None
    hidden: bool = False  #: or within a hidden node
    marked: float = 0.0  #: what its own markup takes from its importance
    by_name: bool = False  #: its mark is one of its names, not of its tag or role
    outcast: bool = False  #: it or a node above is marked, by more than a hint
    aside: bool = False  #: it or a node above is marked by tag or role
    holds: bool = False  #: it has an article in it, or is one
    chars: int = 0  #: of text in it that is neither hidden nor aside
    main: bool = False
    shift: float = 0.0  #: what markup adds to its importance
    near: Node | None = None  #: itself if it is a block or marked, else the next such node above
    clear: bool = True  #: neither it nor such a node above is marked
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    #: (the node it stands in, text)
    blocks: list[tuple[Node, str]] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)
    #: all nodes, those above first
    opened: list[Node] = field(default_factory=list)
    has_main: bool = False


def _kind(tag: str, attributes: str) -> tuple[str, bool, float, bool]:
    """Classes of an element, whether it is hidden, how its markup lowers it, and whether by name."""
    hidden, marked, named, classes = False, MARKED if tag in NOISE_TAGS else 0.0, 0.0, ""
    if not attributes.strip(" /\n\t"):
        return classes, hidden, marked, tag in WRAPPERS
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            if name == "class":
                classes = " ".join(sorted(value.split()))
            if tag not in ("html", "body", "article", "main"):
                for one in value.split():
                    parts = [w.lower() for w in _WORD.findall(one)]
                    if one.lower() in NOISE_WORDS:
                        named = MARKED
                    elif not NOISE_WORDS.isdisjoint(parts) and parts[0] not in MODIFIERS:
                        named = min(named, HINTED)
        elif name == "role":
            if value.strip().lower() in NOISE_ROLES:
                marked = MARKED
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in re.sub(r"\s", "", value.lower())
    by_name = not marked or tag in WRAPPERS
    return classes, hidden, min(marked, named), by_name


def _settle(page: Page) -> None:
    """Give each node its shift, now that it is known what it holds."""
    total = 0
    for node, text in page.blocks:
        if not node.hidden and not node.aside:
            total += len(text)
            node.near.chars += len(text)
    for n in reversed(page.opened):
        if n.near is n and n.above is not None:
            n.above.near.chars += n.chars
    has_article = any(n.holds for n in page.opened)
    for n in page.opened[1:]:
        if n.marked and n.by_name and (n.holds or not has_article and 2 * n.chars > total):
            n.marked = 0.0
        n.main = not n.marked and not n.hidden and (n.above.main or n.holds and n.tag in ("article", "main"))
        n.shift = n.marked + INSIDE * n.main
        n.clear = n.above.near.clear and not n.marked
        page.has_main |= n.main


def parse(html: str) -> Page:
    """The blocks of text of a page in page order, with where they stand."""
    page = Page()
    stack = [Node("", 0)]
    stack[0].near = stack[0]
    page.opened.append(stack[0])
    known: dict[tuple[int, str, str], tuple[int, bool, float, bool]] = {}
    pieces: list[str] = []
    at, size = 0, len(html)

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                page.blocks.append((stack[-1], text))

    def close(index: int) -> None:
        if any(n.tag in BLOCK for n in stack[index:]):
            flush()
        del stack[index:]

    def take(text: str) -> None:
        pieces.append(entities.unescape(text) if "&" in text else text)

    while at < size:
        m = _TAG.search(html, at)
        if not m:
            take(html[at:])
            break
        if m.start() > at:
            take(html[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break
            else:
                if tag == "p":
                    flush()
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in SIBLINGS[tag]:
                    break
        if tag in ("article", "main"):  # an unclosed menu or page header ends where the content begins
            for i in range(1, len(stack)):
                if stack[i].tag in ("nav", "header"):
                    close(i)
                    break
        if tag in VOID:
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                at = end.end() if end else size
            continue
        above = stack[-1]
        key = (above.path, tag, attributes)
        if key not in known:
            classes, *marks = _kind(tag, attributes)
            known[key] = (xxhash.xxh64_intdigest(f"{above.path}>{tag}.{classes}") - (1 << 63), *marks)
        path, hidden, marked, by_name = known[key]
        above.children.append(tag)
        node = Node(tag, path, above, hidden or above.hidden, marked, by_name)
        node.outcast = above.outcast or marked == MARKED
        node.aside = above.aside or marked < 0 and not by_name
        node.near = node if tag in BLOCK or marked else above.near
        stack.append(node)
        page.opened.append(node)
        # an article among comments or in a side bar is not the page's
        if tag in ("article", "main") and not node.hidden and not node.aside and (tag == "main" or not node.outcast):
            for n in stack:
                n.holds = True
        if tag in BLOCK and not node.hidden:
            page.nodes.append(node)
    flush()
    _settle(page)
    return page


def extract(page: Page, importance: dict[int, float]) -> str:
    """The page's text without branches of no importance."""
    stays: dict[Node, bool] = {}  # no node that is near another's text, or above it, falls below the limit
    for n in page.opened:
        if n.near is n:
            own = importance.get(n.path, NEUTRAL) + n.shift >= IMPORTANCE
            stays[n] = own and (n.above is None or stays[n.above.near])

    def kept(node: Node) -> bool:
        below = node.near
        outside = 0.0 if node.main or not page.has_main else OUTSIDE
        return stays[below] and importance.get(below.path, NEUTRAL) + outside + below.shift >= IMPORTANCE

    return " ".join(text for node, text in page.blocks if not node.hidden and kept(node))


def _with_host(pages: DataFrame) -> DataFrame:
    return pages.withColumn("_host", F.lower(F.coalesce(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit(""))))


def _features(page: Page) -> tuple[int, np.ndarray]:
    """A digest of what the page says, and its distinct (path, kind, feature)."""
    digest = xxhash.xxh64()
    found = {(n.path, 0, xxhash.xxh64_intdigest(" ".join(n.children)) - (1 << 63)) for n in page.nodes}
    for node, text in page.blocks:
        if node.hidden:
            continue
        found.add((node.near.path, 1, xxhash.xxh64_intdigest(text) - (1 << 63)))
        if node.main if page.has_main else node.near.clear:
            digest.update(f"{node.near.path} {len(text)} {text}")
    return digest.intdigest() - (1 << 63), np.array(sorted(found), "<i8").reshape(-1, 3)


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of all nodes of each host's pages."""
    source = _with_host(pages).select("_host", "html")

    def run(batches):
        for batch in batches:
            digests, features = [], []
            for html in batch.column(1).to_pylist():
                digest, found = _features(parse(html or ""))
                digests.append(digest)
                features.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.int64()), pa.array(features, pa.binary())], ["host", "digest", "features"]
            )

    def spread(batches):
        for batch in batches:
            found = [np.frombuffer(b, "<i8").reshape(-1, 3) for b in batch.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            path, kind, feature = np.concatenate(found or [np.zeros((0, 3), "<i8")]).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(path), pa.array(kind.astype(np.int32)), pa.array(feature)],
                ["host", "path", "kind", "feature"],
            )

    # pages that say the same are one page; tasks leave out their own repetitions before they send
    once = source.mapInArrow(run, "host string, digest long, features binary").groupBy("host", "digest").agg(F.min("features").alias("features"))
    rows = once.select("host", "features").mapInArrow(spread, "host string, path long, kind int, feature long")
    counted = rows.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"))
    nodes = counted.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("style"),
        F.count(F.when(F.col("kind") == 1, 1)).alias("features"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("blocks"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("content"),
    )
    log_m = F.log("m")
    # each page's blocks count, so a block that all pages share weighs as often as it is read
    presentation = 1 - F.col("style") / (F.col("m") * log_m)
    content = 1 - F.col("content") / (F.col("blocks") * log_m)
    importance = F.when(
        F.col("m") >= LEAST_PAGES,
        PRESENTATION * presentation + (1 - PRESENTATION) * F.coalesce(content, F.lit(1.0)),
    ).otherwise(NEUTRAL)
    return nodes.where("m is not null").select("host", "path", F.col("m").alias("pages"), importance.alias("importance"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` of every page (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    tree = staged(style_tree(pages).where(F.col("pages") >= LEAST_PAGES), "style-tree")
    # a host has as many paths as its templates have; they are joined, not sent to all tasks
    known = tree.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct("path", "importance")).alias("known"))
    joined = _with_host(pages).join(known, "_host", "left").select(
        "page_id", "url", "html", F.col("known.path").alias("paths"), F.col("known.importance").alias("values")
    )
    kind = joined.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = []
            for html, paths, values in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                texts.append(extract(parse(html or ""), dict(zip(paths or (), values or ()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
