"""Main text of web pages, with the templates of a site removed.

Each page is parsed into a light tree. Subtrees are hashed, Spark counts per host on how many different
pages each hash occurs, and subtrees that recur on several pages of their host are deleted. What a single
page shows to be no article (menus, forms, adverts, comments and so on) is deleted as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesloom.functions.columns import q
from salesloom.llm.common import any_names, map_arrow, others, table
from salesloom.llm.url_filter import host_and_path
from salesloom.operators.joins import lookup_join
from salesloom.scratch import land

#: A subtree is a template of its host if it is on this many different pages at least.
MIN_PAGES = 5

RAW = frozenset("script style title textarea noscript iframe xmp template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is never the article's.
DROPPED = RAW | frozenset(
    "nav footer aside form button select option dialog menu svg canvas object audio video map"
    " label fieldset datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span"
    " strike strong sub sup time tt u var wbr nobr ruby rb rt rp img".split()
)
# Elements that may stand in a paragraph.
PHRASING = INLINE | RAW | frozenset(
    "button select svg canvas object audio video map label input".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th".split()) | INLINE
MAIN = frozenset(["article", "main"])
# Words of a class, id or role that mark an element as no part of an article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion"
    " banner menu nav navbar navigation breadcrumb breadcrumbs sidebar side aside widget widgets"
    " footer notice notices cookie cookies consent gdpr alert popup modal"
    " overlay newsletter subscribe subscription signup login form search comment comments reply"
    " replies respond disqus share sharing social related recommended pagination pager toolbar"
    " complementary contentinfo dialog skip tags hidden".split()
)
HEADERS = frozenset(["header", "masthead", "topbar"])
# Words that may stand beside a mark in a name of an element in an article: "comment-list" is no article, "related-work" is.
HOLDERS = frozenset(
    "area articles bar block body bottom box button buttons container content group holder icons inline inner"
    " item items left link links list outer panel placeholder posts right section site slot stories text"
    " title top unit wrap wrapper zone".split()
)
# Of the marks, those that make even an article or main element no article.
NO_ARTICLE = frozenset(
    "ad ads advert sponsored promo comment comments reply replies respond related teaser".split()
)
# An open element that the start of a key ends, up to the nearest element of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=\"']++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I
)
SPLIT = re.compile(r"[^a-z]+")


class Node:
    __slots__ = (
        "tag", "dropped", "marked", "marked_inside", "header", "parts", "text_length", "hash", "has_title"
    )

    def __init__(
        self, tag: str, dropped: bool = False, marked: bool = False, marked_inside: bool = False, header: bool = False
    ):
        self.tag, self.dropped, self.header = tag, dropped, header
        self.marked, self.marked_inside = marked, marked_inside  # by single words; by whole names
        self.parts: list[Node | str] = []
        self.text_length, self.hash, self.has_title = 0, 0, False


def parse(html: str) -> Node:
    """The tree of a page. Never fails: what is not closed ends with its parent."""
    root = Node("")
    stack, place, end = [root], 0, len(html)
    while place < end:
        cut = html.find("<", place)
        if cut < 0:
            cut = end
        found = TOKEN.match(html, cut) if cut < end else None
        while found is None and cut < end:  # a bare "<" is text
            cut = html.find("<", cut + 1)
            if cut < 0:
                cut = end
            else:
                found = TOKEN.match(html, cut)
        if cut > place:
            stack[-1].parts.append(unescape(html[place:cut]))
        if found is None:
            break
        place = found.end()
        tag = found[2]
        if tag is None:
            if html.startswith("<![CDATA[", cut):
                stack[-1].parts.append(html[cut + 9 : place].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found[1]:
            _close(stack, tag)
            continue
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                stack[-1].parts.append("" if tag == "wbr" else " ")
            continue
        _implied_ends(stack, tag)
        names, hidden = _names(found[3], tag not in PROSE)
        words = {w for name in names for w in name}
        whole = any(_marks(name, NO_ARTICLE if tag in MAIN else MARKS) for name in names)
        marked = whole if tag in MAIN else not MARKS.isdisjoint(words)
        header = tag == "header" or not HEADERS.isdisjoint(words)
        node = Node(tag, tag in DROPPED or hidden, marked, whole, header)
        stack[-1].parts.append(node)
        if tag in RAW:
            ending = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(html, place)
            place = ending.end()
        elif not found[3].endswith("/") or tag not in ("svg", "path", "use", "circle", "rect"):
            stack.append(node)
    return root


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if tag in INLINE and stack[i].tag not in INLINE:
            return


def _implied_ends(stack: list[Node], tag: str) -> None:
    if tag not in PHRASING:  # a block ends an open paragraph and what is open in it
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag not in PHRASING:
                break
    if tag in CLOSES:
        ended, within = CLOSES[tag]
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in within:
                break
            if stack[i].tag in ended:
                del stack[i:]
                break


def _names(attributes: str, ids: bool) -> tuple[list[list[str]], bool]:
    """Names of an element (class, role and, if ``ids``, id) as lists of words; whether it is hidden.

    The id of a heading or paragraph is a link's target and says nothing of what it is.
    """
    names: list[list[str]] = []
    hidden = False
    if "=" in attributes or "hidden" in attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
            elif name != "aria-hidden" and (ids or name != "id"):
                names.extend([w for w in SPLIT.split(one) if w] for one in value.split())
    return names, hidden


def _marks(name: list[str], marks: frozenset[str]) -> bool:
    """A whole name marks an element: it has a mark, and no word besides marks and holders."""
    return not marks.isdisjoint(name) and all(w in marks or w in MARKS or w in HOLDERS for w in name)


def finish(root: Node) -> list[Node]:
    """Hash and measure all subtrees; nodes in post-order. Children come before their parents."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(p for p in node.parts if isinstance(p, Node))
    order.reverse()
    for node in order:
        inner = [node.tag]
        for part in node.parts:
            if isinstance(part, Node):
                node.text_length += part.text_length
                node.has_title |= part.has_title or (
                    not part.marked and (part.tag == "h1" or part.tag in MAIN)
                )
                inner.append(f"\x01{part.hash:x}")
            else:
                text = " ".join(part.split())
                node.text_length += len(text)
                inner.append(f"\x02{text}")
        node.hash = xxhash.xxh3_64_intdigest("\x00".join(inner)) - (1 << 63)
    return order


def subtrees(html: str) -> tuple[int, dict[int, bool], set[int]]:
    """Hash of a page, hashes of its subtrees that count for a template, and of those that may be one.

    A counted hash says whether the page has it outside of its ``article`` or ``main`` elements, too.

    Plain paragraphs, headings and inline elements are prose, however often they recur; neither
    is what holds a title. What holds half of the page's text does not count here, but goes
    if other pages show it to be a template.
    """
    root = parse(html)
    may_go = [n for n in finish(root) if _may_go(n)]
    inside = _in_articles(root)
    counted: dict[int, bool] = {}
    for n in may_go:
        if 2 * n.text_length < root.text_length:
            counted[n.hash] = counted.get(n.hash, False) or id(n) not in inside
    return root.hash, counted, {n.hash for n in may_go}


def _in_articles(root: Node) -> set[int]:
    """Identities of the nodes below an ``article`` or ``main`` that is not marked as another thing."""
    found, todo = set(), [(root, False)]
    while todo:
        node, inside = todo.pop()
        if inside:
            found.add(id(node))
        inside |= node.tag in MAIN and not node.marked
        todo.extend((p, inside) for p in node.parts if isinstance(p, Node))
    return found


def _may_go(node: Node) -> bool:
    return (
        node.text_length > 0
        and node.tag not in PROSE
        and node.tag not in MAIN
        and node.tag not in ("", "html", "body")
        and not node.has_title
    )


def main_text(html: str, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The text of a page's article, its blocks joined by one space.

    Where the page has an ``article`` or else a ``main`` element that is not dropped itself, text
    outside of it is left out.
    """
    root = parse(html)
    for node in finish(root):
        node.dropped |= node.hash in templates and _may_go(node)
    for tags in (("article",), ("main",)):
        blocks, found = _blocks(root, tags)
        if found:
            return " ".join(blocks)
    return " ".join(_blocks(root, ())[0])


def _blocks(root: Node, within: tuple[str, ...]) -> tuple[list[str], bool]:
    blocks: list[str] = []
    run: list[str] = []
    found = False

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append(text)

    todo: list[tuple[Node | str | None, bool]] = [(root, not within)]
    while todo:
        part, inside = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            if inside:
                run.append(part)
        elif _kept(part, inside and bool(within)):
            inside_here = inside or part.tag in within
            found |= part.tag in within
            block = part.tag not in INLINE
            if block:
                flush()
                todo.append((None, inside))
            todo.extend((p, inside_here) for p in reversed(part.parts))
    flush()
    return blocks, found


def _kept(node: Node, in_article: bool) -> bool:
    """What holds a title or the article is not dropped for its name; nor is an article's header.

    In an article only a whole name drops a block ("related", "comment-list"), elsewhere any word in it.
    """
    if node.dropped:
        return False
    if node.has_title or node.tag in ("html", "body"):
        return True
    return not node.marked_inside if in_article else not (node.marked or node.header)


def page_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``_on_host``, ``_of_key`` and ``_templates``, hashes of a page's own subtrees that recur on its host.

    ``pages`` has ``_host``, ``_key`` (a hash of the page as it is) and ``_html``. Pages of a host that
    parse alike are one page, and each page counts a subtree once; counts are added up in each task
    first. What recurs within articles only is the articles' own (a list that several quote) and no
    template: some page must have it elsewhere. Templates stay rows of host and hash; an array has at most
    the subtrees of a page.
    """
    schema = (
        "_host string, _key long, _page long, _counted array<struct<hash:long,outside:boolean>>, _own array<long>"
    )
    found = land(pages.select("_host", "_key", "_html").mapInArrow(_subtree_rows, schema), "subtrees")
    different = found.groupBy("_host", "_page").agg(F.min("_counted").alias("_counted"))
    often = land(
        different.select(F.col("_host").alias("_of_host"), F.explode("_counted").alias("_one"))
        .groupBy("_of_host", F.col("_one.hash").alias("_template"))
        .agg(F.count(F.lit(1)).alias("_pages"), F.max("_one.outside").alias("_outside"))
        .where(F.col("_outside") & (F.col("_pages") >= int(min_pages))).drop("_pages", "_outside"),
        "templates",
    )
    own = found.groupBy("_host", "_key").agg(F.min("_own").alias("_own"))
    met = lookup_join(
        own.select("_host", "_key", F.explode("_own").alias("_hash")), often,
        [("_host", "_of_host"), ("_hash", "_template")],
    )
    return met.groupBy(F.col("_host").alias("_on_host"), F.col("_key").alias("_of_key")).agg(
        F.collect_list("_hash").alias("_templates")
    )


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [subtrees(html.as_py() or "") for html in batch["_html"]]
        pages, counted, own = zip(*found) if found else ((), (), ())
        lists = pa.list_(pa.int64())
        marked = pa.list_(pa.struct([("hash", pa.int64()), ("outside", pa.bool_())]))
        pairs = [[{"hash": h, "outside": x} for h, x in sorted(c.items())] for c in counted]
        yield pa.record_batch(
            [batch["_host"], batch["_key"], pa.array(pages, pa.int64()),
             pa.array(pairs, marked), pa.array(map(sorted, own), lists)],
            names=["_host", "_key", "_page", "_counted", "_own"],
        )


@any_names
def extract_text(
    pages: DataFrame, url: str = "url", html: str = "html",
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """All rows of ``pages`` with ``text`` and ``n_chars``, its code points.

    NULL and empty pages have empty text. Pages without a host (NULL URL) count as one host.
    Repeated rows stay repeated and count as one page; an empty table gives an empty one. Blocks of an
    article go for what their whole name says or as a template that is also outside of articles.
    Columns named like the new ones are replaced. Whole pages are parsed.
    """
    made = ["text", "n_chars"]
    host, _ = host_and_path(q(url))
    rows = pages.select(
        *others(pages, made), host.alias("_host"), F.xxhash64(q(html)).alias("_key"),
        q(html).alias("_html"),
    )
    templates = page_templates(rows, min_pages)
    joined = lookup_join(rows, templates, [("_host", "_on_host"), ("_key", "_of_key")], "left")
    schema = StructType().add("text", "string").add("n_chars", "long")
    inputs = [F.col("_html"), F.col("_templates")]
    return map_arrow(joined, others(pages, made), inputs, _text_rows, schema)


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(h.as_py() or "", set(t.as_py() or ()))
            for h, t in zip(batch["_html"], batch["_templates"])
        ]
        yield pa.record_batch(
            [batch["_row"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["_row", "text", "n_chars"],
        )


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).drop("html")
