"""Main text of web pages by removal of the site's template.

Pages are parsed into trees of elements, leniently. Every subtree that may be
part of a template has a hash over its tags, attributes and texts; Spark counts
in how many different pages of its host each hash stands, and those that recur
(``MIN_PAGES`` pages and ``MIN_SHARE`` percent of the host's) are deleted from
every page that holds them. What tags, roles and class names mark as a menu,
header, footer, sidebar, notice, advert, form, share bar or reader comment goes
as well, because such parts often differ from page to page. The text of what is
left is given block by block; where a page has an ``article`` (else a
``main``), only that.

Copies of an article must not pass for a template: pages with the same main text
count as one page, a paragraph inside an article is never a candidate, and a
container there only while it holds less than half of the article's text.

Hashes (16 bytes) and page keys (8 bytes) are what Spark counts and joins; a host's hashes
are spread by their value, so a host may hold any share of the pages. Pages move
once, compressed, to meet the hashes to delete; no list of templates passes
through the driver or a broadcast.

Defined cases: a null html is empty and gives an empty text; a null url is a host of
its own; unclosed, misnested and cut-off markup is read to its end; an unknown
reference stays as written; repeated rows and null ids are kept; an empty table
gives an empty table; extra columns are dropped; a page is read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import pieces, text_bytes, tuned
from tessera.session import materialize

MIN_PAGES, MIN_SHARE = 5, 20

# Names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p
plaintext pre search section summary table tbody td tfoot th thead tr ul xmp""".split())
#: Start tags that end an open element of the second kind, up to an element of the third.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
_ENDS_P = BLOCKS - set("body caption dd html legend li optgroup option tbody td tfoot th thead tr".split())
_IN_HEAD = set("base link meta noscript script style template title".split())
_SCOPE = set("html table td th caption button template object".split())

#: Elements that hold no main text wherever they stand.
DROPPED = RAW | set("""head noscript template nav aside footer form button select datalist input object embed applet canvas svg
audio video map dialog menu search""".split())
#: Roles and words of class and id that mark such elements.
ROLES = set("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar
tablist tooltip status""".split())
MARKS = set("""ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox banner banners breadcrumb
breadcrumbs captcha comment comments commentlist consent cookie cookies copyright dfp disqus footer gdpr login
menu menus modal nav navbar navigation newsletter notice notices notification notifications overlay pager
paginate pagination paywall popup popups promo promos promoted promotion recommendations recommended related replies respond
responses share sharebar sharing sidebar sidebars signin signup skip social sponsor sponsored sponsors subscribe
subscription toolbar topbar widget widgets""".split())
#: These mark the site's header, or an article's own that holds its heading.
HEADER_MARKS = {"header", "masthead"}
_NOT = {"no", "has", "with", "without", "non"}
_HEADS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Containers that may be part of a template inside an article; paragraphs there never are.
_CONTAINERS = set("aside center details div dl fieldset figure footer form header menu nav ol section table ul".split())

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?", re.S)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_SILENT = RAW | {"head", "noscript", "template"}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element; ``children`` holds nodes and texts."""

    __slots__ = ("tag", "attributes", "children", "digest", "size")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []
        self.digest, self.size = b"", 0


def parse(page: str) -> Node:
    """The tree of a page: unclosed elements end where the standard lets them, whatever is left open ends with the page."""
    root = Node("#page")
    stack, at = [root], 0
    while at < len(page):
        tag = _TOKEN.search(page, at)
        text = page[at:tag.start() if tag else len(page)]
        if text:
            stack[-1].children.append(text)
        if not tag:
            break
        at = max(tag.end(), tag.start() + 1)
        slash, name, rest = tag.groups()
        if not name or not page.endswith(">", tag.start(), tag.end()):
            continue
        name = name.lower()
        if slash:
            _close(stack, name)
            continue
        _make_room(stack, name)
        node = Node(name, rest.strip())
        stack[-1].children.append(node)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            node.children.append(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
        else:
            stack.append(node)
    return root


def _close(stack: list[Node], name: str) -> None:
    """An end tag ends the nearest such element, but an inline one ends nothing beyond its block."""
    for k in range(len(stack) - 1, 0, -1):
        tag = stack[k].tag
        if tag == name or name in _HEADS and tag in _HEADS:
            del stack[k:]
            return
        if name not in BLOCKS and tag in BLOCKS or tag in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html", "article", "main"):
            return


def _make_room(stack: list[Node], name: str) -> None:
    """End the elements that a start tag ends."""
    if stack[-1].tag == "head" and name not in _IN_HEAD:
        stack.pop()
    if name in _ENDS_P:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                del stack[k:]
                break
            if stack[k].tag in _SCOPE or stack[k].tag in BLOCKS:
                break
    if name in _ENDS:
        ended, scope = _ENDS[name]
        lowest = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ended:
                lowest = k
            elif stack[k].tag in scope:
                break
        if lowest is not None:
            del stack[lowest:]


def attributes(node: Node) -> dict[str, str]:
    return {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in reversed(_ATTRIBUTE.findall(node.attributes))}


def _mark(node: Node) -> str:
    """``junk`` or ``header`` if tag or attributes mark the element as no main text, else empty."""
    if node.tag in DROPPED:
        return "junk"
    mark = "header" if node.tag == "header" else ""
    if not node.attributes or node.tag in ("html", "body"):
        return mark
    has = attributes(node)
    if "hidden" in has or has.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(has.get("style", "")):
        return "junk"
    if has.get("role", "").lower() in ROLES:
        return "junk"
    for name in ("class", "id"):
        for word in has.get(name, "").split():
            parts = [p.lower() for p in _WORD.findall(word)]
            for k, part in enumerate(parts):
                if not (k and parts[k - 1] in _NOT):
                    if part in MARKS:
                        return "junk"
                    mark = "header" if part in HEADER_MARKS else mark
    return mark


def _elements(node: Node) -> list[Node]:
    """The node and all elements below it, each before its own."""
    found = [node]
    for item in found:
        found += [c for c in item.children if isinstance(c, Node)]
    return found


def _roots(page: Node) -> list[Node]:
    """The outermost articles outside marked elements, else those within, else the same of main, else the page."""
    for tag in ("article", "main"):
        for through in (False, True):
            found, todo = [], [page]
            while todo:
                node = todo.pop()
                marked = bool(_mark(node))
                if node.tag == tag and not marked:
                    found.append(node)
                elif not marked or through and node.tag not in DROPPED:
                    todo += [c for c in reversed(node.children) if isinstance(c, Node)]
            if found:
                return found
    return [page]


def _blocks(root: Node, gone: set[int], inside: bool) -> list[str]:
    """The blocks of text below a root without the nodes in ``gone`` and the elements that hold no main text."""
    blocks, line = [], []

    def end():
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        item = todo.pop()
        if item is None:
            end()
            continue
        if isinstance(item, str):
            line.append(html.unescape(item))
            continue
        block = item.tag in BLOCKS
        if block:
            end()
        elif item.tag == "br":
            line.append(" ")
        if item is not root:
            mark = _mark(item)
            if id(item) in gone or mark == "junk" or mark == "header" and not (inside and any(n.tag in _HEADS for n in _elements(item))):
                line.append("" if block or item.tag in _SILENT else " ")
                continue
        if block:
            todo.append(None)
        todo += reversed(item.children)
    end()
    return blocks


def main_text(page: Node, template: set[bytes] = frozenset()) -> str:
    """The text of the page's articles, without the subtrees whose hash is in ``template``."""
    roots = _roots(page)
    gone = {id(node) for node in _candidates(page, roots) if node.digest in template} if template else set()
    return "\n".join(b for root in roots for b in _blocks(root, gone, root is not page))


def _hash(page: Node, host: bytes) -> None:
    """Set digest and size (characters of text) of every element, from the leaves up."""
    for node in reversed(_elements(page)):
        h = xxhash.xxh3_128(host)
        h.update(f"<{node.tag} {node.attributes}>".encode("utf-8", "surrogatepass"))
        for child in node.children:
            if isinstance(child, Node):
                h.update(b"\x01" + child.digest)
                node.size += child.size
            else:
                text = " ".join(child.split())
                if text:
                    h.update(b"\x02" + text.encode("utf-8", "surrogatepass"))
                    node.size += len(text) if node.tag not in RAW else 0
        node.digest = h.digest()


def _candidates(page: Node, roots: list[Node]) -> Iterator[Node]:
    """Elements that may be part of a template: all outside the articles but what holds one; lesser containers inside."""
    whole = {id(r): r.size for r in roots if r is not page}
    holding = set(whole)
    if whole:
        for node in reversed(_elements(page)):
            if any(id(c) in holding for c in node.children):
                holding.add(id(node))
    todo: list[tuple[Node, int]] = [(page, 0)]
    while todo:
        node, size = todo.pop()
        if node is not page and id(node) not in holding and node.tag not in ("html", "head", "body") and (
                not size or node.tag in _CONTAINERS and 2 * node.size < size):
            yield node
        size = whole.get(id(node), size)
        todo += [(c, size) for c in node.children if isinstance(c, Node)]


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL, without user and port; null stays null."""
    authority = F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\\]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")


def _parsed(batch: pa.RecordBatch, host: int, text: int) -> Iterator[tuple[int, Node]]:
    hosts, texts = batch.column(host).to_pylist(), text_bytes(batch.column(text))
    for k, (name, page) in enumerate(zip(hosts, texts)):
        tree = parse(page.decode("utf-8", "replace"))
        _hash(tree, (name or "").encode() + (b"\x00" if name is None else b"\x01"))
        yield k, tree


def subtrees(pages: DataFrame) -> DataFrame:
    """(host, page, article, subtree) of keyed (host, page, html): the hashes of each page's candidates, once a page."""
    schema = T.StructType([pages.schema["host"], pages.schema["page"], T.StructField("article", T.LongType()), T.StructField("subtree", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, article, found = [], [], []
            for k, tree in _parsed(batch, 0, 2):
                digests = {n.digest for n in _candidates(tree, _roots(tree))}
                row += [k] * len(digests)
                same = xxhash.xxh3_64_intdigest(main_text(tree).encode("utf-8", "surrogatepass")) - (1 << 63)
                article += [same] * len(digests)
                found += digests
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(article, pa.int64()),
                                              pa.array(found, pa.binary())], names=schema.names)

    return pages.mapInArrow(run, schema)


def templates(found: DataFrame, min_pages: int = MIN_PAGES, min_share: int = MIN_SHARE) -> DataFrame:
    """(subtree): hashes in many pages of their host, pages of one main text counted once."""
    host = F.col("host")
    seen = found.select(host, "article", "subtree").distinct()
    often = seen.groupBy("host", "subtree").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    pages = found.select(host, "article").distinct().groupBy(host.alias("__host")).agg(F.count("*").alias("pages"))
    return (often.join(pages, F.col("host").eqNullSafe(F.col("__host")))
            .filter(100 * F.col("n") >= min_share * F.col("pages")).select("subtree"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page, its site's template removed."""
    tuned(pages.sparkSession)
    host = host_of(F.col(url).cast("string"))
    # A page's key only leads hashes back to pages; what it doesn't hold deletes nothing in it.
    page = F.xxhash64(host, text)
    keyed = pages.select(host.alias("host"), page.alias("page"), F.col(text).alias("html"))
    found = materialize(subtrees(keyed), "html_subtrees")
    often = materialize(templates(found), "html_templates")
    hits = (found.select("page", "subtree").join(often.hint("merge"), "subtree")
            .groupBy(F.col("page").alias("__page")).agg(F.collect_set("subtree").alias("template")))
    names = (page_id, url, "text")
    small = _compressed(pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), host.alias("host"), page.alias("page"), F.col(text).alias("html")))
    joined = small.join(hits.hint("merge"), F.col("page") == F.col("__page"), "left").select("id", "url", "host", "html", "template")
    schema = T.StructType([joined.schema["id"], joined.schema["url"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.set_column(3, "html", pa.array(_expanded(batch.column(3)), pa.binary()))
            gone = batch.column(4).to_pylist()
            texts = [main_text(tree, set(gone[k] or ())).encode("utf-8", "replace") for k, tree in _parsed(batch, 2, 3)]
            for lo, hi in pieces(texts):
                made = pa.array(texts[lo:hi], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), made], names=schema.names)

    return joined.mapInArrow(run, schema).toDF(*names)


def _compressed(pages: DataFrame) -> DataFrame:
    """The pages with their html compressed for the shuffle."""
    schema = T.StructType([f if f.name != "html" else T.StructField("html", T.BinaryType()) for f in pages.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = pa.Codec("zstd", compression_level=6)
        for batch in batches:
            packed = [len(t).to_bytes(8, "little") + zstd.compress(t, asbytes=True) for t in text_bytes(batch.column(4))]
            yield batch.set_column(4, "html", pa.array(packed, pa.binary()))

    return pages.mapInArrow(run, schema)


def _expanded(column: pa.Array) -> list[bytes]:
    zstd = pa.Codec("zstd")
    return [zstd.decompress(memoryview(x)[8:], int.from_bytes(x[:8], "little"), asbytes=True) for x in column.to_pylist()]
