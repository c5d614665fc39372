"""Main text of web pages: structure rules plus removal of subtrees that recur on many pages of a host."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from billrisk.llm.common import materialize

# Fixed values of HTML: elements without content, elements that make blocks, elements never part of a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
NEVER = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea iframe object embed "
    "svg canvas audio video map menu dialog datalist".split())
PROSE = frozenset("article main p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre b i em strong a span code u s small sub sup mark q cite td th tr".split())
CLOSED_BY_BLOCK = frozenset(("p",))
CLOSED_BY_SELF = frozenset("li dd dt tr td th option".split())
# Words in class or id that name other parts of a page than its article: those that do so anywhere in a name ...
_PART = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead topbar toolbar cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription comment comments "
    "commentlist replies disqus widget login signin signup pagination pager".split())
# ... and those that do so alone or beside a word for a box, as in "share" and "share-buttons", but not in "share-price".
_LOOSE = frozenset(
    "promo promos promotion promotions banner side notice notices notification alert alerts reply respond discussion related recommend "
    "recommended recommendations share sharing social search skip legal disclaimer header".split())
_BOX = frozenset(
    "area article articles bar block box btn button buttons col column container content form group icons inner item items left link links list "
    "main message module page panel post posts right rail section site slot stories story top bottom wrap wrapper".split())
_REPLIES = frozenset("comment comments commentlist reply replies respond discussion disqus".split())  # also on an article
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def names_other_part(name: str) -> bool:
    """Whether a class or an id of an element names a part of the page that is not its article."""
    for token in name.split():
        words = [w.lower() for w in _NAME_WORDS.findall(token)]
        if any(w in _PART for w in words):
            return True
        if any(w in _LOOSE for w in words) and all(w in _LOOSE or w in _BOX or w.isdigit() for w in words):
            return True
    return False


_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())


@dataclass
class Node:
    tag: str
    name: str = ""
    dropped: bool = False
    parts: list = field(default_factory=list)  # of text and nodes


class _Tree(HTMLParser):
    """Element tree of a page, tolerant of tags that are missing or out of place."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._leave(CLOSED_BY_BLOCK, BLOCK - CLOSED_BY_BLOCK | {"td", "th"})
        if tag in CLOSED_BY_SELF:
            self._leave({tag} | ({"dd", "dt"} & CLOSED_BY_SELF if tag in ("dd", "dt") else set()) | ({"td", "th"} if tag in ("td", "th", "tr") else set()),
                        {"ul", "ol", "dl", "table", "select", "menu"} if tag != "tr" else {"table"})
        have = dict(attrs)
        name = f"{have.get('class') or ''} {have.get('id') or ''}".strip()
        hidden = "hidden" in have or have.get("aria-hidden") == "true" or "display:none" in (have.get("style") or "").replace(" ", "").lower()
        node = Node(tag, name)
        node.dropped = (tag in NEVER or hidden or (have.get("role") or "").lower() in _ROLES
                        or (tag not in ("html", "body", "article", "main") and bool(name) and names_other_part(name))
                        or (tag == "article" and not _REPLIES.isdisjoint(_NAME_WORDS.findall(name.lower()))))
        self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("article", "main", "body", "table") and tag not in BLOCK:
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)

    def _leave(self, tags, barrier):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in barrier:
                return


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _walk(root: Node):
    """(node, depth first, children before parents) without recursion, as markup can be nested very deeply."""
    stack = [(root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            yield node
        else:
            stack.append((node, True))
            stack.extend((p, False) for p in node.parts if isinstance(p, Node))


def subtree_hashes(root: Node) -> dict[int, int]:
    """id(node) -> hash of tag, class, id and all content below, for elements that hold some text."""
    out: dict[int, int] = {}
    for node in _walk(root):
        if not node.parts:
            continue
        text = [out.get(id(p), p.tag) if isinstance(p, Node) else " ".join(p.split()) for p in node.parts]
        if any(isinstance(t, int) or (isinstance(p, str) and t) for t, p in zip(text, node.parts)):
            key = "\x1f".join([node.tag, node.name, *map(str, text)])
            out[id(node)] = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)
    return out


def _content(root: Node) -> list[Node]:
    """Where the article is: ``main``, else the outermost ``article`` elements, else everything."""
    for tag in ("main", "article"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.tag == tag and not node.dropped:
                found.append(node)
            elif not node.dropped:
                stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
        if found:
            return found
    return [root]


def _holds_title(header: Node) -> bool:
    """Whether a header inside an article has a heading of the first two levels, at any depth."""
    return any(node.tag in ("h1", "h2", "hgroup") for node in _walk(header))


def blocks(root: Node, removed: frozenset[int] = frozenset(), hashes: dict[int, int] | None = None) -> list[str]:
    """Text blocks of the article in page order; subtrees whose hash is in ``removed`` are left out.

    Inside an explicit ``article`` or ``main`` only containers are: a paragraph
    that many articles of a site share is still text of each of them.
    """
    hashes = hashes or {}
    out: list[str] = []
    buffer: list[str] = []

    def flush():
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            out.append(text)

    for top in _content(root):
        inside = top.tag in ("main", "article")
        stack: list = [top]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                buffer.append(item)
            else:
                if item.dropped or (removed and not (inside and item.tag in PROSE) and hashes.get(id(item)) in removed):
                    if item.tag in BLOCK:
                        flush()
                    continue
                if item.tag == "header" and not (inside and _holds_title(item)):
                    flush()
                    continue
                if item.tag in BLOCK:
                    flush()
                    stack.append(None)
                elif item.tag in ("br", "td", "th"):
                    buffer.append(" ")
                stack.extend(reversed(item.parts))
        flush()
    return out


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    url, html = F.col(url_col), F.col(html_col)
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), html.alias("html"),
                        host.alias("host"), F.xxhash64(url, html).alias("page_key"))


def template_subtrees(pages: DataFrame, min_pages: int = 5) -> DataFrame:
    """(page_key, removed): for each page the hashes of its subtrees that are part of its site's template.

    A subtree is a template part if it stands on at least ``min_pages`` pages
    of the host with different main text, however many pages the host has.  Pages
    with the same main text count once, so that an article that was fetched
    many times is no template.  A page's own subtrees are all that is gathered
    per page; counts per host combine before the shuffle.
    """
    def list_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            host, key, main, tree = [], [], [], []
            for h, k, html in zip(*(c.to_pylist() for c in batch.columns)):
                root = parse(html)
                text = xxhash.xxh64_intdigest("\n".join(blocks(root)).encode("utf-8", "surrogatepass")) - (1 << 63)
                hashes = subtree_hashes(root)
                keep = {hashes[id(n)] for n in _walk(root) if id(n) in hashes and not n.dropped and n.tag not in ("#root", "html", "body")}
                host += [h] * len(keep)
                key += [k] * len(keep)
                main += [text] * len(keep)
                tree += keep
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(key, pa.int64()), pa.array(main, pa.int64()), pa.array(tree, pa.int64())],
                ["host", "page_key", "main", "tree"])

    rows = pages.where("host <> ''").select("host", "page_key", "html").mapInArrow(
        list_subtrees, "host string, page_key long, main long, tree long")
    rows = materialize(rows.select(F.xxhash64("host").alias("host"), "page_key", "main", "tree"))
    common = rows.select("host", "tree", "main").distinct().groupBy("host", "tree").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    common = materialize(common.select("host", "tree"))
    return rows.select("host", "page_key", "tree").join(common, ["host", "tree"]).groupBy("page_key").agg(F.collect_set("tree").alias("removed"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      broadcast_rows: int = 200_000) -> DataFrame:
    """(page_id, url, text): the article of every page, blocks joined by an empty line.

    Left out are menus, headers, footers, side bars, notices, adverts, forms,
    comments, scripts and styles, by element, role, class and id, and whatever
    recurs as a template on the page's host; the subtrees to remove go to the
    pages if at most ``broadcast_rows`` pages have any, else they meet by
    shuffle.  Character references are decoded
    and white space inside a block becomes one space.

    Null or empty html gives an empty text; a null url, or one without a host,
    is extracted by structure alone.  Repeated rows and null ids are returned as
    often; markup of any length and depth is read whole, without recursion; an
    empty table gives an empty result; extra columns are ignored.
    """
    rows = _pages(pages, id_col, url_col, html_col)
    removed = materialize(template_subtrees(rows).withColumnRenamed("page_key", "_of"))
    side = F.broadcast(removed) if removed.count() <= broadcast_rows else removed
    joined = rows.join(side, F.col("page_key") == F.col("_of"), "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                root = parse(html)
                texts.append("\n\n".join(blocks(root, frozenset(gone), subtree_hashes(root)) if gone else blocks(root)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return joined.select("page_id", "url", "html", "removed").mapInArrow(extract, "page_id long, url string, text string")
