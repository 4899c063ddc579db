"""Main text of web pages: site template removal over element-subtree hashes.

Pass 1 parses each page into a tree and hashes every element subtree (tag,
attributes that name its role, text, children). Pages of a host with the same
main text are copies and count once. Spark counts, per host, on how many
different pages each hash occurs, and keeps those that recur on many of them:
the site's template. Pass 2 takes the article where the page marks one, and
else the page without its template subtrees; it deletes parts that their tag or
name marks as no main text (menus, forms, adverts, comments ...) and writes the
blocks. Inside a marked article nothing is taken for template; a main element
without an article is treated like a page in this.

Copies meet by host and content, subtrees by host and hash, so a host that holds
a third of all pages is summed by many tasks; the join that brings a host's
template to its pages has a salt for hosts with many pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec as tv
from .common import ship, written

CHUNK_BYTES = 2 << 20
#: A subtree is template if it occurs on this share of its host's different pages, and on so many of them at least.
TEMPLATE_SHARE = 0.5
TEMPLATE_PAGES = 10

#: A host with more than this share of all pages is joined with its template in SALTS parts.
BUSY_SHARE = 1 / 512
SALTS = 64

# Element kinds of the HTML standard, and names that sites give to parts other than main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
DROPPED = frozenset("""head nav footer aside form script style textarea select button input iframe noscript template svg math
    object embed canvas audio video dialog menu noembed noframes""".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCKS - frozenset("body html li dd dt tbody td tfoot th thead tr legend summary figcaption".split())
SIBLINGS = {tag: (ends.split(), inside.split()) for tag, ends, inside in (
    ("li", "li", "ul ol menu dir"), ("dt", "dt dd", "dl"), ("dd", "dt dd", "dl"), ("tr", "tr td th", "table"), ("td", "td th", "tr table"),
    ("th", "td th", "tr table"), ("option", "option", "select"), ("tbody", "tbody thead tfoot tr td th", "table"),
    ("tfoot", "tbody thead tfoot tr td th", "table"))}
IMPLIES = CLOSES_P | SIBLINGS.keys() | {"body"}
NOT_MAIN = frozenset("""ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion nav navbar
    navigation menu menubar breadcrumb breadcrumbs sidebar aside widget cookie cookies consent gdpr notice popup modal overlay
    newsletter subscribe subscription comment comments disqus respond replies reply share sharing social related recommended
    pagination pager paging search login signin signup toolbar skip copyright complementary contentinfo search dialog alert
    form""".split())
PAGE_ONLY = frozenset("header footer masthead banner".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold the page or its article: no class, id or role makes them, or what they lie in, a part to drop.
WHOLE = frozenset("html body article main".split())
#: In an article, elements that hold its text go only by names of adverts; other parts not by names that texts have too.
PARTS = frozenset("address center details dir div dl fieldset figure header hgroup menu ol section table ul".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adbox sponsored".split())
TEXT_NAMES = frozenset("alert notice".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>\"']*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")  # takes nothing back
_SPECIAL = re.compile(r"[>\"']")
_BREAK = re.compile(r"[\s/>]")
_AFTER_NAME = frozenset(chr(c) for c in range(0x3001) if chr(c).isspace() or c == 0x2F)  # what _BREAK finds, without the end of the tag
_LETTER = re.compile(r"[a-zA-Z]")
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    tag: str
    names: frozenset[str] = frozenset()
    ids: frozenset[str] = frozenset()
    hidden: bool = False
    children: list[Node | str] = field(default_factory=list)
    hash: int = 0
    holds: bool = False  # an element of WHOLE lies inside


def _attributes(raw: str) -> tuple[frozenset[str], frozenset[str], bool]:
    """Whole tokens of class and role; of id; whether the element is hidden."""
    if not raw.strip():
        return frozenset(), frozenset(), False
    names: set[str] = set()
    ids: set[str] = set()
    hidden = False
    for m in _ATTRIBUTE.finditer(raw):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "role"):
            names.update(value.split())
        elif key == "id":
            ids.update(value.split())
        hidden |= key == "hidden" or (key == "aria-hidden" and value == "true") or (
            key == "style" and "display:none" in value.replace(" ", ""))
    return frozenset(names), frozenset(ids), hidden


class _Tags:
    """The tags of a page, found from left to right in time linear in its length, whatever its markup is like.

    A tag ends at the first > outside quotes. Where there is none (or a quote stays open), its < is text; what such
    an attempt has passed is remembered, so that no later attempt passes it again.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.special = self.broken = -1  # next special character, next end of a name, from the last place asked
        self.dead: set[int] = set()  # special characters from which no tag ends

    def _special(self, at: int) -> int:
        if self.special < at:
            m = _SPECIAL.search(self.page, at)
            self.special = m.start() if m else len(self.page)
        return self.special

    def _end(self, at: int) -> int:
        """Place of the > that ends a tag whose name ends at `at`; -1 if there is none."""
        passed = []
        at = self._special(at)
        while at < len(self.page) and at not in self.dead:
            passed.append(at)
            c = self.page[at]
            if c == ">":
                return at
            if at == self.last[c]:
                break
            after = self.page.find(c, at + 1) + 1
            m = _SPECIAL.search(self.page, after)
            at = m.start() if m else len(self.page)
        self.dead.update(passed)
        return -1

    def find(self, at: int) -> tuple[int, int, str | None, bool, str, bool] | None:
        """(start, end, name or None for comments and the like, is an end tag, attributes, closes itself) of the first tag from `at` on."""
        page = self.page
        while (at := page.find("<", at)) >= 0:
            c = page[at + 1 : at + 2]
            if c in ("!", "?"):
                if page.startswith("<!--", at):
                    ends = [i for i in (page.find("-->", at + 4), page.find("--!>", at + 4)) if i >= 0]
                    end = min(ends) if ends else len(page)
                    return at, min(len(page), end + (3 if page.startswith("-->", end) else 4)), None, False, "", False
                end = page.find(">", at)
                return at, end + 1 if end >= 0 else len(page), None, False, "", False
            begin = at + 2 if c == "/" else at + 1
            if at < self.last[">"] and self._special(at) not in self.dead and (m := _TAG.match(page, at)):
                end, raw = m.end(), m[3]
                if not raw or raw[0] in _AFTER_NAME:
                    own = raw.endswith("/")
                    return at, end, m[2].lower(), bool(m[1]), raw[:-1] if own else raw, own
            if at < self.last[">"] and _LETTER.match(page, begin):
                if self.broken < begin:
                    m = _BREAK.search(page, begin)
                    self.broken = m.start() if m else len(page)
                end = self._end(self.broken)
                if end >= 0:
                    raw = page[self.broken : end]
                    own = raw.endswith("/")
                    return at, end + 1, page[begin : self.broken].lower(), c == "/", raw[:-1] if own else raw, own
            at += 1
        return None


class _Open:
    """The open elements, with the places of each tag among them."""

    def __init__(self, root: Node) -> None:
        self.stack = [root]
        self.where: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.where.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, at: int) -> None:
        """Ends the element at this place and all inside it."""
        while len(self.stack) > at:
            self.where[self.stack.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()

    def nearest(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 if there is none."""
        return max((w[-1] for t in tags if (w := self.where.get(t))), default=0)

    def close(self, tag: str) -> None:
        places = self.where.get(tag)
        if places and (tag in BLOCKS or places[-1] > self.nearest(("article", "main", "table"))):
            self.cut(places[-1])

    def imply(self, tag: str) -> None:
        """Ends the elements that the start of `tag` ends by rule."""
        if tag in CLOSES_P and self.blocks and self.stack[self.blocks[-1]].tag == "p":
            self.cut(self.blocks[-1])
        if tag in SIBLINGS:
            ends, inside = SIBLINGS[tag]
            limit = self.nearest(inside)
            while (at := self.nearest(ends)) > limit:
                self.cut(at)
                if tag not in ("tr", "tbody", "tfoot"):
                    break
        if tag == "body" and (at := self.nearest(("head",))):
            self.cut(at)


def parse(page: str) -> Node:
    """The element tree; unclosed elements end where HTML ends them, stray end tags are ignored."""
    root = Node("#root")
    tags, opened, at = _Tags(page), _Open(root), 0
    while at < len(page):
        found = tags.find(at)
        start = found[0] if found else len(page)
        if start > at:
            opened.stack[-1].children.append(page[at:start])
        if found is None:
            break
        _, at, tag, ends, raw, closed = found
        if tag is None:
            continue
        if ends:
            opened.close(tag)
            continue
        if tag in IMPLIES:
            opened.imply(tag)
        node = Node(tag, *_attributes(raw)) if raw else Node(tag)
        opened.stack[-1].children.append(node)
        if tag in WHOLE:
            for outer in reversed(opened.stack):
                if outer.holds:
                    break
                outer.holds = True
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            until = page.find(">", end.start()) if end else -1
            node.children.append(page[at : end.start() if until >= 0 else len(page)])
            at = until + 1 if until >= 0 else len(page)
            continue
        if not closed or tag in BLOCKS:
            opened.push(node)
    return root


def _post_order(root: Node) -> list[Node]:
    """All elements, children before parents; without recursion, as pages may nest deeply."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node))
    order.reverse()
    return order


def _word_hash(text: str) -> int:
    from xxhash import xxh64_intdigest
    return xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def hash_subtrees(root: Node) -> dict[int, bool]:
    """Sets each element's hash; returns the hashes of elements that hold text."""
    found: dict[int, bool] = {}
    for n in _post_order(root):
        parts, text = [n.tag, *sorted(n.names | n.ids)], False
        for c in n.children:
            if isinstance(c, Node):
                parts.append(f"{c.hash:x}")
                text |= c.hash in found
            elif s := _SPACE.sub(" ", c).strip():
                parts.append("=" + s)
                text = True
        n.hash = _word_hash("\x00".join(parts))
        if text:
            found[n.hash] = True
    return found


def _is_main(n: Node, inside: bool) -> bool:
    """Whether tag and names let the element stay; inside: it lies in a marked article."""
    if n.hidden or n.tag in DROPPED or not inside and n.tag == "header":
        return False
    if n.tag in WHOLE or n.holds:
        return True
    if inside and n.tag not in PARTS:
        return not n.names & ADVERTS
    names = n.names if n.tag in HEADINGS or inside and n.tag == "section" else n.names | n.ids
    return not names & (NOT_MAIN - TEXT_NAMES if inside else NOT_MAIN | PAGE_ONLY)


def _marked(root: Node) -> list[Node]:
    """The outermost article elements in page order; if the page has none, the outermost main elements."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(root, False)]
    while todo:
        n, inside = todo.pop()
        if n.tag in found and _is_main(n, True):
            if n.tag == "article" or not inside:
                found[n.tag].append(n)
            if n.tag == "article":
                continue
            inside = True
        elif n is not root and not _is_main(n, inside):
            continue
        todo.extend((c, inside) for c in reversed(n.children) if isinstance(c, Node))
    return found["article"] or found["main"]


def _without_template(n: Node, template: frozenset[int]) -> list[Node | str]:
    """The children that stay. A cell, or an element amid text of its parent, is no template by itself."""
    if not template:
        return n.children
    amid = any(isinstance(c, str) and c.strip() for c in n.children)
    return [c for c in n.children if isinstance(c, str) or c.hash not in template or c.tag in WHOLE or c.tag in ("td", "th")
            or amid and c.tag not in BLOCKS]


def main_text(root: Node, template: frozenset[int], marked: list[Node] | None = None) -> str:
    """The blocks of the page's main text; template: hashes of subtrees to delete outside a marked article.

    Elements that hold the page as a whole (html, body) are never taken for
    template. marked: what _marked found, if known.
    """
    marked = _marked(root) if marked is None else marked
    blocks: list[str] = []
    run: list[str] = []

    def end_block() -> None:
        s = _SPACE.sub(" ", entities.unescape("".join(run))).strip()
        if s:
            blocks.append(s)
        run.clear()

    for top in marked or [root]:
        inside = top is not root
        work: list[Node | str | None] = [top]
        while work:
            c = work.pop()
            if c is None:
                end_block()
            elif isinstance(c, str):
                run.append(c)
            elif c is top or _is_main(c, inside):
                if c.tag == "br":
                    run.append(" ")
                block = c.tag in BLOCKS or c is top
                if block:
                    end_block()
                    work.append(None)
                work.extend(reversed(c.children if top.tag == "article" else _without_template(c, template)))
        end_block()
    return "\n".join(blocks)


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in tv.rechunk(batches, tv.text_sizes("html"), CHUNK_BYTES):
        found: dict[tuple[str, int], list[int]] = {}  # by host and page
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            page = page or ""
            key = host, _word_hash(page)
            if key not in found:
                root = parse(page)
                # 0 stands for the page itself
                found[key] = [_word_hash(main_text(root, frozenset())), 0, *hash_subtrees(root)]
        ends = np.cumsum([0, *(len(v) - 1 for v in found.values())])
        hashes = np.array([h for v in found.values() for h in v[1:]], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.string()),
             pa.array(np.array([v[0] for v in found.values()], dtype=np.uint64).view(np.int64)),
             pa.array(np.array([h for _, h in found], dtype=np.uint64).view(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes))], names=["host", "content", "page", "hashes"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, template array<long>) of the hosts with a template; pages: (host, html).

    Pages of one host with the same main text count once, by the one with the
    lowest hash. A host's template has at most (elements of a page) /
    TEMPLATE_SHARE entries, however many pages it has.
    """
    different = pages.select("host", "html").mapInArrow(_hasher, "host string, content long, page long, hashes array<long>") \
        .groupBy("host", "content").agg(F.min_by("hashes", "page").alias("hashes"))
    counts = written(different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash")
                     .agg(F.count("*").alias("n")).where(F.col("n") >= TEMPLATE_PAGES), "subtrees")
    total = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    return (counts.where("hash <> 0").join(total, "host").where(F.col("n") >= F.col("pages") * TEMPLATE_SHARE)
            .groupBy("host").agg(F.collect_list("hash").alias("template")))


def _extractor(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tv.rechunk(batches, tv.text_sizes("html"), CHUNK_BYTES):
            known: dict[str, frozenset[int]] = {}
            out = []
            for host, template, page in zip(b.column("host").to_pylist(), b.column("template"), b.column("html").to_pylist()):
                if host not in known:
                    known[host] = frozenset(np.array(template.as_py() or [], dtype=np.int64).view(np.uint64).tolist())
                root = parse(page or "")
                marked = _marked(root)
                if known[host] and not (marked and marked[0].tag == "article"):
                    hash_subtrees(root)
                out.append(main_text(root, known[host], marked))
            yield pa.RecordBatch.from_arrays([b.column("id").cast(id_type), b.column("url"), pa.array(out, pa.string())],
                                             names=["id", "url", "text"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every row of pages.

    text: the main text's blocks joined by newlines, character references
    decoded, white space inside a block one space; empty for null or empty html
    and for pages without main text. Pages without url form one host. Repeated
    rows give a text each and count as one page. Broken markup is read as far as it goes;
    text of any length and depth is read whole. Other columns are not read.
    """
    ship(pages)
    id_field = pages.schema[id_col].dataType
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    known = templates(source)
    busy = _busy_hosts(source)
    split = F.col("host").isin(busy) if busy else F.lit(False)
    salt = F.when(split, F.pmod(F.xxhash64("id", "html"), F.lit(SALTS))).otherwise(0).cast("int").alias("salt")
    salts = F.when(split, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    marked = source.select("*", salt).join(known.select("host", "template", F.explode(salts).alias("salt")), ["host", "salt"], "left")
    return marked.mapInArrow(_extractor(to_arrow_type(id_field)), f"id {id_field.simpleString()}, url string, text string") \
        .withColumnRenamed("id", id_col)


def _busy_hosts(source: DataFrame) -> list[str]:
    """Hosts with more than a BUSY_SHARE of all pages: at most 1 / BUSY_SHARE names."""
    counts = source.groupBy("host").agg(F.count("*").alias("n"))
    total = source.count()
    return [r["host"] for r in counts.where(F.col("n") > total * BUSY_SHARE).select("host").collect()]


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns: the text and its code points."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
