"""Main text of web pages by wrapper induction.

Pages of one host come from one wrapper. Of each host up to `REFERENCES` pages, taken by a
hash of the id, serve as references. Every page's DOM tree is aligned with its host's
references by simple tree matching (top-down, children in order, largest number of
matched nodes). A reference node is constant where the aligned node has the same text;
nodes that are constant on at least `CONSTANT` of the host's other, different pages (two at
least) are the template, all else are slots. Pages with equal text count once, so that copies
of an article don't make it a template.

A page's text is that of its slots, without elements whose tag, role, class or id says that
they are menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader
comments. Where a page has article or main elements, the text is theirs, and constancy
doesn't take away their paragraphs, headings, tables and quotations. Blocks are joined in page order.

A host's pages are spread over all tasks. The references go along by broadcast if their
measured size is small, else by a join on host and salt. Counts are summed by host and node.

Results: every row comes out; null or empty html has the empty text. A null or odd url
belongs to the host ''. Repeated rows come out as often as they come in. Further columns
play no part.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Generator, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.store import saved
from barwright.llm.words import steps

REFERENCES, CONSTANT, OTHERS = 2, 0.5, 2
SMALL_BYTES, SALTS = 16 << 20, 64

# fixed values: element names of HTML and words that name page furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
AWAY = frozenset("head nav footer aside form script style noscript template iframe svg math button select textarea dialog menu object canvas audio video".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote table ul ol dl figure".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
FURNITURE = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login comment comments commentlist reply replies respond disqus sidebar widget widgets related "
    "recommended share sharing social menu nav navbar navigation breadcrumb breadcrumbs pagination pager header masthead footer copyright search toolbar".split()
)
# class words that say that a name speaks of a page's parts, or of an article's own head, not of furniture
NOT_FURNITURE = frozenset("has with no without".split())
OWN_HEAD = frozenset("article post entry content story title headline".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = frozenset("ul ol dl table select article section div body main td th blockquote".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
READ = frozenset("class id role style hidden aria-hidden".split())
_NAME = re.compile(r"[^a-z0-9]+")


class Node:
    """An element: its label for matching, children (elements and texts), and place in document order."""

    __slots__ = ("tag", "label", "away", "kids", "text", "size", "at")

    def __init__(self, tag: str, label: str, away: bool):
        self.tag, self.label, self.away = tag, label, away
        self.kids: list = []
        self.text = 0
        self.size = 1
        self.at = 0


@lru_cache(maxsize=4096)
def _described(tag: str, attributes: str) -> tuple[str, bool]:
    """Label of an element, and whether its tag or attributes say that it isn't content."""
    found = {}
    for name, a, b, c in _ATTR.findall(attributes):
        if name.lower() in READ:
            found.setdefault(name.lower(), html.unescape(a or b or c).lower())
    names = [set(_NAME.split(name)) for key in ("class", "id") for name in found.get(key, "").split()]
    furniture = any(n & (FURNITURE - {"header"} if n & OWN_HEAD else FURNITURE) for n in names if not n & NOT_FURNITURE)
    words = set().union(*names)
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    away = tag in AWAY or found.get("role") in ROLES or hidden or (tag not in ("body", "html", "article", "main") and furniture)
    away = away or (tag == "article" and bool(words & {"comment", "comments", "reply", "ad", "ads", "related", "widget"}))
    return f"{tag}.{found.get('class', '')}", away


def parse(page: str) -> Node:
    """DOM tree of a page; end tags that HTML lets one leave out are supplied."""
    root = Node("", "", False)
    stack = [root]
    at = 0
    match = _TOKEN.search(page, 0)
    while match:
        if match.start() > at:
            stack[-1].kids.append(page[at : match.start()])
        at = match.end()
        tag = match[2]
        if tag:
            tag = tag.lower()
            if match[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
            else:
                if tag not in INLINE:
                    _close(stack, {"p"}, tag)
                if tag in CLOSES:
                    _close(stack, CLOSES[tag], tag)
                # long attributes are read whole as well, they are only not remembered
                label, away = (_described if len(match[3]) < 400 else _described.__wrapped__)(tag, match[3])
                node = Node(tag, label, away)
                stack[-1].kids.append(node)
                if tag in RAW and not match[3].endswith("/"):
                    end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
                elif tag not in VOID and not match[3].endswith("/"):
                    stack.append(node)
        match = _TOKEN.search(page, at)
    if at < len(page):
        stack[-1].kids.append(page[at:])
    _finish(root)
    return root


def _close(stack: list[Node], tags: set[str], opened: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in BARRIER and not (opened in ("td", "th", "tr") and stack[i].tag in ("td", "th")):
            return


def _finish(root: Node) -> None:
    """Places in document order, sizes, and a hash of each subtree's text; without recursion, as trees can be deep."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        node.at = len(order)
        order.append(node)
        todo += [k for k in reversed(node.kids) if isinstance(k, Node)]
    for node in reversed(order):
        parts = [k.text if isinstance(k, Node) else " ".join(k.split()) for k in node.kids]
        node.size = 1 + sum(k.size for k in node.kids if isinstance(k, Node))
        node.text = _text_hash(node.label, parts)


def _text_hash(label: str, parts: list) -> int:
    """The same in every process, unlike hash() of a string."""
    return hash((_string_hash(label), *(p if isinstance(p, int) else _string_hash(p) for p in parts if p != "")))


def _string_hash(s: str) -> int:
    b = s.encode()
    return zlib.crc32(b) << 32 | zlib.adler32(b)


def _elements(node: Node) -> list[Node]:
    return [k for k in node.kids if isinstance(k, Node)]


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching of two trees with one label: matched nodes, children in order.

    Subtrees that differ are matched in turn; they wait on a stack of their own, so trees may be of any depth.
    """
    stack, result = [_matching(a, b)], None
    while stack:
        try:
            p, q = stack[-1].send(result)
            stack.append(_matching(p, q))
            result = None
        except StopIteration as end:
            stack.pop()
            result = end.value
    return result


def _matching(a: Node, b: Node) -> Generator[tuple[Node, Node], list[tuple[Node, Node]], list[tuple[Node, Node]]]:
    """Asks for the matching of pairs of children, is sent it, and returns that of `a` and `b`."""
    out = [(a, b)]
    x, y = _elements(a), _elements(b)
    lo = 0
    while lo < min(len(x), len(y)) and x[lo].text == y[lo].text and x[lo].label == y[lo].label:
        out.append((x[lo], y[lo]))
        lo += 1
    hi = 0
    while hi < min(len(x), len(y)) - lo and x[-1 - hi].text == y[-1 - hi].text and x[-1 - hi].label == y[-1 - hi].label:
        out.append((x[-1 - hi], y[-1 - hi]))
        hi += 1
    x, y = x[lo : len(x) - hi], y[lo : len(y) - hi]
    if not x or not y:
        return out
    pairs = {}
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        row, up = best[i + 1], best[i]
        for j, q in enumerate(y):
            got = 0
            if p.label == q.label:
                if p.text == q.text:
                    got = 2 * p.size
                elif p.size == 1 or q.size == 1:
                    got = 1
                else:
                    sub = pairs[i, j] = yield p, q
                    got = sum(2 * m.size if m.text == n.text else 1 for m, n in sub)
            row[j + 1] = max(up[j + 1], row[j], up[j] + got if got else 0)
    i, j = len(x), len(y)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out += pairs.get((i, j)) or [(x[i], y[j])]
    return out


def same_nodes(page: Node, reference: Node) -> dict[int, int]:
    """Nodes of the page that are aligned with a reference node of the same text: page place to reference place."""
    found: dict[int, int] = {}
    for a, b in align(page, reference):
        if a.text == b.text and a.at not in found:
            found.update(zip(range(a.at, a.at + a.size), range(b.at, b.at + b.size), strict=True))
    return found


def main_text(page: Node, template: set[int]) -> str:
    """Text of a page whose nodes in `template` (by place) are constant on its host."""
    todo, inside = [page], []
    while todo:  # the outermost article and main elements
        node = todo.pop()
        if node.away and node.tag:
            continue
        if node.tag in ("article", "main"):
            inside.append(node)
        else:
            todo += reversed(_elements(node))
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in inside or [page]:
        walk: list = [(top, bool(inside))]
        while walk:
            node, prose = walk.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                line.append(node)
            elif node.tag == "br":
                line.append(" ")
            elif not (node.away or (node.tag == "header" and not prose) or (node.at in template and not (prose and (node.tag in PROSE or node.tag in INLINE or node is top)))):
                block = node.tag not in INLINE
                if block:
                    flush()
                    walk.append((None, prose))
                walk += [(k, prose) for k in reversed(node.kids)]
        flush()
    return "\n".join(blocks)


def hosts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, page) of every row."""
    host = F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce("html", F.lit("")).alias("page"))


def _with_references(rows: DataFrame) -> DataFrame:
    """`rows` with refs (id, page) of the host, by broadcast if they are measured as small."""
    draws = [F.xxhash64(F.lit(i), F.col("page_id"), F.xxhash64("page")) for i in range(REFERENCES)]
    tops = [F.min_by(F.struct("page_id", "page"), d).alias(f"r{i}") for i, d in enumerate(draws)]
    refs = saved(rows.groupBy("host").agg(*tops).select("host", F.array(*(f"r{i}" for i in range(REFERENCES))).alias("refs")), "html-references")
    held = refs.agg(F.sum(F.aggregate("refs", F.lit(0).cast("long"), lambda n, r: n + F.octet_length(r["page"])))).first()[0] or 0
    if held <= SMALL_BYTES:
        return rows.join(F.broadcast(refs), "host")
    refs = refs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "page"), F.lit(SALTS)).cast("int")).join(refs, ["host", "salt"]).drop("salt")


class _References:
    """Parsed references of the hosts met last."""

    def __init__(self):
        self.of: dict[str, list[tuple[int | None, Node]]] = {}

    def get(self, host: str, refs: pa.Scalar) -> list[tuple[int | None, Node]]:
        if host not in self.of:
            if len(self.of) > 256:
                self.of.clear()
            self.of[host] = [(r["page_id"], parse(r["page"])) for r in refs.as_py()]
        return self.of[host]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of `pages` (page_id, url, html)."""
    rows = _with_references(hosts(pages))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _References()
        for b in steps(batches, "page"):
            host, sign, ref, nodes = [], [], [], []
            for i, (h, text) in enumerate(zip(b.column("host").to_pylist(), b.column("page").to_pylist(), strict=True)):
                page = parse(text)
                for r, (_, reference) in enumerate(known.get(h, b.column("refs")[i])):
                    host.append(h)
                    # a reference doesn't count for itself, nor do its copies
                    sign.append(page.text)
                    ref.append(r)
                    nodes.append([] if page.text == reference.text else list(same_nodes(page, reference).values()))
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
            cols = [pa.array(x, k) for x, k in zip((host, sign, ref, nodes), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=["host", "sign", "ref", "nodes"])

    compared = rows.select("host", "page", "refs").mapInArrow(compare, "host string, sign long, ref int, nodes array<int>").dropDuplicates(["host", "sign", "ref"])
    compared = saved(compared, "html-compared")
    others = compared.filter(F.col("ref") == 0).groupBy("host").agg((F.count("*") - 1).alias("others"))
    constant = compared.select("host", "ref", F.explode("nodes").alias("node")).groupBy("host", "ref", "node").agg(F.count("*").alias("n"))
    constant = constant.join(others, "host").filter((F.col("others") >= OTHERS) & (F.col("n") >= CONSTANT * F.col("others")))
    template = saved(constant.groupBy("host").agg(F.collect_list(F.struct("ref", "node")).alias("template")), "html-template")
    if template.count() <= 10_000:  # hosts; a template is no larger than its host's references
        told = rows.join(F.broadcast(template), "host", "left")
    else:
        told = rows.join(template, "host", "left")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _References()
        constant_of: dict[str, list[set[int]]] = {}
        for b in steps(batches, "page"):
            out = []
            for i, (h, text) in enumerate(zip(b.column("host").to_pylist(), b.column("page").to_pylist(), strict=True)):
                page, refs = parse(text), known.get(h, b.column("refs")[i])
                if h not in constant_of:
                    if len(constant_of) > 256:
                        constant_of.clear()
                    got = b.column("template")[i].as_py() or []
                    constant_of[h] = [{x["node"] for x in got if x["ref"] == r} for r in range(len(refs))]
                gone: set[int] = set()
                for (_, reference), fixed in zip(refs, constant_of[h], strict=True):
                    if fixed:
                        gone |= {p for p, n in same_nodes(page, reference).items() if n in fixed}
                out.append(main_text(page, gone))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return told.select("page_id", "url", "host", "page", "refs", "template").mapInArrow(slots, f"page_id {fields['page_id']}, url string, text string")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))
