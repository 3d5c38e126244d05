"""Main text of web pages by site style trees.

The document trees of all pages of a host are merged: a node of the merged tree is a path
of elements with their classes.  For each node the entropy over pages of its presentation
(the sequence of its children) and of its content (the text below it) tells how much it
varies; what is the same on every page of a site belongs to the site and not to the page.
A branch whose importance, the weighted mean of both entropies, is low is removed from
each page, and so is one whose element or class says that it is no part of an article.
Inside an article the tree removes what has the same text on all pages of a host; names
say less there, and a branch whose name could be the article's own stays if it varies.
The elements that mark the article itself and its headings are kept, and copies of a page
count as one.

A page is read in one pass; what it takes grows with its length, however deep its elements
are nested.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored

#: Weight of the content against the presentation.
CONTENT_WEIGHT = 0.7
#: Branches below this importance are removed.
LEAST_IMPORTANCE = 0.3
#: Distinct pages of a host that a node must be on before its entropy counts.
LEAST_PAGES = 4
#: Bytes of unimportant paths that are sent to all tasks; more meet the pages in a shuffle.
BROADCAST_BYTES = 64 << 20
#: A host with more than one page in so many is divided then; there are fewer such hosts.
HOT_HOSTS = 10_000

# HTML elements by their part in a page
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend"
    " li main nav noscript ol option p pre section summary table tbody td tfoot th thead"
    " title tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that an element of the same group ends.
SIBLINGS = (
    frozenset(["li"]),
    frozenset(["dt", "dd"]),
    frozenset(["option"]),
    frozenset(["tr"]),
    frozenset(["td", "th"]),
)
ARTICLE = frozenset(["article", "main"])
OUTSIDE = frozenset(
    "aside button datalist dialog footer form head iframe menu nav noembed noframes"
    " noscript object script select style svg template textarea title".split()
)
OUTSIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar"
    " navigation search".split()
)
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright discussion disqus footer login masthead menu modal"
    " nav navbar navigation newsletter notice notices popup promo related replies respond"
    " search share sharing sidebar signup social sponsor sponsored subscribe toolbar"
    " widget".split()
)
#: Of these names the ones that parts of an article have too.  Inside an article they
#: count as whole classes only, and not where the text varies by page.
AMBIGUOUS_NAMES = frozenset(
    "banner consent copyright discussion footer notice notices related replies respond"
    " search share sharing social sponsor widget".split()
)
#: What readers write below an article, also where it varies by page.
READER_NAMES = frozenset("comment comments disqus".split())
#: Elements that hold others.  In their names inside an article parts count too.
CONTAINERS = frozenset("aside details dialog div dl fieldset form nav ol section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Named so on a page they are outside; inside an article they are its own.
OUTER_ONLY = frozenset(["header"])

# attributes as the states of an HTML tokenizer read them: a quote opens a value only where
# the value begins, so unquoted values may hold quotes
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)"
    rf"(?P<rest>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+)*+)>"
    r"|<[A-Za-z/][^>]*>|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+)))?+"
)
_NAME = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Node:
    """An open element.  Its path is a digest of its parent's and its own step."""

    tag: str
    path: int
    outside: bool
    inside: bool
    ambiguous: bool
    number: int  # among the nodes of the page
    parent: int
    block: int  # place in the stack of the nearest block, its own included
    begin: int  # first block of text below it, and the one behind the last
    end: int = -1
    children: list[str] = field(default_factory=list)

    @property
    def key(self) -> int:
        """The path; odd for an ambiguous name."""
        return self.path & ~1 | self.ambiguous


@dataclass
class Page:
    """Blocks of text with the number of the element that holds them, and the elements."""

    blocks: list[tuple[str, int]] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)


def _attributes(rest: str) -> tuple[str, str, str]:
    """The classes, the id and the role, in lower case."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        name = m[1].lower()
        # of an attribute that comes twice the first counts
        if name in ("class", "id", "role") and name not in found:
            found[name] = (m[2] or m[3] or m[4] or "").lower()
    return found.get("class", ""), found.get("id", "").strip(), found.get("role", "").strip()


def _named_outside(tag: str, classes: list[str], own_id: str) -> tuple[bool, bool]:
    """Whether names inside an article say that an element is no part of it, or may say so.

    Whole classes do, for containers also parts of a class, their whole id, and parts of
    the id that speak of readers.  Other parts of an id may say so, and so may the names
    that an article's own elements have too.
    """
    whole = OUTSIDE_NAMES.intersection(classes)
    sure = not whole <= AMBIGUOUS_NAMES
    maybe = bool(whole)
    if tag in CONTAINERS:
        strong = OUTSIDE_NAMES - AMBIGUOUS_NAMES
        parts = set(_NAME.findall(own_id))
        sure = sure or not strong.isdisjoint(_NAME.findall(" ".join(classes)))
        sure = sure or own_id in strong or not READER_NAMES.isdisjoint(parts)
        maybe = maybe or not strong.isdisjoint(parts)
    return sure, maybe


def read_page(source: str) -> Page:
    """The blocks and elements of a page; every input gives some page.

    End tags close what they name if it is open.  A block ends an open paragraph, and
    items end their neighbours.  Line breaks are white space.
    """
    page = Page()
    root = Node("", _digest(""), False, False, False, -1, -1, 0, 0)
    stack, text = [root], []
    # how many elements of a name are open
    opened: dict[str, int] = {}

    def flush() -> None:
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            if block:
                page.blocks.append((block, stack[-1].number))
            text.clear()

    def close_to(depth: int) -> None:
        if stack[-1].block >= depth:
            flush()
        for node in stack[depth:]:
            node.end = len(page.blocks)
            opened[node.tag] -= 1
        del stack[depth:]

    at, size = 0, len(source)
    while at < size:
        m = _TOKEN.match(source, at)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["data"] is not None:
                text.append(html.escape(m["data"]))
            elif source[m.start()] != "<" or m.end() - m.start() == 1:
                text.append(m.group())
            continue
        tag = tag.lower()
        if m["end"]:
            if opened.get(tag):
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                close_to(depth)
            continue
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            text.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            depth = stack[-1].block
            open_tag = stack[depth].tag
            if open_tag == "p" or any(tag in g and open_tag in g for g in SIBLINGS):
                close_to(depth)
        parent = stack[-1]
        classes, own_id, role = _attributes(m["rest"]) if m["rest"] else ("", "", "")
        words = sorted(classes.split())
        inside = parent.inside or tag in ARTICLE
        # an article may be called anything; inline elements are part of their block
        outside = parent.outside or tag in OUTSIDE or role in OUTSIDE_ROLES
        ambiguous = False
        if inside and tag in BLOCKS and tag not in ARTICLE and tag not in HEADINGS:
            sure, ambiguous = _named_outside(tag, words, own_id)
            outside = outside or sure
        elif not inside and tag != "body" and tag in BLOCKS:
            names = {*_NAME.findall(classes), *_NAME.findall(own_id)}
            outside = outside or not OUTSIDE_NAMES.isdisjoint(names)
            if tag in OUTER_ONLY or not OUTER_ONLY.isdisjoint(names):
                outside = True
        step = f"{tag}.{'.'.join(words)}" if words else tag
        if not parent.children or parent.children[-1] != step:
            parent.children.append(step)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if m["rest"].endswith("/"):
            continue
        node = Node(
            tag,
            _digest(f"{parent.path}/{step}"),
            outside,
            inside,
            ambiguous,
            len(page.nodes),
            parent.number,
            len(stack) if tag in BLOCKS else parent.block,
            len(page.blocks),
        )
        page.nodes.append(node)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    close_to(1)
    return page


def _digest(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


# fixed values: a prime and a base of sums that tell lists of texts apart
_PRIME = (1 << 61) - 1
_BASE = 0x1D2C3B4A59687


def _tree_rows(page: Page) -> Iterator[tuple[int, int, int]]:
    """Key, presentation and content of each node; equal paths of a page are one node.

    The blocks below a node are neighbours, so its content is told by the difference of
    two running sums.
    """
    sums, powers = [0], [1]
    for block, _ in page.blocks:
        sums.append((sums[-1] * _BASE + _digest(block)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
    merged: dict[int, tuple[list[str], list[str]]] = {}
    keys: dict[int, int] = {}
    for node in page.nodes:
        if node.tag in BLOCKS:
            keys.setdefault(node.path, node.key)
            looks, texts = merged.setdefault(node.path, ([], []))
            looks.append(" ".join(node.children))
            count = node.end - node.begin
            content = (sums[node.end] - sums[node.begin] * powers[count]) % _PRIME
            texts.append(f"{count}:{content}")
    for path, (looks, texts) in merged.items():
        yield keys[path], _digest("|".join(looks)), _digest(" ".join(texts))


_NONE: frozenset[int] = frozenset()


def _main_text(
    page: Page,
    dull: frozenset[int],
    alike: frozenset[int] = _NONE,
    varied: frozenset[int] = _NONE,
    constant: frozenset[int] = _NONE,
) -> str:
    """Blocks that are left when outside and unimportant branches are removed.

    Unimportant branches stay where nothing would be left without them.  Branches that
    are only known to be ``alike`` on copies go where the page marks its article.  Inside
    it, branches with a ``constant`` text go, and those with an ambiguous name unless they
    are known to be ``varied``.
    """
    nodes = page.nodes
    held = [False] * len(nodes)
    for node in nodes:
        # a branch that holds the article goes with nothing
        if node.tag in ARTICLE and not node.outside:
            at = node.number
            while at >= 0 and not held[at]:
                held[at] = True
                at = nodes[at].parent
    if any(held):
        dull |= alike

    def unimportant(node: Node) -> bool:
        if node.ambiguous and (varied or node.key in constant):
            return node.key not in varied
        if node.inside or held[node.number]:
            own = not held[node.number] and node.tag in BLOCKS and node.tag not in HEADINGS
            return node.ambiguous or (own and node.key in constant)
        return node.ambiguous or node.key in dull

    # parents come before their children
    gone = [False] * len(nodes)
    for node in nodes:
        above = node.parent >= 0 and gone[node.parent]
        gone[node.number] = above or unimportant(node)
    own = [(b, n) for b, n in page.blocks if n < 0 or not nodes[n].outside]
    left = [b for b, n in own if n < 0 or not gone[n]]
    return "\n".join(left or [b for b, _ in own])


def site_importance(pages: DataFrame) -> DataFrame:
    """``host, path, importance, n, alike, constant`` of the nodes of the merged trees.

    ``pages`` has ``host`` and ``html``.  Pages of a host with the same text, as the
    elements and classes leave it, are copies and count once: what varies by page stays
    varied however often a page comes.  ``n`` pages have the node, and it is ``alike``
    where at least ``LEAST_PAGES`` rows, copies included, do not differ in it, and
    ``constant`` where as many distinct pages have the same text there.  The tree of a
    page, not its source, is shuffled to tell copies; they and counts of equal
    presentations and contents are combined before the shuffle, so a host or a page may
    hold any share of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                rows = batch.slice(part, 256)
                copies, bounds, nodes = [], [0], ([], [], [])
                for source in rows.column(1).to_pylist():
                    page = read_page(source)
                    copies.append(_digest(_main_text(page, frozenset())))
                    for row in _tree_rows(page):
                        for values, value in zip(nodes, row):
                            values.append(value)
                    bounds.append(len(nodes[0]))
                ends = pa.array(bounds, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(copies, pa.int64()),
                        *[
                            pa.ListArray.from_arrays(ends, pa.array(v, pa.int64()))
                            for v in nodes
                        ],
                    ],
                    ["host", "copy", "path", "look", "content"],
                )

    trees = map_arrow(
        pages.select("host", "html"),
        run,
        "host string, copy bigint, path array<bigint>, look array<bigint>,"
        " content array<bigint>",
    )
    # of copies with different surroundings always the same one
    single = trees.groupBy("host", "copy").agg(
        F.min(F.struct("path", "look", "content")).alias("tree"), F.count("*").alias("rows")
    )
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("node.look").alias("value")),
        F.struct(F.lit(1).alias("kind"), F.col("node.content").alias("value")),
    )
    nodes = single.select(
        "host",
        "rows",
        F.explode(F.arrays_zip("tree.path", "tree.look", "tree.content")).alias("node"),
    ).select("host", "rows", F.col("node.path").alias("path"), F.inline(kinds))
    counts = nodes.groupBy("host", "path", "kind", "value").agg(
        F.count("*").alias("c"), F.sum("rows").alias("rows")
    )
    weight = F.when(F.col("kind") == 1, CONTENT_WEIGHT).otherwise(1 - CONTENT_WEIGHT)
    spread = counts.groupBy("host", "path", "kind").agg(
        F.sum("c").alias("n"),
        F.sum(F.col("c") * F.log("c")).alias("same"),
        ((F.count("*") == 1) & (F.sum("rows") >= LEAST_PAGES)).alias("alike"),
        ((F.col("kind") == 1) & (F.count("*") == 1) & (F.sum("c") >= LEAST_PAGES)).alias(
            "constant"
        ),
    )
    entropy = F.when(F.col("n") < LEAST_PAGES, 1.0).otherwise(
        1 - F.col("same") / (F.col("n") * F.log("n"))
    )
    return spread.groupBy("host", "path").agg(
        F.sum(weight * entropy).alias("importance"),
        F.max("n").alias("n"),
        F.every("alike").alias("alike"),
        F.some("constant").alias("constant"),
    )


def extract_main_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """The main text of each page.

    One row per input row: the id, the address, ``text`` (blocks in page order, joined by
    line ends) and ``n_chars``.  A null or empty page has an empty text.  Pages without a
    host in their address are judged by themselves.  Repeated rows and null ids stay as
    they are; an empty table gives no rows; other columns are not read.

    Only paths that a host's pages have in common, and varied ones of ambiguous names,
    return to its pages, so their number follows the templates of a host and not its
    pages.  While all of them are few they are sent to all tasks, and no page is shuffled;
    beyond that they meet the pages by host, and hosts with many pages are divided.
    """
    host = F.lower(F.regexp_extract(url_column, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).alias("html"),
        F.when(host != "", host).alias("host"),
    )
    importance = site_importance(rows.where("host IS NOT NULL"))
    unimportant = F.col("importance") < LEAST_IMPORTANCE
    varied = ~unimportant & (F.col("n") >= LEAST_PAGES) & (F.expr("path & 1") == 1)

    def listed(condition):
        return F.sort_array(F.collect_list(F.when(condition, F.col("path"))))

    judged = ["dull", "alike", "varied", "constant"]
    conditions = [unimportant, F.col("alike"), varied, F.col("constant")]
    found = (
        importance.groupBy("host")
        .agg(
            *[listed(c).alias(name) for c, name in zip(conditions, judged)],
            F.max("n").alias("n"),
        )
        .withColumn("alike", F.when(F.col("n") < LEAST_PAGES, F.col("alike")))
        .withColumn("paths", sum((F.coalesce(F.size(c), F.lit(0)) for c in judged), F.lit(0)))
        .where("paths > 0")
    )
    found = stored(found.select("host", *judged, "paths"), "site_paths")
    size = found.agg(F.sum(F.col("paths") * 8 + F.octet_length("host") + 64)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    met = rows.join(F.broadcast(found), "host", "left") if small else _by_host(rows, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, *paths in zip(*map(batch.column, ["html", *judged])):
                known = [frozenset(p.as_py() or ()) for p in paths]
                texts.append(_main_text(read_page(source.as_py()), *known))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(list(map(len, texts)), pa.int64()),
                ],
                ["id", "url", "text", "n_chars"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    joined = met.select("id", "url", "html", *judged)
    out = map_arrow(joined, run, f"id {kind}, url string, text string, n_chars bigint")
    return out.withColumnRenamed("id", id_column).withColumnRenamed("url", url_column)


def _by_host(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the paths of their host; a host with many rows is divided into parts."""
    total = rows.count()
    often = rows.groupBy("host").agg(F.count("*").alias("pages"))
    # fewer than HOT_HOSTS hosts have more than that share of the rows
    hot = often.where(F.col("pages") * HOT_HOSTS > total).select(
        "host", F.ceil(F.col("pages") * HOT_HOSTS / F.lit(total)).cast("int").alias("parts")
    )
    parts = F.coalesce("parts", F.lit(1))
    salted = rows.join(F.broadcast(hot), "host", "left").withColumn(
        "salt", F.pmod(F.xxhash64("id", "url"), parts).cast("int")
    )
    copies = found.join(F.broadcast(hot), "host", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return salted.join(copies.drop("parts", "paths"), ["host", "salt"], "left")
