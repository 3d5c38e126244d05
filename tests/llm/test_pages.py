import html
import re

import pytest
from llm_cases import CLASHES, collected, prose
from pyspark.sql import types as T

from quadrille.llm import pages

SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())]
    + [T.StructField("html", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in CLASHES if n != "text"]
)


def extracted(spark, rows):
    extra = ["?"] * (len(SCHEMA) - 3)
    df = spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)
    out = pages.extract_main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    return collected(out, "page_id", "text", "n_chars")


def main_text(source):
    return pages._main_text(pages.read_page(source), frozenset())


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three", "one\ntwo three"),
        ("<article><h1>T</h1><p><b>a &lt;b&gt;<p>c</article><footer>x</footer>", "T\na <b>\nc"),
        ("<nav><ul><li><a href='/x'>menu</a></ul></nav><p>body</p>", "body"),
        ("<div class='ad'>buy</div><p>body</p>", "body"),
        ("<div class=\"side-bar sidebar\">s</div><p>a  \n b</p>", "a b"),
        ("<script>var t='</p><p>no';</script><p>yes</p>", "yes"),
        ("<style>p{}</style><title>t</title><p>yes", "yes"),
        ("<p>a<!-- <p>hidden</p> -->b</p>", "ab"),
        ("<p title='a > b'>x</p>", "x"),
        ("<form><p>name</p></form><section id=comments><p>nice</p></section><p>x", "x"),
        ("<header>site</header><article><header><h1>T</h1></header>x</article>", "T\nx"),
        ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"),
        ("<p>a</div></span>b</p></p>c", "ab\nc"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<script>never closed <p>x", ""),
        ("<p>open <b", "open <b"),
        ("<p>&#65;&#x42;&nbsp;C&unknown;</p>", "AB C&unknown;"),
        ("<div role=navigation>m</div><main><p>x</main>", "x"),
        ("<article class='comments-on-life'><p>x</p></article>", "x"),
    ],
)
def test_blocks(source, text):
    assert main_text(source) == text


def test_style_tree_removes_what_a_site_repeats(spark):
    import random

    r = random.Random(5)
    rows, expected = [], []
    for k in range(40):
        body = [prose(r, 12) for _ in range(r.randint(1, 5))]
        paragraphs = "".join(f"<p>{b}</p>" for b in body)
        # nothing but the tree tells that these are no part of the text
        source = (
            "<html><body><div class='top'><span>All offers of the week</span></div>"
            f"<div class='c1'>{paragraphs}</div>"
            "<div class='low'>Made with care</div></body></html>"
        )
        rows.append((k, f"https://Site.example.org/{k}", source))
        expected.append("\n".join(body))
    rows.append((100, "https://other.example.org/", rows[0][2]))
    rows.append((101, None, rows[0][2]))
    rows.append((None, "not an address", None))
    out = {i: (t, n) for i, t, n in extracted(spark, rows)}
    for k, text in enumerate(expected):
        assert out[k] == (text, len(text))
    whole = f"All offers of the week\n{expected[0]}\nMade with care"
    assert out[100][0] == out[101][0] == whole  # a lone page has no site to compare with
    assert out[None] == ("", 0)


def test_copies_of_an_article_stay(spark):
    source = "<body><div class='m'>menu</div><article><p>the same text</p></article>"
    rows = [(1, f"http://a.example.com/{k}", source) for k in range(9)]
    assert extracted(spark, rows) == [(1, "the same text", 13)] * 9


@pytest.mark.parametrize("copies, distinct", [(3, 1), (65, 35), (7, 5)])
def test_copies_do_not_make_a_page_boilerplate(spark, copies, distinct):
    """In a plain div beside distinct pages; copies may differ in what is dropped."""
    import random

    r = random.Random(6)

    def page(number, text):
        return (
            f"<html><head><title>{number}</title></head><body><div class='m'>menu</div>"
            f"<div class='c1'><p>{text}</p></div><footer>{number}</footer></body></html>"
        )

    texts = ["the same text"] * copies + [prose(r, 12) for _ in range(distinct)]
    rows = [
        (k, f"http://a.example.com/{k}", page(k if k % 2 else 0, t))
        for k, t in enumerate(texts)
    ]
    menu = "" if 1 + distinct >= pages.LEAST_PAGES else "menu\n"
    out = {i: t for i, t, _ in extracted(spark, rows)}
    assert out == {k: menu + t for k, t in enumerate(texts)}


def test_a_page_keeps_some_text(spark):
    """Distinct pages whose article is the same, and which hold nothing else."""
    rows = [
        (k, f"http://a.example.com/{k}", f"<div class='c1'><p>notice</p></div><p>{k}</p>")
        for k in range(9)
    ]
    rows += [(9, "http://a.example.com/9", "<div class='c1'><p>notice</p></div>")]
    out = {i: t for i, t, _ in extracted(spark, rows)}
    assert out == {k: str(k) for k in range(9)} | {9: "notice"}


@pytest.mark.parametrize(
    "part, text",
    [
        ("<section id='discussion'><p>x</p></section>", "x"),
        ("<h2 id='related-work'>x</h2>", "x"),
        ("<h2 class='search'>x</h2>", "x"),
        ("<h3 id='search-algorithms'>x</h3><p>y</p>", "x\ny"),
        ("<div class='social-history'><p>x</p></div>", "x"),
        ("<p class='notice-period'>x</p>", "x"),
        ("<div class='box ad'>x</div><p>y</p>", "y"),
        ("<div class='discussion'>x</div><p>y</p>", "y"),
        ("<div class='sidebar'><div class='discussion'>x</div></div><p>y</p>", "y"),
    ],
)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_names_inside_an_article(tag, part, text):
    assert main_text(f"<{tag}>{part}</{tag}>") == text
    assert main_text(f"<{tag}><div class='c1'>{part}</div></{tag}>") == text


def test_ambiguous_names_inside_an_article(spark):
    """Text that varies by page stays on a host with enough pages, other text goes."""

    def page(number):
        return (
            f"<article><p>{number}</p><section class='discussion'><p>d{number}</p></section>"
            "<div class='share'><p>send it on</p></div>"
            f"<div class='ad'>buy {number}</div></article>"
        )

    rows = [(k, f"http://a.example.com/{k}", page(k)) for k in range(6)]
    rows += [(k, f"http://b.example.com/{k}", page(k)) for k in range(10, 13)]
    out = {i: t for i, t, _ in extracted(spark, rows)}
    large = {k: f"{k}\nd{k}" for k in range(6)}
    assert out == large | {k: str(k) for k in range(10, 13)}


def test_long_and_odd_pages(spark):
    rows = [
        (1, "http://x.example.com", "<p>" * 20000 + "x"),
        (2, "http://x.example.com", "<div>" * 3000 + "y"),
        (3, "http://x.example.com", "<" * 50000),
        (4, "http://x.example.com", "<a \"" * 3000),
        (5, "http://x.example.com", "word " * 100000),
        (6, "http://x.example.com", ""),
    ]
    out = {i: (t, n) for i, t, n in extracted(spark, rows)}
    assert out[1][0] == "x" and out[2][0] == "y" and out[3][1] == 50000
    assert out[5][1] == 499999 and out[6] == ("", 0)


def test_given_pages(spark):
    """Against a split of the article by its tags."""
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {i: t for i, t in collected(pages.extract_main_text(table), "page_id", "text")}
    for i, source in collected(table, "page_id", "html"):
        article = re.search("<article>(.*?)</article>", source, re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        assert out[i] == "\n".join(b for b in lines if b)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pages.extract_main_text(df).count() == 0


# --- site trees inside the article ----------------------------------------------------


@pytest.mark.parametrize("limit", [pages.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_what_a_site_repeats_goes_from_the_article_too(spark, tag, limit, monkeypatch):
    monkeypatch.setattr(pages, "BROADCAST_BYTES", limit)

    def page(number):
        return (
            f"<{tag}><h2>Report</h2><div class='c1'><p class='lead'>p{number}</p>"
            "<div class='x7'>Sign up for our letter</div><p class='n'>A note of the site</p>"
            f"<h3>Details</h3><div class='x8'><p>q{number}</p></div></div></{tag}>"
        )

    rows = [(k, f"http://a.example.com/{k}", page(k)) for k in range(6)]
    rows += [(k, f"http://b.example.com/{k}", page(k)) for k in range(10, 13)]
    # the article itself stays, whatever a host has in it
    rows += [(k, f"http://c.example.com/{k}", f"<{tag}><p>same</p></{tag}><p>{k}</p>") for k in range(20, 26)]
    out = {i: t for i, t, _ in extracted(spark, rows)}
    assert all(out[k] == f"Report\np{k}\nDetails\nq{k}" for k in range(6))
    small = "Report\np{0}\nSign up for our letter\nA note of the site\nDetails\nq{0}"
    assert all(out[k] == small.format(k) for k in range(10, 13))
    assert all(out[k] == str(k) for k in range(20, 26))


@pytest.mark.parametrize(
    "part",
    [
        "<section id='comments'><article><p>Nice.</p></article></section>",
        "<div class='comments-area'><p>Nice.</p></div>",
        "<ol class='comment-list'><li>Nice.</ol>",
        "<div id='reader-comments'>Nice.</div>",
        "<div class='newsletter-signup'>Write to us.</div>",
        "<div class='cookie-banner'>We use cookies.</div>",
        "<div class='box article-ad'>Buy.</div>",
        "<section id=newsletter><p>Letter.</p></section>",
        "<form><p>Name</p></form>",
    ],
)
def test_what_is_no_part_of_an_article(part):
    assert main_text(f"<main><p>x</p>{part}<p>y</p></main>") == "x\ny"


@pytest.mark.parametrize(
    "part",
    ["<section id='ad-hoc-methods'><p>z</p></section>", "<div id='menu-of-the-day'>z</div>"],
)
def test_parts_of_ids_count_where_the_tree_agrees(spark, part):
    def page(number, body):
        return f"<article><p>{number}</p>{body}</article>"

    rows = [(k, f"http://a.example.com/{k}", page(k, part.replace("z", f"z{k}"))) for k in range(6)]
    rows += [(k, f"http://b.example.com/{k}", page(k, part)) for k in range(10, 16)]
    out = {i: t for i, t, _ in extracted(spark, rows)}
    assert out == {k: f"{k}\nz{k}" for k in range(6)} | {k: str(k) for k in range(10, 16)}


@pytest.mark.parametrize(
    "source, text",
    [
        ("<p title=don't>It was a good day.</p><p>Isn't it so</p>", "It was a good day.\nIsn't it so"),
        ("<p title='a>b' class = x>y</p>", "y"),
        ("<p a=\"1\"b='2'c=3 d>y</p>", "y"),
        ("<div class=ad>no</div><p>y</p>", "y"),
        ("<div class=x class=ad>y</div>", "y"),
        ("<div data-class='ad' title=\"class='ad'\">y</div>", "y"),
        ("<div/class='ad'>no</div>y", "y"),
        ("<p>a <![CDATA[abc > d & <b>]]> e</p>", "a abc > d & <b> e"),
        ("<p>a<br/>b<img alt='>'>c</p>", "a b c"),
        ("<a href=/x/>link</a>", "link"),
    ],
)
def test_attributes(source, text):
    assert main_text(source) == text


@pytest.mark.parametrize(
    "source, text",
    [
        ("<b>" * 50_000 + "x", "x"),
        ("<b>" * 20_000 + "<p>x</p>" * 20_000, "\n".join("x" * 20_000)),
        ("<div>" * 20_000 + "<p>x</p>" * 20_000, "\n".join("x" * 20_000)),
        ("<b>" * 30_000 + "</i>" * 30_000 + "x", "x"),
        ("<main>" + "<section>y" * 20_000, "\n".join("y" * 20_000)),
        ("<p " + "a=' " * 60_000 + ">x", None),
    ],
)
def test_deep_pages_take_time_and_memory_in_proportion(source, text):
    import time
    import tracemalloc

    tracemalloc.start()
    start = time.perf_counter()
    page = pages.read_page(source)
    rows = list(pages._tree_rows(page))
    found = pages._main_text(page, frozenset([1]), constant=frozenset([1]))
    seconds, (_, peak) = time.perf_counter() - start, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert text is None or found == text
    assert seconds < 15 and peak < 100e6 and len(rows) <= len(page.nodes)


def test_importance_against_brute_force(spark):
    """Entropies over the distinct pages of a host, from all paths of all pages."""
    import math
    import random
    from collections import Counter, defaultdict

    r = random.Random(9)

    def page():
        items = "".join(f"<p>{r.choice('xyz')}</p>" for _ in range(r.randint(0, 3)))
        part = f"<ul><li>{r.choice('uv')}</ul>" if r.random() < 0.5 else ""
        return f"<body><nav>a</nav><div class='c'>{items}</div><div class='d'>w{part}</div></body>"

    sources = [(f"h{k % 3}", page()) for k in range(60)]
    sources += [("small", page()) for _ in range(2)]
    trees = defaultdict(dict)
    for host, source in sources:
        read = pages.read_page(source)
        looks, texts = defaultdict(list), defaultdict(list)
        for n, node in enumerate(read.nodes):
            looks[node.path].append(tuple(node.children))
            texts[node.path].append(
                tuple(b for b, holder in read.blocks if n in ancestors(read, holder))
            )
        # equal texts are copies, and have equal trees here
        tree = {p: (tuple(looks[p]), tuple(texts[p])) for p in looks}
        copy = pages._main_text(read, frozenset())
        assert trees[host].setdefault(copy, tree) == tree
    found = pages.site_importance(spark.createDataFrame(sources, "host string, html string"))
    mine = {(row["host"], row["path"]): row for row in found.collect()}
    expected = {}
    for host, copies in trees.items():
        for path in {p for tree in copies.values() for p in tree}:
            importance, single = 0.0, None
            for kind, weight in ((0, 0.3), (1, 0.7)):
                values = Counter(t[path][kind] for t in copies.values() if path in t)
                n, single = values.total(), len(values) == 1
                same = sum(c * math.log(c) for c in values.values())
                enough = n >= pages.LEAST_PAGES
                importance += weight * (1 - same / (n * math.log(n)) if enough else 1)
            expected[host, path & ~1] = (pytest.approx(importance), n, single and enough)
    assert len(mine) == len(expected) > 12
    for key, row in mine.items():
        assert (row["importance"], row["n"], row["constant"]) == expected[key]


def ancestors(read, number):
    out = set()
    while number >= 0:
        out.add(number)
        number = read.nodes[number].parent
    return out
