import html
import re
from collections import defaultdict

import pytest
from llm_fixtures import SF
from pyspark.sql import functions as F
from tessera.llm import html_extract as H
from tessera.llm import queries

SCHEMA = "page_id long, url string, html string"


def text(page):
    return H.main_text(H.parse(page))


def test_only_the_article_stays():
    page = """<!doctype html><html class="no-js"><head><title>T</title><meta charset=utf-8><style>p{}</style>
      <script>var t="<p>no</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
      <nav><ul><li><a href="/a">Home</a><li>More</ul></nav><div class="cookieNotice">We use cookies</div>
      <aside><article><p>Teaser</p></article></aside><!-- <p>no</p> -->
      <article id=main><header><h1>A &amp; B&nbsp; &lt;c&gt;</h1></header><div class="ad">Buy</div>
      <p>First <b>bold</b>
      line &copy &#8364;<span class="share-bar">Share</span> goes on.<br><p>Second<script>x()</script>half.
      <form><input><p>Your mail</p></form><ul><li>One<li>Two <i>three</ul>
      <table><tr><td>x<td>y</table><blockquote>Quote</blockquote>
      <noscript>off</noscript><section id="comments"><h2>Comments</h2><article><p>nice</p></article></section>
      <footer>By me</footer></article><div id="sidebar">Side</div><footer>&copy; Site</footer></body></html>"""
    assert text(page).split("\n") == ["A & B <c>", "First bold line © € goes on.", "Secondhalf.", "One", "Two three", "x", "y", "Quote"]


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain &lt; text", "plain < text"), ("a < b and c<d>e</d>", "a < b and ce"), ("<p>cut <a href='x", "cut"),
    ("<p>one<p>two</p></p>three", "one\ntwo\nthree"), ("<p title='a > b'>x</p>", "x"), ("<p title=it's>x</p>y", "x\ny"),
    ("<b><p>x</b>y</p>", "xy"), ("<p>&bogus; &#x41;&#66 &am", "&bogus; AB &am"), ("<div>a<!-- b > c -->d</div><!-- open <p>e", "ad"),
    ("<script>if (a < b) '</p>'</script >x", "x"), ("<textarea><p>t</textarea>x", "x"), ("</><p>x</ p>y", "xy"),
    ("<main><p>a</main><p>b", "a"), ("<div class=header>h</div><p>a", "a"), ("<head><title>t</title><p>a", "a"),
    ("<div hidden>x</div><p style='display: none'>y</p>z", "z"), ("<P>A</P><BR>b", "A\nb"), ("<p>a\x0b b </p>", "a b"),
    ("<div class=no-comments>a</div>", "a"), ("<p a=\"b>c</p>", "c"), ("<article><p>x", "x"), ("<svg><text>s</text></svg>y", "y"),
])
def test_lenient(page, want):
    assert text(page) == want


def test_linear_in_odd_pages():
    for page in ("<div>" * 100_000 + "x", "<p " * 100_000, '<a b="' * 100_000, "<!-- " * 100_000, "<li>x" * 100_000, "<b>" * 100_000 + "</i>" * 2000,
                 "&amp" * 200_000, "< " * 200_000, "<div class=ad>" * 20_000 + "x"):
        text(page)


def site(n, host, own):
    menu = "".join(f'<div><a href="/{k}">Item {k}</a></div>' for k in range(4))
    return [(f"http://{host}/{k}", f"<body><div>{menu}</div><div><p>Follow {host} today.</p></div><div>{own(k)}</div><p>Read {k} more.</p></body>") for k in range(n)]


def brute(rows, min_pages=H.MIN_PAGES, share=H.MIN_SHARE):
    """Texts with every subtree removed that recurs in its host, counted with sets."""
    trees, seen, pages = [], defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        host = None if url is None else re.sub(r":\d*$", "", re.sub(r"^.*@", "", m[1])) if (m := re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\\]*)", url.lower())) else ""
        tree = H.parse(page or "")
        H._hash(tree, (host or "").encode() + (b"\x00" if host is None else b"\x01"))
        trees.append((host, tree))
        pages[host].add(H.main_text(tree))
        for node in H._candidates(tree, H._roots(tree)):
            seen[host, node.digest].add(H.main_text(tree))
    gone = {d for (host, d), at in seen.items() if len(at) >= min_pages and 100 * len(at) >= share * len(pages[host])}
    return sorted(((i or 0, u or "", H.main_text(t, gone)) for (i, u, _), (_, t) in zip(rows, trees)))


def got(spark, rows):
    return sorted((r["page_id"] or 0, r["url"] or "", r["text"]) for r in H.extract(spark.createDataFrame(rows, SCHEMA)).collect())


def test_templates_go_and_copies_stay(spark):
    pages = site(30, "a.example", lambda k: f"<p>Own text of page {k}.</p><div><p>Sign the list</p></div>")
    pages += [(u + "?copy", p) for u, p in pages[:1] * 20]  # copies of a page are one page
    pages += site(3, "b.example", lambda k: f"<p>Few pages {k}.</p>")
    article = "<article><h1>Title {0}</h1><p>All share this line.</p><div>Join our list</div>" + "<p>Body {0} of the text that goes on for long.</p>" * 3 + "</article>"
    pages += [(f"http://c.example:80/{k}", f"<div>top {k}</div>" + article.format(k)) for k in range(12)]
    same = "<div><p>The same words on every page.</p><p>And more of them.</p></div>"
    pages += [(f"http://d.example/{k}", same) for k in range(12)] + [(f"//u@D.example/{k}", f"<article>{same}</article>") for k in range(12)]
    rows = [(k, u, p) for k, (u, p) in enumerate(pages)] + [(None, None, "<p>x</p>"), (None, None, None), (7, None, "<p>x</p>")]
    out = got(spark, rows)
    assert out == brute(rows)
    by = {u: t for _, u, t in out}
    assert by["http://a.example/4"] == "Own text of page 4.\nRead 4 more."
    assert by["http://b.example/1"].endswith("Follow b.example today.\nFew pages 1.\nRead 1 more.")
    assert by["http://c.example:80/3"] == "\n".join(["Title 3", "All share this line."] + ["Body 3 of the text that goes on for long."] * 3)
    assert by["http://d.example/2"] == by["//u@D.example/2"] == "The same words on every page.\nAnd more of them."


def test_whole_table(spark):
    """Every page of the test table: its article by another way, and by brute force over sets."""
    made = queries.QUERIES["op12_html_extract"](spark, SF)
    assert made.columns == ["page_id", "url", "text", "n_chars"]
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    out = {r["page_id"]: r for r in made.collect()}
    assert [(i, out[i]["url"], out[i]["text"]) for i in sorted(out)] == brute(pages)
    for i, url, page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert out[i]["text"] == "\n".join(b for b in blocks if b) and out[i]["n_chars"] == len(out[i]["text"])


def test_odd_tables(spark):
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "<p>" + "word &amp; " * 300_000
    rows = [(1, "http://a/1", long), (1, "http://a/1", long), (2, "not a url", "<p>x"), (None, "", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for extra in ("host", "page", "text", "template", "subtree", "id"):
        docs = docs.withColumn(extra, F.lit("x"))
    made = H.extract(docs).collect()
    assert sorted(len(r["text"]) for r in made) == [0, 1, 2_099_999, 2_099_999]
