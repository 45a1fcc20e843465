"""Page cleaning on hand-made pages."""

import duckdb

from lexiforge.functions import dom
from lexiforge.operators import links as L
from lexiforge.operators import web as W

PAGE = """<html><head><title> » My page – </title><meta property="og:description" content=" About it "></head><body>
<!-- note --><nav><a href="/x">Menu item</a></nav><div class="cookie-bar">We use cookies</div>
<ul><li>In this section</li><li>A</li></ul><div>share facebook twitter</div>
<main><p>Before any heading.</p><h1>First part</h1><p>Some <b>bold</b> text<p>and nested</p></p>
<ul><li>one</li><li>two <a href="sub/deep">deeper page</a></li></ul>
<h2>This heading is far too long to be one because it has more than fifteen words in it really now</h2>
<h3>Second &amp; last</h3><table><tr><td>cell</td></tr></table><h2>Empty</h2></main>
<a href="https://o.example/a">Other site</a><a href="https://o.example/a">again</a><a href="/f.pdf?x=1">The file</a>
<a href="https://s.example/">x</a><a href="https://s.example/">long enough</a><a href="#t">top</a><script>var a = "<p>no</p>"</script></body></html>"""


def test_dom_nests_as_written():
    page = dom.parse("<p>a<b>b<p>c</p>d</p>e<br>f</i>")
    p = next(page.named(("p",)))
    assert page.text(p, " ") == "a b c d" and page.text(0, " ") == "a b c d e f"
    assert [page.name[i] for i in page.below()] == ["p", "b", "p", "br"]
    assert (page.size(p), page.count(p), page.size(0)) == (4, 4, 6)
    assert dom.parse(None).text() == ""
    page.remove(lambda i: page.name[i] == "b")
    assert page.text() == "aef" and [page.name[i] for i in page.below()] == ["p", "br"]


def test_visible_text():
    assert W.visible_text("<p> a </p><style>x</style><noscript>n</noscript>b<script>c</script>") == "a b"


def kinds(spark, base):
    rows = L.page_links(spark.createDataFrame([(1, base, PAGE)], "page_id int, url string, html string")).orderBy("pos").collect()
    return {k: [{"text": r.text, "url": r.url} for r in rows if r.kind == k] for k in ("pdf", "external", "internal")}


def test_links_before_cleaning(spark):
    found = kinds(spark, "http://h.example/base")
    assert [x["url"] for x in found["external"]] == ["https://o.example/a"]
    assert found["pdf"] == [{"text": "The file", "url": "http://h.example/f.pdf?x=1"}]
    assert found["internal"] == []
    assert [x["url"] for x in kinds(spark, "http://h.example/sub")["internal"]] == ["http://h.example/sub/deep"]


def test_links_as_they_are_written(spark):
    source = "<a href='../up/x.html'>go up</a><a href=\"y.html\">unclosed <a class=q href=z/./w.html>the next</a><a href='mailto:a@b.c'>mail us</a><a href='MAILTO:a@b.c'>mail more</a><a href='http://[bad'>bad one</a>"
    df = spark.createDataFrame([(1, "http://h.example/a/b/c.html", source), (2, None, None), (3, "http://h.example/a", "<p>none</p>")], "page_id long, url string, html string")
    rows = {r.page_id: [(x.text, x.url) for x in r.links] for r in W.page_targets(df).collect()}
    want = [("go up", "http://h.example/a/up/x.html"), ("unclosed the next mail us mail more bad one", "http://h.example/a/b/y.html"), ("the next", "http://h.example/a/b/z/w.html")]
    assert rows[1][:3] == want and rows[2] == rows[3] == []


def test_clean_pages(spark):
    df = spark.createDataFrame([(1, "http://h.example/base", "catalogue title", PAGE), (2, "http://h.example/gone", "t", None), (3, "u", "t", "")], "resource_id long, url string, title string, html string")
    rows = {r.resource_id: r for r in W.clean_pages(df).collect()}
    r = rows[1]
    assert (r.clean_status, r.clean_title, r.description) == ("success", "My page", "About it")
    assert [(s.heading, s.level, s.content) for s in r.sections] == [
        ("", "preamble", "Before any heading."),
        ("First part", "h1", "Some bold text and nested and nested one two deeper page"),
        ("Second & last", "h3", "cell"),
    ]
    assert r.headings == ["First part", "Second & last"]
    assert r.clean_text.startswith("TITLE: My page\nDESCRIPTION: About it\n\nBefore any heading.\n\n## First part\nSome bold")
    assert r.clean_text.endswith("PDF LINKS: The file (http://h.example/f.pdf?x=1)\nEXTERNAL LINKS: Other site (https://o.example/a)")
    assert r.word_count == len(r.body_text.split()) and r.char_count == len(r.clean_text) and r.route_hint == "single_pass"
    assert (rows[2].clean_status, rows[2].clean_text, rows[2].char_count, rows[2].route_hint) == ("fetch-failed", None, 0, "single_pass")


def test_linked_pages(spark):
    source = '<title>T</title><meta name="Description" content="D"><div class="heading">lost</div><body><h1>Head of it all here</h1><p>short</p><p>A paragraph of some length.</p><a href="/g.pdf">g</a><a href="http://o.example/">out</a><a href="x.png">i</a>'
    r = W.clean_linked_pages(spark.createDataFrame([(1, "http://h.example/", source)], "resource_id long, url string, html string")).first()
    assert r.clean_text == (
        "TITLE: T\n\nDESCRIPTION: D\n\nHEADINGS: Head of it all here\n\nCONTENT: A paragraph of some length.\n\nPDF LINKS: g (http://h.example/g.pdf)\n\nEXTERNAL LINKS: out (http://o.example/)"
    )


def test_container_choice():
    long = "word " * 60

    def chosen(source):
        page = dom.parse(source)
        return page.name[W.main_container(page)], page.attrs[W.main_container(page)].get("class")

    assert chosen(f"<div>{long}</div><div id=content>{long}x</div><article>a</article>") == ("article", None)
    assert chosen(f"<div>{long}{long}</div><div class='a content'>{long}</div>") == ("div", "a content")
    assert chosen("<body><div>short</div></body>") == ("body", None)
    assert chosen(f"<div class=x>{long}</div><div class=y>{long}</div>") == ("div", "x")


def test_headings_once():
    page = dom.parse("<h1>Same one</h1><h2>Same one</h2><h3>abc</h3><h2>" + "w " * 13 + "</h2>")
    assert W.headings(page) == ["Same one"]


def test_visible_words(spark):
    df = spark.createDataFrame([("<p>one two</p><noscript>no</noscript><script>var x</script>three",), (None,)], "html string")
    assert [r[0] for r in df.select(W.visible_words("html")).collect()] == [3, 0]


def test_references_cut_off(spark, tmp_path):
    from lexiforge.plans import model_queries as Q

    assert dom.parse("a&amp;b &lt c &#65; &#66 &nosuch; &", closed=True).text() == "a&b &lt c A &#66 &nosuch; &"
    assert dom.parse("a&amp;b &lt c &#65; &#66").text() == "a&b < c A B"
    assert dom.parse("<a href='/x?a=1&copy=2&amp;c=3'>y</a>", closed=True).attrs[1]["href"] == "/x?a=1&copy=2&c=3"
    html = "<title>x &amp;&amp;&amp</title><article><h1>x &amp;&amp;&amp</h1><p>Words of one paragraph &amp; more.</p></article>"
    spark.createDataFrame([(1, "http://h.example/", html)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("page_clean", "linked_page_clean"):
        got = Q.R.queries[name](spark, str(tmp_path))
        want = con.execute(Q.R.sql[name])
        columns = [c[0] for c in want.description]
        assert [tuple(r) for r in got.select(columns).collect()] == want.fetchall()
