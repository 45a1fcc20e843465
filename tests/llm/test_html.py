import html
import random
import re
from collections import Counter
from html.parser import HTMLParser

from lexiforge.llm import html_extract as H


def text(source):
    return H.page_text(source)


def test_blocks():
    page = """<html><body class="has-sidebar"><div id="wrap" class="page with-sidebar"><header>Top</header>
    <div class="cookie-notice">We use</div><main><h1>T &amp; x</h1><p>One <b>two<p>Three
      four</b> <i>fi</i>ve<ul><li>a<li>b</ul><div class="ad-slot">buy</div><table><tr><td>x<td>y</table>
    <section id="comments">rude</section><p>Last <a href=q>link</a>.<script>if(a<b){"</p>"}</script> end &lt;b&gt;</main>
    <footer>f</footer></div>"""
    assert text(page).split("\n") == ["T & x", "One two", "Three four five", "a", "b", "x", "y", "Last link. end <b>"]


def test_odd_input():
    assert text(None) == text("") == text("<p></p><!-- x") == ""
    assert text("plain & simple &copy; < 3") == "plain & simple © < 3"
    assert text("<p>a<br>b</p>") == "a b"
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert text('<p title="a>b">x</p><p hidden>y</p><p style="display: none">z</p><style>p{}</style>') == "x"
    assert text("<p>" + "long words " * 50_000) == ("long words " * 50_000).strip()
    assert text("<nav>menu<article>odd</article></nav><article>one</article>mid<article>two</article>") == "one\ntwo"


def test_what_is_no_main_text():
    page = """<body class="home with-sidebar"><div class="topnav"><a href=x>Home</a></div><div id="page" class="sidebar-left"><div class="adBox">buy</div>
    <article class="post sidebar-on"><h1>T</h1><p>One.</p><aside>see also</aside><div class="adslot-2">ad</div><form><p>mail</p></form><p class="notice">note</p>
    <p>Two.</p><section class="post-comments"><article class="comment"><p>rude</p></article></section></article>
    <section class="related-posts"><article><p>teaser</p></article></section><div class="cookieBar">ok?</div></div><div class="site-footer">f</div></body>"""
    assert text(page) == "T\nOne.\nTwo."
    assert text("<main><article class='comment'>c</article><p>body</p></main>") == "body"
    assert text("<div class='content-with-sidebar'><article>a</article></div>") == "a"


def test_tree_matching():
    a, b = H.read_tree("#(article(h1 p h2 ul(li)))"), H.read_tree("#(article(h1 div(p) p ul(li)))")
    assert H.read_tree(H.Skeleton().text()) == ("#", [])
    assert H.match(a, b)[0] == 6 and H.size(a) == 7
    assert H.match(a, ("x", []))[0] == 0
    slots, wrappers = H.induce(["#(article(h1 p))", "#(article(h1 div p))", "#(article(h1 p))", "#(table(tr(td(i))))"])
    assert slots[0] == slots[2] and slots[1][1][:3] == slots[0][1][:3] and slots[1][1][-1] == slots[0][1][-1]
    assert slots[3][0] == 1 and H._write(wrappers[0].tree) == ("#(article(h1 div p))", [0, 1, 2, 4, 3])


def pages(n, host="h.example"):
    body = "<html><body><div class=c><h2>News desk</h2><p class=lead>Text {0}</p><div class=box><p>Join our club</p></div><div class=b><p>more {0}</p></div></div></body></html>"
    return [(i, f"https://{host}/{i}", body.format(i)) for i in range(n)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", [1]) for r in rows], "page_id long, url string, html string, host string, slots array<int>").repartition(3)
    out = [tuple(r) for r in H.extract_main_text(df).collect()]
    assert all(r[3] == len(r[2]) for r in out)
    return {r[0]: r[2] for r in out}


def test_constant_slots_are_template(spark):
    got = run(spark, pages(8))
    assert got == {i: f"Text {i}\nmore {i}" for i in range(8)}


def test_mixed_layouts_are_counted_by_wrapper(spark):
    listing = "<html><body><table class=t><tr><td class=k>All items</td><td class=v>item {0}</td></tr></table></body></html>"
    bare = (30, "https://h.example/30", pages(31)[30][2].replace("<div class=box><p>Join our club</p></div>", ""))
    rows = [*pages(8), bare, *((i, f"https://h.example/l{i}", listing.format(i)) for i in range(20, 26)), (40, "https://h.example/", "<ul><li>Home</li></ul>")]
    want = {i: f"Text {i}\nmore {i}" for i in (*range(8), 30)} | {i: f"item {i}" for i in range(20, 26)} | {40: "Home"}
    assert run(spark, rows) == want


def test_constant_texts_among_varying_siblings(spark):
    item = "<article><p>Read our rules</p><p>Text {0}</p><p>{1}</p><ul><li>point {0}</li><li>Print this</li></ul><p>Copyright</p></article>"
    rows = [(i, f"https://s.example/{i}", item.format(i, "seldom" if i < 6 else f"other {i}")) for i in range(8)]
    assert run(spark, rows) == {i: f"Text {i}\n{'seldom' if i < 6 else f'other {i}'}\npoint {i}" for i in range(8)}


def test_too_few_pages_or_copies_show_nothing(spark):
    assert run(spark, pages(3))[1] == "News desk\nText 1\nJoin our club\nmore 1"
    copies = [(i, "http://c.example/", pages(1)[0][2]) for i in range(9)]
    assert set(run(spark, copies).values()) == {"News desk\nText 0\nJoin our club\nmore 0"}


def test_parts_are_weighed_by_their_text():
    story = "Long story of the day, told at length. " * 5
    assert text(f"<main><p>{story}</p><article class=x><a href=q>Teaser</a></article></main>") == f"{story.strip()}\nTeaser"
    assert text(f"<main><p>{story}</p></main><main><p>second</p></main>") == f"{story.strip()}\nsecond"
    assert text(f"<div><p>{story}</p></div><article>tiny</article>") == f"{story.strip()}\ntiny"
    assert text("<article><header><h1>Own title</h1></header><p>x y z</p><header>bare</header></article>") == "Own title\nx y z"


def test_words_alone_remove_nothing():
    for mark in ('div id="shareholders"', 'div class="social-history"', 'section class="search"', 'p class="advertence"', 'p class="comment-analysis"'):
        tag = mark.split()[0]
        assert text(f"<article><p>One long line.</p><{mark}>kept</{tag}></article>") == "One long line.\nkept"
    assert text("<article><p>Write <label>your name</label> here</p></article>") == "Write your name here"
    assert text("<article><div class='notice'>" + "The notice is the article. " * 9 + "</div><p>end</p></article>").endswith("article.\nend")


def test_no_depth_changes_what_is_left_out():
    for depth in (10, 199, 300, 3000):
        inner = "<nav>menu</nav><p>text</p><div hidden>no</div>"
        assert text("<article>" + "<div>" * depth + inner + "</div>" * depth + "<p>end</p></article>") == "text\nend"


def test_wrappers_judge_suspects(spark):
    page = "<article><p>Lead {0} of the day</p><div class=box><div class=promo>{1}</div></div></article>"
    long = "a very long and ever changing column of text, number {0}, which is the story itself"
    rows = [(i, f"https://a.example/{i}", page.format(i, long.format(i))) for i in range(7)]
    rows += [(10 + i, f"https://b.example/{i}", page.format(f"{i} is told here in many more words", f"buy {i}")) for i in range(7)]
    rows += [(20, "https://a.example/x", page.format("with a longer text than its column of one page", "short"))]
    got = run(spark, rows)
    assert got[3] == f"Lead 3 of the day\n{long.format(3)}"
    assert got[13] == "Lead 3 is told here in many more words of the day"
    assert got[20].endswith("\nshort")  # the wrapper's pages decide, not the page


class Paths(HTMLParser):
    """Texts of elements by the path of tags and classes to them."""

    def __init__(self):
        super().__init__()
        self.at, self.found = [], []

    def handle_starttag(self, tag, attrs):
        self.at.append(tag + "." + dict(attrs).get("class", ""))

    def handle_endtag(self, tag):
        self.at.pop()

    def handle_data(self, data):
        if data.strip():
            self.found.append(("/".join(self.at), " ".join(data.split())))


def brute(rows):
    """Texts that every page of a host with their path has there are template."""
    hosts = {}
    for i, url, source in rows:
        p = Paths()
        p.feed(source)
        hosts.setdefault(url.split("/")[2], {})[i] = p.found
    out = {}
    for own in hosts.values():
        pages = {tuple(f): f for f in own.values()}.values()
        having, with_text = Counter(), Counter()
        for f in pages:
            having.update({k for k, _ in f})
            with_text.update(set(f))
        for i, f in own.items():
            out[i] = "\n".join(t for k, t in f if not (with_text[k, t] == having[k] >= H.DISTINCT))
    return out


def test_against_brute_force_induction(spark):
    rng = random.Random(11)
    rows = []
    for h in range(6):
        fixed = [f"fixed {h} {k}" for k in range(5)]
        for i in range(rng.choice([3, 9, 25])):
            body = [f"<h2>{fixed[0]}</h2><h1>Title {h} {i}</h1>"]
            for k in range(rng.randint(1, 6)):
                body.append(f"<p>Text {rng.randint(0, 40)} {k} {i}</p>")
            body.append(f"<p>{fixed[1]}</p><div class=club><p>{fixed[2]}</p><span>{rng.choice(['red', 'blue'])}</span></div>")
            if rng.random() < 0.5:
                body.append(f"<ul class=more><li>{fixed[3]}</li><li>point {rng.randint(0, 9)}</li></ul>")
            if rng.random() < 0.8:
                body.append(f"<h4>{fixed[4] if rng.random() < 0.9 else 'other'}</h4>")
            rows.append((100 * h + i, f"http://h{h}.example/{i}", "<html><body><div class=c>" + "".join(body) + "</div></body></html>"))
    rows += [(900 + i, *rows[i][1:]) for i in range(5)]
    assert run(spark, rows) == brute(rows)


def test_hosts_with_many_skeletons_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(H, "KINDS", 8)
    rows = [(i, f"http://k.example/{i}", "<div class=c><p>Read the rules</p>" + "".join(f"<div class=x{j}><p>{i} {j}</p></div>" for j in range(6) if i >> j & 1) + "</div>") for i in range(1, 64)]
    got = run(spark, rows)
    assert got[63] == "\n".join(f"63 {j}" for j in range(6)) and sum("rules" in t for t in got.values()) == 0


def test_nulls_and_repeats(spark):
    rows = [(1, None, "<p>a</p>"), (2, "no url", None), (3, "", ""), (1, None, "<p>a</p>")]
    assert run(spark, rows) == {1: "a", 2: "", 3: ""}
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert H.extract_main_text(df).count() == 0


def test_sample_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in H.extract_main_text(table).collect()}
    for r in table.collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?p>|</?h1>", article)]
        assert got[r.page_id] == "\n".join(x for x in parts if x)
