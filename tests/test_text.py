"""Text functions and chunkers against plain Python on hand-made input."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexiforge.functions import text as T
from lexiforge.functions import urls as U
from lexiforge.operators import chunking as C
from lexiforge.operators import flat_text as P


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_headings(spark):
    lines = ["AGE", "AG", "1. item", "1.2 Foo", "2.3) x", "## Head", "Key Findings Overview", "", "A" * 130, "  INTRO: PART 2 ", "#no"]
    want = [True, False, True, False, True, True, False, False, False, True, False]
    assert apply(spark, T.is_chunk_heading, lines) == want


def test_heading_numbers(spark):
    heads = ["4.1.1 X", "4. X", "X", "12 Foo", "1234 x"]
    assert apply(spark, T.numeric_depth, heads) == [3, 1, None, 1, None]
    assert apply(spark, T.numeric_prefix, heads) == ["4.1.1", "4", "", "12", ""]
    assert apply(spark, T.heading_key, ["Key–Findings: (2020) .... 14", "ﬁne  \u200bprint"]) == ["key findings 2020", "fine print"]


def test_normalise(spark):
    assert apply(spark, T.normalise_web, ["ﬁ\u00a0x \n y ", None, ""]) == ["fi x y", None, ""]
    assert apply(spark, T.normalise_pdf, ["a\rb\u200b c\td", None]) == ["ab c d", ""]
    assert apply(spark, T.edge_trim, [" » Title – ", "·a | b·"]) == ["Title", "a | b"]


def test_lines_and_words(spark):
    texts = ["a\nb\r\nc\x0bd\u2028e", "a\n", "", "\n\n", "x\u00a0y\x1fz"]
    assert apply(spark, T.lines, texts) == [t.splitlines() for t in texts]
    assert apply(spark, T.word_count, texts) == [len(t.split()) for t in texts]
    assert apply(spark, T.approx_tokens, ["w " * n for n in (0, 1, 2, 20, 600)]) == [int(n * 1.35) for n in (0, 1, 2, 20, 600)]


def test_join_lines(spark):
    rows = [["inter-", "national  law", "", "well-", "Known"], [], ["a- ", "b"]]
    assert apply(spark, T.join_lines, rows, "array<string>") == ["international law well- Known", "", "ab"]


def test_fonts(spark):
    assert apply(spark, T.is_bold_font, ["Helvetica-Bold", "NHaas-75Bd", "NHaas-55Rg", "Foo_md", "bdark", None]) == [True, True, False, True, False, False]


def test_not_described(spark):
    texts = [
        "One. Two. Three. Not described in the document.",
        "One. Not described in the document. Not described in the document.",
        "Not described in the document is the budget.",
        "A plan, not described in the document.",
    ]
    want = ["One. Two. Three.", "One. Not described in the document.", "Not described in the document.", "A plan. Not described in the document."]
    assert apply(spark, T.clean_not_described, texts) == want


def test_labels_and_points(spark):
    assert apply(spark, T.subsections, ["[Sections: ## One | ### Two | x]"]) == [["One", "Two"]]
    assert apply(spark, T.clean_key_point, ["Grew by half (Note: p. 3), though this figure varies widely."]) == ["Grew by half."]


@pytest.mark.parametrize(
    ("url", "kind", "suffix", "skip"),
    [
        ("http://a.b/c/d.PDF?x=1", "pdf", True, False),
        ("http://a.b/.pdf", "webpage", True, False),
        ("http://a.b/x.pdf#p2", "pdf", False, False),
        ("http://a.b/q?f=x.pdf", "webpage", False, False),
        ("MAILTO:x@y", "webpage", False, True),
        ("http://a.b/i.PNG?w=3", "webpage", False, True),
        ("http://a.b/#", "webpage", False, True),
    ],
)
def test_urls(spark, url, kind, suffix, skip):
    row = spark.createDataFrame([(url,)], "u string").select(U.url_class(F.col("u")), U.is_pdf_url(F.col("u")), U.should_skip(F.col("u"))).first()
    assert tuple(row) == (kind, suffix, skip)


def test_resolve(spark):
    df = spark.createDataFrame([("http://a.b/c/d", "../e?x#y"), ("http://a.b/c/", "f"), ("http://a.b", "//z/q"), (None, "k")], "b string, h string")
    assert [r[0] for r in df.select(U.resolve("b", "h")).collect()] == ["http://a.b/e?x#y", "http://a.b/c/f", "http://z/q", "k"]


# -- chunkers ---------------------------------------------------------------------


def n_tokens(text):
    return int(len(text.split()) * 1.35)


def pack(units, threshold):
    groups, size = [], 0
    for u in units:
        if groups and size + n_tokens(u) <= threshold:
            groups[-1].append(u)
            size += n_tokens(u)
        else:
            groups.append([u])
            size = n_tokens(u)
    return groups


def plain_chunks(text, threshold):
    """The chunker's rules in plain Python: (text, token_count, tier, section_title, is_continuation)."""
    if not (text or "").strip():
        return []
    head = re.compile(r"#{1,6}\s+\S|[A-Z][A-Z\s\d:\-]{2,}$|\d+(\.\d+)*[.)]\s+\S")
    sections, title, body = [], None, []

    def close():
        b = "\n".join(body).strip()
        if b or title is not None:
            sections.append((title, b))

    for line in text.splitlines():
        s = line.strip()
        if s and len(s) <= 120 and head.match(s):
            close()
            title, body = s, []
        else:
            body.append(line)
    close()
    raw = []
    for title, b in sections or [(None, text.strip())]:
        whole = f"{title}\n{b}" if title else b
        name = title or "Preamble"
        if n_tokens(whole) <= threshold:
            raw.append((f"[Section: {name}]\n{whole}", n_tokens(whole), 1, title, False))
            continue
        paras = [p.strip() for p in re.split(r"\n\s*\n", b) if p.strip()]
        tier, join = 2, "\n\n"
        if any(n_tokens(p) > threshold for p in paras):
            tier, join = 3, " "
            paras = [u for p in paras for u in ([s.strip() for s in re.split(r"(?<=[.!?])\s+(?=[A-Z])", p)] if n_tokens(p) > threshold else [p])]
        groups = pack(paras, threshold)
        for i, g in enumerate(groups):
            label = f"[Section: {name}]" if len(groups) == 1 else f"[Section: {name} — Part {i + 1} of {len(groups)}{', Paragraph continued' if tier == 3 and i else ''}]"
            joined = f"{label}\n{join.join(g)}"
            raw.append((joined, n_tokens(joined), tier, title, i > 0))
    out, run = [], []

    def merge():
        if len(run) == 1:
            out.append(run[0])
        elif run:
            titles = [r[3] for r in run if r[3]]
            label = f"[Sections: {' | '.join(titles)}]" if titles else "[Document Preamble]"
            out.append((label + "\n\n" + "\n\n".join(r[0] for r in run), sum(r[1] for r in run), 1, run[0][3], False))
        run.clear()

    for c in raw:
        if c[2] != 1:
            merge()
            out.append(c)
        else:
            if run and sum(r[1] for r in run) + c[1] > threshold:
                merge()
            run.append(c)
    merge()
    return out


def test_rhetorical_chunks(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "one", "# Only a heading", "AGE\nx"]
    for _ in range(80):
        lines = []
        for _ in range(rng.randint(0, 14)):
            k = rng.random()
            if k < 0.2:
                lines.append(rng.choice(["# Head one", "INTRODUCTION", "AGE", "1. item here", "2.3) thing", "1.2 Foo", "Key Findings Overview", "   "]))
            elif k < 0.35:
                lines.append("")
            else:
                lines.append(" ".join(rng.choice(["alpha", "Beta.", "gamma,", "Delta?", "eps"]) for _ in range(rng.randint(1, 60))))
        texts.append("\n".join(lines))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in C.chunk_documents(df, 30).orderBy("doc_id", "index").collect():
        assert r["index"] == len(got.setdefault(r.doc_id, []))
        got[r.doc_id].append((r.text, r.token_count, r.tier, r.section_title, r.is_continuation))
    assert [got.get(i, []) for i in range(len(texts))] == [plain_chunks(t, 30) for t in texts]


def test_packing_sizes(spark):
    unit = lambda n: " ".join(["w"] * n)
    words = [223, 297, 149, 667, 8]  # 301, 400, 201, 900 and 10 tokens
    df = spark.createDataFrame([([unit(n) for n in words],)], "u array<string>")
    groups = df.select(C.greedy_pack(C.units(F.col("u")), 800)).first()[0]
    assert [[u.tokens for u in g] for g in groups] == [[301, 400], [201], [900], [10]]


def test_blank_lines_and_documents_make_no_groups(spark, tmp_path):
    import duckdb

    from lexiforge.plans import text_queries as Q

    rows = [(1, "a b\nc"), (2, ""), (3, " \n  "), (4, None), (5, "\t\nx"), (6, "a\n\u00a0\u2003\n\u3000 \nb"), (7, "\u00a0"), (8, "\r\na")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in Q.greedy_pack(spark, str(tmp_path)).collect())
    assert got == [(1, 1, 2, 3), (5, 1, 2, 1), (6, 1, 2, 2), (8, 1, 2, 1)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(Q.R.sql["greedy_pack"]).fetchall())


def test_overlap_chunks(spark):
    unit = lambda n, c: " ".join([c] * n)
    paras = [unit(20, "a"), unit(30, "b"), unit(5, "c"), unit(8, "d"), unit(40, "e")]
    text = "before\n\n=== ONE ===\n\n" + "\n\n".join(paras) + "\n\n=== TWO ===\n\nx y"
    df = spark.createDataFrame([(text,)], "t string")
    got = [tuple(c) for c in df.select(C.chunk_structured(F.col("t"), 60, 20)).first()[0]]
    assert got == [
        ("PREAMBLE", "before", 1, 0),
        ("ONE", paras[0], 27, 0),
        ("ONE", "\n\n".join(paras[1:4]), 56, 0),
        ("ONE", "\n\n".join(paras[2:5]), 70, 16),
        ("TWO", "x y", 2, 0),
    ]


def test_assembly(spark):
    kind = "p string, w array<struct<title:string,text:string>>, f array<struct<title:string,text:string>>"
    df = spark.createDataFrame([("mine", [("A", "a"), ("B", "b")], [("C", "c")]), (None, [], [])], kind)
    got = [r[0] for r in df.select(C.assemble(F.col("p"), F.col("w"), F.col("f"))).collect()]
    assert got[0] == "=== PARENT CONTENT ===\n\nmine\n\n\n=== LINKED WEB PAGES ===\n\n\n--- Linked page 1: A ---\n\na\n\n\n--- Linked page 2: B ---\n\nb\n\n\n=== LINKED PDFs ===\n\n\n--- Linked PDF 1: C ---\n\nc"
    assert got[1] == ""


def test_exact_tokens(spark):
    from lexiforge.functions import tokens
    from lexiforge.operators import documents as D

    count = tokens.exact(lambda: lambda texts: [len(t) for t in texts])
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "doc_id int, text string")
    assert [r.token_count for r in D.profile(df, counter=count).orderBy("doc_id").collect()] == [3, 0, 0]


def test_linked_documents(spark):
    from lexiforge.operators import links

    rows = [(1, 0, "pdf", "success", "A", "u", "x"), (1, 1, "external", "success", "B", "u", "x"), (1, 2, "pdf", "success", "C", "u", " "), (1, 3, "pdf", "success", "D", "u", "y"), (1, 4, "pdf", "timeout", "E", "u", None)]
    df = spark.createDataFrame(rows, "resource_id int, pos int, kind string, status string, title string, url string, clean_text string")
    assert [(r.doc_id, r.title) for r in links.linked_documents(df).orderBy("doc_id").collect()] == [("pdf_1", "A"), ("pdf_2", "D")]


def test_logger(tmp_path, capsys):
    from lexiforge.log import logger

    log = logger("lexiforge.test", str(tmp_path / "a.log"))
    log.debug("low")
    log.info("high")
    assert logger("lexiforge.test") is log and len(log.handlers) == 2
    assert "low" in (tmp_path / "a.log").read_text() and "low" not in capsys.readouterr().err


def test_long_lines_lose_no_words(spark):
    line = "3. Heading words " + " ".join(f"w{i}" for i in range(120_000))
    got = spark.createDataFrame([(line,)], "line string").select(P.split_merged(F.col("line")).alias("p")).first().p
    assert " ".join(got) == line and len(got[0].split()) == P.HEAD_WORDS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flat_sections_in_one_pass(spark):
    rng = random.Random(3)
    lines = ["Introduction", "1. First things here", "Key findings Methodology", "Running head", "12", "AIMS", "Results", "exam- ple of words", "1. Ab cd 2. Ef gh", "", "Conclusion, and more"]
    rows = [(d, p, "\n".join(rng.choice([*lines, " ".join(["word"] * rng.randint(1, 30))]) for _ in range(rng.randint(0, 12)))) for d in range(40) for p in (2, 1)]
    df = spark.createDataFrame([*rows, (99, 1, None)], "doc_id long, page int, text string")
    whole, steps = P.flat_sections(df), P.sections(P.tagged_lines(df))
    got = sorted(tuple(r) for r in whole.collect())
    assert got == sorted(tuple(r) for r in steps.collect()) and len(got) > 40
    fresh = plan(P.flat_sections(df))  # not run yet
    assert fresh.count("Exchange") == 1 and "Window" not in fresh


def test_chunks_are_cut_in_batches(spark):
    df = spark.createDataFrame([(1, "# A\nx"), (2, None)], "doc_id long, text string")
    assert "MapInArrow" in plan(C.chunk_documents(df)) and "transform(" not in plan(C.chunk_documents(df))


def test_batches_are_taken_a_few_rows_at_a_time():
    import pyarrow as pa

    from lexiforge.functions.batches import ROWS, slices

    batch = pa.RecordBatch.from_pydict({"x": list(range(2 * ROWS + 3))})
    got = [b.column(0).to_pylist() for b in slices(iter([batch, batch.slice(0, 0)]))]
    assert [len(x) for x in got] == [ROWS, ROWS, 3] and sum(got, []) == batch.column(0).to_pylist()


def test_nfkc_yields_a_few_rows_at_a_time(spark):
    import pyarrow as pa

    from lexiforge.functions.batches import ROWS

    texts = [None if i % 7 == 0 else f"{i} \ufb01\u00b2" if i % 3 else f"{i}" for i in range(3 * ROWS + 5)]
    assert [len(x) for x in T.nfkc.func(iter([pa.array(texts)]))] == [ROWS] * 3 + [5]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1)
    got = dict(tuple(r) for r in df.select("i", T.nfkc("t").alias("t")).collect())
    assert got == {i: None if t is None else unicodedata.normalize("NFKC", t) for i, t in enumerate(texts)}
