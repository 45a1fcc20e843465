"""Sources and sinks."""

import json
import zipfile

from lexiforge.operators import chunking as C
from lexiforge.operators import evaluation as E
from lexiforge.sources import catalogue as S
from lexiforge.sources import sinks as K


def workbook(path, rows, sheet="List"):
    cell = lambda c, r, v: f'<c r="{chr(65 + c)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if not isinstance(v, int) else f'<c r="{chr(65 + c)}{r}"><v>{v}</v></c>'
    body = "".join(f'<row r="{r}">' + "".join(cell(c, r, v) for c, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(rows, 1))
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")


def test_spreadsheet(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [["Title ", "URL", "Author", "Resource ID", "Career Pathway"], ["One", " http://a.b/c ", None, 7, "Mentoring, early career,"], ["Two", "ftp://x", "Z", 8], [None, "http://q.r/", None, 9], ["Bad", "https", "Z", 10]])
    sheet = S.spreadsheet(spark, str(tmp_path), "List")
    rows = S.resources(sheet).collect()
    assert [(r.title, r.url, r.author, r.resource_id, r.status) for r in rows] == [("One", "http://a.b/c", "Unknown", "7", "pending")]
    from pyspark.sql import functions as F

    wide = sheet.select(F.try_element_at("cells", F.lit("Resource ID")).alias("resource_id"), F.try_element_at("cells", F.lit("Career Pathway")).alias("path"))
    truth = E.ground_truth(wide, {"career_pathway": "path"})
    assert sorted(tuple(r) for r in truth.collect()) == [("7", "career_pathway", "early career"), ("7", "career_pathway", "mentoring")]


def test_predictions(spark, tmp_path):
    tag = lambda t: {"tag": t, "confidence": "high", "chunk_count": 1, "chunk_indices": [1], "evidence": [""], "rescued": False}
    for name, tags in (("a", {"career_pathway": [tag("Mentoring")]}), ("b", {"career_pathway": [tag("Mentoring"), tag("Retention")], "resource_type": []})):
        (tmp_path / f"tagged_{name}.json").write_text(json.dumps({"resource_id": "39", "title": "t", "tags": tags}))
    got = sorted(tuple(r) for r in S.predictions(spark, f"{tmp_path}/tagged_*.json").collect())
    assert got == [("39", "career_pathway", "Mentoring"), ("39", "career_pathway", "Retention")]


def test_files_and_cache(spark, tmp_path):
    (tmp_path / "7.pdf").write_bytes(b"%PDF")
    cached = S.files(spark, str(tmp_path))
    assert [(r.resource_id, bytes(r.content)) for r in cached.collect()] == [("7", b"%PDF")]
    wanted = spark.createDataFrame([("7",), ("8",)], "resource_id string")
    assert [r.resource_id for r in S.uncached(wanted, cached).collect()] == ["8"]


def test_robots(spark):
    urls = spark.createDataFrame([("http://a.b/private/x",), ("http://a.b/open",), ("http://c.d/private/x",)], "url string")
    rules = spark.createDataFrame([("a.b", "User-agent: *\nDisallow: /private/"), ("c.d", None)], "host string, rules string")
    got = {r.url: r.allowed for r in S.robots_gate(urls, rules, "bot").collect()}
    assert got == {"http://a.b/private/x": False, "http://a.b/open": True, "http://c.d/private/x": True}


def opener(url):
    import urllib.error

    if "gone" in url:
        raise urllib.error.HTTPError(url, 404, "gone", {}, None)
    if "slow" in url:
        raise TimeoutError
    if "down" in url:
        raise urllib.error.URLError("refused")
    if "odd" in url:
        raise ValueError("x" * 200)
    return 200, url, "application/pdf" if "file" in url else "text/html", "<p>ok</p>"


def test_fetch(spark):
    names = ["ok", "gone", "slow", "down", "odd", "file"]
    df = spark.createDataFrame([(f"http://h{i % 2}.b/{n}",) for i, n in enumerate(names)], "url string")
    got = {r.url.rsplit("/")[-1]: r for r in S.fetch(df, "bot", seconds=0, opener=opener).collect()}
    assert {k: v.status for k, v in got.items()} == {"ok": "success", "gone": "http_error", "slow": "timeout", "down": "connection_error", "odd": "error", "file": "redirect_to_pdf"}
    assert got["gone"].error == "HTTP 404" and len(got["odd"].error) == 120 and got["ok"].html == "<p>ok</p>"


def test_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", ["a"], None), ("2", [], "x")], "resource_id string, tags array<string>, note string")
    K.write_rows(df, str(tmp_path / "out"), by="resource_id")
    assert sorted(p.name for p in (tmp_path / "out").glob("resource_id=*")) == ["resource_id=1", "resource_id=2"]
    (tmp_path / "array.json").write_text(K.json_array(df))
    back = S.json_array(spark, str(tmp_path / "array.json"), "resource_id string, tags array<string>, note string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    doc = {r.resource_id: json.loads(r.document) for r in K.json_documents(df, "resource_id").collect()}
    assert doc["1"] == {"resource_id": "1", "tags": ["a"], "note": None}


def test_chunk_report(spark):
    text = "# A\n" + "w " * 30 + "\n# B\n" + ("Long sentence here. " * 60)
    chunks = C.chunk_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), 60)
    r = K.chunk_reports(chunks, 60).first()
    assert r.summary.n_chunks == len(r.chunks) and [c.chunk_number for c in r.chunks] == list(range(1, len(r.chunks) + 1))
    assert r.summary.tiny == json.dumps([c.chunk_number for c in r.chunks if c.token_count < 50], separators=(",", ":")) or r.summary.tiny == "none"
    assert "\n".join(r.chunks[0].text_lines) == chunks.orderBy("index").first().text


def test_reports(spark):
    assert K.wrap("alpha, beta, gamma", 12) == ["alpha, beta,", "gamma"]
    report = K.table_report(spark.createDataFrame([(1, "x"), (2, None)], "a int, b string").orderBy("a"), "T")
    assert report == "T\n=\na  b\n-  -\n1  x\n2"
    many = K.table_report(spark.range(7), "T", 5).split("\n")
    assert len(many) == 10 and many[-1] == "... and 2 more rows" and "more" not in K.table_report(spark.range(5), "T", 5)
