import json

from lexiforge import __main__ as cli
from tests.test_sources import workbook


def test_chunk_and_query(spark, tmp_path):
    spark.createDataFrame([(1, "# A\nsome words"), (2, "")], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    cli.main(["chunk", "--input", str(tmp_path / "docs"), "--output", str(tmp_path / "chunks"), "--threshold", "50"])
    assert [r.part_label for r in spark.read.parquet(str(tmp_path / "chunks")).collect()] == ["[Section: # A]"]
    cli.main(["query", "route_counts", "--data", "/root/testdata/sf0.001", "--output", str(tmp_path / "q")])
    assert spark.read.parquet(str(tmp_path / "q")).count() > 0


def test_catalogue_clean_and_links(spark, tmp_path):
    (tmp_path / "books").mkdir()
    workbook(tmp_path / "books" / "a.xlsx", [["Title", "URL", "Resource ID"], ["One", "http://a.b/c", "7"]])
    cli.main(["catalogue", "--workbook", str(tmp_path / "books"), "--sheet", "List", "--output", str(tmp_path / "cat")])
    cat = spark.read.parquet(str(tmp_path / "cat"))
    assert [r.resource_id for r in cat.collect()] == ["7"]
    from pyspark.sql import functions as F

    html = '<p>hello there</p><a href="http://x.y/">a link</a><a href="http://x.y/i.png">picture</a>'
    cat.withColumn("html", F.lit(html)).write.parquet(str(tmp_path / "pages"))
    cli.main(["clean", "--input", str(tmp_path / "pages"), "--output", str(tmp_path / "clean"), "--resource-id", "7"])
    cli.main(["links", "--input", str(tmp_path / "clean"), "--output", str(tmp_path / "links")])
    row = spark.read.parquet(str(tmp_path / "links")).first()
    assert [x.url for x in row.external_links] == ["http://x.y/"] and row.pdf_links == []


def test_evaluate(spark, tmp_path, capsys):
    (tmp_path / "books").mkdir()
    workbook(tmp_path / "books" / "a.xlsx", [["Resource ID", "Career Pathway"], ["7", "Mentoring, Retention"], ["8", "Leadership"]])
    tag = lambda t: {"tag": t, "confidence": "high", "chunk_count": 1, "chunk_indices": [1], "evidence": [], "rescued": False}
    (tmp_path / "tagged_7.json").write_text(json.dumps({"resource_id": "7", "tags": {"career_pathway": [tag("Mentoring"), tag("Recruitment")]}}))
    cli.main(["evaluate", "--tagged", f"{tmp_path}/tagged_*.json", "--workbook", str(tmp_path / "books"), "--sheet", "List", "--dims", "career_pathway", "--output", str(tmp_path / "cells")])
    said = capsys.readouterr().out
    assert "OVERALL" in said and "recruitment" in said and "prediction" in said
    cell = spark.read.json(str(tmp_path / "cells")).first()
    assert (cell.tp, cell.fp, cell.fn, cell.tn, cell.f1) == (1, 1, 1, 7, 0.5)
