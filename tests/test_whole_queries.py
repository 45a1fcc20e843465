"""Queries over all rows of their tables."""

import hashlib
import re
import unicodedata

from pyspark.sql import functions as F

from lexiforge.operators import documents as D
from lexiforge.plans import catalogue, tag_queries
from tests.oracle import DATA

SMALL = str(DATA / "sf0.001")


def run(spark, name):
    return catalogue.queries()[name](spark, SMALL)


def test_all_proposals_are_validated(spark):
    want = {tuple(r) for r in tag_queries._proposed(spark, SMALL).select("resource_id", "dim").distinct().collect()}
    assert {(r.resource_id, r.dim) for r in run(spark, "tag_validate").collect()} == want


def test_lookup_and_stage_take_all_rows(spark):
    found = run(spark, "parent_lookup").collect()
    known = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    odd = [r for r in found if r.resource_id % 2 and r.resource_id in known]
    assert odd and all(r.source is not None for r in odd)
    assert sum(r.source is None for r in found) >= sum(r.resource_id < 0 for r in found) > 0
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert run(spark, "stage_input").count() == labels.where(F.col("toxic") == 0).count() > 9


def test_flows_and_layouts_take_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    routes = {r.doc_id: r.route for r in run(spark, "doc_profile").collect()}
    assert {r.resource_id: r.route for r in run(spark, "batch_tagging").collect()} == routes
    written = {r.doc_id for r in docs.where(F.col("text").rlike(r"\S")).select("doc_id").collect()}
    assert {r.resource_id for r in run(spark, "chunk_tagging").collect()} == written
    assert {r.doc_id for r in run(spark, "summaries").collect()} == written
    assert {r.doc_id for r in run(spark, "layout_clean_text").collect()} == ids
    assert {r.doc_id for r in run(spark, "layout_sections").collect()} >= written


def test_whole_texts_are_normalised(spark, tmp_path):
    def brute(text):
        kept = "".join(c for c in unicodedata.normalize("NFKC", (text or "") + " \ufb01\u00b2\u00ad \uff46\u00a0") if c in "\n\t" or unicodedata.category(c) not in ("Cc", "Cf"))
        raw = re.sub(r"\s+", " ", kept).strip().encode()
        return len(raw), hashlib.md5(raw).hexdigest()

    odd = [(1, None), (2, "ﬁn\u00adal\u200b  x²\u00a0y\u0007\n\tz "), (3, "")]
    spark.createDataFrame(odd, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for folder in (SMALL, str(tmp_path)):
        want = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
        got = {r.doc_id: (r["size"], r.digest) for r in catalogue.queries()["normalised_size"](spark, folder).collect()}
        assert got == want


def test_last_of_several_rows_is_looked_up(spark):
    side = lambda rows: spark.createDataFrame(rows, "resource_id int, at int, title string")
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "resource_id int")
    got = D.parent_lookup(wanted, side([(1, 1, "old"), (1, 2, "new")]), side([(1, 9, "file"), (2, 2, "b"), (2, 1, "a")]), "at").collect()
    assert sorted((r.resource_id, r.title, r.source) for r in got if r.title) == [(1, "new", "web"), (2, "b", "file")] and len(got) == 3
