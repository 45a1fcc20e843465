"""Command line: the stages over files.

    python -m lexiforge catalogue --workbook FOLDER --sheet NAME --output OUT
    python -m lexiforge fetch --input CATALOGUE --output OUT [--agent NAME]
    python -m lexiforge clean --input PAGES --output OUT [--resource-id ID] [--separate]
    python -m lexiforge links --input CLEANED --output OUT [--max-ext N] [--max-pdf N]
    python -m lexiforge chunk --input DOCUMENTS --output OUT [--threshold N]
    python -m lexiforge tag --input CHUNKS --output OUT --model NAME --endpoint URL [--verify] [--min-chunks N]
    python -m lexiforge summarise --input CHUNKS --output OUT --model NAME --endpoint URL
    python -m lexiforge evaluate --tagged FILES --workbook FOLDER --sheet NAME [--dims D ...] [--output OUT]
    python -m lexiforge query NAME --data FOLDER --output OUT

Tables are Parquet folders, but for the tagged JSON files of ``evaluate``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import taxonomy as X
from .functions import urls as U
from .operators import chunking, evaluation, flows, links, models, web
from .session import build_session
from .sources import catalogue, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexiforge", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="stage", required=True)

    def stage(name: str, *flags: tuple) -> None:
        s = sub.add_parser(name)
        for flag, options in flags:
            s.add_argument(flag, **options)

    need, number, switch = {"required": True}, lambda d: {"type": int, "default": d}, {"action": "store_true"}
    io = (("--input", need), ("--output", need))
    model = (("--model", need), ("--endpoint", need))
    book = (("--workbook", need), ("--sheet", need))
    stage("catalogue", *book, ("--output", need))
    stage("fetch", *io, ("--agent", {"default": "lexiforge"}), ("--seconds", {"type": float, "default": 1.5}))
    stage("clean", *io, ("--resource-id", {}), ("--separate", switch))
    stage("links", *io, ("--max-ext", number(links.LINK_CAP)), ("--max-pdf", number(links.LINK_CAP)))
    stage("chunk", *io, ("--threshold", number(chunking.THRESHOLD)))
    stage("tag", *io, *model, ("--verify", switch), ("--min-chunks", number(1)))
    stage("summarise", *io, *model)
    stage("evaluate", ("--tagged", need), *book, ("--dims", {"nargs": "*"}), ("--output", {}))
    stage("query", ("name", {}), ("--data", need), ("--output", need))
    return p


def ground_truth(spark: SparkSession, workbook: str, sheet: str) -> DataFrame:
    cell = lambda name: F.try_element_at("cells", F.lit(name))
    columns = {d: d.replace("_", " ").title() for d in X.TAXONOMY}
    wide = catalogue.spreadsheet(spark, workbook, sheet).select(cell("Resource ID").alias("resource_id"), *[cell(c).alias(d) for d, c in columns.items()])
    return evaluation.ground_truth(wide, {d: d for d in columns})


def evaluate(spark: SparkSession, a: argparse.Namespace) -> str:
    predicted, truth = catalogue.predictions(spark, a.tagged), ground_truth(spark, a.workbook, a.sheet)
    taxonomy, dims = X.taxonomy_frame(spark), a.dims or None
    ids = evaluation.matched_ids(predicted, truth)
    flags = evaluation.tag_flags(predicted, truth, ids, taxonomy, dims)
    cell = evaluation.cells(flags, ids, taxonomy, dims)
    if a.output:
        sinks.write_rows(cell, a.output)
    parts = (
        sinks.table_report(evaluation.overall(cell).orderBy("dim"), "Scores by dimension"),
        sinks.table_report(evaluation.by_tag(flags, ids, taxonomy).orderBy(F.desc("wrong"), "dim", "pos"), "Tags, most wrong first"),
        sinks.table_report(evaluation.unmatched(predicted, truth).orderBy("resource_id"), "Resources on one side only"),
    )
    return "\n\n".join(parts)


def run(spark: SparkSession, a: argparse.Namespace) -> str | None:
    if a.stage == "evaluate":
        return evaluate(spark, a)
    if a.stage == "query":
        from .plans import catalogue as plans

        plans.queries()[a.name](spark, a.data).write.mode("overwrite").parquet(a.output)
        return None
    if a.stage == "catalogue":
        out = catalogue.resources(catalogue.spreadsheet(spark, a.workbook, a.sheet))
    else:
        rows = spark.read.parquet(a.input)
        if a.stage == "fetch":
            kinds = rows.withColumn("url_type", U.url_class(F.col("url")))
            pages = catalogue.fetch(kinds.where("url_type = 'webpage'").select("url").distinct(), a.agent, a.seconds)
            out = kinds.drop("status").join(pages.drop("final_url"), "url", "left").withColumn("status", F.coalesce("status", F.lit("pdf-skip")))
        elif a.stage == "clean":
            rows = rows.where(F.col("resource_id").cast("string") == a.resource_id) if a.resource_id else rows
            out = web.clean_pages(rows.select(F.col("resource_id").cast("long").alias("resource_id"), "url", "title", "html"))
            if a.separate:
                sinks.write_rows(out, a.output, by="resource_id")
                return None
        elif a.stage == "links":
            kept = lambda c, n: links.cap_in_place(F.col(c), n).alias(c)
            out = rows.select("resource_id", kept("external_links", a.max_ext), kept("pdf_links", a.max_pdf))
        elif a.stage == "chunk":
            out = chunking.chunk_documents(rows, a.threshold, "clean_text" if "clean_text" in rows.columns else "text")
        else:
            backend = lambda: models.HttpBackend(a.endpoint, a.model)
            if a.stage == "tag":
                named = rows.select(F.col("doc_id").alias("resource_id"), F.col("index").alias("chunk_index"), "part_label", "text")
                out = flows.tag_resources(named, backend, a.verify, a.min_chunks)
            else:
                numbered = rows.withColumn("chunk_number", F.col("index") + 1)
                groups = chunking.continuation_groups(numbered.select("doc_id", "chunk_number", "part_label", "token_count", "text", "is_continuation"))
                kind = rows.resource_type if "resource_type" in rows.columns else F.lit(None).cast("string")
                out = flows.summarise_groups(groups.withColumn("resource_type", kind) if "resource_type" not in rows.columns else groups.join(rows.select("doc_id", "resource_type").distinct(), "doc_id"), backend)
    out.write.mode("overwrite").parquet(a.output)
    return None


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session()
    said = run(spark, a)
    if said:
        print(said)


if __name__ == "__main__":
    main()
