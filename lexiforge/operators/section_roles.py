"""Roles of sections, cover and back matter, the text for a model, the profile of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# What marks an administrative block, and a closing one.
BACK_BLOCK = (
    r"(?i)(?:©|copyright|all rights reserved|printed\s+(?:in|on|may|january|february|march|april|june|july|august|september|october|november|december)|"
    r"for more information|contact details|alternative format|general enqu|https?://|www\.|@\w|\bemail\b|\be-mail\b|\bisbn\b)"
)
BACK_SECTION = r"(?i)(?:©|all rights reserved|alternative format|general enqu|https?://|www\.)"


def name_tokens(text: Column) -> Column:
    """Distinct words of three letters or more, in lower case."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0), lambda t: F.length(t) >= 3))


def repeats_cover(content: Column, reference: Column) -> Column:
    """Whether a short text says little but title and author: three quarters of its words."""
    own, ref = name_tokens(content), name_tokens(reference)
    return (T.word_count(content) <= 30) & (F.size(own) > 0) & (F.size(F.array_intersect(own, ref)) >= 0.75 * F.size(own))


def without_cover(sections: DataFrame, reference: DataFrame) -> DataFrame:
    """Sections without a first one that has no heading and repeats (doc_id, reference)."""
    joined = sections.join(reference, "doc_id", "left")
    cover = (F.col("section_no") == F.min("section_no").over(Window.partitionBy("doc_id"))) & (F.col("heading") == "") & (F.col("content") != "")
    drop = cover & repeats_cover(F.col("content"), F.coalesce("reference", F.lit("")))
    return joined.withColumn("__drop", drop).where(~F.col("__drop")).drop("__drop", "reference")


def split_back_matter(sections: DataFrame) -> DataFrame:
    """A last page of mostly administrative blocks as a section of its own, not for the model.

    ``sections`` with blocks (type, text, physical_page, logical_page) and
    logical_page_end; adds ``back_matter``.
    """
    end = F.max("logical_page_end").over(Window.partitionBy("doc_id"))
    last = F.filter("blocks", lambda b: b["logical_page"] == F.col("__end"))
    early = F.filter("blocks", lambda b: b["logical_page"] < F.col("__end"))
    hits = F.size(F.filter("__last", lambda b: b["text"].rlike(BACK_BLOCK)))
    out = sections.withColumn("__end", end).withColumns({"__last": last, "__early": early})
    cut = (F.col("logical_page_end") == F.col("__end")) & (F.size("__last") > 0) & (F.size("__early") > 0) & (hits >= F.greatest(F.lit(1), F.floor((F.size("__last") + 1) / 2)))
    parts = F.when(
        cut,
        F.array(
            F.struct(F.lit(0).alias("half"), F.col("heading"), F.col("__early").alias("blocks"), _content("__early").alias("content"), F.lit(False).alias("back_matter")),
            F.struct(F.lit(1).alias("half"), F.lit("").alias("heading"), F.col("__last").alias("blocks"), T.squeeze(F.array_join(F.transform("__last", lambda b: b["text"]), " ")).alias("content"), F.lit(True).alias("back_matter")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("half"), F.col("heading"), F.col("blocks"), F.col("content"), F.lit(False).alias("back_matter"))))
    kept = [c for c in sections.columns if c not in ("heading", "blocks", "content", "section_no")]
    flat = out.select("section_no", *kept, F.explode(parts).alias("p"))
    page = F.when(F.size("p.blocks") > 0, F.array_max(F.transform("p.blocks", lambda b: b["logical_page"]))).otherwise(F.col("logical_page_end"))
    flat = flat.select((F.col("section_no") * 2 + F.col("p.half")).alias("section_no"), *[c for c in kept if c != "logical_page_end"], page.alias("logical_page_end"), "p.heading", "p.blocks", "p.content", "p.back_matter")
    return flat


def _content(blocks: str) -> Column:
    body = F.filter(blocks, lambda b: b["type"].isin("paragraph", "list_item", "table_row", "table_header"))
    return T.squeeze(F.array_join(F.transform(body, lambda b: b["text"]), " "))


def roles(sections: DataFrame, documents: DataFrame) -> DataFrame:
    """``sections`` with section_type and include_in_llm.

    ``documents``: doc_id, toc_end (last page of a table of contents, 0 if
    none), total_pages. The first rule that holds decides.
    """
    h, k = F.col("heading"), F.col("__k")
    p0, p1 = F.col("physical_page_start"), F.col("physical_page_end")
    toc, total = F.coalesce("toc_end", F.lit(0)), F.coalesce("total_pages", F.lit(0))
    back = F.col("back_matter") if "back_matter" in sections.columns else F.lit(False)
    empty = (F.col("content") == "") & (F.size("blocks") == 0 if "blocks" in sections.columns else F.lit(True))
    kind = (
        F.when(k.isin("contents", "table of contents"), "toc")
        .when(k.isin("about this report", "reference") & (toc > 0) & (p0 <= toc), "front_matter")
        .when((h == "") & (toc > 0) & (p1 > 0) & (p1 <= toc), "front_matter")
        .when(k.isin("references", "bibliography"), "references")
        .when(k.startswith("appendix"), "appendix")
        .when(k.isin("acknowledgements", "acknowledgments"), "acknowledgements")
        .when(k.startswith("about ") & (total > 0) & (p0 >= F.greatest(F.lit(1), total - 2)), "back_matter")
        .when(back, "back_matter")
        .when((h == "") & (total > 0) & (p0 >= F.greatest(F.lit(1), total - 1)) & F.col("content").rlike(BACK_SECTION), "back_matter")
        .when((h != "") & empty, "container")
        .otherwise("section")
    )
    out = sections.join(documents, "doc_id", "left").withColumn("__k", T.heading_key(h)).withColumn("section_type", kind)
    return out.withColumn("include_in_llm", F.col("section_type").isin("section", "appendix")).drop("__k", "toc_end", "total_pages")


def clean_text(sections: DataFrame, metadata: DataFrame) -> DataFrame:
    """``doc_id, clean_text`` from sections for the model and (doc_id, title, author, description)."""
    of = lambda *kinds: F.transform(F.filter("blocks", lambda b: b["type"].isin(*kinds)), lambda b: b["text"])
    marks = F.repeat(F.lit("#"), F.least(F.lit(6), F.greatest(F.lit(2), F.col("level") + 1)))
    lines = lambda label, texts: F.transform(texts, lambda t: F.concat(F.lit(f"{label}: "), t))
    blank = lambda c: F.nullif(c, F.lit(""))
    figures = F.concat(lines("FIGURE", of("figure_title", "figure_caption")), lines("FIGURE_TEXT", of("figure_text")))
    body = F.concat_ws("\n", blank(F.col("content")), blank(F.array_join(figures, "\n")), blank(F.array_join(lines("CALLOUT", of("callout")), "\n")), blank(F.array_join(lines("FOOTNOTE", of("footnote")), "\n")))
    part = F.concat_ws("\n", F.when(F.col("heading") != "", F.concat(marks, F.lit(" "), "heading")), blank(body))
    own = sections.where(F.coalesce("include_in_llm", F.lit(True))).select("doc_id", "section_no", part.alias("part")).where("part <> ''")
    joined = own.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("section_no", "part"))), lambda x: x["part"]), "\n\n").alias("body"))
    said = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{label}: "), c))
    out = metadata.join(joined, "doc_id", "left")
    head = F.concat_ws("\n", said("TITLE", F.col("title")), said("AUTHOR", F.col("author")), said("DESCRIPTION", F.col("description")))
    return out.select("doc_id", F.concat_ws("\n\n", blank(head), blank(F.col("body"))).alias("clean_text"))


#: Characters a page below which a document is taken for scanned, and confidence below which headings are doubtful.
SCANNED, DOUBTFUL = 90, 0.78


def profile(segments: DataFrame, sections: DataFrame, documents: DataFrame) -> DataFrame:
    """One row a document: characters a page, blocks by kind, confidence, and warnings.

    ``documents``: doc_id, total_pages, toc_entries, outline_entries.
    """
    chars = segments.groupBy("doc_id").agg(F.sum(F.length("text")).alias("chars"))
    kinds = ("table_row", "callout", "list_item", "footnote", "figure_text")
    count = lambda k: F.sum(F.size(F.filter("blocks", lambda b: b["type"] == k)))
    headed = (F.col("heading") != "") & ~F.col("section_type").isin("front_matter", "toc")
    shape = sections.groupBy("doc_id").agg(*[count(k).alias(f"{k}s") for k in kinds], F.avg(F.when(headed, F.col("heading_confidence"))).alias("confidence"), F.count_if(T.numeric_depth(F.col("heading")).isNotNull()).alias("numbered"))
    out = documents.join(chars, "doc_id", "left").join(shape, "doc_id", "left").na.fill(0, ["chars", "numbered", *[f"{k}s" for k in kinds]])
    per_page = F.col("chars") / F.greatest(F.lit(1), F.col("total_pages"))
    scanned = (F.col("total_pages") > 0) & (per_page < SCANNED)
    warn = F.filter(
        F.array(
            F.when(scanned, "Very little selectable text was found; this PDF may require OCR."),
            F.when((F.col("toc_entries") == 0) & (F.col("outline_entries") == 0), "No author-supplied TOC/bookmarks were available; hierarchy relies on layout/typography."),
            F.when(F.col("confidence") < DOUBTFUL, "Average heading confidence is low; review section boundaries before downstream use."),
        ),
        lambda w: w.isNotNull(),
    )
    sources = F.filter(
        F.array(
            F.lit("geometry"), F.lit("typography"), F.when(F.col("toc_entries") > 0, "visible_toc"), F.when(F.col("outline_entries") > 0, "pdf_outline"), F.when(F.col("numbered") > 0, "explicit_numbering"),
            F.when(F.col("table_rows") > 0, "table_geometry"), F.when(F.col("list_items") > 0, "list_geometry"), F.when(F.col("figure_texts") > 0, "figure_geometry"), F.when(F.col("footnotes") > 0, "footnote_geometry"),
        ),
        lambda s: s.isNotNull(),
    )
    return out.select(
        "doc_id",
        ((F.col("chars") > 0) & ~scanned).alias("text_native"),
        scanned.alias("likely_scanned_or_low_text"),
        F.round(per_page, 1).alias("average_extracted_chars_per_page"),
        *[f"{k}s" for k in kinds],
        F.round(F.coalesce("confidence", F.lit(0.0)), 3).alias("average_heading_confidence"),
        sources.alias("structure_sources_used"),
        warn.alias("structure_warnings"),
    )
