"""Links of pages: classification, caps, budgets, depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from .web import page_targets

#: Links of each kind that are followed for a resource.
LINK_CAP = 20


def page_links(pages: DataFrame) -> DataFrame:
    """``page_id, pos, url, text, kind`` of the links of (page_id, url, html), by the first anchor of each target.

    A target counts as seen by its first anchor even if that one's text is too
    short to keep, so a later, better text doesn't bring it back. Positions count
    targets.
    """
    found = page_targets(pages).select("page_id", "base", F.posexplode("links").alias("pos", "a"))
    kept = found.where(F.length("a.text") >= 3)
    return kept.select("page_id", "pos", "a.url", "a.text", U.link_kind(F.col("a.url"), F.col("base")).alias("kind")).where("kind is not null")


def capped(links: DataFrame, cap: int = LINK_CAP) -> DataFrame:
    """The first ``cap`` links of each kind and page that aren't to be skipped."""
    rank = F.row_number().over(Window.partitionBy("page_id", "kind").orderBy("pos"))
    return links.where(~U.should_skip(F.col("url"))).withColumn("rank", rank).where(F.col("rank") <= cap)


def cap_in_place(links: Column, cap: int = LINK_CAP) -> Column:
    """The same for an array column, before it is exploded."""
    return F.slice(F.filter(links, lambda x: ~U.should_skip(x["url"])), 1, cap)


def link_summary(links: DataFrame, results: DataFrame) -> DataFrame:
    """Per page: links found, processed, succeeded and failed, of web pages and of documents."""
    found = links.groupBy("page_id").agg(
        F.count_if(F.col("kind") == "external").alias("ext_total"), F.count_if(F.col("kind") == "pdf").alias("pdf_total")
    )
    done = results.groupBy("page_id").agg(
        *[
            F.count_if((F.col("kind") == kind) & test).alias(f"{name}_{what}")
            for name, kind in (("ext", "external"), ("pdf", "pdf"))
            for what, test in (("processed", F.lit(True)), ("success", F.col("status") == "success"), ("failed", F.col("status") != "success"))
        ]
    )
    return found.join(done, "page_id", "left").na.fill(0)


def link_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(*[F.sum(c).alias(c) for c in summary.columns if c != "page_id"])


def combined_budget(parents: DataFrame, linked: DataFrame) -> DataFrame:
    """Tokens of a page and of what it links to, and the route they take together.

    Linked tokens are summed before the join, so a page with very many links
    sends one row.
    """
    sums = linked.groupBy("resource_id").agg(F.sum(F.coalesce("token_count", F.lit(0))).alias("linked_tokens"))
    out = parents.join(sums, "resource_id", "left").na.fill(0, ["linked_tokens"])
    total = F.col("token_count") + F.col("linked_tokens")
    return out.select(
        "resource_id",
        F.col("token_count").alias("parent_token_count"),
        F.col("linked_tokens").alias("linked_token_count"),
        total.alias("combined_token_count"),
        T.route(total).alias("combined_route"),
    )


def depth_label(n: Column) -> Column:
    return F.when(n == 0, "single-page").when(n <= 5, "shallow").when(n <= 20, "medium").otherwise("deep")


def internal_depth(pages: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct internal targets of each page, its own address aside, and what depth that suggests."""
    own = pages.select("page_id", F.rtrim("url", F.lit("/")).alias("own"))
    inner = links.where("kind = 'internal'").select("page_id", F.rtrim("url", F.lit("/")).alias("target")).distinct()
    n = inner.join(own, "page_id").where("target <> own").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_internal"))
    out = pages.select("page_id").join(n, "page_id", "left").na.fill(0, ["n_internal"])
    return out.withColumn("depth", depth_label(F.col("n_internal")))


def usable_linked(results: DataFrame, least_tokens: int = 50) -> DataFrame:
    """Linked content worth reading: fetched and read, and web pages of some length."""
    ok = (F.col("status") == "success") & F.col("text").isNotNull()
    return results.where(ok & ((F.col("kind") == "pdf") | (F.col("token_count") >= least_tokens)))


def linked_documents(results: DataFrame) -> DataFrame:
    """Linked documents with text as sources of chunks, numbered anew: resource_id, doc_id, title, url, clean_text."""
    good = results.where((F.col("kind") == "pdf") & (F.col("status") == "success") & (F.trim(F.coalesce("clean_text", F.lit(""))) != ""))
    order = Window.partitionBy("resource_id").orderBy("pos")
    return good.select("resource_id", F.concat(F.lit("pdf_"), F.row_number().over(order).cast("string")).alias("doc_id"), "title", "url", "clean_text")
