"""Profiles, routes and status accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U


def profile(docs: DataFrame, text: str = "text", counter=None) -> DataFrame:
    """``docs`` with word, character and token counts and the route.

    ``counter``: a function of a column that counts tokens exactly, as
    ``functions.tokens.exact`` makes one; without it words times 1.35 are taken.
    """
    counted = docs.withColumns({"word_count": T.word_count(F.col(text)), "char_count": F.length(text)})
    tokens = counter(F.col(text)) if counter else F.floor(F.col("word_count") * T.TOKENS_PER_100_WORDS / 100).cast("int")
    return counted.withColumn("token_count", tokens).withColumn("route", T.route(F.col("token_count")))


def route_counts(profiled: DataFrame, *keys: str) -> DataFrame:
    return profiled.groupBy(*keys, "route").agg(F.count(F.lit(1)).alias("n"), F.sum("token_count").alias("tokens"))


def route_rollup(profiled: DataFrame, key: str) -> DataFrame:
    """Counts by key and route, by key, and in all; ``grain`` tells them apart."""
    return profiled.rollup(key, "route").agg(
        F.grouping_id().cast("int").alias("grain"), F.count(F.lit(1)).alias("n"), F.sum("token_count").alias("tokens"), F.max("word_count").alias("longest")
    )


def fetch_status(url: Column, failure: Column, n_words: Column) -> Column:
    """The first that holds: a PDF isn't fetched, a failure, too few words without scripts, success."""
    return (
        F.when(U.url_class(url) == "pdf", "pdf-skip")
        .when(failure.isNotNull(), "failed")
        .when(T.js_heavy(n_words), "js-skip")
        .otherwise("success")
    )


def status_counts(resources: DataFrame) -> DataFrame:
    return resources.agg(
        *[F.count_if(F.col("status") == s).alias(s.replace("-", "_")) for s in ("success", "pdf-skip", "js-skip", "failed")],
        F.count(F.lit(1)).alias("total"),
    )


def skipped_log(resources: DataFrame) -> DataFrame:
    """What was left out and why."""
    reason = F.when(F.col("status") == "pdf-skip", "pdf").when(F.col("status") == "failed", "fetch-failed").otherwise("js-heavy")
    return resources.where("status <> 'success'").select(
        "resource_id",
        "url",
        reason.alias("reason"),
        F.when(F.col("status") == "failed", F.col("failure")).alias("failure_detail"),
        F.when(F.col("status") == "js-skip", F.col("word_count")).alias("word_count"),
    )


def stage_input(rows: DataFrame, column: str, wanted: str, ids: list[str] | None = None) -> DataFrame:
    """Rows that a stage takes in: of one status and, if given, of the named resources."""
    taken = rows.where(F.col(column) == wanted)
    return taken.where(F.col("resource_id").isin(ids)) if ids else taken


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key, the last by ``order``; a struct aggregate, so it combines before the shuffle."""
    others = [c for c in rows.columns if c not in (key, order)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("__row"))
    return best.select(key, *[F.col("__row").getField(c).alias(c) for c in others])


def parent_lookup(wanted: DataFrame, web: DataFrame, files: DataFrame, order: str | None = None) -> DataFrame:
    """The web row of a resource, else its file's row.

    Of several rows with one ``resource_id`` the last by ``order`` counts; without
    it either side holds one row a resource.
    """
    if order is not None:
        web, files = (latest(x, "resource_id", order) for x in (web, files))
    cols = [c for c in web.columns if c != "resource_id"]
    a = web.select("resource_id", F.struct(*cols, F.lit("web").alias("source")).alias("__a"))
    b = files.select("resource_id", F.struct(*cols, F.lit("file").alias("source")).alias("__b"))
    joined = wanted.join(a, "resource_id", "left").join(b, "resource_id", "left").withColumn("__p", F.coalesce("__a", "__b"))
    return joined.select(*wanted.columns, *[F.col("__p").getField(c).alias(c) for c in [*cols, "source"]])


def driver_ids(linked: DataFrame, files: DataFrame) -> DataFrame:
    """All ids with linked content, and ids of read files that have none."""
    good = files.where("clean_status = 'success'").select("resource_id")
    return linked.select("resource_id").unionByName(good.join(linked.select("resource_id"), "resource_id", "left_anti"))
