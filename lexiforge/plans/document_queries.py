"""Profiles, routes, fetch accounting, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import documents as D
from ..operators import web as W
from ..sources.tables import spread, table
from .registry import Registry, tokens, words

R = Registry()

_PROFILE = f"""
SELECT doc_id, lang, {words("text")} AS word_count, CAST(length(text) AS INTEGER) AS char_count, {tokens("text")} AS token_count,
       CASE WHEN {tokens("text")} <= 3796 THEN 'single_pass' ELSE 'map_reduce' END AS route
FROM documents"""


@R.add(_PROFILE)
def doc_profile(spark, sf_dir):
    return D.profile(table(spark, sf_dir, "documents")).select("doc_id", "lang", "word_count", "char_count", "token_count", "route")


@R.add(f"SELECT lang, route, count(*) AS n, CAST(sum(token_count) AS BIGINT) AS tokens FROM ({_PROFILE}) GROUP BY ALL")
def route_counts(spark, sf_dir):
    return D.route_counts(D.profile(table(spark, sf_dir, "documents")), "lang")


@R.add(
    f"""SELECT lang, route, CAST(grouping(lang, route) AS INTEGER) AS grain, count(*) AS n, CAST(sum(token_count) AS BIGINT) AS tokens, max(word_count) AS longest
FROM ({_PROFILE}) GROUP BY ROLLUP (lang, route)"""
)
def route_rollup(spark, sf_dir):
    return D.route_rollup(D.profile(table(spark, sf_dir, "documents")), "lang")


@R.add(
    r"""SELECT doc_id, c AS clean, CAST(length(c) AS INTEGER) AS clean_chars FROM (SELECT doc_id, trim(regexp_replace(text || ' fi2 ', '[\s\x{a0}]+', ' ', 'g')) AS c FROM documents)"""
)
def clean_whitespace(spark, sf_dir):
    clean = T.normalise_web(F.concat("text", F.lit("\u00a0\ufb01\u00b2 ")))
    return table(spark, sf_dir, "documents").select("doc_id", clean.alias("clean")).withColumn("clean_chars", F.length("clean"))


# every page address, and forms of it that the rules treat apart
_URLS = """
SELECT page_id, form, CASE form WHEN 0 THEN url WHEN 1 THEN split_part(split_part(url, '?', 1), '#', 1) || '.PDF?v=1'
  WHEN 2 THEN split_part(split_part(url, '?', 1), '#', 1) || '/.pdf' WHEN 3 THEN url || '#' ELSE 'mailto:' || page_id || '@example.org' END AS url
FROM pages, (VALUES (0), (1), (2), (3), (4)) f(form)"""


def _urls(spark, sf_dir):
    bare = F.regexp_replace("url", r"[?#].*$", "")
    forms = F.array(
        F.col("url"),
        F.concat(bare, F.lit(".PDF?v=1")),
        F.concat(bare, F.lit("/.pdf")),
        F.concat("url", F.lit("#")),
        F.concat(F.lit("mailto:"), F.col("page_id").cast("string"), F.lit("@example.org")),
    )
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(forms).alias("form", "url"))


@R.add(
    rf"""SELECT page_id, form, url, CASE WHEN regexp_matches(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)), '[^/.][^/]*\.pdf$') THEN 'pdf' ELSE 'webpage' END AS url_class,
  suffix(split_part(lower(url), '?', 1), '.pdf') AS pdf_by_suffix, contains(lower(url), '.pdf') AS pdf_mentioned
FROM ({_URLS})"""
)
def url_classify(spark, sf_dir):
    u = F.col("url")
    return _urls(spark, sf_dir).select("page_id", "form", "url", U.url_class(u).alias("url_class"), U.is_pdf_url(u).alias("pdf_by_suffix"), U.mentions_pdf(u).alias("pdf_mentioned"))


@R.add(f"SELECT page_id, form, url FROM ({_URLS}) WHERE NOT regexp_matches(url, '(?i)" + "|".join(f"(?:{p})" for p in U.SKIP_PATTERNS) + "')")
def url_skip_filter(spark, sf_dir):
    return _urls(spark, sf_dir).where(~U.should_skip(F.col("url")))


@R.add(
    r"""SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) AS netloc,
  regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path, page_id || '_' || substr(md5(url), 1, 10) || '.pdf' AS cache_name
FROM pages"""
)
def url_parts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.netloc(u).alias("netloc"), U.path(u).alias("path"), U.cache_name(F.col("page_id"), u).alias("cache_name"))


# visible words by pattern: script, style and noscript out, then comments and tags
_VISIBLE = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)\b.*?</(script|style|noscript)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
_FETCHED = f"""
SELECT resource_id, url, failure, word_count,
  CASE WHEN regexp_matches(lower(split_part(split_part(url, '?', 1), '#', 1)), '[^/.][^/]*\\.pdf$') THEN 'pdf-skip' WHEN failure IS NOT NULL THEN 'failed' WHEN word_count < 150 THEN 'js-skip' ELSE 'success' END AS status
FROM (
  SELECT page_id AS resource_id, CASE WHEN page_id % 7 = 0 THEN split_part(split_part(url, '?', 1), '#', 1) || '.pdf' ELSE url END AS url,
         CASE WHEN page_id % 11 = 0 THEN 'robots-blocked' END AS failure, {words(_VISIBLE)} AS word_count
  FROM pages)"""


def _fetched(spark, sf_dir):
    """Pages as fetched resources; some stand in for documents and for failures."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        F.col("page_id").alias("resource_id"),
        F.when(F.col("page_id") % 7 == 0, F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit(".pdf"))).otherwise(F.col("url")).alias("url"),
        F.when(F.col("page_id") % 11 == 0, "robots-blocked").alias("failure"),
        W.visible_words("html").alias("word_count"),
    )
    return pages.withColumn("status", D.fetch_status(F.col("url"), F.col("failure"), F.col("word_count")))


@R.add(f"SELECT resource_id, word_count, status FROM ({_FETCHED})")
def fetch_status(spark, sf_dir):
    return _fetched(spark, sf_dir).select("resource_id", "word_count", "status")


@R.add(
    f"""SELECT count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'pdf-skip') AS pdf_skip,
  count(*) FILTER (status = 'js-skip') AS js_skip, count(*) FILTER (status = 'failed') AS failed, count(*) AS total FROM ({_FETCHED})"""
)
def status_counts(spark, sf_dir):
    return D.status_counts(_fetched(spark, sf_dir))


@R.add(
    f"""SELECT resource_id, url, CASE status WHEN 'pdf-skip' THEN 'pdf' WHEN 'failed' THEN 'fetch-failed' ELSE 'js-heavy' END AS reason,
  CASE WHEN status = 'failed' THEN failure END AS failure_detail, CASE WHEN status = 'js-skip' THEN word_count END AS word_count
FROM ({_FETCHED}) WHERE status <> 'success'"""
)
def skipped_log(spark, sf_dir):
    return D.skipped_log(_fetched(spark, sf_dir))


@R.add(
    f"""SELECT q.resource_id, coalesce(a.title, b.title) AS title, coalesce(a.token_count, b.token_count) AS token_count,
  CASE WHEN a.resource_id IS NOT NULL THEN 'web' WHEN b.resource_id IS NOT NULL THEN 'file' END AS source
FROM (SELECT doc_id AS resource_id FROM labels UNION ALL SELECT -1 - doc_id FROM labels) q
LEFT JOIN (SELECT page_id AS resource_id, url AS title, CAST(length(html) AS INTEGER) AS token_count FROM pages) a USING (resource_id)
LEFT JOIN (SELECT doc_id AS resource_id, source AS title, {tokens("text")} AS token_count FROM documents) b USING (resource_id)"""
)
def parent_lookup(spark, sf_dir):
    web = table(spark, sf_dir, "pages").select(F.col("page_id").alias("resource_id"), F.col("url").alias("title"), F.length("html").alias("token_count"))
    files = table(spark, sf_dir, "documents")
    files = files.select(F.col("doc_id").alias("resource_id"), F.col("source").alias("title"), T.approx_tokens(F.col("text")).alias("token_count"))
    labels = table(spark, sf_dir, "labels")
    asked = labels.select(F.col("doc_id").alias("resource_id")).union(labels.select(-1 - F.col("doc_id")))  # and ids that exist nowhere
    return D.parent_lookup(asked, web, files)


@R.add(
    """SELECT page_id AS resource_id FROM pages UNION ALL
SELECT doc_id FROM documents d WHERE doc_id % 3 = 0 AND NOT EXISTS (SELECT 1 FROM pages WHERE page_id = doc_id)"""
)
def driver_ids(spark, sf_dir):
    linked = table(spark, sf_dir, "pages").select(F.col("page_id").alias("resource_id"))
    status = F.when(F.col("doc_id") % 3 == 0, "success").otherwise("extraction-failed")
    return D.driver_ids(linked, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("resource_id"), status.alias("clean_status")))


@R.add("SELECT user_id, event_type AS last_type, value AS last_value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_row(spark, sf_dir):
    """The last of several rows with the same id wins."""
    out = D.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")
    return out.withColumnsRenamed({"event_type": "last_type", "value": "last_value"})


@R.add("SELECT doc_id AS resource_id, 'success' AS status FROM labels WHERE toxic = 0")
def stage_input(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("resource_id"), F.when(F.col("toxic") == 1, "failed").otherwise("success").alias("status"))
    return D.stage_input(rows, "status", "success")
