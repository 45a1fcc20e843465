"""Links of pages, their caps, budgets and depth."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import links as L
from ..sources.tables import spread, table
from .registry import Registry, tokens

R = Registry()

_NET = r"regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"
_PATH = r"rtrim(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/')"

# the pages' own links lead elsewhere on their site; more are added that lead below, above, out, to files and nowhere
_MORE = """<a href="#top">top</a><a href="mailto:x@example.org">mail</a><a href="https://twitter.com/intent/tweet">tweet it</a><a href="https://z.example.org/">x</a><a href="https://z.example.org/">longer text</a>"""
_HTML = f"""(SELECT page_id, url, html || '<a href="' || split_part(split_part(url, '?', 1), '#', 1) || '/sub/' || (page_id % 4) || '">deeper</a>'
  || '<a href="https://other.example.org/' || (page_id % 5) || '">go out</a><a class=file href=''/files/' || page_id || '.pdf''>the <b>file</b> &amp; more</a>'
  || '<a href="../up/../above-' || (page_id % 3) || '.pdf">one level up</a>{_MORE}' AS html
  FROM pages)"""


def _pages(spark, sf_dir):
    bare = F.regexp_replace("url", r"[?#].*$", "")
    number = lambda n: (F.col("page_id") % n).cast("string")
    more = F.concat(
        F.col("html"),
        F.lit('<a href="'), bare, F.lit("/sub/"), number(4), F.lit('">deeper</a><a href="https://other.example.org/'),
        number(5), F.lit("\">go out</a><a class=file href='/files/"), F.col("page_id").cast("string"), F.lit(".pdf'>the <b>file</b> &amp; more</a>"),
        F.lit('<a href="../up/../above-'), number(3), F.lit('.pdf">one level up</a>'), F.lit(_MORE),
    )
    return spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", more.alias("html"))


_BARE = "regexp_replace(base, '[?#].*$', '')"
_FOLDER = "regexp_replace(CASE WHEN regexp_matches(bare, '^[a-z]+://[^/]*$') THEN bare || '/' ELSE bare END, '[^/]*$', '')"


def links_sql(pages: str) -> str:
    """WITH clauses up to ``links``, the targets of pages by their first anchors, for markup without nested anchors."""
    return rf"""
WITH m AS (
  SELECT page_id, url AS base, unnest(found) AS a, unnest(range(len(found))) AS nth
  FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*?href=(?:"[^"]*"|''[^'']*'')[^>]*>.*?</a>') AS found FROM {pages})
), a AS (
  SELECT page_id, base, {_BARE} AS bare, nth, trim(regexp_extract(a, '(?is)href=["'']([^"'']*)["'']', 1)) AS href, regexp_extract(a, '(?is)>(.*)</a>', 1) AS label FROM m
), d AS (
  SELECT *, {_FOLDER} AS folder FROM a WHERE href <> '' AND NOT starts_with(href, '#') AND NOT starts_with(href, 'mailto:')
), u AS (
  SELECT page_id, base, nth, trim(regexp_replace(replace(replace(replace(regexp_replace(label, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text,
         CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN href
              WHEN starts_with(href, '/') THEN regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.\-]*:)', 1) || '//' || {_NET.format("base")} || href
              WHEN starts_with(href, '../up/../') THEN regexp_replace(folder, '(://[^/]*/(?:.*/)?)[^/]+/$', '\1') || substr(href, 10)
              ELSE folder || href END AS url
  FROM d
), f AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY nth) AS n FROM u
), links AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS INTEGER) AS pos, url, text, CASE WHEN contains(lower(url), '.pdf') THEN 'pdf' WHEN {_NET.format("url")} <> '' AND {_NET.format("url")} <> {_NET.format("base")} THEN 'external'
    WHEN {_NET.format("url")} = {_NET.format("base")} AND starts_with({_PATH.format("url")}, {_PATH.format("base")} || '/') AND {_PATH.format("url")} <> {_PATH.format("base")} THEN 'internal' END AS kind
  FROM f WHERE n = 1
)"""


_LINKS = links_sql(_HTML)
_KEPT = _LINKS + ", kept AS (SELECT * FROM links WHERE kind IS NOT NULL AND length(text) >= 3)"
_SKIP = "regexp_matches(url, '(?i)(?:^mailto:)|(?:twitter\\.com/(intent|home\\?status))')"
_CAPPED = _KEPT + f", capped AS (SELECT *, CAST(row_number() OVER (PARTITION BY page_id, kind ORDER BY pos) AS INTEGER) AS rank FROM kept WHERE NOT {_SKIP})"


def _links(spark, sf_dir):
    return L.page_links(_pages(spark, sf_dir))


@R.add(_KEPT + " SELECT * FROM kept")
def page_links(spark, sf_dir):
    return _links(spark, sf_dir)


@R.add(_CAPPED + " SELECT * FROM capped WHERE rank <= 2")
def link_caps(spark, sf_dir):
    return L.capped(_links(spark, sf_dir), 2)


_RESULTS = ", results AS (SELECT page_id, kind, CASE WHEN (page_id + pos) % 3 = 0 THEN 'http_error' ELSE 'success' END AS status FROM capped WHERE rank <= 20 AND kind <> 'internal')"
_SUMMARY = (
    _CAPPED
    + _RESULTS
    + """, summary AS (
  SELECT page_id, ext_total, pdf_total, coalesce(ext_processed, 0) AS ext_processed, coalesce(ext_success, 0) AS ext_success, coalesce(ext_failed, 0) AS ext_failed,
         coalesce(pdf_processed, 0) AS pdf_processed, coalesce(pdf_success, 0) AS pdf_success, coalesce(pdf_failed, 0) AS pdf_failed
  FROM (SELECT page_id, count(*) FILTER (kind = 'external') AS ext_total, count(*) FILTER (kind = 'pdf') AS pdf_total FROM kept GROUP BY page_id)
  LEFT JOIN (SELECT page_id, count(*) FILTER (kind = 'external') AS ext_processed, count(*) FILTER (kind = 'external' AND status = 'success') AS ext_success,
    count(*) FILTER (kind = 'external' AND status <> 'success') AS ext_failed, count(*) FILTER (kind = 'pdf') AS pdf_processed,
    count(*) FILTER (kind = 'pdf' AND status = 'success') AS pdf_success, count(*) FILTER (kind = 'pdf' AND status <> 'success') AS pdf_failed
    FROM results GROUP BY page_id) USING (page_id))"""
)


def _summary(spark, sf_dir):
    links = _links(spark, sf_dir)
    tried = L.capped(links).where("kind <> 'internal'")
    results = tried.select("page_id", "kind", F.when((F.col("page_id") + F.col("pos")) % 3 == 0, "http_error").otherwise("success").alias("status"))
    return L.link_summary(links, results)


@R.add(_SUMMARY + " SELECT * FROM summary")
def link_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@R.add(_SUMMARY + " SELECT " + ", ".join(f"CAST(sum({a}_{b}) AS BIGINT) AS {a}_{b}" for a in ("ext", "pdf") for b in ("total", "processed", "success", "failed")) + " FROM summary")
def link_totals(spark, sf_dir):
    return L.link_totals(_summary(spark, sf_dir))


@R.add(
    _KEPT
    + """ SELECT p.page_id, coalesce(n, 0) AS n_internal, CASE WHEN coalesce(n, 0) = 0 THEN 'single-page' WHEN n <= 5 THEN 'shallow' WHEN n <= 20 THEN 'medium' ELSE 'deep' END AS depth
FROM pages p LEFT JOIN (SELECT k.page_id, count(DISTINCT rtrim(k.url, '/')) AS n FROM kept k JOIN pages q ON q.page_id = k.page_id
  WHERE kind = 'internal' AND rtrim(k.url, '/') <> rtrim(q.url, '/') GROUP BY k.page_id) USING (page_id)"""
)
def internal_depth(spark, sf_dir):
    return L.internal_depth(table(spark, sf_dir, "pages"), _links(spark, sf_dir))


# each document is linked from the page with the rest of its id by 50
_LINKED = f"(SELECT doc_id % 50 AS resource_id, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE {tokens('text')} END AS token_count FROM documents)"


@R.add(
    f"""SELECT p.page_id AS resource_id, CAST(length(html) // 100 AS INTEGER) AS parent_token_count, CAST(coalesce(s, 0) AS BIGINT) AS linked_token_count,
  CAST(length(html) // 100 + coalesce(s, 0) AS BIGINT) AS combined_token_count,
  CASE WHEN length(html) // 100 + coalesce(s, 0) <= 3796 THEN 'single_pass' ELSE 'map_reduce' END AS combined_route
FROM pages p LEFT JOIN (SELECT resource_id, sum(coalesce(token_count, 0)) AS s FROM {_LINKED} GROUP BY 1) l ON l.resource_id = p.page_id"""
)
def combined_budget(spark, sf_dir):
    parents = table(spark, sf_dir, "pages").select(F.col("page_id").alias("resource_id"), F.floor(F.length("html") / 100).cast("int").alias("token_count"))
    linked = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 50).alias("resource_id"), F.when(F.col("doc_id") % 13 != 0, T.approx_tokens(F.col("text"))).alias("token_count")
    )
    return L.combined_budget(parents, linked)


@R.add(
    f"""SELECT doc_id, kind, token_count FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'pdf' ELSE 'external' END AS kind,
  CASE WHEN doc_id % 5 = 0 THEN 'timeout' ELSE 'success' END AS status, {tokens("text")} AS token_count FROM documents)
WHERE status = 'success' AND (kind = 'pdf' OR token_count >= 50)"""
)
def usable_linked(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.when(F.col("doc_id") % 4 == 0, "pdf").otherwise("external").alias("kind"),
        F.when(F.col("doc_id") % 5 == 0, "timeout").otherwise("success").alias("status"),
        T.approx_tokens(F.col("text")).alias("token_count"),
    )
    return L.usable_linked(rows).select("doc_id", "kind", "token_count")
