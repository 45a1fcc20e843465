"""URL predicates and parts."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Links that are never followed (mail, phone, share buttons, forms, licences, media).
SKIP_PATTERNS = [
    r"^mailto:",
    r"^tel:",
    r"linkedin\.com/shareArticle",
    r"twitter\.com/(intent|home\?status)",
    r"facebook\.com/sharer",
    r"forms\.cloud\.microsoft",
    r"creativecommons\.org/licenses",
    r"#$",
    r"\.(jpg|jpeg|png|gif|svg|ico|mp4|mp3|zip|exe)(\?.*)?$",
]


def netloc(url: Column) -> Column:
    """Authority, empty if there is none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_class(url: Column) -> Column:
    """``pdf`` by the extension of the path, else ``webpage``; a leading dot makes no extension."""
    return F.when(F.lower(path(url)).rlike(r"[^/.][^/]*\.pdf$"), "pdf").otherwise("webpage")


def is_pdf_url(url: Column) -> Column:
    return F.substring_index(F.lower(url), "?", 1).endswith(".pdf")


def mentions_pdf(url: Column) -> Column:
    return F.lower(url).contains(".pdf")


def should_skip(url: Column) -> Column:
    return url.rlike("(?i)" + "|".join(f"(?:{p})" for p in SKIP_PATTERNS))


def is_subpage(url: Column, base: Column) -> Column:
    """Same authority, and a path below the base's."""
    below, above = F.rtrim(path(url), F.lit("/")), F.rtrim(path(base), F.lit("/"))
    return (netloc(url) == netloc(base)) & (netloc(url) != "") & below.startswith(F.concat(above, F.lit("/"))) & (below != above)


def link_kind(url: Column, base: Column) -> Column:
    """``pdf``, ``external``, ``internal`` (a page below the base), or null for other pages of the site."""
    return F.when(mentions_pdf(url), "pdf").when((netloc(url) != "") & (netloc(url) != netloc(base)), "external").when(is_subpage(url, base), "internal")


def cache_name(parent_id: Column, url: Column) -> Column:
    """File name under which a linked document is kept."""
    return F.concat(parent_id.cast("string"), F.lit("_"), F.substring(F.md5(url), 1, 10), F.lit(".pdf"))


def absolute(base: str, href: str) -> str | None:
    """A link's target on a page, or null if it is no address."""
    try:
        url = urljoin(base, href)
        urlparse(url)
    except ValueError:
        return None
    return url


@F.pandas_udf(StringType())
def resolve(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """``absolute`` on columns; there is no built-in resolver."""
    for base, href in batches:
        yield pd.Series([absolute(b or "", h or "") for b, h in zip(base, href, strict=True)], dtype=object)
