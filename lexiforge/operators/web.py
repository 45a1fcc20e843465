"""Cleaning of web pages: boilerplate, sections, links, the text for a model.

Parsing is the one step without a built-in expression; it runs in Arrow batches
and returns structured columns: sections and resolved anchors. Kinds of links,
counts, routes and the assembled text are expressions on these.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import pairwise
from urllib.parse import urlparse

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..functions import dom
from ..functions import fixed_values as V
from ..functions import text as T
from ..functions import urls as U

_LINKED_NOISE = re.compile(V.LINKED_NOISE_PATTERN, re.I)
_SKIP = re.compile("|".join(f"(?:{p})" for p in U.SKIP_PATTERNS), re.I)
_HEADS = ("h1", "h2", "h3")
#: Where a description is looked for, first come first served.
DESCRIPTIONS = (("name", "description"), ("property", "og:description"), ("name", "twitter:description"))


def normalise(text: str) -> str:
    return re.sub(r"\s+", " ", text if text.isascii() else unicodedata.normalize("NFKC", text)).strip()


def visible_text(source: str | None) -> str:
    """All text outside scripts, styles and noscript, strings joined by a space."""
    page = dom.parse(source)
    page.remove(lambda i: page.name[i] == "noscript")
    return page.text(0, " ")


@F.pandas_udf(IntegerType())
def visible_words(sources: pd.Series) -> pd.Series:
    """Words of ``visible_text``."""
    return sources.map(lambda s: len(visible_text(s).split()))


def strip_boilerplate(page: dom.Outline) -> None:
    """Removes noise by tag, by class and id, and small navigation and share blocks."""
    social = frozenset(V.SOCIAL_WORDS)

    def noise(i):
        return page.name[i] in V.NOISE_TAGS or any(m in page.marks(i) for m in V.NOISE_PATTERNS)

    def local_menu(i):
        return page.name[i] in ("ul", "nav", "section") and page.size(i) < 300 and page.text(i).lower().startswith("in this section")

    def share_box(i):
        return page.name[i] in ("div", "ul", "section") and page.count(i) < 80 and len(social & {*page.text(i, " ").lower().split()}) >= 3

    for rule in (noise, local_menu, share_box):
        page.remove(rule)


def description(page: dom.Outline) -> str:
    """The first of the usual meta descriptions that says something."""
    told: dict[tuple, str] = {}
    for i in page.named(("meta",)):
        for place in DESCRIPTIONS:
            if page.attrs[i].get(place[0]) == place[1]:
                told.setdefault(place, page.attrs[i].get("content", ""))
    return next((told[p].strip() for p in DESCRIPTIONS if told.get(p)), "")


def anchors(page: dom.Outline, base: str, join: str = " ") -> Iterator[tuple[str, str]]:
    """(absolute target, text) of the anchors that lead to another page, in order."""
    for i in page.named(("a",)):
        href = page.attrs[i].get("href", "").strip()
        if href and not href.startswith("#") and (target := U.absolute(base, href)) is not None:
            yield target, page.text(i, join)


def targets(page: dom.Outline, base: str) -> list[dict]:
    """Each target with the text of its first anchor."""
    first: dict[str, str] = {}
    for url, text in anchors(page, base):
        if not url.startswith("mailto:"):
            first.setdefault(url, normalise(text))
    return [{"text": text, "url": url} for url, text in first.items()]


def main_container(page: dom.Outline) -> int | None:
    """main, article, a division named for content, the largest division, or the body."""
    first: dict[str, int] = {}
    for i in page.named(("main", "article", "body")):
        first.setdefault(page.name[i], i)
    if {"main", "article"} & first.keys():
        return first.get("main", first.get("article"))
    divisions = list(page.named(("div",)))
    by_id, by_class = {}, {}
    for i in reversed(divisions):  # the first of a name is what stays
        by_id[page.attrs[i].get("id")] = i
        by_class.update((c, i) for c in page.attrs[i].get("class", "").split())
    hinted = [by_id.get(h, by_class.get(h)) for h in V.CONTENT_HINTS]
    # max() takes the first of equally large ones
    likely = [*hinted, max(divisions, key=page.size, default=None)]
    return next((i for i in likely if i is not None and page.size(i) > 200), first.get("body"))


def sections(page: dom.Outline) -> list[dict]:
    """Text under each heading of up to 15 words, in document order; longer headings are passed over."""
    place = main_container(page)
    if place is None:
        return []
    # which content tags an element stands in, a bit each
    bit = {name: 1 << n for n, name in enumerate(V.CONTENT_TAGS)}
    within = [0] * len(page.name)
    for i in range(1, len(within)):
        up = page.parent[i]
        within[i] = within[up] | bit.get(page.name[up], 0)
    items = []  # (tag of a heading or "", text)
    for i in page.below(place):
        own = bit.get(page.name[i], 0)
        if page.name[i] in _HEADS or (own and not within[i] & ~own):
            text = normalise(page.text(i, " "))
            if text and (own or len(text.split()) <= 15):
                items.append(("" if own else page.name[i], text))
    items.insert(0, ("preamble", ""))
    cuts = [n for n, (level, _) in enumerate(items) if level]
    parts = [(items[lo], normalise(" ".join(t for _, t in items[lo + 1 : hi]))) for lo, hi in pairwise([*cuts, len(items)])]
    return [{"heading": head, "level": level, "content": text} for (level, head), text in parts if text]


def headings(page: dom.Outline) -> list[str]:
    """Distinct headings of 4 characters to 12 words."""
    found = (normalise(page.text(i, " ")) for i in page.named(_HEADS))
    return list(dict.fromkeys(t for t in found if len(t) > 3 and len(t.split()) <= 12))


_LINK = pa.list_(pa.struct([("text", pa.string()), ("url", pa.string())]))
_LINK_DDL = "array<struct<text:string,url:string>>"
PARSED = pa.schema(
    [
        ("page_title", pa.string()),
        ("description", pa.string()),
        ("sections", pa.list_(pa.struct([("heading", pa.string()), ("level", pa.string()), ("content", pa.string())]))),
        ("links", _LINK),
    ]
)
PARSED_DDL = f"page_title string, description string, sections array<struct<heading:string,level:string,content:string>>, links {_LINK_DDL}"


def _title(page: dom.Outline) -> int | None:
    return next(page.named(("title",)), None)


def _parse_page(source: str, url: str, title: str, closed: bool) -> dict:
    page = dom.parse(source, closed)
    tag = _title(page)
    out = {"page_title": title if tag is None else page.text(tag, " "), "description": normalise(description(page)), "links": targets(page, url)}
    strip_boilerplate(page)  # after the links, which the navigation holds too
    return {**out, "sections": sections(page)}


def _clean(batches: Iterator[pa.RecordBatch], closed: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, url, title, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = _parse_page(source, url or "", title or "", closed) if source else None
            rows.append({"resource_id": key, "url": url, "page": page})
        kind = pa.schema([("resource_id", pa.int64()), ("url", pa.string()), ("page", pa.struct(list(PARSED)))])
        yield pa.RecordBatch.from_pylist(rows, schema=kind)


def page_targets(pages: DataFrame) -> DataFrame:
    """``page_id, base, links``: the targets of (page_id, url, html), each by its first anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [targets(dom.parse(s), b or "") for b, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _LINK)], names=["page_id", "base", "links"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, f"page_id long, base string, links {_LINK_DDL}")


def of_kind(links: Column, base: Column, kind: str) -> Column:
    """The links of an array that are of a kind and say something."""
    return F.filter(links, lambda x: (F.length(x["text"]) >= 3) & F.coalesce(U.link_kind(x["url"], base) == kind, F.lit(False)))


def listed(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(x["text"], F.lit(" ("), x["url"], F.lit(")"))), " | ")


def said(label: str, value: Column) -> Column:
    """``LABEL: value`` or null without a value, for concat_ws."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))


def clean_pages(pages: DataFrame, closed: bool = False) -> DataFrame:
    """Cleaned pages from (resource_id, url, title, html); null html is a failed fetch with empty results.

    ``closed``: only character references with their semicolon are read.
    """
    kind = ", ".join(f"{a}:{b}" for a, b in (x.split(" ", 1) for x in PARSED_DDL.split(", ")))
    parsed = pages.select("resource_id", "url", "title", "html").mapInArrow(lambda batches: _clean(batches, closed), f"resource_id long, url string, page struct<{kind}>")
    good = F.col("page").isNotNull()
    body = T.squeeze(F.array_join(F.transform("page.sections", lambda s: s["content"]), " "))
    out = parsed.select(
        "resource_id",
        "url",
        F.when(good, "success").otherwise("fetch-failed").alias("clean_status"),
        F.coalesce(T.normalise_web(T.edge_trim(F.col("page.page_title"))), F.lit("")).alias("clean_title"),
        F.coalesce("page.description", F.lit("")).alias("description"),
        F.filter(F.transform("page.sections", lambda s: s["heading"]), lambda h: h != "").alias("headings"),
        F.transform(
            "page.sections",
            lambda s: F.struct(
                s["heading"].alias("heading"),
                s["level"].alias("level"),
                s["content"].alias("content"),
                T.word_count(s["content"]).alias("word_count"),
                F.length(s["content"]).alias("char_count"),
                T.approx_tokens(s["content"]).alias("token_count"),
            ),
        ).alias("sections"),
        F.coalesce(body, F.lit("")).alias("body_text"),
        *[of_kind(F.col("page.links"), F.col("url"), kind).alias(f"{kind}_links") for kind in ("pdf", "external", "internal")],
    )
    part = F.transform("sections", lambda s: F.when(s["heading"] != "", F.concat(F.lit("## "), s["heading"], F.lit("\n"), s["content"])).otherwise(s["content"]))
    head = F.concat_ws("\n", said("TITLE", F.col("clean_title")), said("DESCRIPTION", F.col("description")))
    tail = F.concat_ws("\n", said("PDF LINKS", listed(F.col("pdf_links"))), said("EXTERNAL LINKS", listed(F.slice("external_links", 1, 10))))
    blank = lambda c: F.nullif(c, F.lit(""))
    text = F.concat_ws("\n\n", blank(head), blank(F.array_join(part, "\n\n")), blank(tail))
    out = out.withColumn("clean_text", F.when(F.col("clean_status") == "success", text))
    counted = out.withColumns({"word_count": T.word_count(F.col("body_text")), "char_count": F.coalesce(F.length("clean_text"), F.lit(0)), "token_count": T.approx_tokens(F.col("clean_text"))})
    return counted.withColumn("route_hint", T.route(F.col("token_count")))


# -- linked pages -----------------------------------------------------------------


def _linked_page(source: str, url: str, closed: bool) -> dict:
    page = dom.parse(source, closed)
    tag = _title(page)
    meta = next((i for i in page.named(("meta",)) if page.attrs[i].get("name", "").lower() == "description"), None)
    page.remove(lambda i: page.name[i] in V.LINKED_NOISE_TAGS or bool(_LINKED_NOISE.search(page.marks(i))))
    first = {page.name[i]: i for i in reversed(list(page.named(("main", "article", "body"))))}
    place = first.get("main", first.get("article", first.get("body", 0)))
    blocks = (page.text(i, " ") for i in page.named(("p", "li", "td", "th", "h1", "h2", "h3", "h4", "h5"), place))
    links = [{"text": text or target, "url": target} for target, text in anchors(page, url, "") if not _SKIP.search(target)]
    is_pdf = [x["url"].lower().partition("?")[0].endswith(".pdf") for x in links]
    here = urlparse(url).netloc
    return {
        "title": "" if tag is None else page.text(tag),
        "description": "" if meta is None else page.attrs[meta].get("content", "").strip(),
        "headings": [t for t in (page.text(i) for i in page.named(("h1", "h2", "h3", "h4"))) if t],
        "body_text": " ".join(t for t in blocks if len(t) > 20),
        "pdf_links": [x for x, pdf in zip(links, is_pdf, strict=True) if pdf],
        "external_links": [x for x, pdf in zip(links, is_pdf, strict=True) if not pdf and urlparse(x["url"]).netloc != here],
    }


def _linked(batches: Iterator[pa.RecordBatch], closed: bool = False) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("resource_id", pa.int64()), ("url", pa.string()), ("title", pa.string()), ("description", pa.string()), ("headings", pa.list_(pa.string())), ("body_text", pa.string()), ("pdf_links", _LINK), ("external_links", _LINK)]
    )
    for batch in batches:
        rows = [{"resource_id": k, "url": u, **_linked_page(s or "", u or "", closed)} for k, u, s in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def clean_linked_pages(pages: DataFrame, closed: bool = False) -> DataFrame:
    """Pages that a resource links to, from (resource_id, url, html), in the fixed six-block text; ``closed`` as in ``clean_pages``."""
    kind = f"resource_id long, url string, title string, description string, headings array<string>, body_text string, pdf_links {_LINK_DDL}, external_links {_LINK_DDL}"
    out = pages.select("resource_id", "url", "html").mapInArrow(lambda batches: _linked(batches, closed), kind)
    some = lambda items, none: F.when(F.size(items) > 0, listed(items)).otherwise(none)
    text = F.concat_ws(
        "\n\n",
        F.concat(F.lit("TITLE: "), "title"),
        F.concat(F.lit("DESCRIPTION: "), "description"),
        F.concat(F.lit("HEADINGS: "), F.when(F.size("headings") > 0, F.array_join("headings", " | ")).otherwise("N/A")),
        F.concat(F.lit("CONTENT: "), "body_text"),
        F.concat(F.lit("PDF LINKS: "), some(F.col("pdf_links"), "None")),
        F.concat(F.lit("EXTERNAL LINKS: "), some(F.slice("external_links", 1, 20), "None")),
    )
    out = out.withColumn("clean_text", text)
    counted = out.withColumns({"word_count": T.word_count(F.col("body_text")), "char_count": F.length("clean_text"), "token_count": T.approx_tokens(F.col("clean_text"))})
    return counted.withColumn("route_hint", T.route(F.col("token_count")))

