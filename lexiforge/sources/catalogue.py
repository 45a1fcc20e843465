"""Catalogues, stage outputs, spreadsheets, documents and web pages as DataFrames."""

from __future__ import annotations

import io
import re
import time
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions import urls as U

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def read_sheet(raw: bytes, sheet: str) -> list[list[str | None]]:
    """Cells of a sheet of a workbook, as text; missing cells are None."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        found = next((s for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet") if s.get("name") == sheet), None)
        if found is None:
            raise ValueError(f"the workbook has no sheet {sheet!r}")
        target = targets[found.get(f"{_REL}id")].lstrip("/")
        body = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
    rows = []
    for row in body.iter(f"{_MAIN}row"):
        cells: dict[int, str | None] = {}
        for at, c in enumerate(row.iter(f"{_MAIN}c")):
            letters = re.match(r"[A-Z]+", c.get("r") or "")
            column = at
            if letters:
                column = 0
                for ch in letters[0]:
                    column = column * 26 + ord(ch) - 64
                column -= 1
            value, kind = c.find(f"{_MAIN}v"), c.get("t")
            if kind == "inlineStr":
                cells[column] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
            elif value is not None and value.text is not None:
                cells[column] = shared[int(value.text)] if kind == "s" else value.text
        rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return rows


def spreadsheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """``path, row_no, cells map<header, text>`` of all workbooks under ``path``, in any store that Spark reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("row_no", pa.int32()), ("cells", pa.map_(pa.string(), pa.string()))])
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = read_sheet(raw, sheet)
                head = [(h or "").strip() for h in rows[0]] if rows else []
                out = [
                    {"path": name, "row_no": i, "cells": [(h, r[k]) for k, h in enumerate(head) if h and k < len(r) and r[k] is not None]}
                    for i, r in enumerate(rows[1:], 1)
                ]
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, row_no int, cells map<string,string>")


def resources(sheet: DataFrame) -> DataFrame:
    """Catalogue rows with a web address: title, url, author, resource_id, and the states before fetching.

    Missing cells take the defaults, and an address must have an authority.
    """
    cell = lambda name, default: F.coalesce(F.trim(F.try_element_at("cells", F.lit(name))), F.lit(default))
    out = sheet.select(
        cell("Title", "").alias("title"),
        cell("URL", "").alias("url"),
        cell("Author", "Unknown").alias("author"),
        F.coalesce(F.trim(F.try_element_at("cells", F.lit("Resource ID"))), F.col("row_no").cast("string")).alias("resource_id"),
        F.lit("pending").alias("status"),
        F.lit("unknown").alias("url_type"),
    )
    return out.where(F.col("url").startswith("http") & (U.netloc(F.col("url")) != "") & (F.col("title") != ""))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that hold one JSON array each; always with a schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


# Fixed format: the fields of a tagged resource's file.
TAGGED = (
    "resource_id string, title string, url string, source string, chunk_count int, "
    "tags map<string,array<struct<tag:string,confidence:string,chunk_count:int,chunk_indices:array<int>,evidence:array<string>,rescued:boolean>>>, "
    "conflicts array<struct<dimension:string,conflict:array<string>,note:string>>, "
    "stats struct<total_tags_assigned:int,tags_rescued:int,total_errors:int,total_olmo_calls:int>"
)


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """``resource_id, dim, tag`` of tagged files; several files of a resource are united."""
    tagged = json_array(spark, path, TAGGED).select("resource_id", F.explode("tags").alias("dim", "own"))
    return tagged.select("resource_id", "dim", F.explode("own.tag").alias("tag")).distinct()


def chunk_texts(chunks: DataFrame) -> DataFrame:
    """Text of a chunk from its lines."""
    return chunks.withColumn("text", F.array_join("text_lines", "\n"))


def clean_text_of(rows: DataFrame, resource_id: str) -> DataFrame:
    """Title, address and text of one resource."""
    title = F.coalesce(F.nullif("clean_title", F.lit("")), "title") if "clean_title" in rows.columns else F.col("title")
    return rows.where(F.col("resource_id").cast("string") == resource_id).select(title.alias("title"), "url", "clean_text")


def files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """``resource_id, content`` of cached files; the id is the file's name."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return raw.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("resource_id"), "content")


def uncached(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """Resources whose file still has to be fetched."""
    return wanted.join(cached.select("resource_id"), "resource_id", "left_anti")


# -- the web -------------------------------------------------------------------------


@lru_cache(maxsize=1024)
def _parser(rules: str):
    from urllib.robotparser import RobotFileParser

    parser = RobotFileParser()
    parser.parse(rules.splitlines())
    return parser


def allowed(rules: str | None, agent: str, url: str) -> bool:
    """Whether a robots.txt lets an agent at an address; without rules all is allowed. Rules are parsed once."""
    return not rules or _parser(rules).can_fetch(agent, url)


def robots_gate(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """``urls`` with ``allowed``, from a table of rules by host."""

    @F.pandas_udf(BooleanType())
    def gate(rules: pd.Series, url: pd.Series) -> pd.Series:
        return pd.Series([allowed(r, agent, u) for r, u in zip(rules, url, strict=True)], dtype=bool)

    hosts = robots.select(F.col("host").alias("__host"), F.col("rules").alias("__rules"))
    out = urls.join(hosts, U.netloc(F.col("url")) == F.col("__host"), "left")
    return out.withColumn("allowed", gate("__rules", "url")).drop("__host", "__rules")


def failure(kind: Column, detail: Column) -> Column:
    """Reason of a failed fetch in words."""
    return F.when(kind == "http", F.concat(F.lit("http-error ("), detail, F.lit(")"))).when(kind == "unknown", F.concat(F.lit("unknown-error ("), detail, F.lit(")"))).otherwise(kind)


def fetch(urls: DataFrame, agent: str, seconds: float = 1.5, timeout: float = 15.0, opener=None) -> DataFrame:
    """``url, status, error, final_url, content_type, html`` of each address.

    One host's addresses are fetched by one task, ``seconds`` apart, so the
    spacing holds across the cluster; ``opener(url) -> (code, final url, type,
    text)`` replaces the network in tests.
    """

    def get(url: str):
        import urllib.request

        request = urllib.request.Request(url, headers={"User-Agent": agent})
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.status, r.url, r.headers.get("Content-Type", ""), r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")

    def one(url: str) -> dict:
        import socket
        import urllib.error

        out = {"url": url, "status": "success", "error": None, "final_url": None, "content_type": None, "html": None}
        try:
            code, final, kind, text = (opener or get)(url)
        except urllib.error.HTTPError as e:
            return out | {"status": "http_error", "error": f"HTTP {e.code}"}
        except (TimeoutError, socket.timeout):
            return out | {"status": "timeout", "error": "timeout"}
        except (urllib.error.URLError, ConnectionError) as e:
            return out | {"status": "connection_error", "error": str(e)[:120]}
        except Exception as e:  # noqa: BLE001  any page may fail in its own way, and its row says how
            return out | {"status": "error", "error": f"{type(e).__name__}: {e}"[:120]}
        if code != 200:
            return out | {"status": "http_error", "error": f"HTTP {code}"}
        if "pdf" in (kind or "").lower() or (final or "").lower().split("?")[0].endswith(".pdf"):
            return out | {"status": "redirect_to_pdf", "final_url": final, "content_type": kind}
        return out | {"final_url": final, "content_type": kind, "html": text}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.string()) for n in ("url", "status", "error", "final_url", "content_type", "html")])
        last: dict[str, float] = {}
        for batch in batches:
            for host, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                wait = last.get(host, 0) + seconds - time.monotonic()
                if wait > 0:
                    time.sleep(wait)
                last[host] = time.monotonic()
                yield pa.RecordBatch.from_pylist([one(url)], schema=schema)

    rows = urls.select(U.netloc(F.col("url")).alias("host"), "url").repartition("host")
    return rows.mapInArrow(run, "url string, status string, error string, final_url string, content_type string, html string")
