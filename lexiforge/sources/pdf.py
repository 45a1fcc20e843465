"""Documents as lines, words, bookmarks and metadata, with whichever PDF library is installed.

Each function takes (resource_id, content) rows, as ``catalogue.files`` gives
them, and returns the tables that the layout operators start from. Without a
library the call fails at once and says what is missing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import layout as L


def library():
    """The layout library, or an error that names it."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("reading the layout of PDF files needs the PyMuPDF package on driver and executors") from e
    return fitz


BOLD = re.compile(r"bold|black|heavy|medium|(?:^|[-_])(?:\d{2})?(?:md|bd|blk)(?:$|[-_])")


def line_style(spans: list[dict]) -> tuple[float, bool]:
    """Mean size by characters, and whether most characters are emphasised."""
    parts = [(max(1, len(s["text"].strip())), float(s["size"]), bool(BOLD.search((s.get("font") or "").strip().lower()))) for s in spans if s["text"].strip()]
    n = sum(w for w, _, _ in parts)
    return (round(sum(w * size for w, size, _ in parts) / n, 1), sum(w for w, _, bold in parts if bold) / n >= 0.55) if n else (0.0, False)


LINES = (
    "doc_id string, pos int, block int, text string, font_size double, bold boolean, x0 double, y0 double, x1 double, y1 double, "
    "physical_page int, page_width double, page_height double"
)
WORDS = "doc_id string, physical_page int, x0 double, y0 double, x1 double, y1 double, text string, page_width double, page_height double"
BOOKMARKS = "doc_id string, entry int, title string, level int, physical_page int"


def _pages(open_document):
    def lines(name: str, raw: bytes) -> list[dict]:
        out = []
        for number, page in enumerate(open_document(raw)[: L.PAGE_CAP], 1):
            for b, block in enumerate(page.get_text("dict", sort=False).get("blocks", [])):
                for line in block.get("lines", []):
                    text = "".join(s["text"] for s in line["spans"]).strip()
                    if text:
                        size, bold = line_style(line["spans"])
                        x0, y0, x1, y1 = map(float, line["bbox"])
                        out.append({"doc_id": name, "pos": len(out), "block": b, "text": text, "font_size": size, "bold": bold, "x0": x0, "y0": y0, "x1": x1, "y1": y1, "physical_page": number, "page_width": float(page.rect.width), "page_height": float(page.rect.height)})
        return out

    return lines


def _table(files: DataFrame, rows, ddl: str) -> DataFrame:
    library()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        schema = pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in ddl.split(", "))])
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = rows(name, raw)
                except Exception:  # noqa: BLE001  a damaged file gives no rows, as one without text
                    found = []
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    return files.select("resource_id", "content").mapInArrow(run, ddl)


def _open(raw: bytes):
    return library().open(stream=raw, filetype="pdf")


def lines(files: DataFrame) -> DataFrame:
    """Visual lines with style and place, up to the page cap."""
    return _table(files, lambda name, raw: _pages(_open)(name, raw), LINES)


def words(files: DataFrame) -> DataFrame:
    """Words with place, for telling spreads."""

    def rows(name, raw):
        out = []
        for number, page in enumerate(_open(raw)[: L.PAGE_CAP], 1):
            for w in page.get_text("words", sort=False):
                out.append({"doc_id": name, "physical_page": number, "x0": float(w[0]), "y0": float(w[1]), "x1": float(w[2]), "y1": float(w[3]), "text": str(w[4]), "page_width": float(page.rect.width), "page_height": float(page.rect.height)})
        return out

    return _table(files, rows, WORDS)


def bookmarks(files: DataFrame) -> DataFrame:
    """The outline of each document."""
    return _table(files, lambda name, raw: [{"doc_id": name, "entry": i, "title": t, "level": int(n), "physical_page": int(p)} for i, (n, t, p, *_) in enumerate(_open(raw).get_toc(simple=True))], BOOKMARKS)


def page_counts(files: DataFrame) -> DataFrame:
    return _table(files, lambda name, raw: [{"doc_id": name, "pages": len(_open(raw))}], "doc_id string, pages int")


def segments(lines_: DataFrame, clips: DataFrame) -> DataFrame:
    """Segments from lines: cut by style within a block, on the logical pages of the clips.

    ``lines_`` as above; ``clips`` as ``layout.spread_clips`` gives them. Style
    runs follow the order of lines, so a page's lines go to one Arrow call.
    """
    places = clips.select("doc_id", "physical_page", F.posexplode("clips").alias("half", "clip"))
    inside = lines_.join(places, ["doc_id", "physical_page"]).where((F.col("x0") >= F.col("clip.x0") - 0.5) & (F.col("x0") < F.col("clip.x1")))
    row = F.struct("pos", "block", "text", "font_size", "bold", "x0", "y0", "x1", "y1", (F.col("clip.x1") - F.col("clip.x0")).alias("w"), (F.col("clip.y1") - F.col("clip.y0")).alias("h"))
    pages = inside.groupBy("doc_id", "physical_page", "half").agg(F.sort_array(F.collect_list(row)).alias("own"))
    out = "doc_id string, physical_page int, half int, run int, text string, font_size double, bold boolean, x0 double, y0 double, x1 double, y1 double, logical_width double, logical_height double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for name, page, half, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, r in enumerate(L.style_runs(own)):
                    rows.append({"doc_id": name, "physical_page": page, "half": half, "run": i, **{k: r[k] for k in ("text", "font_size", "bold", "x0", "y0", "x1", "y1")}, "logical_width": r["w"], "logical_height": r["h"]})
            kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in out.split(", "))]))

    from pyspark.sql import Window

    runs = pages.mapInArrow(run, out)
    doc = Window.partitionBy("doc_id").orderBy("physical_page", "half", "run")
    page = Window.partitionBy("doc_id").orderBy("physical_page", "half")
    numbered = runs.withColumns({"pos": F.row_number().over(doc), "logical_page": F.dense_rank().over(page)})
    return numbered.drop("half", "run")


def metadata(files: DataFrame) -> DataFrame:
    """Title, author, subject and creator of each file; empty where there are none."""
    names = ("title", "author", "subject", "creator")

    def rows(name, raw):
        found = _open(raw).metadata or {}
        return [{"doc_id": name, **{f"pdf_{n}": (found.get(n) or "").strip() for n in names}}]

    return _table(files, rows, "doc_id string, " + ", ".join(f"pdf_{n} string" for n in names))


def with_resolved(catalogue: DataFrame, meta: DataFrame) -> DataFrame:
    """Title, author and description: the catalogue's where it has them, else the file's."""
    joined = catalogue.join(meta.withColumnRenamed("doc_id", "resource_id"), "resource_id", "left")
    return joined.select("resource_id", T.resolved(F.col("title"), F.col("pdf_title")).alias("title"), T.resolved(F.col("author"), F.col("pdf_author")).alias("author"), T.resolved(F.col("description"), F.col("pdf_subject")).alias("description"))


def flat_text(files: DataFrame) -> DataFrame:
    """Text by page without layout, for files whose layout can't be read: doc_id, page, text.

    ``flat_text.sections`` and ``tagged_lines`` take it from there.
    """
    try:
        import pypdf
    except ImportError as e:
        raise RuntimeError("reading the plain text of PDF files needs the pypdf package on driver and executors") from e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        schema = pa.schema([("doc_id", pa.string()), ("page", pa.int32()), ("text", pa.string())])
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = [p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(raw)).pages[: L.PAGE_CAP]]
                except Exception:  # noqa: BLE001  a damaged file gives no pages
                    found = []
                yield pa.RecordBatch.from_pylist([{"doc_id": name, "page": i, "text": t} for i, t in enumerate(found, 1)], schema=schema)

    return files.select("resource_id", "content").mapInArrow(run, "doc_id string, page int, text string")


def status(wanted: DataFrame, files: DataFrame, texts: DataFrame) -> DataFrame:
    """``wanted`` with clean_status: no file, a file without text, or success.

    ``files``: resource_id; ``texts``: doc_id, clean_text.
    """
    have = files.select("resource_id", F.lit(True).alias("__file")).distinct()
    read = texts.where(F.trim(F.coalesce("clean_text", F.lit(""))) != "").select(F.col("doc_id").cast("string").alias("resource_id"), F.lit(True).alias("__text")).distinct()
    out = wanted.join(have, "resource_id", "left").join(read, "resource_id", "left")
    state = F.when(F.col("__file").isNull(), "download-failed").when(F.col("__text").isNull(), "extraction-failed").otherwise("success")
    return out.withColumn("clean_status", state).drop("__file", "__text")
