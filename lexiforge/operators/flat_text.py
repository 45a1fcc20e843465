"""Sections of flat page text: a document's lines in one call, in Arrow batches."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import text as T
from ..functions.batches import slices
from ..functions.fixed_values import KNOWN_SECTIONS
from .chunking import n_tokens

# Headings that run together, and the shapes of headings.
MERGED = re.compile(r"(The broader picture|Key findings|Findings in.depth|Connect with us)\s+(Methodology|Introduction|Interventions|Conclusion|Testimonials)", re.ASCII | re.I)
NUMBERED = re.compile(r"\d{1,2}(?:\.\d{1,2})*\.\s+[A-Z][a-z].{1,80}\Z", re.ASCII)
CAPITALS = re.compile(r"[A-Z][A-Z\s]{3,40}:?\Z", re.ASCII)
TWO_NUMBERS = re.compile(r"\d+\.\s+\w.+\d+\.\s+\w", re.ASCII)
START = re.compile(r"\d{1,2}\.\s+[A-Z]", re.ASCII)
BEFORE_START = re.compile(r"(?=\b\d{1,2}\.\s+[A-Z])", re.ASCII)
NUMBERS_ONLY = re.compile(r"\d{1,4}\Z|\d{1,3}\s+\d{1,3}\Z", re.ASCII)
HYPHEN = re.compile(r"-\s+", re.ASCII)
LEADING_NUMBER = re.compile(r"\d{1,2}\s+[A-Z]", re.ASCII)
CLAUSE = re.compile(r"[,;]\Z|,\s+\w", re.ASCII)
OPENING_WORD = re.compile(r"(?:Our|This|They|We|It|In|On|By|For|As|At)\s+\w", re.ASCII)
KNOWN = frozenset(KNOWN_SECTIONS)
#: Words of a heading that body text runs into, and of a section too small to stand.
HEAD_WORDS, TRIVIAL = 12, 15
#: Times that a short line is repeated, and its words, to be a running head.
LEAST, MOST_WORDS = 3, 10


def page_lines(pages: DataFrame) -> DataFrame:
    """``doc_id, page, line_no, line``: trimmed lines of (doc_id, page, text)."""
    out = pages.select("doc_id", "page", F.posexplode(T.lines(F.coalesce("text", F.lit("")))).alias("line_no", "line"))
    return out.withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", ""))


def repeated_lines(lines: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS) -> DataFrame:
    """``doc_id, line, n``: short lines that a document repeats, such as running heads."""
    counted = lines.where("line <> ''").groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= least) & (T.word_count(F.col("line")) <= most_words))


def repeated_margins(segments: DataFrame, least: int = 3) -> DataFrame:
    """``doc_id, zone, signature, pages``: margin texts on several distinct pages."""
    out = segments.groupBy("doc_id", "zone", "signature").agg(F.count_distinct("page").alias("pages"))
    return out.where(F.col("pages") >= least)


def cut_merged(line: str) -> list[str]:
    """A line that holds several numbered headings, or one with body text behind it, cut apart."""
    starts = len(START.findall(line))
    if starts >= 2:
        return [p for x in BEFORE_START.split(line) if (p := x.strip(" "))]
    w = line.split() if starts and START.match(line) else []
    return [" ".join(w[:HEAD_WORDS]), " ".join(w[HEAD_WORDS:])] if len(w) > HEAD_WORDS else [line]


@F.pandas_udf(ArrayType(StringType()))
def split_merged(lines: pd.Series) -> pd.Series:
    """``cut_merged`` on a column."""
    return lines.map(lambda x: None if x is None else cut_merged(x))


def looks_like_heading(line: str) -> bool:
    if NUMBERED.match(line) or CAPITALS.match(line):
        return len(line.split()) <= 15 and not TWO_NUMBERS.search(line)
    if line.lower() not in KNOWN:
        return False
    n = len(line.split())
    return n <= 8 and not (TWO_NUMBERS.search(line) or CLAUSE.search(line) or (n > 2 and (LEADING_NUMBER.match(line) or OPENING_WORD.match(line))))


def tagged(pages: list[tuple[int, str]]) -> list[tuple[str, bool]]:
    """(line, whether it is a heading) of a document's (page, text), without running heads and page numbers.

    A heading counts once a document. Runs of short headings are lists, and content.
    """
    numbered = sorted(((p, i, x.strip(" \t\n\x0b\f\r")) for p, text in pages for i, x in enumerate((text or "").splitlines())), key=lambda x: (x[0] is not None, x[0], x[1]))
    lines = [x for _, _, x in numbered]
    common = {x for x, n in Counter(filter(None, lines)).items() if n >= LEAST and len(x.split()) <= MOST_WORDS}
    seen: Counter = Counter()
    pieces: list[tuple[str, bool]] = []
    for part in (p for x in lines for p in cut_merged(x)):
        if len(part) < 3 or NUMBERS_ONLY.match(part) or part in common:
            continue
        line = HYPHEN.sub("", part)
        merged = MERGED.match(line)
        for piece in merged.groups() if merged else (line,):
            head = bool(merged) or looks_like_heading(piece)
            seen[piece, head] += 1
            first = seen[piece, head] == 1
            # later sights of a heading are content, or nothing if they came merged
            if first or not merged:
                pieces.append((piece, head and first))
    out = []
    for head, run in groupby(pieces, key=lambda x: x[1]):
        own = [x for x, _ in run]
        listing = head and len(own) > 1 and max(len(x.split()) for x in own) <= 4
        out += [(x, head and not listing) for x in own]
    return out


def squeezed(text: str) -> str:
    return " ".join(text.split())


def joined(lines: list[tuple[str, bool]]) -> list[tuple[str, str]]:
    """(heading, content) of tagged lines; sections under 15 words join the one before, with their heading."""
    parts: list[tuple[str | None, list[str]]] = [(None, [])]
    for line, head in lines:
        if head:
            parts.append((line, []))
        else:
            parts[-1][1].append(line)
    out: list[tuple[str, list[str]]] = []
    for head, own in parts:
        content = squeezed(" ".join(own))
        if not content:
            continue
        # the first stands whatever its size
        if not out or len(content.split()) >= TRIVIAL:
            out.append((head or "", [content]))
        else:
            out[-1][1].extend([content] if head is None else [head, content])
    return [(head, squeezed(" ".join(own))) for head, own in out]


def _sectioned(docs: Iterator[tuple[int, list[tuple[str, bool]]]]) -> list[tuple]:
    return [(n, i, head, text, len(text.split()), len(text), n_tokens(text)) for n, lines in docs for i, (head, text) in enumerate(joined(lines), 1)]


_SECTION = pa.schema([("section_no", pa.int64()), ("heading", pa.string()), ("content", pa.string()), ("word_count", pa.int32()), ("char_count", pa.int32()), ("token_count", pa.int32())])
_SECTION_DDL = "section_no long, heading string, content string, word_count int, char_count int, token_count int"
_TAGGED = pa.schema([("pos", pa.int32()), ("line", pa.string()), ("is_heading", pa.bool_())])


def _by_document(rows: DataFrame, columns: tuple[str, ...], found, schema: pa.Schema, ddl: str) -> DataFrame:
    """``found`` on the lists of ``columns`` of each doc_id: its rows begin with the document's place in the list."""
    docs = rows.groupBy("doc_id").agg(F.collect_list(F.struct(*columns)).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = found([[tuple(x.values()) for x in own] for own in batch.column(1).to_pylist()])
            if out:
                place, *fields = zip(*out, strict=True)
                arrays = [batch.column(0).take(pa.array(place)), *[pa.array(f, k.type) for f, k in zip(fields, schema, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *schema.names])

    return docs.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {ddl}")


def tagged_lines(pages: DataFrame) -> DataFrame:
    """``doc_id, pos, line, is_heading`` of (doc_id, page, text), as ``tagged`` has them, in order."""
    found = lambda docs: [(n, i, *x) for n, own in enumerate(docs) for i, x in enumerate(tagged(own), 1)]
    return _by_document(pages, ("page", "text"), found, _TAGGED, "pos int, line string, is_heading boolean")


def sections(tagged: DataFrame) -> DataFrame:
    """``doc_id, section_no, heading, content, word_count, char_count, token_count`` of tagged lines, as ``joined`` has them."""
    return _by_document(tagged, ("pos", "line", "is_heading"), lambda docs: _sectioned((n, [x[1:] for x in sorted(own)]) for n, own in enumerate(docs)), _SECTION, _SECTION_DDL)


def flat_sections(pages: DataFrame) -> DataFrame:
    """``sections`` of the ``tagged_lines`` of (doc_id, page, text), in one pass."""
    return _by_document(pages, ("page", "text"), lambda docs: _sectioned((n, tagged(own)) for n, own in enumerate(docs)), _SECTION, _SECTION_DDL)
