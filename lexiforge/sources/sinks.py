"""Results as files and reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import chunking as C


def write_rows(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, in one folder for each value of ``by`` if given."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def json_documents(df: DataFrame, key: str) -> DataFrame:
    """``key, document``: each row as one pretty JSON text."""
    return df.select(key, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"pretty": "true", "ignoreNullFields": "false"}).alias("document"))


def json_array(df: DataFrame) -> str:
    """A small result (a report, never a corpus) as one JSON array on the driver."""
    return json.dumps([json.loads(r) for r in df.toJSON().toLocalIterator()], indent=2, ensure_ascii=False)


def chunk_reports(chunks: DataFrame, threshold: int = C.THRESHOLD) -> DataFrame:
    """``doc_id, summary, chunks``: the report of each document's chunks, lists as lines of text."""
    none = lambda c: F.when(F.size(c) > 0, F.to_json(c)).otherwise("none")
    summary = C.chunk_report(chunks, threshold)
    named = summary.select("doc_id", F.struct(*[c for c in summary.columns if c not in ("doc_id", "over_threshold", "tiny")], none("over_threshold").alias("over_threshold"), none("tiny").alias("tiny")).alias("summary"))
    row = F.struct(
        "index",
        (F.col("index") + 1).alias("chunk_number"),
        "token_count",
        "tier",
        "section_title",
        "part_label",
        "is_continuation",
        "parent_section_part",
        "parent_section_total",
        "tier_reason",
        (F.col("token_count") > threshold).alias("over_threshold"),
        F.split("text", "\n").alias("text_lines"),
    )
    listed = chunks.groupBy("doc_id").agg(F.sort_array(F.collect_list(row)).alias("chunks"))
    return named.join(listed, "doc_id")


def cut(text: Column, width: int) -> Column:
    """Text cut to a width with dots behind."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 1), F.lit("…"))).otherwise(text)


def wrap(text: str, width: int) -> list[str]:
    """A list of labels broken at the last comma that fits, else at the width."""
    out = []
    while len(text) > width:
        at = text.rfind(", ", 0, width + 1)
        at = at + 1 if at > 0 else width
        out.append(text[:at].rstrip())
        text = text[at:].lstrip()
    return [*out, text]


def table_report(df: DataFrame, title: str, most: int = 200) -> str:
    """A small result as a table of text; ``most`` bounds what reaches the driver, and a last line says how many rows are left out."""
    found = df.limit(most + 1).collect()
    left = df.count() - most if len(found) > most else 0
    rows = [["" if v is None else str(v) for v in r] for r in found[:most]]
    width = [max([len(c), *(len(r[i]) for r in rows)]) for i, c in enumerate(df.columns)]
    line = lambda cells: "  ".join(c.ljust(w) for c, w in zip(cells, width, strict=True)).rstrip()
    tail = [f"... and {left} more rows"] if left else []
    return "\n".join([title, "=" * len(title), line(df.columns), line(["-" * w for w in width]), *map(line, rows), *tail])
