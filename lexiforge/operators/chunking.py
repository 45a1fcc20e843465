"""Chunking of texts, row by row: overlap chunks as array folds inside the JVM, rhetorical chunks in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.batches import slices
from ..functions.columns import let

THRESHOLD = 800
CHUNK, OVERLAP = 3000, 175
#: Chunks under so many tokens are reported as tiny.
TINY = 50

UNIT = "struct<text:string,tokens:int>"
CHUNK_TYPE = (
    "struct<text:string,token_count:int,tier:int,section_title:string,part_label:string,"
    "is_continuation:boolean,parent_section_part:int,parent_section_total:int,tier_reason:string>"
)


def units(texts: Column) -> Column:
    """Texts with their token counts, counted once."""
    return F.transform(texts, lambda x: F.struct(x.alias("text"), T.approx_tokens(x).alias("tokens")))


def runs(items: Column, starts: Column) -> Column:
    """Consecutive items cut before the positions ``starts``, of which 0 is the first; without positions there are no runs."""
    ends = F.slice(F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(items))), F.lit(1), F.size(starts))
    return F.transform(F.arrays_zip(starts.alias("lo"), ends.alias("hi")), lambda r: F.slice(items, r["lo"] + 1, r["hi"] - r["lo"]))  # items: bound by let


def packed(items: Column, tokens, threshold: int, alone=None) -> Column:
    """Runs of items whose ``tokens`` stay within the threshold; a larger item, or one that is ``alone``, is a run of its own.

    The fold carries positions and a count, so no item is copied before the runs are cut.
    """
    alone = alone or (lambda x: F.lit(False))
    none = F.array().cast("array<int>")
    # tokens is null after an item that stands alone
    empty = F.struct(none.alias("starts"), F.lit(None).cast("int").alias("tokens"), F.lit(0).alias("i"))

    def step(acc: Column, x: Column) -> Column:
        cut = alone(x) | acc["tokens"].isNull() | (acc["tokens"] + tokens(x) > threshold)
        return F.struct(
            F.when(cut, F.concat(acc["starts"], F.array(acc["i"]))).otherwise(acc["starts"]).alias("starts"),
            F.when(alone(x), F.lit(None)).when(cut, tokens(x)).otherwise(acc["tokens"] + tokens(x)).cast("int").alias("tokens"),
            (acc["i"] + 1).alias("i"),
        )

    return let(items, lambda own: let(F.aggregate(own, empty, step, lambda acc: acc["starts"]), lambda starts: runs(own, starts)))


def greedy_pack(sized: Column, threshold: int) -> Column:
    """Groups of consecutive units whose tokens stay within the threshold; a larger unit stands alone.

    ``sized``: array of (text, tokens). Returns an array of arrays of them.
    """
    return packed(sized, lambda u: u["tokens"], threshold)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


# -- rhetorical chunks: plain functions over a text, called in Arrow batches -----------------

_ENDS = " \t\n\x0b\f\r"
_HEAD = re.compile(r"#{1,6}\s+\S|[A-Z](?:[A-Z\s\d:\-]{3,}|[A-Z\s\d:\-]{2})\Z|\d+(?:\.\d+)*[.)]\s+\S", re.ASCII)
_BLANK_LINES = re.compile(r"\n\s*\n", re.ASCII)
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=[A-Z])", re.ASCII)
Sized = tuple[str, int]


class Chunk(NamedTuple):
    """The fields of ``CHUNK_TYPE``."""

    text: str
    token_count: int
    tier: int
    section_title: str | None
    part_label: str
    is_continuation: bool
    parent_section_part: int
    parent_section_total: int
    tier_reason: str


def n_tokens(text: str) -> int:
    """``text.approx_tokens`` of a string."""
    return len(text.split()) * T.TOKENS_PER_100_WORDS // 100


def _packed(items: list, tokens: Callable[[Any], int], threshold: int, alone: Callable[[Any], bool] = lambda _: False) -> list[list]:
    """``packed`` over a list."""
    out, held = [], None
    for x in items:
        own = tokens(x)
        if held is None or alone(x) or held + own > threshold:
            out.append([])
            held = 0
        out[-1].append(x)
        held = None if alone(x) else held + own
    return out


def _cut(text: str, mark: re.Pattern) -> list[Sized]:
    """Parts between marks, trimmed, without empty ones, with their tokens."""
    return [(p, n_tokens(p)) for x in mark.split(text) if (p := x.strip(_ENDS))]


def _label(title: str | None, part: int, total: int, continued: bool) -> str:
    more = "" if total == 1 else f" — Part {part} of {total}{', Paragraph continued' if continued else ''}"
    return f"[Section: {title or 'Preamble'}{more}]"


def heading_sections(text: str) -> list[tuple[str | None, str]]:
    """(heading, body) pairs; text before the first heading has none. A heading without body counts too."""
    parts: list[tuple[str | None, list[str]]] = [(None, [])]
    for line in text.splitlines():
        s = line.strip(_ENDS)
        if s and len(s) <= 120 and _HEAD.match(s):
            parts.append((s, []))
        else:
            parts[-1][1].append(line)
    pairs = [(head, "\n".join(own).strip(_ENDS)) for head, own in parts]
    return [p for p in pairs if p[0] is not None or p[1]] or [(None, text.strip(_ENDS))]


def _section_chunks(heading: str | None, body: str, threshold: int) -> list[Chunk]:
    text = body if heading is None else f"{heading}\n{body}"
    n = n_tokens(text)
    if n <= threshold:
        label = _label(heading, 1, 1, False)
        return [Chunk(f"{label}\n{text}", n, 1, heading, label, False, 1, 1, f"Tier 1 — section fits ({n} <= {threshold} tokens)")]
    units_, tier, join = _cut(body, _BLANK_LINES), 2, "\n\n"
    if any(k > threshold for _, k in units_):
        tier, join = 3, " "
        units_ = [u for p in units_ for u in (_cut(p[0], _SENTENCE) if p[1] > threshold else [p])]
    groups = _packed(units_, lambda u: u[1], threshold)
    out, total = [], len(groups)
    for i, group in enumerate(groups, 1):
        label = _label(heading, i, total, tier == 3 and i > 1)
        whole = f"{label}\n{join.join(u for u, _ in group)}"
        reason = f"section too large ({n} tokens); packed {len(group)} paragraph(s) into" if tier == 2 else "paragraph(s) too large even after section split; sentence-packed"
        out.append(Chunk(whole, n_tokens(whole), tier, heading, label, i > 1, i, total, f"Tier {tier} — {reason} part {i}/{total}"))
    return out


def _combined(run: list[Chunk]) -> Chunk:
    """Small neighbouring sections as one chunk."""
    if len(run) == 1:
        return run[0]
    titles = " | ".join(c.section_title for c in run if c.section_title)
    label = f"[Sections: {titles}]" if titles else "[Document Preamble]"
    text = f"{label}\n\n" + "\n\n".join(c.text for c in run)
    counts = ", ".join(str(c.token_count) for c in run)
    return Chunk(text, sum(c.token_count for c in run), 1, run[0].section_title, label, False, 1, 1, f"Tier 1 merge — {len(run)} small sections combined ({counts} tokens)")


def chunk_rhetorical(text: str | None, threshold: int = THRESHOLD) -> list[Chunk]:
    """Chunks of a text: whole sections, else packed paragraphs, else packed sentences; small sections merged."""
    if not (text or "").strip(_ENDS):
        return []
    raw = [c for head, body in heading_sections(text) for c in _section_chunks(head, body, threshold)]
    return [_combined(run) for run in _packed(raw, lambda c: c.token_count, threshold, lambda c: c.tier != 1)]


def chunk_documents(docs: DataFrame, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """``doc_id, index, chunk columns``: one row a chunk, numbered from 0."""
    kinds = [("text", pa.string()), ("token_count", pa.int32()), ("tier", pa.int32()), ("section_title", pa.string()), ("part_label", pa.string()), ("is_continuation", pa.bool_()),
             ("parent_section_part", pa.int32()), ("parent_section_total", pa.int32()), ("tier_reason", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(n, i, *c) for n, t in enumerate(batch.column(1).to_pylist()) for i, c in enumerate(chunk_rhetorical(t, threshold))]
            if rows:
                own, index, *fields = zip(*rows, strict=True)
                arrays = [batch.column(0).take(pa.array(own)), pa.array(index, pa.int32()), *[pa.array(f, k) for f, (_, k) in zip(fields, kinds, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "index", *[k for k, _ in kinds]])

    fields = CHUNK_TYPE.removeprefix("struct<").removesuffix(">").replace(":", " ")
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, index int, {fields}")


def marker_sections(text: Column) -> Column:
    """(label, text) of parts between ``=== LABEL ===`` markers; PREAMBLE before the first."""
    kind = "struct<label:string,text:string>"
    # a marker becomes a part of its own between two separators
    cut = F.split(F.regexp_replace(text, r"(=== .+? ===)", "\u0001$1\u0001"), "\u0001")
    empty = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit("PREAMBLE").alias("label"))

    def step(acc: Column, part: Column) -> Column:
        return let(
            strip(part),
            lambda p: F.when(p == "", acc)
            .when(
                p.rlike(r"^=== .+? ===$"),
                F.struct(acc["done"].alias("done"), F.trim(F.regexp_replace(p, r"^[= ]+|[= ]+$", "")).alias("label")),
            )
            .otherwise(F.struct(F.concat(acc["done"], F.array(F.struct(acc["label"].alias("label"), p.alias("text")))).alias("done"), acc["label"].alias("label"))),
        )

    return F.aggregate(cut, empty, step, lambda acc: acc["done"])


def overlap_pack(sized: Column, size: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Chunks of paragraphs that begin with the last paragraphs of the chunk before.

    The carried tail is one paragraph of the next chunk. Returns an array of
    (text, token_count, overlap_tokens).
    """
    out = "struct<text:string,token_count:int,overlap_tokens:int>"
    empty = F.struct(
        F.array().cast(f"array<{out}>").alias("done"), F.array().cast(f"array<{UNIT}>").alias("open"), F.lit(0).alias("tokens"), F.lit(0).alias("over")
    )

    def emitted(acc: Column) -> Column:
        text = F.array_join(F.transform(acc["open"], lambda u: u["text"]), "\n\n")
        return F.concat(acc["done"], F.array(F.struct(text.alias("text"), acc["tokens"].alias("token_count"), acc["over"].alias("overlap_tokens"))))

    def tail(open_: Column) -> Column:
        start = F.struct(F.array().cast(f"array<{UNIT}>").alias("kept"), F.lit(0).alias("tokens"), F.lit(False).alias("shut"))

        def back(acc: Column, u: Column) -> Column:
            fits = ~acc["shut"] & (acc["tokens"] + u["tokens"] <= overlap)
            return F.struct(
                F.when(fits, F.concat(F.array(u), acc["kept"])).otherwise(acc["kept"]).alias("kept"),
                F.when(fits, acc["tokens"] + u["tokens"]).otherwise(acc["tokens"]).alias("tokens"),
                (~fits).alias("shut"),
            )

        return F.aggregate(F.reverse(open_), start, back)

    def step(acc: Column, u: Column) -> Column:
        cut = (F.size(acc["open"]) > 0) & (acc["tokens"] + u["tokens"] > size)

        def fresh(t: Column) -> Column:
            carried = F.array_join(F.transform(t["kept"], lambda x: x["text"]), "\n\n")
            head = F.struct(carried.alias("text"), t["tokens"].alias("tokens")).cast(UNIT)
            return F.when(
                carried != "",
                F.struct(emitted(acc).alias("done"), F.array(head, u).alias("open"), (t["tokens"] + u["tokens"]).alias("tokens"), t["tokens"].alias("over")),
            ).otherwise(F.struct(emitted(acc).alias("done"), F.array(u).alias("open"), u["tokens"].alias("tokens"), F.lit(0).alias("over")))

        more = F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.array(u)).alias("open"), (acc["tokens"] + u["tokens"]).alias("tokens"), acc["over"].alias("over"))
        return F.when(cut, let(tail(acc["open"]), fresh)).otherwise(more)

    return F.aggregate(sized, empty, step, lambda acc: F.when(F.size(acc["open"]) > 0, emitted(acc)).otherwise(acc["done"]))


def chunk_structured(text: Column, size: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """Marked sections, each whole or as overlapping chunks: (section, text, token_count, overlap_tokens)."""

    def one(section: Column) -> Column:
        paras = F.filter(F.split(section["text"], "\n\n"), lambda p: ~p.rlike(r"^\s*$"))

        def shaped(n: Column) -> Column:
            whole = F.array(F.struct(section["text"].alias("text"), n.alias("token_count"), F.lit(0).alias("overlap_tokens")))
            return F.when(n <= size, whole).otherwise(overlap_pack(units(paras), size, overlap))

        pieces = let(T.approx_tokens(section["text"]), shaped)
        return F.transform(pieces, lambda c: F.struct(section["label"].alias("section"), c["text"].alias("text"), c["token_count"].alias("token_count"), c["overlap_tokens"].alias("overlap_tokens")))

    return F.flatten(F.transform(marker_sections(text), one))


def assemble(parent: Column, pages: Column, files: Column) -> Column:
    """A resource's text with what it links to, under section markers.

    ``pages`` and ``files`` are arrays of (title, text), already filtered.
    """

    def listed(kind: str, items: Column) -> Column:
        return F.flatten(
            F.transform(items, lambda x, i: F.array(F.concat(F.lit(f"\n--- Linked {kind} "), (i + 1).cast("string"), F.lit(": "), x["title"], F.lit(" ---")), F.coalesce(x["text"], F.lit(""))))
        )

    none = F.array().cast("array<string>")
    parts = F.concat(
        F.when(F.coalesce(parent, F.lit("")) != "", F.array(F.lit("=== PARENT CONTENT ==="), parent)).otherwise(none),
        F.when(F.size(pages) > 0, F.concat(F.array(F.lit("\n=== LINKED WEB PAGES ===")), listed("page", pages))).otherwise(none),
        F.when(F.size(files) > 0, F.concat(F.array(F.lit("\n=== LINKED PDFs ===")), listed("PDF", files))).otherwise(none),
    )
    return F.array_join(parts, "\n\n")


def continuation_groups(chunks: DataFrame) -> DataFrame:
    """Each chunk with the chunks that continue it, as one unit to summarise.

    ``chunks``: doc_id, chunk_number, part_label, token_count, text, is_continuation.
    A document's chunks are bounded by its text, so its window is too.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("doc_id").orderBy("chunk_number")
    first = ~F.coalesce("is_continuation", F.lit(False)) | (F.row_number().over(order) == 1)
    numbered = chunks.withColumn("group_no", F.sum(first.cast("int")).over(order))
    row = F.struct("chunk_number", "part_label", "token_count", "text")
    grouped = numbered.groupBy("doc_id", "group_no").agg(F.sort_array(F.collect_list(row)).alias("own"))
    return grouped.select(
        "doc_id",
        "group_no",
        F.transform("own", lambda x: x["chunk_number"]).alias("chunk_numbers"),
        F.array_join(F.transform("own", lambda x: x["part_label"]), " + ").alias("part_label"),
        (F.size("own") > 1).alias("is_merged"),
        F.aggregate("own", F.lit(0).cast("long"), lambda a, x: a + x["token_count"]).alias("token_count"),
        F.array_join(F.transform("own", lambda x: x["text"]), "\n\n").alias("text"),
    )


def chunk_report(chunks: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: chunks by tier, token range and mean, and chunks over the threshold or tiny."""
    listed = lambda test: F.sort_array(F.collect_list(F.when(test, F.col("index") + 1)))
    return chunks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        *[F.count_if(F.col("tier") == t).alias(f"tier_{t}") for t in (1, 2, 3)],
        F.min("token_count").alias("min_tokens"),
        F.max("token_count").alias("max_tokens"),
        F.floor(F.avg("token_count")).cast("int").alias("avg_tokens"),
        listed(F.col("token_count") > threshold).alias("over_threshold"),
        listed(F.col("token_count") < TINY).alias("tiny"),
    )
