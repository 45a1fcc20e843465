"""Chat formatting from typed content parts.

A turn's content is a list of typed parts. A visitor flattens text, image,
audio and document parts into one ordered string with a placeholder for each
attachment, records the attachments and counts the tokens they expand to.
The template writes a turn as ``<|im_start|>ROLE\\nBODY<|im_end|>\\n``.

Control strings inside texts are escaped so that no text makes a ``<|``: in each
run of text, that is all that stands between two placeholders whatever parts it
came from, every ``<`` + backslashes + ``|`` gets one more backslash, and reading
takes one away, run by run. Line breaks and backslashes of a role are escaped too.

The formatted conversation is the concatenation of its turns' segments in
order; a segment is a row, so a conversation of any length is never held whole.
Reading back streams over the sorted segments with one running digest per
conversation.

Defined results for odd input: null text and null role are empty; null turn
sorts first; turns with equal numbers are ordered by role and text; repeated
rows are turns each; null conv_id is a conversation of its own; empty tables
give none; other columns don't take part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose text is trained on.
TRAINED = ("assistant",)
#: Tokens that an attachment expands to: a fixed part, and one for so many bytes or milliseconds.
EXPANSION = {"image": (64, 16_384), "audio": (8, 640), "document": (16, 4)}
#: What the size of a part is counted in.
PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)

_CONTROL, _GUARDED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_ATTACHED = re.compile(r"<\|(?:image|audio|document):\d+\|>")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _GUARDED.sub(r"<\1|", text)


def read_body(body: str) -> str:
    """The texts of a body, without its placeholders."""
    return "".join(map(unescape, _ATTACHED.split(body)))


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


class Visitor:
    """Visits the parts of one turn in order."""

    def __init__(self):
        self.out: list[str] = []
        self.run: list[str] = []
        self.attachments: list[dict] = []
        self.expanded = 0

    def body(self) -> str:
        self._end_run()
        return "".join(self.out)

    def _end_run(self) -> None:
        # texts are escaped together, as a control string may span parts
        self.out.append(escape("".join(self.run)))
        self.run.clear()

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.run.append(part.get("text") or "")

    def _attach(self, kind: str, part: dict) -> None:
        self._end_run()
        fixed, per = EXPANSION[kind]
        tokens = fixed + -(-(part.get("size") or 0) // per)
        self.out.append(f"<|{kind}:{len(self.attachments)}|>")
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self.expanded += tokens

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)
        self.visit_text(part)


SEGMENT = (
    "conv_id long, turn long, segment string, loss_from int, loss_to int, "
    "attachments array<struct<kind:string,ref:string,tokens:long>>, expanded_tokens long"
)
_SEGMENT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("segment", pa.string()),
        ("loss_from", pa.int32()),
        ("loss_to", pa.int32()),
        ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
        ("expanded_tokens", pa.int64()),
    ]
)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            role, visitor = row["role"] or "", Visitor()
            for part in row["parts"] or []:
                visitor.visit(part or {})
            head, body = f"{START}{escape_role(role)}\n", visitor.body()
            lo, hi = (len(head), len(head) + len(body)) if role in TRAINED else (0, 0)
            rows.append(
                {
                    "conv_id": row["conv_id"],
                    "turn": row["turn"],
                    "segment": f"{head}{body}{END}\n",
                    "loss_from": lo,
                    "loss_to": hi,
                    "attachments": visitor.attachments,
                    "expanded_tokens": visitor.expanded,
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENT)


def format_chat(turns: DataFrame) -> DataFrame:
    """One formatted segment for each row of ``turns`` (conv_id, turn, role, parts)."""
    return turns.select("conv_id", "turn", "role", "parts").mapInArrow(_format, SEGMENT)


def text_parts(conversations: DataFrame) -> DataFrame:
    """Rows with a plain text column as turns of one text part."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("size"))
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not (segment.startswith(START) and segment.endswith(END + "\n")):
        raise ValueError("not a formatted turn")
    role, _, body = segment[len(START) : -len(END) - 1].partition("\n")
    return unescape_role(role), read_body(body)


_DIGEST = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation and order -> one row per conversation, with constant memory."""
    key, state = None, None
    done: list[dict] = []

    def close():
        turns, loss = state.pop("turns"), state.pop("loss")
        done.append({"conv_id": key[0], "turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest(), **state})

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "segment", "loss_from", "loss_to")]
        for conv_id, segment, lo, hi in zip(*columns, strict=True):
            if key != (conv_id,):
                if key is not None:
                    close()
                key = (conv_id,)
                state = {"n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0}
            role, text = read_segment(segment)
            state["n_turns"] += 1
            state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            trained = read_body(segment[lo:hi])
            state["loss_chars"] += len(trained)
            state["loss"].update(trained.encode("utf-8", "surrogatepass"))
            state["formatted_chars"] += len(segment)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)
            done = []
    if key is not None:
        close()
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_DIGEST)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of what the formatted segments hold, one row per conversation."""
    rows = segments.select("conv_id", "turn", "segment", "loss_from", "loss_to").repartition("conv_id")
    # role and text are read after the exchange, so that they needn't travel; equal rows are interchangeable
    end = F.locate("\n", "segment")
    role = F.substr("segment", F.lit(len(START) + 1), end - len(START) - 1)
    body = F.substr("segment", end + 1, F.length("segment") - end - len(END) - 1)
    runs = F.transform(F.split(body, _ATTACHED.pattern), lambda r: F.regexp_replace(r, _GUARDED.pattern, "<$1|"))
    whole = F.split(F.regexp_replace(role, _GUARDED.pattern, "<$1|"), r"\\\\")
    plain = F.array_join(F.transform(whole, lambda r: F.replace(r, F.lit("\\n"), F.lit("\n"))), "\\")
    ordered = rows.withColumns({"role": plain, "text": F.array_join(runs, "")})
    ordered = ordered.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "segment", "loss_from", "loss_to").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
