"""Texts as zstd of their UTF-8 bytes: half the size or less where texts are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, ...) -> (key, packed, ...); a null text is an empty one."""
    small = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        raw = [small((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), *batch.columns[2:]], names=[batch.schema.names[0], "packed", *batch.schema.names[2:]])


def unpack(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw) if raw else b""
