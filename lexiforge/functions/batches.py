"""Row-local work in Arrow batches, a few rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows that are Python objects at once. A batch holds up to 10 000 rows, which as objects take several times its bytes.
ROWS = 256


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, at most ``rows`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
