"""JSON out of model answers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

def without_fence(answer: str) -> str:
    return re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", answer.strip()).strip())


def greedy(answer: str | None):
    """The whole answer, else from the first brace to the last; None if neither parses."""
    if not answer:
        return None
    clean = without_fence(answer)
    span = re.search(r"\{.*\}", clean, re.S)
    for part in (clean, span[0] if span else ""):
        try:
            return json.loads(part)
        except ValueError:
            continue
    return None


def balanced(answer: str | None):
    """The whole answer, else the first balanced object or list that parses; brackets in strings count."""
    if not answer:
        return None
    clean = without_fence(answer)
    try:
        return json.loads(clean)
    except ValueError:
        pass
    depth, start = 0, -1
    for m in re.finditer(r"[{}\[\]]", clean):
        if m[0] in "{[":
            start = m.start() if depth == 0 else start
            depth += 1
        else:
            depth -= 1
            if depth == 0 and start >= 0:
                try:
                    return json.loads(clean[start : m.end()])
                except ValueError:
                    pass
    return None


def _as_text(find):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda a: None if (found := find(a)) is None else json.dumps(found)).astype(object)

    return run


# Built-in parsers take text with anything behind the first value, so both searches run in Arrow batches.


@F.pandas_udf(StringType())
def greedy_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The JSON that ``greedy`` finds, as text."""
    yield from _as_text(greedy)(batches)


@F.pandas_udf(StringType())
def balanced_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The JSON that ``balanced`` finds, as text."""
    yield from _as_text(balanced)(batches)
