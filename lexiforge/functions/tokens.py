"""Exact token counts with any tokenizer that the executors can load."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


def exact(load: Callable[[], Callable[[list[str]], list[int]]]):
    """A column function that counts tokens; ``load`` runs once a worker and returns a counter of texts.

    Null and empty texts have none. Without a tokenizer use ``text.approx_tokens``.
    """

    @F.pandas_udf(IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = load()
        for s in batches:
            texts = ["" if x is None else x for x in s]
            full = [x for x in texts if x]
            found = iter(counter(full) if full else [])
            yield pd.Series([next(found) if x else 0 for x in texts], dtype="int32")

    return count
