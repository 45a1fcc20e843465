"""Binding of intermediate values inside column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once. A lambda variable holds it; an expression would be repeated."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
