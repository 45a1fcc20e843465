"""Queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a query under its function's name, with its SQL if there is one."""

        def put(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return put


#: SQL of a text's word count.
def words(column: str) -> str:
    return rf"CAST(len(list_filter(regexp_split_to_array({column}, '\s+'), lambda x: x <> '')) AS INTEGER)"


def tokens(column: str) -> str:
    return f"CAST({words(column)} * 135 // 100 AS INTEGER)"
