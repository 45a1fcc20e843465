"""All queries over the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from . import document_queries, link_queries, model_queries, tag_queries, text_queries

_PARTS = (document_queries, link_queries, text_queries, tag_queries, model_queries)


def queries() -> dict:
    return {name: f for part in _PARTS for name, f in part.R.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.R.sql.items()}
