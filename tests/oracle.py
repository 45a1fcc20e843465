"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = Path(os.environ.get("LEXIFORGE_TESTDATA", "/root/testdata"))


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = con.execute(sql)
    return [c[0] for c in out.description], out.fetchall()


def canonical(columns: list[str], rows: list[tuple]) -> list[str]:
    """Rows as text, columns by name, order left aside."""

    def show(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(map(show, v)) + "]"
        if isinstance(v, dict):
            return "{" + ",".join(f"{k}:{show(x)}" for k, x in sorted(v.items())) + "}"
        return repr(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(show(r[i]) for i in order) for r in rows)


def assert_same(df, sql: str, sf_dir: str) -> int:
    columns, want = sql_rows(sql, sf_dir)
    assert sorted(columns) == sorted(df.columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = canonical(columns, want)
    assert len(got) == len(want)
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not wrong, wrong[:3]
    return len(got)
