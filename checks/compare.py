"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> list[tuple]:
    return rows_of(df.columns, df.collect())


def duck_rows(con, statement: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(statement)
    names = [c[0] for c in result.description]
    return names, rows_of(names, result.fetchall())


def difference(df, con, statement: str) -> str | None:
    """None when equal, else a short account of what differs."""
    names, want = duck_rows(con, statement)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = spark_rows(df)
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    lack = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows against {len(want)}; only here {str(extra)[:700]}; only there {str(lack)[:700]}"
