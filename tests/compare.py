"""Compare a query with its SQL in DuckDB."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v) -> str:
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.6f}".rstrip("0").rstrip(".")
    return str(v)


def rows(columns: list[str], data) -> list[tuple]:
    return sorted(tuple(plain(r[c]) for c in columns) for r in data)


def check(df, sql: str, connection) -> None:
    other = connection.sql(sql).df()
    columns = sorted(df.columns)
    assert columns == sorted(other.columns)
    mine = df.toPandas()
    assert rows(columns, mine.to_dict("records")) == rows(columns, other.to_dict("records"))
