"""Comparison of a query's rows with DuckDB's, as bags."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in found.fetchall())


def actual(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())
