"""Compare a query with its SQL in DuckDB."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str):
    c = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p / '*.parquet' if p.is_dir() else p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return round(float(v), 6) if isinstance(v, Decimal) else v


def same_rows(df, connection, sql: str) -> None:
    columns = sorted(df.columns)
    mine = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    result = connection.execute(sql)
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = [tuple(plain(r[i]) for i in at) for r in result.fetchall()]
    key = lambda row: tuple((x is not None, str(x)) for x in row)
    assert sorted(mine, key=key) == sorted(theirs, key=key)
