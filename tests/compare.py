"""Compare a Spark result with an SQL result as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

from workload.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.10g}"))
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    want, got = rows_of(want_cols, cur.fetchall()), rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (f"rows {sum(got.values())} vs {sum(want.values())}; only here {list(extra.items())[:3]}; "
            f"only there {list(missing.items())[:3]}")
