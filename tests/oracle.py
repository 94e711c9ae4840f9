"""Compare a Spark result with a DuckDB result, order-insensitively."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

from claimloom.plans.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return value


def compare(df, con, sql: str) -> None:
    columns = sorted(df.columns)
    left = Counter(tuple(norm(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns, (sorted(names), columns)
    place = [names.index(c) for c in columns]
    right = Counter(tuple(norm(row[i]) for i in place) for row in result.fetchall())
    missing, extra = right - left, left - right
    assert not missing and not extra, (
        f"{sum(left.values())} spark rows, {sum(right.values())} sql rows; "
        f"only sql: {list(missing.items())[:3]}; only spark: {list(extra.items())[:3]}"
    )
