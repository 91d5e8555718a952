"""Runs a registered query and its SQL check, and compares rows in any order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, Decimal)):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return repr(value)


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else a description of the first differences."""
    df = fn(spark, sf_dir)
    relation = oracle(sf_dir).sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"{name}: columns {sorted(df.columns)} != {sorted(relation.columns)}"
    ours = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    extra = list((ours - theirs).items())[:3]
    lost = list((theirs - ours).items())[:3]
    return (
        f"{name}: {sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only here {str(extra)[:600]}; only there {str(lost)[:600]}"
    )
