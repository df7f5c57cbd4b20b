"""Compare registered queries with their SQL, run by DuckDB on the same files."""

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql):
    """What differs between a DataFrame and a SQL result; empty when nothing does."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got, wanted = rows_by_name(df.columns, df.collect()), rows_by_name(columns, result.fetchall())
    if len(got) != len(wanted):
        return f"{len(got)} rows instead of {len(wanted)}"
    wrong = [(g, w) for g, w in zip(got, wanted) if g != w]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:600]}" if wrong else ""
