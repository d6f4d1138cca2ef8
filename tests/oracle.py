"""Spark-vs-DuckDB comparison used by the tests and the verify script.

Values are normalised (decimals and doubles rounded to 6 places, dates to ISO
text, NaN to NULL) and compared as an order-insensitive multiset of rows with
columns sorted by name — the same shape of check as the external gate.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(sorted((_norm(x) for x in v), key=repr))
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    cols = [columns[i].lower() for i in order]
    return cols, Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return rows_of(cols, cur.fetchall())


def compare(df, con, sql):
    """Return (ok, message)."""
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    ns, nd = sum(s_rows.values()), sum(d_rows.values())
    if s_rows != d_rows:
        only_s = list((s_rows - d_rows).elements())[:3]
        only_d = list((d_rows - s_rows).elements())[:3]
        return False, f"rows differ: spark={ns} duck={nd}; spark-only {only_s}; duck-only {only_d}"
    return True, f"{ns} rows"
