"""Comparing a query with its SQL, columns by name and rows as a bag."""

import glob
import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def views(folder: str):
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{source}'")
    return c


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime, date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), Counter(tuple(plain(r[k]) for k in order) for r in rows)


def compare(df, connection, sql):
    """(None or what differs) of a DataFrame and SQL over the same tables."""
    got = bag(df.columns, df.collect())
    answer = connection.sql(sql)
    want = bag(answer.columns, answer.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] != want[1]:
        return f"{sum(got[1].values())} and {sum(want[1].values())} rows; only Spark {list((got[1] - want[1]).items())[:3]}; only SQL {list((want[1] - got[1]).items())[:3]}"
    return None
