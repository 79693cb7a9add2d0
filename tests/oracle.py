"""Compare a Spark result with its SQL twin run by DuckDB over the same files."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """(equal, message)"""
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    theirs = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} vs {theirs[0]}"
    if ours[1] == theirs[1]:
        return True, f"{len(ours[1])} rows"
    left, right = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
    return False, f"{len(ours[1])} vs {len(theirs[1])} rows; spark only {sorted(left)[:2]}; sql only {sorted(right)[:2]}"
