"""Key filters on large tables whose hottest key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys`` (semi join).

    Both sides reach the join as they are, repeated keys included: then adaptive execution can split a key that holds
    many rows into as many tasks as its size asks for, and the other side is read up to its first match only.
    """
    return rows.join(keys.select(key), key, "left_semi")


def drop_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``keys`` (anti join)."""
    return rows.join(keys.select(key), key, "left_anti")


def drop_entities_matching(rows: DataFrame, key: str, column: str, pattern: str) -> DataFrame:
    """Remove every row of an entity that has at least one row matching ``pattern``."""
    return drop_keys(rows, rows.where(F.col(column).rlike(pattern)), key)


def drop_rows_matching(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    return rows.where(~F.col(column).rlike(pattern))


def one_per_key(rows: DataFrame, key: str, prefer: list[Column] | None = None) -> DataFrame:
    """One whole row per key: the largest by ``prefer`` and then by all columns.

    Brings a join side to unique keys, so that a repeated key cannot multiply the other side. Each
    task keeps one row per key before the shuffle.
    """
    others = [c for c in rows.columns if c != key]
    order = [p.alias(f"p{i}") for i, p in enumerate(prefer or [])]
    best = rows.groupBy(key).agg(F.max(F.struct(*order, *others)).alias("best"))
    return best.select(key, *(F.col("best")[c].alias(c) for c in others))


def drop_incomplete(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (default: all); plain predicates, so they reach the scan."""
    return rows.where(" AND ".join(f"`{name}` IS NOT NULL" for name in columns or rows.columns))
