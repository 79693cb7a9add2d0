"""Registered queries: each runs an operator over whole test tables, most with a SQL twin."""

from __future__ import annotations

from . import campaign, churn, corpus, vectors

MODULES = (churn, vectors, corpus, campaign)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
