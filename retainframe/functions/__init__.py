"""Column expressions: everything here is built from JVM-side Spark functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body or a lambda in it uses it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
