"""Dense vectors as ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bind


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def unit(vector: Column) -> Column:
    """Length-one vector; the zero vector stays as it is."""

    def scaled(pair: Column) -> Column:
        v, length = pair["v"], pair["length"]
        return F.when(length > 0, F.transform(v, lambda x: x / length)).otherwise(v)

    return bind(bind(vector, lambda v: F.struct(v.alias("v"), norm(v).alias("length"))), scaled)


def cosine(left: Column, right: Column) -> Column:
    return F.try_divide(dot(left, right), norm(left) * norm(right))


def fuse(text_vector: Column, numbers: Sequence[Column], text_weight: float = 0.3, number_weight: float = 0.7) -> Column:
    """Weighted concatenation: text dimensions first, then the numeric features."""
    numeric = F.array(*(F.coalesce(n.cast("double"), F.lit(0.0)) for n in numbers))
    return F.concat(
        F.transform(as_doubles(text_vector), lambda x: x * F.lit(text_weight)),
        F.transform(numeric, lambda x: x * F.lit(number_weight)),
    )
