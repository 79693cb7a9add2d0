"""Exact profiles of numeric columns of any length."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a range that are read off directly, and how finely the sketch that proposes pivots is kept.
FINISH_ROWS, ACCURACY = 20_000, 10_000
PROFILE_SCHEMA = (
    "column string, n bigint, min double, max double, q1 double, median double, q3 double, iqr double, "
    "mean double, std_pop double, skew double, method string"
)


@dataclass(frozen=True)
class ColumnStats:
    column: str
    n: int
    min: float
    max: float
    q1: float
    median: float
    q3: float
    iqr: float
    mean: float
    std_pop: float
    skew: float | None
    method: str


def sample_skewness(n: int, population_skew: float | None) -> float | None:
    """Bias-corrected skewness; undefined below three values, 0 for a constant column."""
    if n < 3 or population_skew is None:
        return None
    if math.isnan(population_skew):
        return 0.0
    return population_skew * math.sqrt(n * (n - 1)) / (n - 2)


def scaling_method(low: float, high: float, iqr: float, skew: float | None) -> str:
    """robust for long-tailed ranges, yeo_johnson for skewed columns, otherwise standard."""
    if iqr > 0 and (high - low) / iqr > 10:
        return "robust"
    if skew is not None and abs(skew) > 1:
        return "yeo_johnson"
    return "standard"


def finite(name: str) -> Column:
    """The column as a double; NaN and infinities count as null."""
    x = F.col(name).cast("double")
    return F.when(F.abs(x) < math.inf, x)


def profile_columns(rows: DataFrame, columns: Sequence[str]) -> list[ColumnStats]:
    """Count, range, quartiles, moments and scaling method of each column (nulls, NaN and infinities skipped)."""
    measures = []
    for i, name in enumerate(columns):
        x = finite(name)
        measures += [
            F.count(x).alias(f"n{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
            F.avg(x).alias(f"mean{i}"), F.stddev_pop(x).alias(f"std{i}"), F.skewness(x).alias(f"skew{i}"),
        ]
    basic = rows.agg(*measures).first()
    present = [(i, c) for i, c in enumerate(columns) if basic[f"n{i}"]]
    ranks = {c: quantile_ranks(basic[f"n{i}"], (0.25, 0.5, 0.75)) for i, c in present}
    ranges = {c: (basic[f"min{i}"], basic[f"max{i}"], basic[f"n{i}"]) for i, c in present}
    values = order_statistics(rows, {c: {r for pair in ranks[c] for r in pair[:2]} for c in ranks}, ranges)
    stats = []
    for i, c in present:
        q1, median, q3 = (
            values[c][lower] + share * (values[c][upper] - values[c][lower]) for lower, upper, share in ranks[c]
        )
        low, high, n = ranges[c]
        skew = sample_skewness(n, basic[f"skew{i}"])
        stats.append(ColumnStats(
            c, n, low, high, q1, median, q3, q3 - q1, basic[f"mean{i}"], basic[f"std{i}"], skew,
            scaling_method(low, high, q3 - q1, skew),
        ))
    return stats


def column_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The profile as a table, one row per column."""
    stats = profile_columns(rows, columns)
    return rows.sparkSession.createDataFrame([tuple(asdict(s).values()) for s in stats], PROFILE_SCHEMA)


def quantile_ranks(n: int, shares: Iterable[float]) -> list[tuple[int, int, float]]:
    """Zero-based ranks below and above each linearly interpolated quantile, and the weight of the upper."""
    ranks = []
    for share in shares:
        position = share * (n - 1)
        lower = math.floor(position)
        ranks.append((lower, min(lower + 1, n - 1), position - lower))
    return ranks


class _Range:
    """An open interval of a column's values that holds some of the ranks asked for, with the rows below it and in it."""

    def __init__(self, column: str, low: float, high: float, below: int, n: int, ranks: set[int]):
        self.column, self.low, self.high, self.below, self.n, self.ranks = column, low, high, below, n, ranks

    def inside(self) -> Column:
        x = finite(self.column)
        return (x > F.lit(self.low)) & (x < F.lit(self.high))


def order_statistics(
    rows: DataFrame,
    ranks: dict[str, set[int]],
    ranges: dict[str, tuple[float, float, int]],
    finish_rows: int = FINISH_ROWS,
    passes: list | None = None,
) -> dict[str, dict[int, float]]:
    """Exact values at zero-based ranks, without sorting a column or collecting it anywhere.

    A round proposes two pivots around each range's ranks from an approximate sketch, and then counts exactly what lies
    below, at, between and above them. A rank at a pivot is found; the others go on in an open range without the
    pivots, so every round narrows, and by the sketch's accuracy a range keeps a few thousandths of its rows. Ranges
    of at most ``finish_rows`` rows are read off. ``passes`` collects one entry per pass over the rows.
    """
    found: dict[str, dict[int, float]] = defaultdict(dict)
    done = passes if passes is not None else []
    todo = [_Range(c, -math.inf, math.inf, 0, ranges[c][2], group) for c in ranks for group in _neighbouring(ranks[c])]
    while todo:
        small = [r for r in todo if r.n <= finish_rows]
        if small:
            done.append("read")
            _read_off(rows, small, found)
        todo = [r for r in todo if r.n > finish_rows]
        if todo:
            done += ["sketch", "count"]
            todo = _narrowed(rows, todo, found)
    return found


def _neighbouring(ranks: set[int]) -> list[set[int]]:
    """Ranks next to each other share a range."""
    out: list[set[int]] = []
    for r in sorted(ranks):
        if out and r - max(out[-1]) <= 1:
            out[-1].add(r)
        else:
            out.append({r})
    return out


def _read_off(rows: DataFrame, ranges: list[_Range], found: dict) -> None:
    entries = [F.when(r.inside(), F.struct(F.lit(i).alias("range"), finite(r.column).alias("x"))) for i, r in enumerate(ranges)]
    exploded = rows.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
    values = defaultdict(list)
    for row in exploded.groupBy("range", "x").count().collect():
        values[row["range"]].append((row["x"], row["count"]))
    for i, r in enumerate(ranges):
        upto, ordered = r.below, iter(sorted(values[i]))
        value = None
        for rank in sorted(r.ranks):
            while upto <= rank:
                value, n = next(ordered)
                upto += n
            found[r.column][rank] = value


def _narrowed(rows: DataFrame, ranges: list[_Range], found: dict) -> list[_Range]:
    sketches = []
    for i, r in enumerate(ranges):
        slack = 2 * r.n / ACCURACY
        shares = [max(0.0, (min(r.ranks) - r.below - slack) / r.n), min(1.0, (max(r.ranks) - r.below + 1 + slack) / r.n)]
        sketches.append(F.percentile_approx(F.when(r.inside(), finite(r.column)), shares, ACCURACY).alias(f"p{i}"))
    pivots = rows.agg(*sketches).first()
    counts = []
    for i, r in enumerate(ranges):
        x = finite(r.column)
        first, last = (F.lit(v) for v in pivots[f"p{i}"])
        counts += [
            F.count_if(r.inside() & (x < first)).alias(f"a{i}"), F.count_if(x == first).alias(f"b{i}"),
            F.count_if((x > first) & (x < last)).alias(f"c{i}"), F.count_if((x == last) & (x > first)).alias(f"d{i}"),
        ]
    counted = rows.agg(*counts).first()
    out = []
    for i, r in enumerate(ranges):
        first, last = pivots[f"p{i}"]
        at = r.below
        parts = [(r.low, first, counted[f"a{i}"]), (first, None, counted[f"b{i}"]), (first, last, counted[f"c{i}"]), (last, None, counted[f"d{i}"])]
        parts.append((last, r.high, r.below + r.n - at - sum(n for _, _, n in parts)))
        for low, high, n in parts:
            here = {k for k in r.ranks if at <= k < at + n}
            if here and high is None:
                found[r.column].update(dict.fromkeys(here, low))
            elif here:
                out.append(_Range(r.column, low, high, at, n, here))
            at += n
    return out
