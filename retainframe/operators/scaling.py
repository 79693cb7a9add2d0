"""Column scaling fitted on all rows: robust, Yeo-Johnson or standard, chosen by the column profile."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .column_stats import ColumnStats, finite, profile_columns

# Half steps to each side of the centre of a coarse pass; the centre moves until the best power lies inside.
COARSE_REACH = 8


def robust(x: Column, stats: ColumnStats) -> Column:
    return (x - F.lit(stats.median)) / F.lit(stats.iqr if stats.iqr else 1.0)


def standard(x: Column, mean: float, deviation: float) -> Column:
    """Zero mean and unit population variance; a constant column becomes all zeros."""
    return (x - F.lit(mean)) / F.lit(deviation if deviation else 1.0)


def yeo_johnson(x: Column, power: Column) -> Column:
    """The Yeo-Johnson power transform (Yeo and Johnson, 2000)."""
    rest = F.lit(2.0) - power
    positive = F.when(power == 0, F.log1p(x)).otherwise((F.pow(x + 1, power) - 1) / power)
    negative = F.when(rest == 0, -F.log1p(-x)).otherwise(-(F.pow(1 - x, rest) - 1) / rest)
    return F.when(x >= 0, positive).otherwise(negative)


def power_grids(decimals: int = 4) -> list[tuple[float, int]]:
    """(step, steps to each side) per pass: halves, moved on while the best is at the edge, then one decimal more each."""
    return [(0.5, COARSE_REACH)] + [(10.0 ** -d, 5 if d == 1 else 10) for d in range(1, decimals + 1)]


def fit_yeo_johnson(rows: DataFrame, columns: Sequence[str], decimals: int = 4) -> dict[str, float]:
    """Maximum-likelihood power per column; nulls, NaN and infinities are skipped.

    Rows are first combined to distinct values with their counts, on the map side, and written; all passes read those. A
    pass scores a grid of powers for every column at once in two sums; the next one refines the grid
    around the best power. The likelihood has a single peak, so this finds the best power on the finest grid; no range
    is set beforehand.
    """
    values = F.array(*(F.struct(F.lit(i).alias("i"), finite(c).alias("x")) for i, c in enumerate(columns)))
    exploded = rows.select(F.explode(values).alias("v")).select("v.i", "v.x").where(F.col("x").isNotNull())
    counted = materialize(exploded.groupBy("i", "x").agg(F.count(F.lit(1)).alias("n")), "counted")
    x, n = F.col("x"), F.col("n")
    facts = {r["i"]: r for r in counted.groupBy("i").agg(F.sum(n).alias("n"), (F.sum(x * n) / F.sum(n)).alias("mean"), F.sum(n * F.signum(x) * F.log1p(F.abs(x))).alias("tilt")).collect()}
    best = dict.fromkeys(columns, 0.0)

    def score_grids(grids: dict[str, list[float]]) -> dict[str, tuple[float, float]]:
        """Best (likelihood, power) of each column's grid; a power that overflows does not count."""
        def per_column(numbers: list[float]) -> Column:
            return F.get(F.array(*(F.lit(float(v)) for v in numbers)), F.col("i"))

        centre = per_column([facts[i]["mean"] if i in facts else 0.0 for i in range(len(columns))])
        # powers are data, so that all passes share one compiled plan
        choices = F.array(*(F.array(*(F.lit(p) for p in grids.get(c, []))).cast("array<double>") for c in columns))
        power = F.col("power")
        away = yeo_johnson(x, power) - yeo_johnson(F.col("centre"), power)  # distances from a middle value keep the variance exact
        candidates = counted.withColumn("centre", centre).withColumn("power", F.explode(F.get(choices, F.col("i"))))
        scored = candidates.groupBy("i", "power").agg(F.sum(n * away).alias("a"), F.sum(n * away * away).alias("b"))
        peak = {c: (-math.inf, best[c]) for c in grids}
        for row in sorted(scored.collect()):
            column, fact = columns[row["i"]], facts[row["i"]]
            variance = row["b"] / fact["n"] - (row["a"] / fact["n"]) ** 2
            if 0 < variance < math.inf:
                score = -fact["n"] / 2 * math.log(variance) + (row["power"] - 1) * fact["tilt"]
                if score > peak[column][0]:
                    peak[column] = (score, row["power"])
        return peak

    for k, (step, reach) in enumerate(power_grids(decimals)):
        moving = list(columns)
        while moving:
            found = score_grids({c: [round(best[c] + j * step, 10) + 0.0 for j in range(-reach, reach + 1)] for c in moving})
            edge = [c for c in moving if abs(found[c][1] - best[c]) > (reach - 0.5) * step]
            best.update({c: p for c, (_, p) in found.items()})
            # the likelihood has one peak: at the edge of the coarse grid it still rises outwards
            moving = edge if k == 0 else []
    return best


def auto_scale(rows: DataFrame, columns: Sequence[str], decimals: int = 4) -> DataFrame:
    """Replace each column by its scaled form; the method follows from the column's own profile.

    NaN and infinities count as null in the profile and the fit, and are null in the result.
    """
    stats = {s.column: s for s in profile_columns(rows, columns)}
    skewed = [c for c, s in stats.items() if s.method == "yeo_johnson"]
    powers = fit_yeo_johnson(rows, skewed, decimals) if skewed else {}
    moments = {}
    if skewed:
        transformed = {c: yeo_johnson(finite(c), F.lit(powers[c])) for c in skewed}
        found = rows.agg(*(
            f(transformed[c]).alias(f"{kind}{i}")
            for i, c in enumerate(skewed) for kind, f in (("mean", F.avg), ("std", F.stddev_pop))
        )).first()
        moments = {c: (found[f"mean{i}"], found[f"std{i}"]) for i, c in enumerate(skewed)}
    scaled = {c: F.lit(None).cast("double") for c in columns}  # a column without a value stays empty
    for c, s in stats.items():
        x = finite(c)
        if s.method == "robust":
            scaled[c] = robust(x, s)
        elif s.method == "yeo_johnson":
            scaled[c] = standard(yeo_johnson(x, F.lit(powers[c])), *moments[c])
        else:
            scaled[c] = standard(x, s.mean, s.std_pop)
    return rows.withColumns(scaled)
