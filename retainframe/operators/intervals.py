"""Intervals between consecutive visits and the repair of falling mileages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.dates import day_gap
from ..functions.numbers import ratio, ratio_or_zero

MEASURES = ("day_diff", "mile_diff", "day_speed")


def per_entity() -> WindowSpec:
    return Window.partitionBy("entity_id")


def by_date() -> WindowSpec:
    return per_entity().orderBy("visit_date")


def raw_intervals(visits: DataFrame, purchases: DataFrame | None = None) -> DataFrame:
    """Gap to the previous visit, or to the purchase (mileage 0) for the first one; positive gaps only.

    ``visits`` holds one row per entity and day. The purchase date comes from ``purchases``, one row
    per entity, or is a column of ``visits`` already.
    """
    lagged = visits.select(
        "*",
        F.lag("visit_date").over(by_date()).alias("previous_date"),
        F.lag("mile").over(by_date()).alias("previous_mile"),
    )
    if purchases is not None:
        lagged = lagged.join(purchases.select("entity_id", "purchase_date"), "entity_id", "left")
    filled = lagged.select(
        *(c for c in visits.columns if c != "purchase_date"),
        F.coalesce("previous_date", "purchase_date").alias("previous_date"),
        F.coalesce("previous_mile", F.lit(0.0)).alias("previous_mile"),
    )
    gaps = filled.withColumns({
        "day_diff": day_gap(F.col("visit_date"), F.col("previous_date")),
        "mile_diff": F.col("mile") - F.col("previous_mile"),
    })
    return gaps.withColumn("day_speed", ratio(F.col("mile_diff"), F.col("day_diff"))).where(F.col("day_diff") > 0)


def repair_mileage(intervals: DataFrame) -> DataFrame:
    """Where the mileage fell, put in the entity's median daily mileage of its good intervals."""
    fell = F.col("mile_diff") < 0
    speed = F.median(F.when(F.col("mile_diff") >= 0, F.col("day_speed"))).over(per_entity())
    return (
        intervals.withColumn("median_speed", speed)
        .withColumns({
            "mile_diff": F.when(fell, F.col("day_diff") * F.col("median_speed")).otherwise(F.col("mile_diff")),
            "day_speed": F.when(fell, F.col("median_speed")).otherwise(F.col("day_speed")),
            "previous_mile": F.when(fell, F.col("mile") - F.col("day_diff") * F.col("median_speed"))
            .otherwise(F.col("previous_mile")),
        })
        .drop("median_speed")
    )


def visit_intervals(visits: DataFrame, purchases: DataFrame | None = None) -> DataFrame:
    return repair_mileage(raw_intervals(visits, purchases))


def mark_inactive(intervals: DataFrame, split: Column, years: int = 3) -> DataFrame:
    """Flag the rows of entities whose last visit is more than ``years`` before the split date."""
    cutoff = split - F.expr(f"INTERVAL '{int(years)}' YEAR")
    return intervals.withColumn("inactive", F.max("visit_date").over(per_entity()) < cutoff)


def numbered(intervals: DataFrame) -> DataFrame:
    """Ordinal of each visit within its entity, oldest first."""
    return intervals.withColumn("visit_no", F.row_number().over(by_date()))


def nth_visit(column: str, n: int) -> Column:
    return F.max(F.when(F.col("visit_no") == n, F.col(column)))


def first_second(intervals: DataFrame) -> DataFrame:
    """First and second day and mileage gap of the entities that have both."""
    return (
        numbered(intervals).groupBy("entity_id")
        .agg(*first_second_columns(), F.max("visit_no").alias("last_no"))
        .where(F.col("last_no") >= 2).drop("last_no")
    )


def first_second_columns() -> list[Column]:
    return [
        nth_visit("day_diff", 1).alias("first_to_purchase_day_diff"),
        nth_visit("mile_diff", 1).alias("first_to_purchase_mile_diff"),
        nth_visit("day_diff", 2).alias("second_to_first_day_diff"),
        nth_visit("mile_diff", 2).alias("second_to_first_mile_diff"),
    ]


def spread_columns() -> list[Column]:
    """Median, sample deviation (0 for one visit), mean and variation coefficient of each measure."""
    columns = []
    for measure in MEASURES:
        deviation, mean = F.stddev_samp(measure), F.avg(measure)
        columns += [
            F.median(measure).alias(f"{measure}_median"),
            F.coalesce(deviation, F.lit(0.0)).alias(f"{measure}_std"),
            mean.alias(f"{measure}_mean"),
            ratio_or_zero(deviation, mean).alias(f"{measure.replace('_diff', '')}_cv"),
        ]
    return columns


def interval_stats(intervals: DataFrame) -> DataFrame:
    """Spread of the gaps and the visit count of every entity."""
    return intervals.groupBy("entity_id").agg(*spread_columns(), F.count("visit_date").alias("all_times"))
