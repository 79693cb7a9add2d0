"""Wide feature rows, churn labels and the train/valid split."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import age_in_years, day_gap, shift_days, shift_months
from ..functions.strings import natural_sort
from ..session import materialize
from .intervals import first_second_columns, mark_inactive, numbered, spread_columns


def visit_features(
    intervals: DataFrame, profile: DataFrame, split: Column, as_of: date, inactive: str = "drop"
) -> DataFrame:
    """One feature row per entity that has a first and a second valid visit.

    All visit features come out of a single aggregation on the entity key. The latest visit may be
    read from the intervals: cleaning drops only first visits, and an entity whose only visit is
    dropped has no second one. ``inactive`` = "drop" leaves out long-gone entities, "label" keeps
    them with a flag for :func:`churn_label`.
    """
    flagged = mark_inactive(intervals, split)
    if inactive == "drop":
        flagged = flagged.where(~F.col("inactive"))
    grouped = numbered(flagged).groupBy("entity_id").agg(
        F.max("visit_date").alias("last_date"),
        F.max_by("mile", "visit_date").alias("last_mile"),
        natural_sort(F.max_by("visit_types", "visit_date")).alias("last_visit_types"),
        *first_second_columns(),
        *spread_columns(),
        F.count("visit_date").alias("all_times"),
        natural_sort(F.array_distinct(F.flatten(F.collect_set("visit_types")))).alias("all_visit_types"),
        F.bool_or("inactive").alias("inactive"),
    )
    usable = grouped.where((F.col("all_times") >= 2) & F.col("mile_diff_median").isNotNull())
    today = F.lit(as_of)
    return usable.join(profile, "entity_id", "inner").withColumns({
        "last_till_now_days": day_gap(today, F.col("last_date")),
        "car_age": age_in_years(today, F.col("purchase_date")),
    })


def churn_label(features: DataFrame, split: Column, grace_months: int = 3) -> DataFrame:
    """Label 1 where the expected next visit plus the grace period is not after the split date."""
    expected = shift_days(F.col("last_date"), F.col("day_diff_median"))
    latest = shift_months(F.col("relative_next_instore_date"), grace_months)
    lost = (F.col("max_relative_next_instore_date") <= split.cast("timestamp_ntz")) | F.col("inactive")
    return (
        features.withColumn("relative_next_instore_date", expected)
        .withColumn("max_relative_next_instore_date", latest)
        .withColumn("churn_label", F.when(lost, 1).otherwise(0))
        .drop("inactive")
    )


def stratified_split(
    rows: DataFrame, label: str, key: str, valid_fraction: float = 0.1, seed: int = 42, prefix: int = 4
) -> DataFrame:
    """Add ``dataset``: exactly round(fraction * n) rows of every class are ``valid``.

    Rows are ordered by a hash of seed and key. The quota of a class is found as a cut-off hash:
    first the hash prefix in which the quota is reached (counts per prefix, at most 16^prefix rows
    per class), then the cut-off inside that one prefix. Tagging is then a row-local comparison, so
    neither a large class nor the whole table is ever sorted or shuffled.
    """
    place = F.concat_ws(":", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), F.col(key).cast("string"))
    hashed = rows.select(F.col(label).alias("label"), place.alias("place"))
    per_prefix = hashed.groupBy("label", F.substring("place", 1, prefix).alias("start")).agg(F.count(F.lit(1)).alias("n"))
    by_start = Window.partitionBy("label").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    totals = per_prefix.select(
        "label", "start",
        (F.sum("n").over(by_start) - F.col("n")).alias("before"),
        F.sum("n").over(by_start).alias("upto"),
        F.round(F.sum("n").over(Window.partitionBy("label")) * F.lit(valid_fraction)).cast("bigint").alias("quota"),
    )
    crossing = totals.where((F.col("before") < F.col("quota")) & (F.col("upto") >= F.col("quota")))
    crossing = crossing.select(F.col("label").alias("class"), "start", (F.col("quota") - F.col("before")).alias("needed"))
    # one row per class from here on, joined by Spark in the way their number asks for
    inside = hashed.join(crossing, F.col("label").eqNullSafe(F.col("class")) & (F.substring("place", 1, prefix) == F.col("start")))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("place"))
    cuts = materialize(inside.withColumn("rank", rank).where(F.col("rank") == F.col("needed")).select(F.col("class").alias("_class"), F.col("place").alias("_cut")), "cuts")
    marked = rows.join(cuts, F.col(label).eqNullSafe(F.col("_class")), "left")
    return marked.withColumn("dataset", F.when(place <= F.col("_cut"), "valid").otherwise("train")).drop("_class", "_cut")
