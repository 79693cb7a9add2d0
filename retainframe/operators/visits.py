"""Visit cleaning: passive visits out, internal vehicles out, one row per entity and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import UNIFIED_TYPES, natural_sort, split_tokens, unify_tokens
from .joins import drop_incomplete

# Visit types of internal vehicles, and of visits the customer did not choose to make.
INTERNAL_TYPES = "内部|二手"
PASSIVE_TYPES = "事故|三包|质量担保|索赔|PDI|返工|免费|售前|代验车|召回|受控"


def collapse_days(
    visits: DataFrame, internal: str = INTERNAL_TYPES, passive: str = PASSIVE_TYPES
) -> DataFrame:
    """One row per (entity, day): mean mileage and type set of its active visits, internal flag.

    This aggregation runs first and combines on the map side. From here on an entity has at most one
    row per calendar day, so no later window or join can meet a group larger than that, however many
    raw visits the entity has.
    """
    complete = drop_incomplete(visits.select("entity_id", "visit_date", "mile", "visit_type"))
    active = ~F.col("visit_type").rlike(passive)
    return complete.groupBy("entity_id", "visit_date").agg(
        F.avg(F.when(active, F.col("mile"))).alias("mile"),
        F.collect_set(F.when(active, F.col("visit_type"))).alias("raw_types"),
        F.bool_or(F.col("visit_type").rlike(internal)).alias("internal"),
    )


def clean_visits(
    visits: DataFrame,
    profile: DataFrame | None = None,
    internal: str = INTERNAL_TYPES,
    passive: str = PASSIVE_TYPES,
    rules: Sequence[tuple[str, str]] = tuple(UNIFIED_TYPES),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Visits of known, non-internal entities: entity_id, visit_date, mile, visit_types.

    ``profile`` holds one row per known entity; its ``carry`` columns are added by the same join
    that keeps the known entities.

    ``visit_types`` is a set: it is put in natural order where it is shown (:func:`in_order`,
    :func:`latest_visits`, :func:`type_history`), once per result row instead of once per visit.
    """
    daily = collapse_days(visits, internal, passive)
    if profile is not None:
        daily = daily.join(profile.select("entity_id", *carry), "entity_id", "inner" if carry else "left_semi")
    ever_internal = F.bool_or("internal").over(Window.partitionBy("entity_id"))
    kept = (
        daily.withColumn("ever_internal", ever_internal)
        .where(~F.col("ever_internal") & (F.size("raw_types") > 0))
    )
    types = visit_types(F.col("raw_types"), rules).alias("visit_types")
    return kept.select("entity_id", "visit_date", "mile", types, *carry)


def visit_types(raw_types: Column, rules: Sequence[tuple[str, str]] = tuple(UNIFIED_TYPES)) -> Column:
    """Array of ``;`` lists to one set of unified types."""
    return unify_tokens(F.flatten(F.transform(raw_types, lambda listed: split_tokens(listed))), rules)


def in_order(visits: DataFrame) -> DataFrame:
    return visits.withColumn("visit_types", natural_sort(F.col("visit_types")))


def active_entities(
    visits: DataFrame, profile: DataFrame | None = None, internal: str = INTERNAL_TYPES, passive: str = PASSIVE_TYPES
) -> DataFrame:
    """Last active visit of every known, non-internal entity.

    The same entities and last dates as in :func:`clean_visits`, but combined to one row per entity
    before the only shuffle, so the split date costs a scan and not a second cleaning.
    """
    complete = drop_incomplete(visits.select("entity_id", "visit_date", "mile", "visit_type"))
    active = ~F.col("visit_type").rlike(passive)
    last = complete.groupBy("entity_id").agg(
        F.max(F.when(active, F.col("visit_date"))).alias("visit_date"),
        F.bool_or(F.col("visit_type").rlike(internal)).alias("internal"),
    )
    kept = last.where(~F.col("internal") & F.col("visit_date").isNotNull()).drop("internal")
    return kept if profile is None else kept.join(profile.select("entity_id"), "entity_id", "left_semi")


def split_date(visits: DataFrame, months: int = 3, date: str = "visit_date") -> Column:
    """Latest visit minus calendar months, as a scalar subquery inside the same plan.

    ``visits`` are cleaned visits or, cheaper, :func:`active_entities`.
    """
    newest = visits.agg(F.max(date).alias(date))
    return newest.select((F.col(date) - F.expr(f"INTERVAL '{int(months)}' MONTH")).cast("date")).scalar()


def history(visits: DataFrame, split: Column) -> DataFrame:
    """Visits up to and including the split date."""
    return visits.where(F.col("visit_date") <= split)


def latest_visits(visits: DataFrame) -> DataFrame:
    """Last date, mileage and types per entity; each column skips its own nulls."""

    def last(column: str) -> Column:
        known = F.when(F.col(column).isNotNull(), F.col("visit_date"))
        return F.max_by(column, known)

    return visits.groupBy("entity_id").agg(
        F.max("visit_date").alias("last_date"),
        last("mile").alias("last_mile"),
        natural_sort(last("visit_types")).alias("last_visit_types"),
    )


def inactive_entities(visits: DataFrame, split: Column, years: int = 3) -> DataFrame:
    """Entities whose last visit is more than ``years`` before the split date."""
    cutoff = split - F.expr(f"INTERVAL '{int(years)}' YEAR")
    last = visits.groupBy("entity_id").agg(F.max("visit_date").alias("max_date"))
    return last.where(F.col("max_date") < cutoff)


def type_history(visits: DataFrame) -> DataFrame:
    """Naturally sorted set of all visit types per entity."""
    return visits.groupBy("entity_id").agg(
        natural_sort(F.array_distinct(F.flatten(F.collect_set("visit_types")))).alias("all_visit_types")
    )


def entity_counts(visits: DataFrame) -> DataFrame:
    """Row, entity and day counts of a visit table."""
    return visits.agg(
        F.count(F.lit(1)).alias("n_visits"),
        F.count_distinct("entity_id").alias("n_entities"),
        F.count_distinct("visit_date").alias("n_days"),
    )
