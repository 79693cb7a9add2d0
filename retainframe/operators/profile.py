"""One profile row per entity out of vehicle, member and purchase tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import drop_incomplete, one_per_key

# Fill-ins for missing profile fields.
DEFAULT_MEMBER_LEVEL = "无"
DEFAULT_OWNER_TYPE = "个人"


def first_purchases(purchases: DataFrame, key: str = "entity_id", date: str = "purchase_date") -> DataFrame:
    """Earliest known purchase date per entity."""
    return drop_incomplete(purchases, [key, date]).groupBy(key).agg(F.min(date).alias(date))


def fill_profile(
    vehicles: DataFrame,
    members: DataFrame,
    key: str = "entity_id",
    member_default: str = DEFAULT_MEMBER_LEVEL,
    owner_default: str = DEFAULT_OWNER_TYPE,
) -> DataFrame:
    """Full outer join of vehicles and known member levels, defaults filled, incomplete rows dropped.

    Both sides are brought to one row per key before the join, so a repeated key cannot multiply rows.
    """
    owned = one_per_key(vehicles.select(key, "owner_type", "car_mode", "car_level"), key)
    levels = (
        members.where(F.col("member_level").isNotNull())
        .groupBy(F.col(key).alias("member_key")).agg(F.max("member_level").alias("member_level"))
    )
    joined = owned.join(levels, F.col(key) == F.col("member_key"), "full_outer").drop("member_key")
    # a member without a vehicle has no key and no model here, so the last step drops it; the
    # optimizer turns the outer join into a left one and keeps the partitioning on the key
    return drop_incomplete(joined.fillna({"member_level": member_default, "owner_type": owner_default}))


def customer_profile(
    vehicles: DataFrame, members: DataFrame, purchases: DataFrame, key: str = "entity_id", **defaults: str
) -> DataFrame:
    """Filled profile of every entity with a known purchase date."""
    return fill_profile(vehicles, members, key, **defaults).join(first_purchases(purchases, key), key, "inner")
