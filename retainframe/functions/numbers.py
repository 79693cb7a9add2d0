"""Ratios that are total: a zero or missing denominator never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def click_through_rate(clicks: Column, impressions: Column, digits: int = 4) -> Column:
    """Clicks per impression, 0 when there were no impressions."""
    shown = F.when(impressions > 0, impressions)
    return F.round(ratio_or_zero(clicks, shown), digits)
