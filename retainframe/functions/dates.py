"""Calendar arithmetic on dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_gap(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def shift_months(moment: Column, months: int) -> Column:
    """Calendar months forward or back; the time of day and the month end are kept."""
    return moment + F.expr(f"INTERVAL '{int(months)}' MONTH")


def shift_days(moment: Column, days: Column) -> Column:
    """Date or moment plus a possibly fractional number of days (1.5 days moves 36 hours), as a moment without a time zone.

    A day has 24 hours whatever the session's zone, also where its clocks change.
    """
    zero = F.lit(0)
    seconds = (days * F.lit(86400)).cast("decimal(18,6)")
    return moment.cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def age_in_years(as_of: Column, since: Column) -> Column:
    """Started years of 365 days between two dates."""
    return F.ceil(day_gap(as_of, since) / F.lit(365)).cast("int")


def parse_date(text: Column) -> Column:
    """Date of ``2020-1-5``, ``2020/01/05`` or ``20200105``, with or without a time; null otherwise."""
    compact = F.regexp_replace(text, r"^\s*(\d{4})(\d{2})(\d{2})\b", "$1-$2-$3")
    return F.translate(compact, "/", "-").try_cast("date")


def parse_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")
