"""Category strings: natural order, ``;`` lists, prefixes, labels and display text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that a strip removes (the Unicode white space set).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Category renames (substring -> unified name).
UNIFIED_TYPES = [("首", "首次保养"), ("普修", "普通维修")]

# Text labels.
FIELD_LABELS = {
    "member_level": "会员卡：",
    "owner_type": "用户性质：",
    "car_mode": "汽车型号：",
    "last_repair_type": "上次进店类型：",
    "all_repair_types": "历史进店类型：",
}
TIER_NAMES = {"family_1": "高档车", "family_2": "中档车"}
OTHER_TIER = "低档车"
CHURN_NAMES = {1: "用户标签：流失", 0: "用户标签：未流失"}
TEXT_SEPARATOR = "，"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def natural_key(text: Column) -> Column:
    """Sort key that orders digit runs by value: ``b9`` before ``b10``.

    One struct per run of non-digits and the digits after it. A number is compared by its length
    without leading zeros and then digit by digit, so any length is exact; an absent number sorts
    first.
    """
    runs = F.lit(r"(\D*)(\d*)")
    prefixes, numbers = F.regexp_extract_all(text, runs, 1), F.regexp_extract_all(text, runs, 2)

    def key(prefix: Column, number: Column) -> Column:
        digits = F.when(number != "", F.ltrim(number, F.lit("0")))
        return F.struct(prefix.alias("prefix"), F.length(digits).alias("width"), digits.alias("digits"))

    return F.zip_with(prefixes, numbers, key)


def natural_sort(items: Column) -> Column:
    """Array in natural order, equal keys in plain string order."""
    keyed = F.transform(items, lambda s: F.struct(natural_key(s).alias("key"), s.alias("item")))
    return F.transform(F.sort_array(keyed), lambda pair: pair["item"])


def split_tokens(text: Column, separator: str = ";") -> Column:
    return F.split(text, re.escape(separator))


def unify_tokens(items: Column, rules: Sequence[tuple[str, str]] = tuple(UNIFIED_TYPES)) -> Column:
    """Map tokens holding a rule's substring to its unified name, rule after rule, and drop repeats."""

    def rename(token: Column) -> Column:
        for needle, name in rules:
            token = F.when(token.contains(needle), F.lit(name)).otherwise(token)
        return token

    return F.array_distinct(F.transform(items, rename))


def labelled(prefix: str, text: Column) -> Column:
    return F.concat(F.lit(prefix), text)


def named_bin(value: Column, names: dict, other: str | None = None) -> Column:
    """Name of a category value; ``other`` for all the rest."""
    chosen = None
    for key, name in names.items():
        hit = value == F.lit(key)
        chosen = F.when(hit, F.lit(name)) if chosen is None else chosen.when(hit, F.lit(name))
    return chosen.otherwise(F.lit(other)) if other is not None else chosen


def pack_key(key: Column, label: Column) -> Column:
    return F.concat_ws(":", key.cast("string"), label.cast("string"))


def unpack_key(packed: Column) -> tuple[Column, Column]:
    """Key and label of ``key:label``."""
    return F.split_part(packed, F.lit(":"), F.lit(1)), F.split_part(packed, F.lit(":"), F.lit(2)).cast("int")


def post_message(headline: Column, body: Column, call_to_action: Column) -> Column:
    return F.concat_ws("\n\n", *(F.coalesce(part, F.lit("")) for part in (headline, body, call_to_action)))


def preview(text: Column, width: int = 200) -> Column:
    return F.substring(text, 1, width)


def insight_line(insight_id: Column, insight: Column, relevance: Column) -> Column:
    return F.concat(
        F.lit("ID: "), insight_id.cast("string"),
        F.lit(" | Insight: "), insight,
        F.lit(" | Relevance: "), relevance,
    )
