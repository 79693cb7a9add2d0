"""Schemas of the input and result tables."""

from __future__ import annotations

# Input files of the visit analysis, original header -> column name.
VEHICLE_COLUMNS = {"VIN": "entity_id", "车主性质": "owner_type", "车型": "car_mode", "family_name": "car_level"}
MEMBER_COLUMNS = {"VIN": "entity_id", "会员等级": "member_level"}
PURCHASE_COLUMNS = {"VIN": "entity_id", "purchase_date": "purchase_date"}
VISIT_COLUMNS = {"VIN": "entity_id", "修理日期": "visit_date", "公里数": "mile", "修理类型": "visit_type"}

# Input file of each table, and the columns that are not text.
VISIT_FILES = {
    "vehicles": ("vehicle3.csv", VEHICLE_COLUMNS, {}),
    "members": ("member_info.csv", MEMBER_COLUMNS, {}),
    "purchases": ("repare_maintain_info1.csv", PURCHASE_COLUMNS, {"purchase_date": "date"}),
    "visits": ("repare_maintain_info1.csv", VISIT_COLUMNS, {"visit_date": "date", "mile": "double"}),
}

# Numeric inputs of the vector model.
NUMERIC_FEATURES = [
    "last_mile", "last_till_now_days", "first_to_purchase_day_diff", "first_to_purchase_mile_diff",
    "second_to_first_day_diff", "second_to_first_mile_diff", "day_diff_median", "mile_diff_median",
    "day_speed_median", "day_cv", "mile_cv", "day_speed_cv", "all_times", "car_age",
]

NEWS_ITEM = "struct<link:string,title:string,source:string,date:string,snippet:string>"
POST_METRICS = "array<struct<name:string,values:array<struct<value:string>>>>"
CONTENTS = (
    "insight_id string, content_format string, headline string, body_text string, call_to_action string, "
    "target_audience string, distribution_channel array<string>, sources array<string>"
)
