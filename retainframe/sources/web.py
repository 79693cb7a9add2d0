"""News results and post metrics that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .schemas import NEWS_ITEM, POST_METRICS

CLICKS = "post_clicks_by_type"
NEWS_FIELDS = ["link", "title", "source", "date", "snippet"]


def news_results(items: DataFrame, per_query: int = 10) -> DataFrame:
    """(query, place, item JSON) rows to news rows, the first ``per_query`` of each query by place.

    A missing field is an empty string. The limit is applied inside each task before the shuffle.
    """
    first = Window.partitionBy("query").orderBy("place")
    parsed = (
        items.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_query)
        .select("query", "rank", F.from_json("item", NEWS_ITEM).alias("item"))
    )
    return parsed.select("query", "rank", *(F.coalesce(f"item.{f}", F.lit("")).alias(f) for f in NEWS_FIELDS))


def _parsed_posts(posts: DataFrame) -> DataFrame:
    """Posts with their parsed metrics and whether these can be used as they stand."""
    metrics = F.from_json("metrics", POST_METRICS)

    def sound(metric: Column) -> Column:
        first = F.get(metric["values"], F.lit(0))["value"]
        by_type = (metric["name"] != CLICKS) | first.startswith("{")
        return F.coalesce((F.size(metric["values"]) > 0) & by_type, F.lit(False))

    parsed = posts.withColumn("parsed", metrics)
    return parsed.withColumn("sound", F.coalesce(F.forall("parsed", sound), F.lit(False)))


def rejected_posts(posts: DataFrame) -> DataFrame:
    """Posts that leave the report: no JSON list, a metric without values, or clicks not given by type."""
    return _parsed_posts(posts).where(~F.col("sound")).drop("parsed", "sound")


def post_metric_rows(posts: DataFrame) -> DataFrame:
    """(post_id, metrics JSON) rows to (post_id, place, name, value): the first value of every metric.

    Clicks are a JSON object by type: its ``link click`` entry counts, 0 if absent, or the sum of
    that entry if it is an object itself. A post with an empty list keeps one row without a name.
    """
    sound = _parsed_posts(posts).where("sound")
    entries = sound.select("post_id", F.posexplode_outer("parsed").alias("place", "metric"))
    raw = entries.select("post_id", "place", "metric.name", F.get("metric.values", F.lit(0))["value"].alias("raw"))
    zero = F.lit(0).cast("bigint")
    link = F.try_element_at(F.from_json("raw", "map<string,string>"), F.lit("link click"))
    counts = F.map_values(F.from_json(link, "map<string,bigint>"))
    nested = F.aggregate(counts, zero, lambda total, x: total + F.coalesce(x, zero))
    clicks = F.coalesce(link.try_cast("bigint"), F.when(link.startswith("{"), nested), zero)
    value = F.when(F.col("name") == CLICKS, clicks).otherwise(F.coalesce(F.col("raw").try_cast("bigint"), zero))
    return raw.select("post_id", "place", "name", value.alias("value"))
