"""Review-gated publishing and the report on what was published."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.campaign import (
    approved_only, post_performance, publish_queue, published_posts, report_totals, reviewed,
)
from ..sources.web import post_metric_rows


def gated_queue(contents: DataFrame, decisions: DataFrame | None, page_id: str, whole_words: bool = True) -> DataFrame:
    """Rows to publish. With a decisions table only approved contents pass; None means no review."""
    if decisions is not None:
        contents = approved_only(reviewed(contents, decisions, whole_words=whole_words)).select(*contents.columns)
    return publish_queue(contents, page_id)


def post_performance_report(results: DataFrame, posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per-post rows, totals) of the successful posts. ``posts``: post_id, metrics JSON."""
    wanted = published_posts(results).distinct()
    performance = post_performance(post_metric_rows(posts.join(wanted, "post_id", "left_semi")))
    return performance, report_totals(performance)
