"""Review gate, publish queue and post performance report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import click_through_rate
from ..functions.strings import insight_line, post_message, preview, strip
from .joins import one_per_key

# Accepted answers, and the words that approve an answer with feedback.
APPROVALS = ["approve", "approved", "yes", "y"]
REJECTIONS = ["reject", "rejected", "no", "n"]
APPROVING_TEXT = ["approve", "yes"]
WHOLE_WORD_APPROVAL = r"(^|[^a-z])(approve|approved|yes)([^a-z]|$)"

# Metric names of a post and the report columns they fill.
METRIC_COLUMNS = {
    "post_impressions_unique": "reach",
    "post_impressions": "impressions",
    "post_clicks_by_type": "clicks",
    "post_engagements": "engagement",
}


def review(decision: Column, extra_feedback: Column | None = None, whole_words: bool = True) -> tuple[Column, Column]:
    """(approval, feedback) of a free-text decision; anything unclear or missing is rejected.

    ``whole_words`` = False accepts the approving text anywhere in the answer, so that "disapprove"
    approves; the default asks for whole words. Text beyond a plain answer is kept as feedback, and
    ``extra_feedback`` is used where there is none.
    """
    answer = F.lower(strip(F.coalesce(decision, F.lit(""))))
    plain = answer.isin(APPROVALS + REJECTIONS)
    if whole_words:
        approving = answer.rlike(WHOLE_WORD_APPROVAL)
    else:
        approving = answer.contains(APPROVING_TEXT[0]) | answer.contains(APPROVING_TEXT[1])
    approved = answer.isin(APPROVALS) | (~plain & approving)
    approval = F.when(approved, "approved").otherwise("rejected")
    feedback = F.when(~plain & (answer != ""), answer)
    if extra_feedback is not None:
        more = strip(extra_feedback)
        feedback = F.coalesce(feedback, F.when(more != "", more))
    return approval, feedback


def reviewed(contents: DataFrame, decisions: DataFrame, key: str = "insight_id", whole_words: bool = True) -> DataFrame:
    """Contents with approval and feedback.

    ``decisions``: key, decision, optional extra_feedback, optional place; the decision with the
    highest place counts where a content has several.
    """
    wanted = [c for c in (key, "decision", "extra_feedback", "place") if c in decisions.columns]
    prefer = [F.col("place")] if "place" in wanted else []
    last = one_per_key(decisions.select(wanted), key, prefer).drop("place")
    extra = F.col("extra_feedback") if "extra_feedback" in wanted else None
    approval, feedback = review(F.col("decision"), extra, whole_words)
    joined = contents.join(last, key, "left")
    return joined.select(*contents.columns, approval.alias("approval"), feedback.alias("feedback"))


def approved_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("approval") == "approved")


def review_listing(contents: DataFrame, width: int = 200) -> DataFrame:
    """What a reviewer sees of each content: body preview and comma-joined channels."""
    return contents.select(
        "insight_id", "content_format", "headline", "target_audience",
        F.array_join("distribution_channel", ", ").alias("channels"),
        preview(F.col("body_text"), width).alias("body_preview"),
        "call_to_action",
    )


def eligible(contents: DataFrame) -> DataFrame:
    """Posters, and contents with a Facebook channel."""
    on_channel = F.exists("distribution_channel", lambda c: c.contains("Facebook"))
    return contents.where(F.col("content_format").contains("Poster") | F.coalesce(on_channel, F.lit(False)))


def publish_queue(contents: DataFrame, page_id: str) -> DataFrame:
    """One row to post per eligible content."""
    message = post_message(F.col("headline"), F.col("body_text"), F.col("call_to_action"))
    return eligible(contents).select(
        F.col("insight_id").alias("content_id"), F.lit(page_id).alias("page_id"), message.alias("message")
    )


def publish_results(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Queue rows with status, post_id and response.

    ``outcomes``: content_id, error, post_id; a success counts before failed attempts of the same
    content. A row with an error, or without any outcome, failed.
    """
    attempts = outcomes.select("content_id", "post_id", "error")
    settled = one_per_key(attempts, "content_id", [F.col("error").isNull()]).withColumn("answered", F.lit(True))
    answered = F.col("answered") & F.col("error").isNull()
    joined = queue.select("content_id").join(settled, "content_id", "left")
    success = F.coalesce(answered, F.lit(False))
    post_id = F.when(success, F.coalesce("post_id", F.lit(""))).otherwise("")
    response = F.when(success, F.create_map(F.lit("id"), post_id)).otherwise(
        F.create_map(F.lit("error"), F.coalesce("error", F.lit("no outcome")))
    )
    return joined.select(
        "content_id", post_id.alias("post_id"),
        F.when(success, "success").otherwise("failed").alias("status"), response.alias("response"),
    )


def published_posts(results: DataFrame) -> DataFrame:
    """Ids of posts that succeeded and have an id."""
    return results.where((F.col("status") == "success") & (F.col("post_id") != "")).select("post_id")


def publish_counts(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == "success").alias("successful"), F.count(F.lit(1)).alias("total")
    )


def insight_text(insights: DataFrame) -> DataFrame:
    """One text of the few top insights, a line each in insight_no order."""
    line = insight_line(F.col("insight_id"), F.col("key_insight_content"), F.col("strategic_relevance"))
    lines = F.sort_array(F.collect_list(F.struct("insight_no", line.alias("line"))))
    return insights.agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("insights"))


def post_metrics(metrics: DataFrame) -> DataFrame:
    """(post_id, name, value, place) rows to one row per post: reach, impressions, clicks, engagement.

    The last entry of a name counts, an absent metric is 0.
    """

    def last(name: str) -> Column:
        return F.coalesce(F.max_by("value", F.when(F.col("name") == name, F.col("place"))), F.lit(0).cast("bigint"))

    return metrics.groupBy("post_id").agg(*(last(n).alias(c) for n, c in METRIC_COLUMNS.items()))


def post_performance(metrics: DataFrame) -> DataFrame:
    """Per-post report rows with the click-through rate."""
    return post_metrics(metrics).withColumn("ctr", click_through_rate(F.col("clicks"), F.col("impressions")))


def report_totals(performance: DataFrame, order: str = "post_id") -> DataFrame:
    """Unweighted mean of the rounded rates, and the post with most clicks (first in ``order`` on ties).

    An empty report has mean 0.0 and no top post.
    """
    return performance.agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.round(F.coalesce(F.avg("ctr"), F.lit(0.0)), 4).alias("total_avg_ctr"),
        F.min_by("post_id", F.struct((-F.col("clicks")).alias("clicks"), F.col(order))).alias("top_performing_post_id"),
    )
