"""News, review, publishing and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import campaign as op
from ..plans.campaign import gated_queue, post_performance_report
from ..session import shared_dir
from ..sources.files import write_table
from ..sources.web import news_results, post_metric_rows
from . import inputs
from .inputs import rounded, table, tidy

PAGE_ID = "page-1"
HOST = r"^[a-z]+://([^/?#]+)"

# ---------------------------------------------------------------- Spark


def news_ingest_top10(spark, sf_dir):
    """Pages as search results: the host is the query, some items lack fields."""
    item = F.to_json(F.struct(
        F.col("url").alias("link"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.when(F.col("url").contains("?"), F.lit("search")).alias("source"),
    ))
    items = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", HOST, 1).alias("query"), F.col("page_id").alias("place"), item.alias("item")
    )
    return tidy(news_results(items))


def decided(spark, sf_dir, whole_words=True):
    contents = inputs.contents(spark, sf_dir).select("insight_id", "content_format")
    return tidy(op.reviewed(contents, inputs.decisions(spark, sf_dir), whole_words=whole_words))


def review_decisions(spark, sf_dir):
    return decided(spark, sf_dir)


def review_decisions_contains(spark, sf_dir):
    return decided(spark, sf_dir, whole_words=False)


def review_gate(spark, sf_dir):
    contents = inputs.contents(spark, sf_dir)
    passed = op.approved_only(op.reviewed(contents, inputs.decisions(spark, sf_dir)))
    return tidy(passed.select("insight_id", "headline", "approval", "feedback"))


def review_listing(spark, sf_dir):
    return tidy(op.review_listing(inputs.contents(spark, sf_dir)))


def eligible_contents(spark, sf_dir):
    return tidy(op.eligible(inputs.contents(spark, sf_dir)).select("insight_id", "content_format", "distribution_channel"))


def queue(spark, sf_dir, gated=True):
    decisions = inputs.decisions(spark, sf_dir) if gated else None
    return gated_queue(inputs.contents(spark, sf_dir), decisions, PAGE_ID)


def publish_queue(spark, sf_dir):
    return tidy(queue(spark, sf_dir))


def publish_queue_unreviewed(spark, sf_dir):
    return tidy(queue(spark, sf_dir, gated=False))


def results(spark, sf_dir):
    return op.publish_results(queue(spark, sf_dir, gated=False), inputs.outcomes(spark, sf_dir))


def publish_results(spark, sf_dir):
    found = results(spark, sf_dir)
    return tidy(found.withColumn("response", F.to_json("response")))


def publish_sink(spark, sf_dir):
    """Queue and status tables, written and read back."""
    folder = shared_dir(spark, "publish")
    queued = write_table(queue(spark, sf_dir, gated=False), f"{folder}/queue")
    status = write_table(op.publish_results(queued, inputs.outcomes(spark, sf_dir)).select("content_id", "post_id", "status"), f"{folder}/status")
    return tidy(queued.join(status, "content_id"))


def published_posts(spark, sf_dir):
    return tidy(op.published_posts(results(spark, sf_dir)))


def publish_counts(spark, sf_dir):
    return tidy(op.publish_counts(results(spark, sf_dir)))


def post_metrics(spark, sf_dir):
    return tidy(op.post_metrics(post_metric_rows(inputs.posts(spark, sf_dir))))


def post_report(spark, sf_dir):
    return tidy(op.post_performance(post_metric_rows(inputs.posts(spark, sf_dir))))


def post_report_totals(spark, sf_dir):
    return tidy(op.report_totals(op.post_performance(post_metric_rows(inputs.posts(spark, sf_dir)))))


def published_report(spark, sf_dir):
    """Totals over the posts that were published."""
    posts = inputs.posts(spark, sf_dir).withColumn("post_id", F.col("post_id").cast("string"))
    return tidy(post_performance_report(results(spark, sf_dir), posts)[1])


QUERIES = {
    "news_ingest_top10": news_ingest_top10,
    "review_decisions": review_decisions,
    "review_decisions_contains": review_decisions_contains,
    "review_gate": review_gate,
    "review_listing": review_listing,
    "eligible_contents": eligible_contents,
    "publish_queue": publish_queue,
    "publish_queue_unreviewed": publish_queue_unreviewed,
    "publish_results": publish_results,
    "publish_sink": publish_sink,
    "published_posts": published_posts,
    "publish_counts": publish_counts,
    "post_metrics": post_metrics,
    "post_report": post_report,
    "post_report_totals": post_report_totals,
    "published_report": published_report,
}

# ---------------------------------------------------------------- SQL


def review_sql(approving: str) -> str:
    return f"""{inputs.CONTENTS_SQL},{inputs.DECISIONS_SQL},
answers AS (
  SELECT c.*, lower(trim(coalesce(decision, ''))) AS answer, nullif(trim(extra_feedback), '') AS more
  FROM contents c LEFT JOIN decisions d ON c.insight_id = d.insight_id),
reviewed AS (
  SELECT *,
    CASE WHEN answer IN ('approve', 'approved', 'yes', 'y') THEN 'approved'
         WHEN answer IN ('reject', 'rejected', 'no', 'n') THEN 'rejected'
         WHEN {approving} THEN 'approved' ELSE 'rejected' END AS approval,
    CASE WHEN answer IN ('approve', 'approved', 'yes', 'y', 'reject', 'rejected', 'no', 'n', '') THEN more ELSE answer END AS feedback
  FROM answers)"""


WHOLE = "regexp_matches(answer, '(^|[^a-z])(approve|approved|yes)([^a-z]|$)')"
ANYWHERE = "contains(answer, 'approve') OR contains(answer, 'yes')"
ELIGIBLE = """contains(content_format, 'Poster')
  OR len(list_filter(distribution_channel, lambda c: contains(c, 'Facebook'))) > 0"""
MESSAGE = f"""insight_id AS content_id, '{PAGE_ID}' AS page_id,
  headline || chr(10) || chr(10) || body_text || chr(10) || chr(10) || call_to_action AS message"""

RESULTS_SQL = f"""{inputs.CONTENTS_SQL},{inputs.OUTCOMES_SQL},
results AS (
  SELECT insight_id AS content_id, CASE WHEN o.content_id IS NOT NULL AND error IS NULL THEN post_id ELSE '' END AS post_id,
    CASE WHEN o.content_id IS NOT NULL AND error IS NULL THEN 'success' ELSE 'failed' END AS status, coalesce(error, 'no outcome') AS reason
  FROM contents LEFT JOIN outcomes o ON insight_id = o.content_id WHERE {ELIGIBLE})"""

REPORT_SQL = f"""{inputs.METRICS_SQL},
report AS (
  SELECT *, round(CASE WHEN impressions > 0 THEN clicks / impressions::DOUBLE ELSE 0 END, 4) AS ctr FROM performance)"""


def totals_sql(where: str, post_id: str) -> str:
    return f"""SELECT count(*) AS n_posts, {rounded('round(coalesce(avg(ctr), 0), 4)')} AS total_avg_ctr,
  (SELECT {post_id} FROM report WHERE {where} ORDER BY clicks DESC, {post_id} LIMIT 1) AS top_performing_post_id
FROM report WHERE {where}"""


SQL = {
    "news_ingest_top10": f"""WITH items AS (
  SELECT regexp_extract(url, '{HOST}', 1) AS query, page_id, url AS link, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    CASE WHEN contains(url, '?') THEN 'search' ELSE '' END AS source, '' AS date, '' AS snippet FROM pages)
SELECT query, rank, link, title, source, date, snippet
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY page_id) AS rank FROM items) t WHERE rank <= 10""",
    "review_decisions": f"WITH {review_sql(WHOLE)} SELECT insight_id, content_format, approval, feedback FROM reviewed",
    "review_decisions_contains": f"WITH {review_sql(ANYWHERE)} SELECT insight_id, content_format, approval, feedback FROM reviewed",
    "review_gate": f"""WITH {review_sql(WHOLE)}
SELECT insight_id, headline, approval, feedback FROM reviewed WHERE approval = 'approved'""",
    "review_listing": f"""WITH {inputs.CONTENTS_SQL}
SELECT insight_id, content_format, headline, target_audience, coalesce(array_to_string(distribution_channel, ', '), '') AS channels,
  substring(body_text, 1, 200) AS body_preview, call_to_action FROM contents""",
    "eligible_contents": f"""WITH {inputs.CONTENTS_SQL}
SELECT insight_id, content_format, coalesce(array_to_string(distribution_channel, ';'), '') AS distribution_channel
FROM contents WHERE {ELIGIBLE}""",
    "publish_queue": f"WITH {review_sql(WHOLE)} SELECT {MESSAGE} FROM reviewed WHERE approval = 'approved' AND ({ELIGIBLE})",
    "publish_queue_unreviewed": f"WITH {inputs.CONTENTS_SQL} SELECT {MESSAGE} FROM contents WHERE {ELIGIBLE}",
    "publish_results": f"""WITH {RESULTS_SQL}
SELECT content_id, post_id, status, CASE status WHEN 'success' THEN '{{"id":"' || post_id || '"}}'
  ELSE '{{"error":"' || reason || '"}}' END AS response FROM results""",
    "publish_sink": f"""WITH {RESULTS_SQL},
queue AS (SELECT {MESSAGE} FROM contents WHERE {ELIGIBLE})
SELECT queue.*, post_id, status FROM queue JOIN results ON queue.content_id = results.content_id""",
    "published_posts": f"WITH {RESULTS_SQL} SELECT post_id FROM results WHERE status = 'success' AND post_id <> ''",
    "publish_counts": f"""WITH {RESULTS_SQL}
SELECT count(*) FILTER (WHERE status = 'success') AS successful, count(*) AS total FROM results""",
    "post_metrics": f"WITH {inputs.METRICS_SQL} SELECT * FROM performance",
    "post_report": f"WITH {REPORT_SQL} SELECT post_id, reach, impressions, clicks, engagement, {rounded('ctr')} AS ctr FROM report",
    "post_report_totals": f"WITH {REPORT_SQL} {totals_sql('TRUE', 'post_id')}",
    "published_report": f"""WITH {RESULTS_SQL},{REPORT_SQL}
{totals_sql("CAST(post_id AS VARCHAR) IN (SELECT post_id FROM results WHERE status = 'success')", 'CAST(post_id AS VARCHAR)')}""",
}
