"""The operators' input tables as views on the test tables, in Spark and as SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2001, 9, 1)
INTERNAL = "internal"
PASSIVE = "warranty|recall"
RULES = [("first", "first service"), ("LOW", "routine")]
DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Plain comparable columns: rounded doubles, bigint integers, dates and lists as strings."""
    columns = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype in ("double", "float"):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif dtype in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        elif dtype == "date":
            c = c.cast("string")
        elif dtype in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif dtype == "array<string>":
            c = F.array_join(c, ";")
        columns.append(c.alias(name))
    return df.select(*columns)


def rounded(expression: str, digits: int = DIGITS) -> str:
    """SQL twin of the rounding in :func:`tidy`."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0"


# Visits: orders as service visits, whole miles. Types carry ";" lists, number runs, and the two exclusion rules.
VISITS_SQL = f"""
visits AS (
  SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS visit_date, floor(o_totalprice) AS mile,
    CASE WHEN o_totalprice < 1900 THEN 'internal car'
         WHEN o_totalprice < 40000 THEN 'warranty case'
         ELSE o_orderpriority || ';lane ' || CAST(month(o_orderdate) AS VARCHAR)
              || CASE WHEN o_orderstatus = 'P' THEN ';first check' ELSE '' END END AS visit_type
  FROM orders)"""


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    usual = F.concat(
        "o_orderpriority", F.lit(";lane "), F.month("o_orderdate").cast("string"),
        F.when(F.col("o_orderstatus") == "P", ";first check").otherwise(""),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderdate").cast("date").alias("visit_date"),
        F.floor(price).cast("double").alias("mile"),
        F.when(price < 1900, "internal car").when(price < 40000, "warranty case").otherwise(usual).alias("visit_type"),
    )


# Purchases: a date for most customers, null for those deep in debt; some dates lie after the first visit.
PURCHASES_SQL = """
purchases AS (
  SELECT c_custkey AS entity_id,
    CASE WHEN c_acctbal >= -700
      THEN DATE '1994-12-01' + CAST(floor(abs(c_acctbal) / 70) AS INTEGER) END AS purchase_date
  FROM customer),
first_purchases AS (
  SELECT entity_id, min(purchase_date) AS purchase_date FROM purchases WHERE purchase_date IS NOT NULL GROUP BY 1)"""


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.floor(F.abs("c_acctbal") / 70).cast("int")
    bought = F.date_add(F.lit(date(1994, 12, 1)), days)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.when(F.col("c_acctbal") >= -700, bought).alias("purchase_date")
    )


VEHICLES_SQL = """
vehicles AS (
  SELECT c_custkey AS entity_id, CASE WHEN c_acctbal < 0 OR c_acctbal > 1000 THEN c_mktsegment END AS owner_type,
    n_name AS car_mode, 'family_' || CAST(1 + n_regionkey % 3 AS VARCHAR) AS car_level
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    customers = table(spark, sf_dir, "customer")
    return customers.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity_id"),
        F.when((balance < 0) | (balance > 1000), F.col("c_mktsegment")).alias("owner_type"),
        F.col("n_name").alias("car_mode"),
        F.concat(F.lit("family_"), (1 + F.col("n_regionkey") % 3).cast("string")).alias("car_level"),
    )


# Members: the keys are shifted, so that each side of the outer join has keys the other lacks.
MEMBERS_SQL = """
members AS (
  SELECT c_custkey + 100 AS entity_id,
    CASE WHEN c_acctbal > 5000 THEN 'gold' WHEN c_acctbal > 0 THEN 'basic' END AS member_level
  FROM customer)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 100).alias("entity_id"),
        F.when(balance > 5000, "gold").when(balance > 0, "basic").alias("member_level"),
    )


# Document lines: lines of the texts, twenty to a page; every seventh line ends in a hyphen.
LINES_SQL = r"""
lines AS (
  SELECT doc, CAST(line_no // 20 AS INTEGER) AS page_no, line_no,
    CASE WHEN line_no % 7 = 6 THEN piece || '-' ELSE piece END AS line
  FROM (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS piece,
               unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents) t)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("line_no", "piece")
    )
    return numbered.select(
        "doc", F.floor(F.col("line_no") / 20).cast("int").alias("page_no"), "line_no",
        F.when(F.col("line_no") % 7 == 6, F.concat("piece", F.lit("-"))).otherwise(F.col("piece")).alias("line"),
    )


# Contents: documents as marketing contents.
CONTENTS_SQL = """
contents AS (
  SELECT CAST(doc_id AS VARCHAR) AS insight_id,
    CASE lang WHEN 'en' THEN 'Poster' WHEN 'fr' THEN 'Blog' ELSE 'Article' END AS content_format,
    substring(text, 1, 60) AS headline, text AS body_text, 'Read more in ' || lang AS call_to_action,
    source AS target_audience,
    CASE WHEN n_chars < 500 THEN ['Facebook Ads'] WHEN n_chars < 1500 THEN ['LinkedIn', 'Facebook']
         WHEN n_chars < 4000 THEN ['LinkedIn'] ELSE CAST([] AS VARCHAR[]) END AS distribution_channel,
    [source] AS sources
  FROM documents)"""


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("n_chars")
    none = F.array().cast("array<string>")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("insight_id"),
        F.when(F.col("lang") == "en", "Poster").when(F.col("lang") == "fr", "Blog").otherwise("Article").alias("content_format"),
        F.substring("text", 1, 60).alias("headline"),
        F.col("text").alias("body_text"),
        F.concat(F.lit("Read more in "), "lang").alias("call_to_action"),
        F.col("source").alias("target_audience"),
        F.when(size < 500, F.array(F.lit("Facebook Ads")))
        .when(size < 1500, F.array(F.lit("LinkedIn"), F.lit("Facebook")))
        .when(size < 4000, F.array(F.lit("LinkedIn"))).otherwise(none).alias("distribution_channel"),
        F.array("source").alias("sources"),
    )


# Decisions: every turn of a conversation, for the content of the same number; the turn is its place. The wording
# follows from the length of the turn's text, and that text is the reviewer's remark.
WORDINGS = ["approve", " YES ", "no", "approve but shorten: ", "disapprove: ", "", "Reject", "please say yes: "]
DECISIONS_SQL = f"""
worded AS (
  SELECT conv_id, turn, text AS remark, [{', '.join(repr(w) for w in WORDINGS)}][1 + length(text) % {len(WORDINGS)}] AS wording
  FROM conversations),
all_decisions AS (
  SELECT CAST(conv_id AS VARCHAR) AS insight_id, turn,
    CASE WHEN wording LIKE '%: ' THEN wording || remark ELSE wording END AS decision,
    CASE WHEN wording = 'no' THEN remark END AS extra_feedback
  FROM worded),
decisions AS (
  SELECT insight_id, decision, extra_feedback FROM (
    SELECT *, row_number() OVER (PARTITION BY insight_id ORDER BY turn DESC) AS back FROM all_decisions) t WHERE back = 1)"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").withColumn("remark", F.col("text"))
    wording = F.element_at(F.array(*(F.lit(w) for w in WORDINGS)), F.length("remark") % len(WORDINGS) + 1)
    worded = turns.withColumn("wording", wording)
    return worded.select(
        F.col("conv_id").cast("string").alias("insight_id"),
        F.when(F.col("wording").endswith(": "), F.concat("wording", "remark")).otherwise(F.col("wording")).alias("decision"),
        F.when(F.col("wording") == "no", F.col("remark")).alias("extra_feedback"),
        F.col("turn").alias("place"),
    )


# Outcomes: what came back for a content; the label table decides between failure, empty id and id.
OUTCOMES_SQL = """
outcomes AS (
  SELECT CAST(doc_id AS VARCHAR) AS content_id, CASE WHEN toxic = 1 THEN 'refused' END AS error,
    CASE WHEN quality = 1 THEN CAST(doc_id AS VARCHAR) ELSE '' END AS post_id
  FROM labels)"""


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "labels").select(
        doc.alias("content_id"), F.when(F.col("toxic") == 1, "refused").alias("error"),
        F.when(F.col("quality") == 1, doc).otherwise("").alias("post_id"),
    )


# Posts: all events of a user in a calendar month as the metrics of one post, each event an entry of the post's
# JSON list, in their order; the last entry of a name counts. Views, signups
# and purchases give a number, clicks an object by type (nested for large values).
METRICS_SQL = """
metric_events AS (
  SELECT user_id * 12 + month(ts) - 1 AS post_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value AS amount,
    CASE event_type WHEN 'view' THEN 'impressions' WHEN 'signup' THEN 'reach'
      WHEN 'click' THEN 'clicks' WHEN 'purchase' THEN 'engagement' END AS measure
  FROM events),
latest_metrics AS (
  SELECT post_id, measure, max_by(CASE WHEN measure = 'clicks' AND amount > 100 THEN k + 1 ELSE k END, event_id) AS value
  FROM metric_events GROUP BY 1, 2),
performance AS (
  SELECT post_id,
    CAST(coalesce(max(CASE WHEN measure = 'reach' THEN value END), 0) AS BIGINT) AS reach,
    CAST(coalesce(max(CASE WHEN measure = 'impressions' THEN value END), 0) AS BIGINT) AS impressions,
    CAST(coalesce(max(CASE WHEN measure = 'clicks' THEN value END), 0) AS BIGINT) AS clicks,
    CAST(coalesce(max(CASE WHEN measure = 'engagement' THEN value END), 0) AS BIGINT) AS engagement
  FROM latest_metrics GROUP BY 1)"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", "post_impressions").when(kind == "signup", "post_impressions_unique")
        .when(kind == "click", "post_clicks_by_type").when(kind == "purchase", "post_engagements").otherwise(kind)
    )
    k = F.get_json_object("props", "$.k")
    clicks = F.when(
        F.col("value") > 100, F.concat(F.lit('{"link click":{"a":'), k, F.lit(',"b":1}}'))
    ).otherwise(F.concat(F.lit('{"other clicks":5,"link click":'), k, F.lit("}")))
    value = F.when(kind == "click", clicks).otherwise(k)
    entry = F.concat(F.lit('{"name":"'), name, F.lit('","values":[{"value":'), value, F.lit("}]}"))
    post = F.col("user_id") * 12 + F.month("ts") - 1
    ordered = F.sort_array(F.collect_list(F.struct("event_id", "entry")))
    return table(spark, sf_dir, "events").select(post.alias("post_id"), "event_id", entry.alias("entry")).groupBy("post_id").agg(
        F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda x: x["entry"]), ","), F.lit("]")).alias("metrics")
    )
