"""Visit analysis queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators.features import churn_label, stratified_split, visit_features
from ..operators.joins import drop_entities_matching, drop_rows_matching, keep_keys
from ..operators.profile import customer_profile, fill_profile, first_purchases
from ..operators.visits import (
    active_entities, clean_visits, entity_counts, history, in_order, inactive_entities, latest_visits, split_date, type_history,
)
from ..plans.churn import churn_features, labelled_dataset, text_features
from ..session import shared_dir
from ..sources.files import read_csv, typed, write_csv, write_table
from . import inputs
from .inputs import AS_OF, INTERNAL, PASSIVE, RULES, rounded, table, tidy

# ---------------------------------------------------------------- Spark


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (f(spark, sf_dir) for f in (inputs.vehicles, inputs.members, inputs.purchases))
    return customer_profile(*tables)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_visits(inputs.visits(spark, sf_dir), None, INTERNAL, PASSIVE, RULES)


def past(spark: SparkSession, sf_dir: str):
    """Cleaned visits up to the split date, and that date."""
    split = split_date(active_entities(inputs.visits(spark, sf_dir), None, INTERNAL, PASSIVE))
    return history(cleaned(spark, sf_dir), split), split


def past_intervals(spark: SparkSession, sf_dir: str):
    visits, split = past(spark, sf_dir)
    return iv.visit_intervals(visits, first_purchases(inputs.purchases(spark, sf_dir))), split


def last_active(spark, sf_dir):
    return tidy(active_entities(inputs.visits(spark, sf_dir), profile(spark, sf_dir), INTERNAL, PASSIVE))


def csv_source(spark, sf_dir):
    """Write a table as CSV, read chosen columns back under new names and typed."""
    path = shared_dir(spark, "csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    rows = read_csv(spark, path, {"c_custkey": "entity_id", "c_mktsegment": "owner_type", "c_acctbal": "balance"})
    good, _ = typed(rows, {"entity_id": "bigint", "balance": "double"})
    return tidy(good)


def csv_documents(spark, sf_dir):
    """Texts with quotes, commas and line breaks, written as CSV and read back."""
    path = shared_dir(spark, "csv")
    text = F.concat(F.lit('"'), "lang", F.lit('", '), "text", F.lit(' ""\n'))
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "source", text.alias("text")), path)
    good, _ = typed(read_csv(spark, path, {"text": "body", "doc_id": "doc_id"}), {"doc_id": "bigint"})
    return tidy(good)


def csv_dates(spark, sf_dir):
    """Dates and timestamps in several spellings, written as CSV, read back and typed."""
    path = shared_dir(spark, "csv")
    day = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyyMMdd"))
    moment = F.date_format(F.col("o_orderdate") + F.expr("make_dt_interval(0, 0, 0, o_orderkey % 86400)"), "yyyy-MM-dd HH:mm:ss")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day.otherwise(F.date_format("o_orderdate", "yyyy-M-d")).alias("day"), moment.alias("moment"))
    write_csv(orders, path)
    rows = read_csv(spark, path, {"o_orderkey": "order_id", "day": "visit_date", "moment": "visit_time"}, multi_line=False)
    good, _ = typed(rows, {"order_id": "bigint", "visit_date": "date", "visit_time": "timestamp"})
    return tidy(good)


def csv_rejects(spark, sf_dir):
    """Orders read as text, with the date missing its form in cancelled orders: the rejected rows."""
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd.MM.yy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("visit_date"),
    )
    _, rejected = typed(text, {"visit_date": "date"})
    return tidy(rejected)


def profile_outer_fill(spark, sf_dir):
    return tidy(fill_profile(inputs.vehicles(spark, sf_dir), inputs.members(spark, sf_dir)))


def customer_profiles(spark, sf_dir):
    return tidy(profile(spark, sf_dir))


def visits_excluding_internal(spark, sf_dir):
    visits = keep_keys(inputs.visits(spark, sf_dir), profile(spark, sf_dir), "entity_id")
    own = drop_entities_matching(visits, "entity_id", "visit_type", INTERNAL)
    return tidy(drop_rows_matching(own, "visit_type", PASSIVE))


def visits_same_day(spark, sf_dir):
    return tidy(in_order(cleaned(spark, sf_dir)))


def visit_counts(spark, sf_dir):
    return tidy(entity_counts(cleaned(spark, sf_dir)))


def visit_interval_stats(spark, sf_dir):
    return tidy(iv.interval_stats(past_intervals(spark, sf_dir)[0]))


def visit_raw_intervals(spark, sf_dir):
    visits, _ = past(spark, sf_dir)
    found = iv.raw_intervals(visits, first_purchases(inputs.purchases(spark, sf_dir)))
    return tidy(found.drop("visit_types"))


def visit_mileage_repair(spark, sf_dir):
    return tidy(past_intervals(spark, sf_dir)[0].drop("visit_types"))


def visit_first_second(spark, sf_dir):
    return tidy(iv.first_second(past_intervals(spark, sf_dir)[0]))


def visit_latest(spark, sf_dir):
    return tidy(latest_visits(past(spark, sf_dir)[0]))


def inactive(spark, sf_dir):
    intervals, split = past_intervals(spark, sf_dir)
    return tidy(inactive_entities(intervals, split))


def history_type_set(spark, sf_dir):
    return tidy(type_history(past(spark, sf_dir)[0]))


def features(spark, sf_dir, inactive_rule: str = "drop"):
    known = profile(spark, sf_dir)
    visits = inputs.visits(spark, sf_dir)
    split = split_date(active_entities(visits, known, INTERNAL, PASSIVE))
    past_visits = history(clean_visits(visits, known, INTERNAL, PASSIVE, RULES, ["purchase_date"]), split)
    intervals = iv.visit_intervals(past_visits)
    return visit_features(intervals, known, split, AS_OF, inactive_rule), split


def visit_feature_table(spark, sf_dir):
    return tidy(features(spark, sf_dir)[0].drop("inactive"))


def labelled(spark, sf_dir, inactive_rule: str = "drop"):
    return churn_features(
        inputs.visits(spark, sf_dir), inputs.vehicles(spark, sf_dir), inputs.members(spark, sf_dir),
        inputs.purchases(spark, sf_dir), AS_OF, INTERNAL, PASSIVE, RULES, inactive_rule,
    )


LABEL_COLUMNS = ["entity_id", "last_date", "day_diff_median", "relative_next_instore_date", "max_relative_next_instore_date", "churn_label"]


def churn_labels(spark, sf_dir):
    return tidy(labelled(spark, sf_dir).select(LABEL_COLUMNS))


def churn_labels_inactive(spark, sf_dir):
    return tidy(labelled(spark, sf_dir, "label").select(LABEL_COLUMNS))


def split_members(spark, sf_dir):
    return tidy(labelled_dataset(labelled(spark, sf_dir)).select("entity_id", "churn_label", "dataset"))


def split_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    marked = stratified_split(orders, "o_orderstatus", "o_orderkey")
    return tidy(marked.groupBy("o_orderstatus", "dataset").agg(F.count(F.lit(1)).alias("n")))


def text_feature(spark, sf_dir):
    texts = text_features(labelled(spark, sf_dir))
    return tidy(texts.select("entity_id", "text_feature", "label_txt", "key_label"))


def feature_table_sink(spark, sf_dir):
    written = write_table(features(spark, sf_dir)[0], shared_dir(spark, "features"))
    return tidy(written.groupBy("car_level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("all_times").alias("visits"), F.max("last_date").alias("last_date")
    ))


QUERIES = {
    "csv_source": csv_source,
    "csv_documents": csv_documents,
    "csv_dates": csv_dates,
    "csv_rejects": csv_rejects,
    "profile_outer_fill": profile_outer_fill,
    "customer_profile": customer_profiles,
    "visits_excluding_internal": visits_excluding_internal,
    "visits_same_day": visits_same_day,
    "active_entities": last_active,
    "entity_counts": visit_counts,
    "visit_raw_intervals": visit_raw_intervals,
    "visit_mileage_repair": visit_mileage_repair,
    "visit_interval_stats": visit_interval_stats,
    "visit_first_second": visit_first_second,
    "visit_latest": visit_latest,
    "inactive_entities": inactive,
    "history_type_set": history_type_set,
    "visit_features": visit_feature_table,
    "churn_label": churn_labels,
    "churn_label_inactive": churn_labels_inactive,
    "stratified_split": split_members,
    "stratified_split_counts": split_counts,
    "text_feature": text_feature,
    "feature_table_sink": feature_table_sink,
}

# ---------------------------------------------------------------- SQL


def natural_sorted(items: str) -> str:
    key = (
        r"list_transform(regexp_extract_all(s, '\d+|\D+'), "
        r"lambda r: CASE WHEN regexp_matches(r, '^\d') THEN lpad(r, 12, '0') ELSE r END)"
    )
    return f"list_transform(list_sort(list_transform({items}, lambda s: {{'key': {key}, 'item': s}})), lambda p: p.item)"


def renamed(token: str) -> str:
    for needle, name in RULES:
        token = f"CASE WHEN contains({token}, '{needle}') THEN '{name}' ELSE {token} END"
    return token


PROFILE_SQL = f"""{inputs.VEHICLES_SQL},{inputs.MEMBERS_SQL},{inputs.PURCHASES_SQL},
filled AS (
  SELECT coalesce(v.entity_id, m.entity_id) AS entity_id, coalesce(owner_type, '个人') AS owner_type, car_mode, car_level,
    coalesce(member_level, '无') AS member_level
  FROM vehicles v FULL OUTER JOIN (SELECT * FROM members WHERE member_level IS NOT NULL) m ON v.entity_id = m.entity_id),
full_profile AS (
  SELECT f.*, purchase_date FROM filled f JOIN first_purchases p ON f.entity_id = p.entity_id
  WHERE car_mode IS NOT NULL AND car_level IS NOT NULL)"""


def cleaned_sql(known: bool) -> str:
    only_known = "WHERE entity_id IN (SELECT entity_id FROM full_profile)" if known else ""
    return f"""{inputs.VISITS_SQL},{PROFILE_SQL},
own AS (
  SELECT * FROM visits {only_known} {"AND" if known else "WHERE"} entity_id NOT IN
    (SELECT entity_id FROM visits WHERE regexp_matches(visit_type, '{INTERNAL}'))),
active AS (SELECT * FROM own WHERE NOT regexp_matches(visit_type, '{PASSIVE}')),
tokens AS (
  SELECT entity_id, visit_date, list(DISTINCT {renamed('token')}) AS items
  FROM (SELECT entity_id, visit_date, unnest(string_split(visit_type, ';')) AS token FROM active) t GROUP BY 1, 2),
cleaned AS (
  SELECT d.entity_id, d.visit_date, d.mile, {natural_sorted('items')} AS visit_types
  FROM (SELECT entity_id, visit_date, avg(mile) AS mile FROM active GROUP BY 1, 2) d
  JOIN tokens t ON d.entity_id = t.entity_id AND d.visit_date = t.visit_date),
split AS (SELECT CAST(max(visit_date) - INTERVAL 3 MONTH AS DATE) AS day FROM cleaned),
past AS (SELECT * FROM cleaned WHERE visit_date <= (SELECT day FROM split)),
lagged AS (
  SELECT v.*, coalesce(lag(visit_date) OVER w, purchase_date) AS previous_date, coalesce(lag(mile) OVER w, 0.0) AS previous_mile
  FROM past v LEFT JOIN first_purchases p ON v.entity_id = p.entity_id
  WINDOW w AS (PARTITION BY v.entity_id ORDER BY visit_date)),
gaps AS (
  SELECT *, date_diff('day', previous_date, visit_date) AS day_diff, mile - previous_mile AS mile_diff FROM lagged),
intervals AS (
  SELECT *, mile_diff / day_diff AS day_speed FROM gaps WHERE day_diff > 0),
speeds AS (
  SELECT entity_id, median(day_speed) AS speed FROM intervals WHERE mile_diff >= 0 GROUP BY 1),
repaired AS (
  SELECT i.entity_id, visit_date, mile, visit_types, previous_date, day_diff,
    CASE WHEN mile_diff < 0 THEN mile - day_diff * speed ELSE previous_mile END AS previous_mile,
    CASE WHEN mile_diff < 0 THEN day_diff * speed ELSE mile_diff END AS mile_diff,
    CASE WHEN mile_diff < 0 THEN speed ELSE day_speed END AS day_speed
  FROM intervals i LEFT JOIN speeds s ON i.entity_id = s.entity_id),
gone AS (
  SELECT entity_id, max(visit_date) AS max_date FROM repaired GROUP BY 1
  HAVING max(visit_date) < (SELECT day FROM split) - INTERVAL 3 YEAR)"""


def spread_sql(measure: str) -> str:
    short = measure.replace("_diff", "")
    return f"""{rounded(f'median({measure})')} AS {measure}_median,
    {rounded(f'coalesce(stddev_samp({measure}), 0)')} AS {measure}_std, {rounded(f'avg({measure})')} AS {measure}_mean,
    {rounded(f'coalesce(stddev_samp({measure}) / nullif(avg({measure}), 0), 0)')} AS {short}_cv"""


SPREADS = ",\n    ".join(spread_sql(m) for m in iv.MEASURES)
FIRST_SECOND = f"""
    max(CASE WHEN n = 1 THEN day_diff END) AS first_to_purchase_day_diff,
    {rounded('max(CASE WHEN n = 1 THEN mile_diff END)')} AS first_to_purchase_mile_diff,
    max(CASE WHEN n = 2 THEN day_diff END) AS second_to_first_day_diff,
    {rounded('max(CASE WHEN n = 2 THEN mile_diff END)')} AS second_to_first_mile_diff"""
NUMBERED = "(SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY visit_date) AS n FROM {}) t"


def features_sql(keep_inactive: bool = False) -> str:
    source = "repaired" if keep_inactive else "(SELECT * FROM repaired WHERE entity_id NOT IN (SELECT entity_id FROM gone)) k"
    return f"""{cleaned_sql(True)},
grouped AS (
  SELECT entity_id, max(visit_date) AS last_date, {FIRST_SECOND},
    {SPREADS}, median(day_diff) AS exact_median, count(visit_date) AS all_times
  FROM {NUMBERED.format(source)} GROUP BY 1 HAVING count(*) >= 2 AND median(mile_diff) IS NOT NULL),
last_visits AS (
  SELECT entity_id, max_by(mile, visit_date) AS last_mile, max_by(visit_types, visit_date) AS last_visit_types
  FROM past GROUP BY 1),
all_types AS (
  SELECT entity_id, {natural_sorted('list(DISTINCT token)')} AS all_visit_types
  FROM (SELECT entity_id, unnest(visit_types) AS token FROM repaired) t GROUP BY 1),
features AS (
  SELECT g.*, last_mile, last_visit_types, all_visit_types, owner_type, car_mode, car_level, member_level, purchase_date,
    date_diff('day', last_date, DATE '{AS_OF}') AS last_till_now_days,
    CAST(ceil(date_diff('day', purchase_date, DATE '{AS_OF}') / 365.0) AS BIGINT) AS car_age
  FROM grouped g JOIN last_visits USING (entity_id) JOIN all_types USING (entity_id) JOIN full_profile USING (entity_id)),
expected AS (
  SELECT *, CAST(last_date AS TIMESTAMP) + to_microseconds(CAST(exact_median * 86400000000 AS BIGINT)) AS next_visit FROM features),
labelled AS (
  SELECT *, next_visit + INTERVAL 3 MONTH AS latest_visit,
    CASE WHEN next_visit + INTERVAL 3 MONTH <= (SELECT day FROM split) OR entity_id IN (SELECT entity_id FROM gone)
      THEN 1 ELSE 0 END AS churn_label
  FROM expected)"""


LABELS_SQL = f"""SELECT entity_id, CAST(last_date AS VARCHAR) AS last_date, day_diff_median,
  strftime(next_visit, '%Y-%m-%d %H:%M:%S') AS relative_next_instore_date,
  strftime(latest_visit, '%Y-%m-%d %H:%M:%S') AS max_relative_next_instore_date,
  CAST(churn_label AS BIGINT) AS churn_label FROM labelled"""
INTERVAL_COLUMNS = f"""entity_id, CAST(visit_date AS VARCHAR) AS visit_date, {rounded('mile')} AS mile,
  CAST(previous_date AS VARCHAR) AS previous_date, {rounded('previous_mile')} AS previous_mile,
  CAST(day_diff AS BIGINT) AS day_diff, {rounded('mile_diff')} AS mile_diff, {rounded('day_speed')} AS day_speed"""


def quota_sql(rows: str, label: str, key: str, columns: str) -> str:
    order = f"md5('42:' || CAST({key} AS VARCHAR)), {key}"
    return f"""SELECT {columns}, CASE WHEN place <= round(0.1 * n) THEN 'valid' ELSE 'train' END AS dataset
  FROM (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {order}) AS place, count(*) OVER (PARTITION BY {label}) AS n
        FROM {rows}) t"""


TEXT_SQL = """SELECT entity_id,
  concat_ws('，', '上次进店类型：' || array_to_string(last_visit_types, ';'), '历史进店类型：' || array_to_string(all_visit_types, ';'),
    '用户性质：' || owner_type, '汽车型号：' || car_mode,
    CASE car_level WHEN 'family_1' THEN '高档车' WHEN 'family_2' THEN '中档车' ELSE '低档车' END,
    '会员卡：' || member_level) AS text_feature,
  CASE churn_label WHEN 1 THEN '用户标签：流失' ELSE '用户标签：未流失' END AS label_txt,
  CAST(entity_id AS VARCHAR) || ':' || CAST(churn_label AS VARCHAR) AS key_label
FROM labelled"""

SQL = {
    "csv_source": f"SELECT c_custkey AS entity_id, c_mktsegment AS owner_type, {rounded('c_acctbal')} AS balance FROM customer",
    "csv_documents": """SELECT doc_id, '"' || lang || '", ' || text || ' ""' || chr(10) AS body FROM documents""",
    "csv_dates": """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS visit_date,
  o_orderdate + to_seconds(o_orderkey % 86400) AS visit_time FROM orders""",
    "csv_rejects": """SELECT o_orderkey AS order_id, strftime(o_orderdate, '%d.%m.%y') AS visit_date,
  'visit_date' AS misfits FROM orders WHERE o_orderstatus = 'F'""",
    "profile_outer_fill": f"WITH {PROFILE_SQL} SELECT * FROM filled WHERE car_mode IS NOT NULL AND car_level IS NOT NULL",
    "customer_profile": f"WITH {PROFILE_SQL} SELECT * REPLACE (CAST(purchase_date AS VARCHAR) AS purchase_date) FROM full_profile",
    "visits_excluding_internal": f"""WITH {cleaned_sql(True)}
SELECT entity_id, CAST(visit_date AS VARCHAR) AS visit_date, {rounded('mile')} AS mile, visit_type FROM active""",
    "visits_same_day": f"""WITH {cleaned_sql(False)}
SELECT entity_id, CAST(visit_date AS VARCHAR) AS visit_date, {rounded('mile')} AS mile,
  array_to_string(visit_types, ';') AS visit_types FROM cleaned""",
    "active_entities": f"""WITH {cleaned_sql(True)}
SELECT entity_id, CAST(max(visit_date) AS VARCHAR) AS visit_date FROM cleaned GROUP BY 1""",
    "entity_counts": f"""WITH {cleaned_sql(False)}
SELECT count(*) AS n_visits, count(DISTINCT entity_id) AS n_entities, count(DISTINCT visit_date) AS n_days FROM cleaned""",
    "visit_raw_intervals": f"WITH {cleaned_sql(False)} SELECT {INTERVAL_COLUMNS} FROM intervals",
    "visit_mileage_repair": f"WITH {cleaned_sql(False)} SELECT {INTERVAL_COLUMNS} FROM repaired",
    "visit_interval_stats": f"""WITH {cleaned_sql(False)}
SELECT entity_id, {SPREADS}, count(visit_date) AS all_times FROM repaired GROUP BY 1""",
    "visit_first_second": f"""WITH {cleaned_sql(False)}
SELECT entity_id, {FIRST_SECOND} FROM {NUMBERED.format('repaired')} GROUP BY 1 HAVING count(*) >= 2""",
    "visit_latest": f"""WITH {cleaned_sql(False)}
SELECT entity_id, CAST(max(visit_date) AS VARCHAR) AS last_date, {rounded('max_by(mile, visit_date)')} AS last_mile,
  array_to_string(max_by(visit_types, visit_date), ';') AS last_visit_types FROM past GROUP BY 1""",
    "inactive_entities": f"WITH {cleaned_sql(False)} SELECT entity_id, CAST(max_date AS VARCHAR) AS max_date FROM gone",
    "history_type_set": f"""WITH {cleaned_sql(False)}
SELECT entity_id, array_to_string({natural_sorted('list(DISTINCT token)')}, ';') AS all_visit_types
FROM (SELECT entity_id, unnest(visit_types) AS token FROM past) t GROUP BY 1""",
    "visit_features": f"""WITH {features_sql()}
SELECT * EXCLUDE (exact_median) REPLACE (CAST(last_date AS VARCHAR) AS last_date, CAST(purchase_date AS VARCHAR) AS purchase_date,
  array_to_string(last_visit_types, ';') AS last_visit_types, array_to_string(all_visit_types, ';') AS all_visit_types,
  {rounded('last_mile')} AS last_mile) FROM features""",
    "churn_label": f"WITH {features_sql()} {LABELS_SQL}",
    "churn_label_inactive": f"WITH {features_sql(True)} {LABELS_SQL}",
    "stratified_split": f"WITH {features_sql()} {quota_sql('labelled', 'churn_label', 'entity_id', 'entity_id, CAST(churn_label AS BIGINT) AS churn_label')}",
    "stratified_split_counts": f"""SELECT o_orderstatus, dataset, count(*) AS n
FROM ({quota_sql('orders', 'o_orderstatus', 'o_orderkey', 'o_orderstatus')}) s GROUP BY 1, 2""",
    "text_feature": f"WITH {features_sql()} {TEXT_SQL}",
    "feature_table_sink": f"""WITH {features_sql()}
SELECT car_level, count(*) AS n, CAST(sum(all_times) AS BIGINT) AS visits, CAST(max(last_date) AS VARCHAR) AS last_date
FROM features GROUP BY 1""",
}
