"""Scaling, vector, neighbour and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import as_doubles, fuse, norm, unit
from ..operators.column_stats import column_profile
from ..operators.evaluate import auc, classification_report, roc_points
from ..operators.features import stratified_split
from ..operators.hashed_neighbours import hashed_neighbours
from ..operators.neighbours import nearest_neighbours
from ..operators.retrieval import retrieve_by_vector
from ..operators.scaling import auto_scale
from ..plans.churn import churn_report, hybrid_vectors, knn_churn, labelled_dataset, text_features, text_vectors
from ..session import materialize, shared_dir
from ..sources.files import read_csv, rebuild_vectors, typed, write_csv, write_vectors
from . import churn
from .inputs import rounded, table, tidy

PROFILED = [("documents", "n_chars"), ("events", "value"), ("lineitem", "l_quantity"), ("lineitem", "l_extendedprice")]

# ---------------------------------------------------------------- Spark


def profile_of_columns(spark, sf_dir):
    by_table: dict[str, list[str]] = {}
    for name, column in PROFILED:
        by_table.setdefault(name, []).append(column)
    profiles = [column_profile(table(spark, sf_dir, name), columns) for name, columns in by_table.items()]
    result = profiles[0]
    for other in profiles[1:]:
        result = result.unionByName(other)
    return tidy(result)


def profile_hard(spark, sf_dir):
    """Columns with NaN and infinities, spread over many orders of magnitude, and with one very frequent value."""
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).when(F.col("event_id") % 89 == 0, F.lit(float("inf"))).when(F.col("event_id") % 83 == 0, F.lit(float("-inf"))).otherwise(F.col("value")).alias("broken"),
        F.pow(F.lit(2.0), F.pmod(F.col("event_id") * 7919, F.lit(1999)) / 2 - 500).alias("spread"),
        F.when(F.col("event_id") % 3 == 0, F.lit(5.0)).otherwise(F.col("event_id") / 2).alias("frequent"),
    )
    found = column_profile(events, ["broken", "spread", "frequent"])
    relative = [F.col(c) if c in ("column", "n", "method") else F.signum(c) * F.log2(1 + F.abs(c)) for c in ("column", "n", "q1", "median", "q3")]
    return tidy(found.select(*[e.alias(c) for e, c in zip(relative, ("column", "n", "q1", "median", "q3"))]))


def scale_robust(spark, sf_dir):
    return tidy(auto_scale(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["n_chars"]))


def scale_standard(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return tidy(auto_scale(items, ["l_quantity"]))


def scale_yeo_johnson(spark, sf_dir):
    return tidy(auto_scale(table(spark, sf_dir, "events").select("event_id", "value"), ["value"]))


def left_skewed(spark, sf_dir):
    """A column whose best power lies far beyond 2."""
    share = F.pow(F.col("l_quantity") / 50, F.lit(0.125))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", share.alias("share"))


def scale_yeo_johnson_left(spark, sf_dir):
    return tidy(auto_scale(left_skewed(spark, sf_dir), ["share"]))


def scale_with_gaps(spark, sf_dir):
    """A skewed column with NaN, infinities and nulls."""
    value = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).when(F.col("event_id") % 89 == 0, F.lit(float("inf"))).when(F.col("event_id") % 83 == 0, F.lit(float("-inf"))).when(F.col("event_id") % 79 != 0, F.col("value"))
    return tidy(auto_scale(table(spark, sf_dir, "events").select("event_id", value.alias("value")), ["value"]))


def vector_fuse_normalise(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    fused = vectors.select("vec_id", unit(fuse(F.col("embedding"), [F.col("label"), F.col("label") * 0.5])).alias("v"))
    return tidy(fused.select(
        "vec_id", F.size("v").alias("dims"), norm(F.col("v")).alias("length"),
        F.get("v", F.lit(0)).alias("first_text"), F.element_at("v", -1).alias("last_number"),
        F.aggregate("v", F.lit(0.0), lambda total, x: total + x).alias("total"),
    ))


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a binary label and a train/valid mark."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("entity_id"), as_doubles(F.col("embedding")).alias("vector"),
        F.when(F.col("label") < 5, 1).otherwise(0).alias("churn_label"),
    )
    return stratified_split(vectors, "churn_label", "entity_id")


def knn_neighbours(spark, sf_dir):
    vectors = labelled_vectors(spark, sf_dir)
    queries = vectors.where(F.col("dataset") == "valid").select(F.col("entity_id").alias("query_id"), "vector")
    base = vectors.where(F.col("dataset") == "train").select(F.col("entity_id").alias("base_id"), "vector")
    return tidy(nearest_neighbours(queries, base, 10))


def knn_neighbours_pivots(spark, sf_dir):
    """Every vector against every vector, by the way taken when neither side can be shared."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return tidy(nearest_neighbours(
        vectors.withColumnRenamed("vec_id", "query_id"), vectors.withColumnRenamed("vec_id", "base_id"), 5,
        shared_side_bytes=0, block_bytes=256 * 8 * 64,
    ))


def knn_hashed(spark, sf_dir):
    """Every vector against every vector by random-projection hashing: nearly all of the nearest five."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return tidy(hashed_neighbours(vectors.withColumnRenamed("vec_id", "query_id"), vectors.withColumnRenamed("vec_id", "base_id"), 5))


def predictions(spark, sf_dir):
    return knn_churn(labelled_vectors(spark, sf_dir))


def knn_vote(spark, sf_dir):
    return tidy(predictions(spark, sf_dir))


def prediction_sink(spark, sf_dir):
    """Predictions written as CSV and read back typed."""
    path = shared_dir(spark, "predictions")
    columns = {"query_id": "bigint", "total_score": "bigint", "pred_label": "bigint", "true_label": "bigint"}
    write_csv(predictions(spark, sf_dir), path)
    good, _ = typed(read_csv(spark, path, {c: c for c in [*columns, "key_label"]}, multi_line=False), columns)
    return tidy(good)


def knn_report(spark, sf_dir):
    return tidy(classification_report(predictions(spark, sf_dir)))


def roc_hard(spark, sf_dir):
    return tidy(roc_points(predictions(spark, sf_dir), "pred_label"))


def roc_share(spark, sf_dir):
    voted = predictions(spark, sf_dir)
    return tidy(roc_points(voted.withColumn("share", F.col("total_score") / 10), "share"))


def purchases_by_value(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "value", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("true_label")
    )


def auc_by_value(spark, sf_dir):
    return tidy(auc(purchases_by_value(spark, sf_dir), "value"))


def roc_by_value(spark, sf_dir):
    return tidy(roc_points(purchases_by_value(spark, sf_dir), "value"))


def centroids(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    places = table(spark, sf_dir, "embeddings").select(*by, F.posexplode("embedding").alias("place", "x"))
    means = places.groupBy(*by, "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "x")))
    return means.groupBy(*by).agg(F.transform(ordered, lambda p: p["x"]).alias("vector"))


def retrieve_topk(spark, sf_dir):
    """The centre of each label as a query over all vectors."""
    queries = centroids(spark, sf_dir, "label").withColumnRenamed("label", "query_id")
    base = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("base_id"), F.col("embedding").alias("vector"))
    return tidy(nearest_neighbours(queries, base, 50, min_similarity=0.25))


def retrieve_one(spark, sf_dir):
    """The centre of all vectors as a single query."""
    query = centroids(spark, sf_dir).first()["vector"]
    chunks = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("vector"))
    return tidy(retrieve_by_vector(chunks, query, 50, 0.25).drop("vector"))


def vector_rows(spark: SparkSession, sf_dir: str, origin: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit(f"{origin}_"), F.col("vec_id").cast("string")).alias("id"), "embedding",
        F.concat(F.lit("text "), F.col("label").cast("string")).alias("text"),
        F.create_map(F.lit("key_id"), F.concat_ws(":", "vec_id", "label")).alias("metadata"),
    )


def table_roundtrip(spark, sf_dir):
    written = write_vectors(vector_rows(spark, sf_dir, "doc"), shared_dir(spark, "vectors"), 200)
    return tidy(written.select(
        "id", norm(as_doubles(F.col("embedding"))).alias("length"), "text", F.col("metadata")["key_id"].alias("key_id")
    ))


def vector_rebuild(spark, sf_dir):
    path = shared_dir(spark, "vectors")
    write_vectors(vector_rows(spark, sf_dir, "old"), path)
    rebuilt = rebuild_vectors(vector_rows(spark, sf_dir, "web"), vector_rows(spark, sf_dir, "local"), path)
    return tidy(rebuilt.groupBy(F.split_part("id", F.lit("_"), F.lit(1)).alias("origin"), "text").agg(
        F.count(F.lit(1)).alias("n")
    ))


def hybrid_churn_report(spark, sf_dir):
    """Visits to features, TF-IDF of the text and scaled numbers, fused vectors, votes and the report."""
    features = text_features(labelled_dataset(churn.labelled(spark, sf_dir)))
    vectors = materialize(hybrid_vectors(text_vectors(features), "text_vector"), "hybrid")
    return tidy(churn_report(knn_churn(vectors)))


QUERIES = {
    "column_profile": profile_of_columns,
    "column_profile_hard": profile_hard,
    "scale_robust": scale_robust,
    "scale_standard": scale_standard,
    "scale_yeo_johnson": scale_yeo_johnson,
    "scale_yeo_johnson_left": scale_yeo_johnson_left,
    "scale_with_gaps": scale_with_gaps,
    "vector_fuse_normalise": vector_fuse_normalise,
    "knn_neighbours": knn_neighbours,
    "knn_neighbours_pivots": knn_neighbours_pivots,
    "knn_hashed": knn_hashed,
    "knn_vote": knn_vote,
    "prediction_sink": prediction_sink,
    "classification_report": knn_report,
    "roc_points": roc_hard,
    "roc_points_vote_share": roc_share,
    "roc_points_scores": roc_by_value,
    "auc_scores": auc_by_value,
    "retrieve_topk": retrieve_topk,
    "retrieve_one_query": retrieve_one,
    "table_roundtrip": table_roundtrip,
    "vector_rebuild": vector_rebuild,
    "hybrid_churn_report": hybrid_churn_report,
}

# ---------------------------------------------------------------- SQL


def profile_sql(name: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", n, {rounded('low')} AS "min", {rounded('high')} AS "max", {rounded('q1')} AS q1,
  {rounded('q2')} AS median, {rounded('q3')} AS q3, {rounded('q3 - q1')} AS iqr, {rounded('mean')} AS mean,
  {rounded('std')} AS std_pop, {rounded('skew')} AS skew,
  CASE WHEN q3 - q1 > 0 AND (high - low) / (q3 - q1) > 10 THEN 'robust'
       WHEN abs(skew) > 1 THEN 'yeo_johnson' ELSE 'standard' END AS method
FROM (SELECT count(x) AS n, min(x) AS low, max(x) AS high, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2,
        quantile_cont(x, 0.75) AS q3, avg(x) AS mean, stddev_pop(x) AS std, skewness(x) AS skew
      FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {name}) t) s"""


def power_sql(power: str) -> str:
    return f"""CASE WHEN x >= 0 THEN CASE WHEN {power} = 0 THEN ln(1 + x) ELSE (pow(x + 1, {power}) - 1) / {power} END
    ELSE CASE WHEN {power} = 2 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - {power}) - 1) / (2 - {power}) END END"""


def best_power_sql(decimals: int = 4) -> str:
    """The same successive grids as the operator, one common table expression per pass."""
    parts, previous = [], "SELECT 0.0::DOUBLE AS p"
    # one wide coarse grid, far beyond any optimum in the test tables, instead of a moving one
    steps = [(0.5, 80)] + [(10.0 ** -d, 5 if d == 1 else 10) for d in range(1, decimals + 1)]
    for i, (step, reach) in enumerate(steps):
        parts.append(f"""
grid{i} AS (
  SELECT round(p + j * {step!r}::DOUBLE, 10) AS p FROM ({previous}) b, (SELECT unnest(range(-{reach}, {reach + 1})) AS j) g),
best{i} AS (
  SELECT p FROM (
    SELECT p, -count(x) / 2.0::DOUBLE * ln(nullif(var_pop({power_sql('p')}), 0)) + (p - 1) * sum(sign(x) * ln(1 + abs(x))) AS score
    FROM grid{i}, source GROUP BY p) s
  WHERE isfinite(score) ORDER BY score DESC LIMIT 1)""")
        previous = f"SELECT p FROM best{i}"
    return ",".join(parts) + f",\nbest AS ({previous})"


def scale_sql(name: str, keys: str, column: str) -> str:
    """The column scaled by the method its own profile asks for, as the operator does."""
    return f"""WITH source AS (SELECT {keys}, CAST({column} AS DOUBLE) AS x FROM {name}),{best_power_sql()},
moved AS (SELECT source.*, {power_sql('p')} AS y FROM source, best),
facts AS (
  SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3, min(x) AS low, max(x) AS high,
    skewness(x) AS skew, avg(x) AS mean, stddev_pop(x) AS std, avg(y) AS y_mean, stddev_pop(y) AS y_std FROM moved)
SELECT moved.* EXCLUDE (x, y), {rounded("""CASE WHEN q3 - q1 > 0 AND (high - low) / (q3 - q1) > 10 THEN (x - q2) / (q3 - q1)
    WHEN abs(skew) > 1 THEN (y - y_mean) / y_std ELSE (x - mean) / std END""")} AS {column}
FROM moved, facts"""


SPLIT_SQL = f"""
marked AS ({churn.quota_sql('(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN label < 5 THEN 1 ELSE 0 END AS y FROM embeddings) e',
                            'y', 'vec_id', 'vec_id, v, y')}),
scored AS (
  SELECT q.vec_id AS query_id, b.vec_id AS base_id, q.y AS true_label, b.y AS label,
    round(list_cosine_similarity(q.v, b.v), 9) AS score
  FROM marked q JOIN marked b ON q.dataset = 'valid' AND b.dataset = 'train'),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, base_id) AS place FROM scored) t
  WHERE place <= 10),
votes AS (
  SELECT query_id, CAST(sum(label) AS BIGINT) AS total_score,
    CAST(CASE WHEN sum(label) / 10.0::DOUBLE >= 0.4::DOUBLE THEN 1 ELSE 0 END AS BIGINT) AS pred_label,
    CAST(max(true_label) AS BIGINT) AS true_label FROM near GROUP BY 1)"""


def roc_sql(rows: str, score: str) -> str:
    return f"""
per_score AS (
  SELECT CAST({score} AS DOUBLE) AS threshold, count(*) FILTER (WHERE true_label = 1) AS pos,
    count(*) FILTER (WHERE true_label = 0) AS neg FROM {rows} GROUP BY 1),
points AS (
  SELECT threshold, sum(neg) OVER w / sum(neg) OVER ()::DOUBLE AS fpr, sum(pos) OVER w / sum(pos) OVER ()::DOUBLE AS tpr
  FROM per_score WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT {rounded('threshold')}, {rounded('fpr')}, {rounded('tpr')} FROM points"""


VALUE_SQL = "scores AS (SELECT value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS true_label FROM events)"


def centroid_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
places AS (
  SELECT {keys}unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS place FROM embeddings),
centres AS (
  SELECT {keys}list(x ORDER BY place) AS v FROM (SELECT {keys}place, avg(x) AS x FROM places GROUP BY {keys}place) m {group})"""


SQL = {
    "column_profile": "\nUNION ALL ".join(profile_sql(*p) for p in PROFILED),
    "column_profile_hard": "\nUNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(x) AS n, {rounded('sign(quantile_cont(x, 0.25)) * log2(1 + abs(quantile_cont(x, 0.25)))')} AS q1,
  {rounded('sign(quantile_cont(x, 0.5)) * log2(1 + abs(quantile_cont(x, 0.5)))')} AS median, {rounded('sign(quantile_cont(x, 0.75)) * log2(1 + abs(quantile_cont(x, 0.75)))')} AS q3
FROM (SELECT {value} AS x FROM events) t"""
        for name, value in (
            ("broken", "CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 THEN value END"),
            ("spread", "pow(2.0, ((event_id * 7919) % 1999) / 2.0 - 500)"),
            ("frequent", "CASE WHEN event_id % 3 = 0 THEN 5.0 ELSE event_id / 2.0 END"),
        )
    ),
    "scale_robust": scale_sql("documents", "doc_id", "n_chars"),
    "scale_standard": scale_sql("lineitem", "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_quantity"),
    "scale_yeo_johnson": scale_sql("events", "event_id", "value"),
    "scale_yeo_johnson_left": scale_sql("(SELECT l_orderkey, l_linenumber, pow(l_quantity / 50.0, 0.125) AS share FROM lineitem) l", "l_orderkey, l_linenumber", "share"),
    "scale_with_gaps": scale_sql("(SELECT event_id, CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0 THEN value END AS value FROM events) e", "event_id", "value"),
    "vector_fuse_normalise": f"""WITH fused AS (
  SELECT vec_id, list_concat(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * 0.3::DOUBLE),
    [label * 0.7::DOUBLE, label * 0.5::DOUBLE * 0.7::DOUBLE]) AS f FROM embeddings),
normed AS (SELECT vec_id, f, sqrt(list_sum(list_transform(f, lambda x: x * x))) AS n FROM fused)
SELECT vec_id, CAST(len(f) AS BIGINT) AS dims, {rounded('n / n')} AS length, {rounded('f[1] / n')} AS first_text,
  {rounded('f[len(f)] / n')} AS last_number, {rounded('list_sum(f) / n')} AS total FROM normed""",
    "knn_neighbours": f"WITH {SPLIT_SQL} SELECT query_id, base_id, {rounded('score')} AS score FROM near",
    "knn_neighbours_pivots": f"""WITH scored AS (
  SELECT q.vec_id AS query_id, b.vec_id AS base_id,
    round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS score
  FROM embeddings q, embeddings b)
SELECT query_id, base_id, {rounded('score')} AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, base_id) AS place FROM scored) t WHERE place <= 5""",
    "knn_vote": f"""WITH {SPLIT_SQL}
SELECT *, CAST(query_id AS VARCHAR) || ':' || CAST(true_label AS VARCHAR) AS key_label FROM votes""",
    "prediction_sink": f"""WITH {SPLIT_SQL}
SELECT *, CAST(query_id AS VARCHAR) || ':' || CAST(true_label AS VARCHAR) AS key_label FROM votes""",
    "classification_report": f"""WITH {SPLIT_SQL},
counts AS (
  SELECT count(*) FILTER (WHERE true_label = 1 AND pred_label = 1) AS tp, count(*) FILTER (WHERE true_label = 0 AND pred_label = 1) AS fp,
    count(*) FILTER (WHERE true_label = 1 AND pred_label = 0) AS fn, count(*) FILTER (WHERE true_label = 0 AND pred_label = 0) AS tn
  FROM votes)
SELECT tp, fp, fn, tn, {rounded('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
  {rounded('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall, {rounded('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,
  {rounded('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy,
  {rounded('(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2')} AS auc FROM counts""",
    "roc_points": f"WITH {SPLIT_SQL},{roc_sql('votes', 'pred_label')}",
    "roc_points_vote_share": f"WITH {SPLIT_SQL},{roc_sql('votes', 'total_score / 10')}",
    "roc_points_scores": f"WITH {VALUE_SQL},{roc_sql('scores', 'value')}",
    "auc_scores": f"""WITH {VALUE_SQL},
ranked AS (
  SELECT true_label, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE AS r FROM scores),
sums AS (
  SELECT sum(r) FILTER (WHERE true_label = 1) AS r, count(*) FILTER (WHERE true_label = 1) AS p,
    count(*) FILTER (WHERE true_label = 0) AS n FROM ranked)
SELECT {rounded('(r - p * (p + 1) / 2) / (p * n)')} AS auc, p AS n_pos, n AS n_neg FROM sums""",
    "retrieve_topk": f"""WITH {centroid_sql('label')},
scored AS (
  SELECT c.label AS query_id, e.vec_id AS base_id, round(list_cosine_similarity(c.v, CAST(e.embedding AS DOUBLE[])), 9) AS score
  FROM centres c, embeddings e)
SELECT CAST(query_id AS BIGINT) AS query_id, base_id, {rounded('score')} AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, base_id) AS place FROM scored) t
WHERE place <= 50 AND score >= 0.25""",
    "retrieve_one_query": f"""WITH {centroid_sql('')},
scored AS (
  SELECT e.vec_id AS chunk_id, round(list_cosine_similarity(c.v, CAST(e.embedding AS DOUBLE[])), 9) AS score FROM centres c, embeddings e)
SELECT chunk_id, {rounded('score')} AS score FROM (SELECT * FROM scored ORDER BY score DESC, chunk_id LIMIT 50) t WHERE score >= 0.25""",
    "table_roundtrip": f"""SELECT 'doc_' || CAST(vec_id AS VARCHAR) AS id,
  {rounded('sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)))')} AS length,
  'text ' || CAST(label AS VARCHAR) AS text, CAST(vec_id AS VARCHAR) || ':' || CAST(label AS VARCHAR) AS key_id FROM embeddings""",
    "vector_rebuild": """SELECT origin, 'text ' || CAST(label AS VARCHAR) AS text, count(*) AS n
FROM embeddings, (SELECT unnest(['web', 'local']) AS origin) o GROUP BY 1, 2""",
}
