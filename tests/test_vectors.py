"""Column statistics, scaling, neighbours and evaluation against numpy."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retainframe.functions.vectors import cosine, fuse, norm, unit
from retainframe.operators import column_stats as cs
from retainframe.operators import neighbours as nb
from retainframe.operators.evaluate import auc, classification_report, roc_points, vote
from retainframe.operators.hashed_neighbours import hashed_neighbours
from retainframe.operators.neighbours import nearest_neighbours
from retainframe.operators.scaling import auto_scale, fit_yeo_johnson
from retainframe.plans.churn import knn_churn

RNG = np.random.default_rng(7)


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*(list(map(float, v)) for v in columns.values()))), ", ".join(f"{n} double" for n in names))


@pytest.mark.parametrize("finish_rows", [10, 100_000])
def test_quantiles_match_numpy(spark, finish_rows, monkeypatch):
    monkeypatch.setattr(cs, "FINISH_ROWS", finish_rows)
    monkeypatch.setattr(cs.order_statistics, "__defaults__", (finish_rows, None))
    a = np.exp(RNG.normal(size=3000) * 3)
    b = np.where(np.arange(3000) % 3 == 0, 5.0, RNG.normal(size=3000))  # a third of the rows are equal
    for s, values in zip(cs.profile_columns(frame(spark, a=a, b=b), ["a", "b"]), (a, b)):
        assert (s.q1, s.median, s.q3) == pytest.approx(tuple(np.percentile(values, [25, 50, 75])), rel=1e-12)
        assert s.std_pop == pytest.approx(values.std())


def test_profile_edge_cases(spark):
    rows = spark.createDataFrame([(1.0, 4.0, None), (1.0, None, None)], "c double, one double, none double")
    stats = {s.column: s for s in cs.profile_columns(rows, ["c", "one", "none"])}
    assert set(stats) == {"c", "one"}
    assert (stats["c"].iqr, stats["c"].method, stats["one"].n, stats["one"].median) == (0.0, "standard", 1, 4.0)


def test_skewness_is_bias_corrected(spark):
    values = np.array([1.0, 2.0, 3.0, 10.0])
    z = values - values.mean()
    population = (z**3).mean() / (z**2).mean() ** 1.5
    [s] = cs.profile_columns(frame(spark, x=values), ["x"])
    assert s.skew == pytest.approx(population * np.sqrt(12) / 2)


def test_scaling_methods(spark):
    standard = RNG.uniform(size=400)
    skewed = RNG.gamma(1.5, size=400)
    heavy = np.r_[RNG.normal(size=399), 1000.0]
    rows = frame(spark, standard=standard, skewed=skewed, heavy=heavy, constant=np.full(400, 3.0))
    out = auto_scale(rows, ["standard", "skewed", "heavy", "constant"]).toPandas()
    assert sorted(out.standard) == pytest.approx(sorted((standard - standard.mean()) / standard.std()))
    q1, median, q3 = np.percentile(heavy, [25, 50, 75])
    assert sorted(out.heavy) == pytest.approx(sorted((heavy - median) / (q3 - q1)))
    assert (out.constant == 0).all()
    assert out.skewed.mean() == pytest.approx(0, abs=1e-9) and out.skewed.std(ddof=0) == pytest.approx(1)


def log_likelihood(x, power):
    y = np.empty_like(x)
    up = x >= 0
    y[up] = np.log1p(x[up]) if power == 0 else ((x[up] + 1) ** power - 1) / power
    y[~up] = -np.log1p(-x[~up]) if power == 2 else -((1 - x[~up]) ** (2 - power) - 1) / (2 - power)
    return -len(x) / 2 * np.log(y.var()) + (power - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def test_power_has_the_highest_likelihood(spark):
    a, b = RNG.gamma(1.2, 30.0, size=800), RNG.normal(size=800) * np.abs(RNG.normal(size=800)) - 1
    found = fit_yeo_johnson(frame(spark, a=a, b=b), ["a", "b"], decimals=3)
    for name, values in (("a", a), ("b", b)):
        grid = np.arange(-2000, 2001) / 1000
        best = grid[np.argmax([log_likelihood(values, p) for p in grid])]
        assert found[name] == pytest.approx(best, abs=1e-9)


def test_values_that_are_not_finite_do_not_count(spark):
    values = np.exp(RNG.normal(size=2000))
    holes = [float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)] + [(2000 + i, h) for i, h in enumerate(holes)], "i int, x double")
    plain = {r["i"]: r["x"] for r in auto_scale(rows.where("i < 2000"), ["x"]).collect()}
    found = {r["i"]: r["x"] for r in auto_scale(rows, ["x"]).collect()}
    assert [found.pop(2000 + i) for i in range(4)] == [None] * 4
    assert found == pytest.approx(plain)
    grid = np.arange(-3000, 1000) / 1000
    assert fit_yeo_johnson(rows, ["x"], 3)["x"] == pytest.approx(grid[np.argmax([log_likelihood(values, p) for p in grid])])


def test_columns_without_values_and_constant_columns(spark):
    rows = spark.createDataFrame([(None, 2.0), (float("nan"), 2.0)], "none double, same double")
    assert [tuple(r) for r in auto_scale(rows, ["none", "same"]).collect()] == [(None, 0.0)] * 2
    assert fit_yeo_johnson(rows, ["none", "same"]) == {"none": 0.0, "same": 0.0}


def test_vector_expressions(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], 2.0)], "v array<double>, z array<double>, n double")
    v, z = F.col("v"), F.col("z")
    found = rows.select(norm(v).alias("n"), unit(v).alias("u"), unit(z).alias("z"), cosine(v, z).alias("c"), fuse(v, [F.col("n"), F.lit(None)]).alias("f")).first()
    assert (found["n"], found["u"], found["z"], found["c"]) == (5.0, [0.6, 0.8], [0.0, 0.0], None)
    assert found["f"] == pytest.approx([0.9, 1.2, 1.4, 0.0])


def brute(queries, base, k):
    def unit_rows(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n > 0, n, 1)

    scores = np.round(unit_rows(queries) @ unit_rows(base).T, 9)
    return {(q, b): scores[q, b] for q in range(len(queries)) for b in sorted(range(len(base)), key=lambda j: (-scores[q, j], j))[:k]}


def vectors(spark, matrix, name, **extra):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, vector array<double>").repartition(5)


STRATEGIES = {
    "base everywhere": {},
    "queries everywhere": {"shared_side_bytes": 50 * 8 * 8},
    "blocks": {"shared_side_bytes": 0, "block_bytes": 17 * 8 * 8},
}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_neighbours_match_brute_force(spark, strategy):
    base = RNG.normal(size=(300, 8))
    base[::3] = base[0]  # a third of the base rows are copies, so ties abound
    base[7] = 0.0
    queries = np.r_[RNG.normal(size=(40, 8)), base[:1], np.zeros((1, 8))]
    found = nearest_neighbours(vectors(spark, queries, "query_id"), vectors(spark, base, "base_id"), 10, **STRATEGIES[strategy])
    assert {(r["query_id"], r["base_id"]): r["score"] for r in found.collect()} == pytest.approx(brute(queries, base, 10))


def test_pivots_skip_far_groups_and_stay_exact(spark, monkeypatch):
    centres = RNG.normal(size=(12, 8)) * 5
    base = np.repeat(centres, 60, axis=0) + RNG.normal(size=(720, 8)) * 0.05
    queries = np.repeat(centres, 5, axis=0) + RNG.normal(size=(60, 8)) * 0.05
    sent = []
    router = nb._router

    def counting(pivots, rings, k, digits):
        route = router(pivots, rings, k, digits)
        table = pa.table({"query_id": range(60), "vector": [list(map(float, q)) for q in queries]})
        sent.append((sum(len(p) for b in route(table.to_batches()) for p in b.column("pivots").to_pylist()), len(rings)))
        return route

    monkeypatch.setattr(nb, "_router", counting)
    found = nearest_neighbours(
        vectors(spark, queries, "query_id"), vectors(spark, base, "base_id"), 10, shared_side_bytes=0, block_bytes=40 * 8 * 8
    )
    assert {(r["query_id"], r["base_id"]): r["score"] for r in found.collect()} == pytest.approx(brute(queries, base, 10))
    routes, groups = sent[0]
    assert routes < 60 * groups / 2


def test_a_scan_gives_back_few_rows(spark):
    """However many tasks scan the base, about FLOOR_SHARE * k rows per query are merged."""
    base, queries = RNG.normal(size=(4000, 8)), RNG.normal(size=(20, 8))
    rows = vectors(spark, base, "base_id").repartition(100)
    asked = vectors(spark, queries, "query_id")
    schema = T.StructType.fromDDL("query_id bigint, base_id bigint, score double")
    partial = nb._scan_base(asked, rows, 5, 9, schema)
    assert partial.count() < 20 * 5 * nb.FLOOR_SHARE * 2  # without the floor: 20 * 5 * 100
    found = nearest_neighbours(asked, rows, 5, shared_side_bytes=20 * 8 * 8 + 2000)
    assert {(r["query_id"], r["base_id"]): r["score"] for r in found.collect()} == pytest.approx(brute(queries, base, 5))


def test_hashed_neighbours_find_nearly_all_with_exact_scores(spark):
    centres = RNG.normal(size=(60, 32))
    base = np.repeat(centres, 50, axis=0) + RNG.normal(size=(3000, 32)) * 0.6
    base[:900] = base[0]  # copies fill one bucket
    queries = np.r_[centres + RNG.normal(size=(60, 32)) * 0.6, base[:1], np.zeros((1, 32))]
    exact = brute(queries, base, 10)
    found = {(r["query_id"], r["base_id"]): r["score"] for r in hashed_neighbours(vectors(spark, queries, "query_id"), vectors(spark, base, "base_id"), 10, block_bytes=200 * 8 * 32).collect()}
    everyone = brute(queries, base, len(base))
    assert found == pytest.approx({pair: everyone[pair] for pair in found})
    near = {pair for pair in exact if pair[0] < 61}
    assert len(near & set(found)) >= 0.9 * len(near)
    assert hashed_neighbours(vectors(spark, queries, "query_id"), vectors(spark, base, "base_id").limit(0)).count() == 0


def test_neighbour_edge_cases(spark):
    base = vectors(spark, np.eye(3), "base_id")
    few = nearest_neighbours(vectors(spark, np.eye(3)[:1], "query_id"), base, 10)
    assert few.count() == 3
    assert nearest_neighbours(vectors(spark, np.eye(3)[:1], "query_id"), base, 10, min_similarity=0.5).count() == 1
    none = nearest_neighbours(vectors(spark, np.eye(3)[:1], "query_id").where("query_id < 0"), base, 10, shared_side_bytes=0)
    assert none.count() == 0
    assert nearest_neighbours(base.withColumnRenamed("base_id", "query_id"), base.where("base_id < 0"), 10, shared_side_bytes=-1).count() == 0
    with pytest.raises(ValueError):
        nearest_neighbours(vectors(spark, np.eye(3), "query_id").unionByName(vectors(spark, np.eye(2), "query_id")), base)


def test_vote_divides_by_k(spark):
    rows = spark.createDataFrame([("q", 1), ("q", 1), ("q", 1), ("p", 1), ("p", 1), ("p", 1), ("p", 1)], "query_id string, label int")
    assert {r["query_id"]: (r["total_score"], r["pred_label"]) for r in vote(rows).collect()} == {"q": (3, 0), "p": (4, 1)}


def test_predictions_with_a_similarity_floor(spark):
    rows = [("a", [1.0, 0.0], 1, "train"), ("b", [0.0, 1.0], 1, "train"), ("q", [1.0, 0.0], 1, "valid"), ("r", [-1.0, 0.0], 0, "valid")]
    data = spark.createDataFrame(rows, "entity_id string, vector array<double>, churn_label int, dataset string")
    found = {r["query_id"]: r["total_score"] for r in knn_churn(data, min_similarity=0.5).collect()}
    assert found == {"q": 1, "r": 0}


def test_report_counts_undefined_scores_as_zero(spark):
    rows = spark.createDataFrame([(1, 0), (0, 0)], "true_label int, pred_label int")
    found = classification_report(rows).first()
    assert (found["precision"], found["recall"], found["f1"], found["accuracy"], found["auc"]) == (0.0, 0.0, 0.0, 0.5, 0.5)


def test_auc_and_roc_with_ties(spark):
    score, label = RNG.integers(0, 12, size=600) / 4, RNG.integers(0, 2, size=600)
    rows = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label)], "s double, true_label int")
    pos, neg = score[label == 1], score[label == 0]
    pairs = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
    assert auc(rows, "s").first()["auc"] == pytest.approx(pairs)
    points = roc_points(rows, "s").collect()
    for p in points:
        if p["threshold"] is None:
            assert (p["fpr"], p["tpr"]) == (0, 0)
        else:
            assert (p["fpr"], p["tpr"]) == pytest.approx(((neg >= p["threshold"]).mean(), (pos >= p["threshold"]).mean()))
    assert len(points) == len(set(score)) + 1


def test_predictions_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(500).selectExpr("double(id % 90) AS s", "int(id % 7 = 0) AS true_label").mapInArrow(counted, "s double, true_label int")
    assert roc_points(rows, "s").count() == 91
    assert read.value == 500
    assert roc_points(rows.limit(0), "s").count() == 1


def test_roc_of_many_scores_uses_all_buckets(spark):
    score, label = RNG.normal(size=2000), RNG.integers(0, 2, size=2000)
    rows = spark.createDataFrame([(float(s), int(y)) for s, y in zip(score, label)], "s double, true_label int")
    pos, neg = score[label == 1], score[label == 0]
    assert auc(rows, "s").first()["auc"] == pytest.approx((pos[:, None] > neg).mean())


def test_order_statistics_end_in_few_passes(spark):
    from retainframe.operators.column_stats import order_statistics, profile_columns

    rows = spark.range(100_000).selectExpr("pow(10D, (id * 7919 % 100003) / 100003D * 600D - 300D) AS x", "CASE WHEN id = 5 THEN double('NaN') WHEN id = 6 THEN double('Infinity') ELSE double(id) END AS y")
    values = sorted(10.0 ** ((i * 7919 % 100003) / 100003.0 * 600 - 300) for i in range(100_000))
    passes = []
    got = order_statistics(rows, {"x": {0, 25_000, 50_000, 50_001, 99_999}}, {"x": (values[0], values[-1], 100_000)}, 2_000, passes)
    assert len(passes) <= 3
    assert all(abs(got["x"][r] / values[r] - 1) < 1e-9 for r in got["x"]) and len(got["x"]) == 5
    (stats,) = profile_columns(rows, ["y"])
    assert stats.n == 99_998 and stats.max == 99_999.0 and abs(stats.median - 50_000) < 2


def test_vectors_are_sent_per_cell_not_per_pivot(spark):
    """Vectors without groups, where no pivot can be skipped: partial results are bounded by the cells along a side."""
    base, queries = RNG.normal(size=(800, 16)), RNG.normal(size=(100, 16))
    schema = T.StructType.fromDDL("query_id bigint, base_id bigint, score double")
    partial = nb._by_pivot(vectors(spark, queries, "query_id"), vectors(spark, base, "base_id"), 5, 9, schema, 800, 8, 1000)
    assert partial.count() <= 100 * 5 * 2 * nb.LEAST_CELLS  # one by one: 100 * 5 * 400 pivots
    found = nearest_neighbours(vectors(spark, queries, "query_id"), vectors(spark, base, "base_id"), 5, shared_side_bytes=0, block_bytes=8 * 8 * 16)
    assert {(r["query_id"], r["base_id"]): r["score"] for r in found.collect()} == pytest.approx(brute(queries, base, 5))


def test_single_precision_decides_nothing(spark):
    """Scores that differ by less than single precision can tell keep their order, and ties their ids."""
    base = np.tile([1.0, 0.0], (400, 1))
    base[:, 1] = np.arange(400)[::-1] // 2 * 1e-4
    best = nb._Best(nb._matrix(pa.table({"vector": [[1.0, 0.0]]})), 7, 9)
    rows = pa.table({"vector": base.tolist()})
    for start in range(0, 400, 30):
        part = np.arange(start, min(start + 30, 400))
        best.add(nb._matrix(rows)[part], part)
    expected = sorted(range(400), key=lambda j: (-round(1 / np.hypot(1, base[j, 1]), 9), j))[:7]
    assert best.place[0].tolist() == expected


def test_a_large_base_is_not_held_by_every_worker(spark, monkeypatch):
    """A base of 10 MB is read in batches or cells, not copied into each Python worker."""
    def refused(*_):
        raise AssertionError("the base was shared")

    monkeypatch.setattr(nb, "_scan_queries", refused)
    rows = spark.range(20_000).select("id", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(F.col("id") * i + i)).alias("vector"))
    found = nearest_neighbours(rows.where("id < 3").withColumnRenamed("id", "query_id"), rows.withColumnRenamed("id", "base_id"), 1)
    assert {(r["query_id"], r["base_id"], r["score"]) for r in found.collect()} == {(i, i, 1.0) for i in range(3)}


def test_hashed_search_shuffles_vectors_once(spark):
    """Narrow vectors stay narrow, and go to their cells in one shuffle a side; the rows found are shuffled once, by query."""
    rows = vectors(spark, RNG.normal(size=(300, 8)), "id").select("id", F.col("vector").cast("array<float>"))
    found = hashed_neighbours(rows.withColumnRenamed("id", "query_id"), rows.withColumnRenamed("id", "base_id"), 3)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("BroadcastHashJoin [bucket") == 2  # the sizes of buckets are joined where the vectors lie
    assert plan.count("hashpartitioning(query_id") == 1
    assert "array<double>" not in plan and "as array<double>" not in plan
