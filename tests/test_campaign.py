"""Review, publishing, reports and sources on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from retainframe.operators import campaign as op
from retainframe.plans.campaign import gated_queue, post_performance_report
from retainframe.plans.churn import churn_features
from retainframe.session import shared_dir
from retainframe.sources.files import read_csv, read_visit_tables, read_vectors, rebuild_vectors, typed, vector_versions, write_csv, write_vectors
from retainframe.sources.schemas import CONTENTS, MEMBER_COLUMNS, VISIT_COLUMNS
from retainframe.sources.web import news_results, post_metric_rows, rejected_posts


def contents(spark, rows):
    full = [(i, f, f"head {i}", "b" * 300, "go", "all", channels, []) for i, f, channels in rows]
    return spark.createDataFrame(full, CONTENTS)


DECISIONS = {
    "approve": ("approved", None), " YES ": ("approved", None), "Y": ("approved", None), "no": ("rejected", None),
    "approve but shorten": ("approved", "approve but shorten"), "disapprove": ("rejected", "disapprove"),
    "not yet": ("rejected", "not yet"), "": ("rejected", None), None: ("rejected", None),
    "I say: Approved!": ("approved", "i say: approved!"),
}


def test_decisions(spark):
    ids = {f"c{i}": d for i, d in enumerate(DECISIONS)}
    rows = contents(spark, [(i, "Blog", []) for i in [*ids, "undecided"]])
    decisions = spark.createDataFrame(list(ids.items()), "insight_id string, decision string")
    found = {r["insight_id"]: (r["approval"], r["feedback"]) for r in op.reviewed(rows, decisions).collect()}
    assert {ids[i]: found[i] for i in ids} == DECISIONS
    assert found["undecided"] == ("rejected", None)
    loose = {r["insight_id"]: r["approval"] for r in op.reviewed(rows, decisions, whole_words=False).collect()}
    assert {ids[i]: loose[i] for i in ids}["disapprove"] == "approved"


def test_extra_feedback_fills_in(spark):
    rows = contents(spark, [("a", "Blog", []), ("b", "Blog", [])])
    decisions = spark.createDataFrame([("a", "yes", " nice "), ("b", "yes but", "unused")], "insight_id string, decision string, extra_feedback string")
    found = {r["insight_id"]: r["feedback"] for r in op.reviewed(rows, decisions).collect()}
    assert found == {"a": "nice", "b": "yes but"}


def test_queue_and_channel_rule(spark):
    rows = contents(spark, [("a", "Poster A", []), ("b", "Blog", ["X", "Facebook Ads"]), ("c", "Blog", ["LinkedIn"]), ("d", "Blog", None)])
    queue = gated_queue(rows, None, "page")
    assert {r["content_id"] for r in queue.collect()} == {"a", "b"}
    assert queue.first()["message"].split("\n\n")[0].startswith("head ")
    gated = gated_queue(rows, spark.createDataFrame([("b", "yes"), ("c", "yes")], "insight_id string, decision string"), "page")
    assert [r["content_id"] for r in gated.collect()] == ["b"]
    listing = op.review_listing(rows).where("insight_id = 'b'").first()
    assert (listing["channels"], len(listing["body_preview"])) == ("X, Facebook Ads", 200)


def test_results_and_counts(spark):
    queue = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "content_id string")
    outcomes = spark.createDataFrame([("a", None, "p1"), ("b", "timeout", None), ("c", None, None)], "content_id string, error string, post_id string")
    results = op.publish_results(queue, outcomes)
    found = {r["content_id"]: (r["status"], r["post_id"], r["response"]) for r in results.collect()}
    assert found == {
        "a": ("success", "p1", {"id": "p1"}), "b": ("failed", "", {"error": "timeout"}),
        "c": ("success", "", {"id": ""}), "d": ("failed", "", {"error": "no outcome"}),
    }
    assert [r["post_id"] for r in op.published_posts(results).collect()] == ["p1"]
    assert tuple(op.publish_counts(results).first()) == (2, 4)


def metric(name, value):
    return f'{{"name":"{name}","values":[{{"value":{value}}},{{"value":99}}]}}'


POSTS = {
    "p1": [("post_impressions", 160), ("post_impressions_unique", 9), ("post_clicks_by_type", '{"link click":1,"other":7}'), ("post_engagements", 3)],
    "p2": [("post_clicks_by_type", '{"link click":{"a":4,"b":2}}'), ("post_impressions", 0)],
    "p3": [("post_clicks_by_type", '{"other":7}'), ("post_impressions", 5), ("post_impressions", 8)],
    "p4": [],
    "p5": [("post_clicks_by_type", 3)],
}


def posts(spark):
    rows = [(p, "[" + ",".join(metric(*m) for m in ms) + "]") for p, ms in POSTS.items()]
    rows += [("p6", "no json"), ("p7", '[{"name":"post_impressions","values":[]}]'), ("p8", None)]
    return spark.createDataFrame(rows, "post_id string, metrics string")


def test_post_metrics(spark):
    found = {r["post_id"]: tuple(r)[1:] for r in op.post_performance(post_metric_rows(posts(spark))).collect()}
    assert found == {"p1": (9, 160, 1, 3, 0.0063), "p2": (0, 0, 6, 0, 0.0), "p3": (0, 8, 0, 0, 0.0), "p4": (0, 0, 0, 0, 0.0)}
    assert {r["post_id"] for r in rejected_posts(posts(spark)).collect()} == {"p5", "p6", "p7", "p8"}


def test_report(spark):
    results = spark.createDataFrame([("p1", "success"), ("p3", "success"), ("p2", "failed"), ("", "success")], "post_id string, status string")
    performance, totals = post_performance_report(results, posts(spark))
    assert {r["post_id"] for r in performance.collect()} == {"p1", "p3"}
    assert tuple(totals.first()) == (2, pytest.approx(0.0032, abs=1e-9), "p1")
    empty = post_performance_report(results.limit(0), posts(spark))[1].first()
    assert tuple(empty) == (0, 0.0, None)


def test_first_post_wins_a_tie(spark):
    rows = spark.createDataFrame([("b", 2, 5, 0.1), ("a", 3, 5, 0.2), ("c", 1, 4, 0.3)], "post_id string, place int, clicks bigint, ctr double")
    assert op.report_totals(rows, "place").first()["top_performing_post_id"] == "b"


def test_news_defaults_and_limit(spark):
    rows = [("q", i, f'{{"link":"l{i}","title":null}}') for i in range(15)] + [("r", 0, "{}")]
    items = spark.createDataFrame(rows, "query string, place int, item string").repartition(4)
    found = news_results(items).collect()
    assert sorted(r["link"] for r in found if r["query"] == "q") == sorted(f"l{i}" for i in range(10))
    assert {(r["title"], r["source"], r["date"], r["snippet"]) for r in found} == {("", "", "", "")}
    assert news_results(items.limit(0)).count() == 0


def test_csv_with_original_headers(spark, tmp_path):
    path = tmp_path / "visits.csv"
    path.write_text("备注,VIN,修理日期,公里数,修理类型\nx,v1,2020-01-05,12.5,保养\ny,v2,not a date,7,保养\nz,v3,,8,\n", encoding="utf-8")
    good, rejected = typed(read_csv(spark, str(path), VISIT_COLUMNS), {"visit_date": "date", "mile": "double"})
    assert [(r["entity_id"], str(r["visit_date"]), r["mile"]) for r in good.orderBy("entity_id").collect()] == [("v1", "2020-01-05", 12.5), ("v3", "None", 8.0)]
    assert [(r["entity_id"], r["misfits"]) for r in rejected.collect()] == [("v2", ["visit_date"])]
    (tmp_path / "m.csv").write_text("VIN,会员等级\nv1,金卡\n", encoding="utf-8")
    assert tuple(read_csv(spark, str(tmp_path / "m.csv"), MEMBER_COLUMNS, ["VIN", "会员等级"]).drop("corrupt_record").first()) == ("v1", "金卡")


def test_csv_quotes_line_breaks_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "q.csv").write_text('id,text,n\n1,"a ""big"" car, red",10\n2,"two\nlines",20\n3,short\n4,too,many,values\n5,fine,50\n', encoding="utf-8")
    good, rejected = typed(read_csv(spark, str(tmp_path / "q.csv"), {"id": "id", "text": "text", "n": "n"}), {"id": "int", "n": "int"})
    assert sorted(tuple(r) for r in good.collect()) == [(1, 'a "big" car, red', 10), (2, "two\nlines", 20), (5, "fine", 50)]
    assert sorted((r["id"], r["misfits"]) for r in rejected.collect()) == [("3", ["corrupt_record"]), ("4", ["n", "corrupt_record"])]


def test_churn_features_from_csv_files(spark, tmp_path):
    (tmp_path / "vehicle3.csv").write_text("VIN,车主性质,车型,family_name,x\nv1,,m1,family_2,1\nv2,公司,m2,family_1,1\n", encoding="utf-8")
    (tmp_path / "member_info.csv").write_text("VIN,会员等级\nv1,金卡\nv1,金卡\nv9,银卡\n", encoding="utf-8")
    visits = ["VIN,purchase_date,修理日期,公里数,修理类型"]
    visits += [f"v1,2020-01-01,2020-{m:02d}-10,{m * 1000},普修A;首保" for m in (3, 5, 7)]
    visits += ["v2,2020-01-01,2020-12-01,100,保养", "v2,2020-01-01,2020-13-01,100,保养", "v1,2020-01-01,2020-08-01,1,事故车"]
    (tmp_path / "repare_maintain_info1.csv").write_text("\n".join(visits) + "\n", encoding="utf-8")
    tables, rejected = read_visit_tables(spark, str(tmp_path))
    found = churn_features(**tables, as_of=date(2021, 1, 1)).collect()
    assert [r["entity_id"] for r in found] == ["v1"]
    row = found[0]
    assert (row["owner_type"], row["member_level"], row["all_times"], row["day_diff_median"]) == ("个人", "金卡", 3, 61.0)
    assert (row["last_visit_types"], row["mile_diff_mean"], row["churn_label"]) == (["普通维修", "首次保养"], 7000 / 3, 0)
    assert rejected["visits"].count() == 1 and rejected["vehicles"].count() == 0


def test_csv_sink_joins_lists(spark):
    path = shared_dir(spark, "csv")
    write_csv(spark.createDataFrame([("a", ["x", "y"])], "k string, t array<string>"), path)
    assert tuple(read_csv(spark, path, {"k": "k", "t": "t"}).drop("corrupt_record").first()) == ("a", "x;y")


def test_vector_table_is_rebuilt(spark):
    path = shared_dir(spark, "vectors")
    rows = spark.createDataFrame([("1", [1.0], "t", {"k": "v"})], "id string, embedding array<float>, text string, metadata map<string,string>")
    write_vectors(rows.union(rows), path)
    assert rebuild_vectors(rows, rows.limit(0), path).count() == 1


def test_repeated_decisions_and_attempts_do_not_multiply_rows(spark):
    rows = contents(spark, [("a", "Poster", [])])
    decisions = spark.createDataFrame([("a", "yes", 1), ("a", "no", 2)], "insight_id string, decision string, place int")
    assert [r["approval"] for r in op.reviewed(rows, decisions).collect()] == ["rejected"]
    attempts = spark.createDataFrame([("a", "timeout", None), ("a", None, "p"), ("a", "timeout", None)], "content_id string, error string, post_id string")
    results = op.publish_results(op.publish_queue(rows, "page"), attempts)
    assert [(r["status"], r["post_id"]) for r in results.collect()] == [("success", "p")]


def test_a_failed_rebuild_leaves_the_table(spark):
    path = shared_dir(spark, "vectors")
    rows = spark.createDataFrame([("a", [1.0], "t")], "id string, embedding array<double>, text string")
    write_vectors(rows, path)
    assert read_vectors(spark, path).count() == 1
    first = rebuild_vectors(rows, rows, path)
    broken = rows.select(F.when(F.rand() >= 0, F.raise_error(F.lit("no more rows"))).cast("string").alias("id"), "embedding", "text")
    with pytest.raises(Exception, match="no more rows"):
        rebuild_vectors(rows, broken, path)
    assert read_vectors(spark, path).count() == 2 and vector_versions(spark, path) == [1]
    second = rebuild_vectors(rows, rows.limit(0), path)
    assert second.count() == 1 and first.count() == 2  # readers of the version before go on
    rebuild_vectors(rows, rows, path)
    assert vector_versions(spark, path) == [2, 3] and read_vectors(spark, path).count() == 2
