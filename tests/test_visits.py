"""Hand-made visit histories."""

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from retainframe.functions.dates import parse_date, shift_days, shift_months
from retainframe.functions.strings import natural_sort, pack_key, unpack_key
from retainframe.operators import intervals as iv
from retainframe.operators.features import stratified_split
from retainframe.operators.joins import drop_entities_matching, keep_keys
from retainframe.operators.profile import customer_profile
from retainframe.operators.visits import active_entities, clean_visits, history, in_order, split_date, visit_types
from retainframe.plans.churn import churn_features, text_features

VISITS = "entity_id string, visit_date date, mile double, visit_type string"
START = date(2020, 1, 1)


def day(n):
    return START + timedelta(days=n)


def visits(spark, rows):
    """(entity, day number, mile, type)"""
    return spark.createDataFrame([(e, None if n is None else day(n), m, t) for e, n, m, t in rows], VISITS)


def bought(spark, rows):
    return spark.createDataFrame([(e, day(n)) for e, n in rows], "entity_id string, purchase_date date")


def gaps(spark, rows, purchases):
    plain = visits(spark, [(e, n, m, "保养") for e, n, m in rows])
    return iv.visit_intervals(clean_visits(plain), bought(spark, purchases)).orderBy("entity_id", "visit_date").collect()


def test_same_day_visits_become_one(spark):
    rows = clean_visits(visits(spark, [("a", 1, 10.0, "普修A;首保"), ("a", 1, 30.0, "首次保养"), ("a", 1, 90.0, "索赔")]))
    [row] = in_order(rows).collect()
    assert row["mile"] == 20.0
    assert row["visit_types"] == ["普通维修", "首次保养"]


def test_passive_visits_and_internal_vehicles_leave(spark):
    rows = visits(spark, [
        ("a", 1, 1.0, "保养"), ("a", 2, 2.0, "召回检查"), ("b", 1, 1.0, "保养"), ("b", 2, 2.0, "内部车"), ("c", 1, 1.0, "PDI"),
        ("d", 1, None, "保养"),
    ])
    assert [(r["entity_id"], r["visit_date"]) for r in clean_visits(rows).collect()] == [("a", day(1))]
    assert [tuple(r) for r in active_entities(rows).collect()] == [("a", day(1))]


def test_internal_rule_on_incomplete_rows_is_ignored(spark):
    rows = visits(spark, [("a", 1, 1.0, "保养"), ("a", 2, None, "二手")])
    assert clean_visits(rows).count() == 1


def test_natural_order(spark):
    items = spark.createDataFrame([(["b10", "b9", "a", "b", "b-1", "b007", "10", "9x"],)], "v array<string>")
    assert items.select(natural_sort(F.col("v"))).first()[0] == ["9x", "10", "a", "b", "b007", "b9", "b10", "b-1"]


def test_type_set(spark):
    rows = spark.createDataFrame([(["首保;首次保养;普修A"],)], "v array<string>")
    assert rows.select(natural_sort(visit_types(F.col("v")))).first()[0] == ["普通维修", "首次保养"]


def test_first_gap_is_since_the_purchase(spark):
    rows = gaps(spark, [("a", 10, 500.0), ("a", 30, 900.0)], [("a", 0)])
    assert [(r["day_diff"], r["mile_diff"], r["day_speed"]) for r in rows] == [(10, 500.0, 50.0), (20, 400.0, 20.0)]


def test_visit_before_the_purchase_is_dropped(spark):
    rows = gaps(spark, [("a", 10, 500.0), ("a", 30, 900.0)], [("a", 10)])
    assert [r["day_diff"] for r in rows] == [20]
    assert iv.numbered(iv.visit_intervals(
        clean_visits(visits(spark, [("a", 10, 1.0, "x"), ("a", 30, 2.0, "x")])), bought(spark, [("a", 10)])
    )).first()["visit_no"] == 1


def test_falling_mileage_gets_the_median_speed(spark):
    rows = gaps(spark, [("a", 10, 100.0), ("a", 20, 300.0), ("a", 30, 250.0)], [("a", 0)])
    # speeds 10 and 20 are good, so the repaired speed is 15
    assert (rows[2]["day_speed"], rows[2]["mile_diff"], rows[2]["previous_mile"]) == (15.0, 150.0, 100.0)


def test_only_falling_mileages_leave_no_median(spark):
    rows = gaps(spark, [("a", 10, 300.0), ("a", 20, 100.0)], [("a", 10)])
    assert rows[0]["mile_diff"] is None
    assert iv.interval_stats(iv.visit_intervals(
        clean_visits(visits(spark, [("a", 10, 300.0, "x"), ("a", 20, 100.0, "x")])), bought(spark, [("a", 10)])
    )).first()["mile_diff_median"] is None


def test_single_visit_and_zero_mean(spark):
    one = iv.interval_stats(iv.visit_intervals(clean_visits(visits(spark, [("a", 10, 0.0, "x")])), bought(spark, [("a", 0)]))).first()
    assert (one["day_diff_std"], one["day_cv"], one["mile_cv"], one["all_times"]) == (0.0, 0.0, 0.0, 1)
    two = iv.interval_stats(iv.visit_intervals(
        clean_visits(visits(spark, [("a", 10, 0.0, "x"), ("a", 20, 0.0, "x")])), bought(spark, [("a", 0)])
    )).first()
    assert two["mile_cv"] == 0.0


def test_moments(spark):
    rows = spark.createDataFrame([(datetime(2020, 1, 31, 12, 30), 10.5)], "t timestamp, d double")
    month, days = rows.select(shift_months(F.col("t"), 3), shift_days(F.col("t"), F.col("d"))).first()
    assert month == datetime(2020, 4, 30, 12, 30)
    assert days == datetime(2020, 2, 11, 0, 30)


def test_date_forms(spark):
    texts = ["2020-01-05", "2020/1/5", "20200105", "2020/01/05 10:30", "2020-01-05T10:30:00", " 2020-1-5 ", "2020-13-05", "x", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in rows.orderBy("i").select(parse_date(F.col("t"))).collect()]
    assert found == [date(2020, 1, 5)] * 6 + [None] * 4


def profile_tables(spark, entities):
    vehicles = spark.createDataFrame([(e, None, "m", "family_1") for e in entities], "entity_id string, owner_type string, car_mode string, car_level string")
    members = spark.createDataFrame([("zz", "gold")], "entity_id string, member_level string")
    return vehicles, members, bought(spark, [(e, 0) for e in entities])


def test_profile_fills_and_drops(spark):
    vehicles, members, purchases = profile_tables(spark, ["a", "b"])
    rows = customer_profile(vehicles, members, purchases.unionByName(bought(spark, [("a", -5), ("a", 7)]))).orderBy("entity_id").collect()
    assert [(r["entity_id"], r["owner_type"], r["member_level"], r["purchase_date"]) for r in rows] == [
        ("a", "个人", "无", day(-5)), ("b", "个人", "无", day(0)),
    ]


def test_features_need_a_second_visit_and_label_by_expected_return(spark):
    rows = [("a", 10, 10.0), ("a", 21, 20.0), ("b", 10, 10.0), ("c", 400, 1.0), ("c", 800, 2.0), ("z", 900, 1.0)]
    raw = visits(spark, [(e, n, m, "保养") for e, n, m in rows])
    found = churn_features(raw, *profile_tables(spark, ["a", "b", "c", "z"]), as_of=day(1000)).orderBy("entity_id").collect()
    assert [r["entity_id"] for r in found] == ["a", "c"]
    a, c = found
    # gaps 10 and 11 days: the expected return is at noon
    assert a["relative_next_instore_date"] == datetime(2020, 1, 22) + timedelta(days=10.5)
    assert (a["churn_label"], c["churn_label"]) == (1, 0)
    assert (a["last_till_now_days"], a["car_age"], a["all_times"]) == (979, 3, 2)
    text = text_features(spark.createDataFrame([a])).first()
    assert text["text_feature"] == "上次进店类型：保养，历史进店类型：保养，用户性质：个人，汽车型号：m，高档车，会员卡：无"
    assert (text["label_txt"], text["key_label"]) == ("用户标签：流失", "a:1")


def test_inactive_entities_drop_or_label(spark):
    rows = [("a", 10, 1.0), ("a", 20, 2.0), ("b", 1500, 1.0), ("b", 1600, 2.0)]
    raw = visits(spark, [(e, n, m, "x") for e, n, m in rows])
    tables = profile_tables(spark, ["a", "b"])
    last = clean_visits(visits(spark, [("b", 1700, 3.0, "x")])).select("visit_date")
    assert last.count() == 1
    raw = raw.unionByName(visits(spark, [("b", 1700, 3.0, "x")]))
    assert [r["entity_id"] for r in churn_features(raw, *tables, as_of=day(1700)).collect()] == ["b"]
    kept = {r["entity_id"]: r["churn_label"] for r in churn_features(raw, *tables, as_of=day(1700), inactive="label").collect()}
    assert kept["a"] == 1 and "b" in kept


def test_hot_entity_matches_brute_force(spark):
    """A third of all visits belong to one entity, many on the same days."""
    rows = [("hot", i % 300, float(i), "x") for i in range(3000)] + [(f"e{i % 500}", i // 500 * 7, float(i), "x") for i in range(6000)]
    frame = pd.DataFrame(rows, columns=["e", "n", "m", "t"])
    daily = frame.groupby(["e", "n"]).m.mean().reset_index().sort_values(["e", "n"])
    split = (pd.Timestamp(START) + pd.Timedelta(days=299) - pd.DateOffset(months=3)).date()
    past = daily[[day(n) <= split for n in daily.n]].copy()
    past["d"] = past.n - past.groupby("e").n.shift(1).fillna(-1)
    expected = past.groupby("e").d.median().to_dict()
    raw = visits(spark, rows)
    cut = split_date(active_entities(raw))
    entities = [r[0] for r in raw.select("entity_id").distinct().collect()]
    found = iv.interval_stats(iv.visit_intervals(history(clean_visits(raw), cut), bought(spark, [(e, -1) for e in entities])))
    assert {r["entity_id"]: r["day_diff_median"] for r in found.collect()} == expected


def test_result_does_not_depend_on_partitioning(spark):
    rows = visits(spark, [(f"e{i % 7}", i * 3 % 200, float(i * 37 % 91), "b10;b9") for i in range(400)])
    purchases = bought(spark, [(f"e{i}", -1) for i in range(7)])
    one = iv.interval_stats(iv.visit_intervals(clean_visits(rows.coalesce(1)), purchases))
    many = iv.interval_stats(iv.visit_intervals(clean_visits(rows.repartition(13)), purchases))
    rounded = [sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect()) for d in (one, many)]
    assert rounded[0] == rounded[1]


def test_key_filters_split_a_hot_key(spark):
    rows = visits(spark, [("hot", i, 1.0, "a") for i in range(200)] + [("x", 1, 1.0, "a"), ("y", 1, 1.0, "bad"), ("y", 2, 1.0, "a")])
    keys = spark.createDataFrame([("hot",), ("y",)], "entity_id string")
    assert keep_keys(rows, keys, "entity_id").count() == 202
    assert drop_entities_matching(rows, "entity_id", "visit_type", "bad").count() == 201


@pytest.mark.parametrize("prefix", [1, 4])
def test_split_meets_every_quota(spark, prefix):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("label"))
    marked = stratified_split(rows, "label", "id", 0.1, prefix=prefix)
    counts = {r["label"]: r["n"] for r in marked.where("dataset = 'valid'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 167, 0: 333}
    again = stratified_split(rows.repartition(7), "label", "id", 0.1)
    assert marked.exceptAll(again).count() == 0


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint, label int")
    assert stratified_split(empty, "label", "id").count() == 0


def test_packed_keys(spark):
    packed = spark.createDataFrame([("v1", 1)], "k string, l int").select(pack_key(F.col("k"), F.col("l")).alias("p"))
    assert packed.first()[0] == "v1:1"
    assert tuple(packed.select(*unpack_key(F.col("p"))).first()) == ("v1", 1)




@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_labels_do_not_depend_on_the_session_zone(spark, zone):
    """Days that clocks change on have 24 hours too."""
    from retainframe.operators.features import churn_label

    features = spark.createDataFrame([(i, date(2021, 3, 13), 0.5 + i / 4, False) for i in range(12)], "entity_id int, last_date date, day_diff_median double, inactive boolean")

    def found():
        out = churn_label(features, F.lit(date(2021, 6, 15)))
        return {r[0]: tuple(r) for r in out.selectExpr("entity_id", "string(relative_next_instore_date)", "string(max_relative_next_instore_date)", "churn_label").collect()}

    usual = found()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert found() == usual
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r[3] for r in usual.values()} == {0, 1} and usual[0][1] == "2021-03-13 12:00:00"
