import zlib

from llm_fixtures import edge_documents, no_documents

from retainframe.llm import sharding


def check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    return by


def test_near_equal_bytes_with_a_hot_text(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * (i % 50)) for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sharding.assign_shards(docs, 40).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(6_000))
    texts = dict(rows)
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)
    sizes = [sum(r["size"] for r in m) for m in check(got, 40).values()]
    assert len(sizes) == 40 and max(sizes) - min(sizes) <= 2 * max(r["size"] for r in got)


def test_overfull_ranges_are_divided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES", 1)  # a bad sample: ranges must be divided to come out even
    rows = [(i, "x" * (i % 97)) for i in range(3_000)]
    slim = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    sizes = [sum(r["size"] for r in m) for m in check(slim, 8).values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 112


def test_edge_rows(spark):
    docs = edge_documents(spark)
    got = sharding.assign_shards(docs, 4).collect()
    assert len(got) == docs.count()
    check(got, 4)
    assert sorted(r["size"] for r in got)[:2] == [16, 16]
    assert [r["doc_id"] for r in got].count(None) == 1 and [r["doc_id"] for r in got].count(4) == 2
    assert sharding.assign_shards(no_documents(spark), 4).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * i) for i in range(50)], "doc_id long, text string")
    back = sharding.write_shards(docs, f"file://{tmp_path}/shards", 4)
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == [(i, "t" * i) for i in range(50)]
    assert {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
