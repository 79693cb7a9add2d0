import random

import numpy as np
from llm_fixtures import babble, edge_documents, no_documents
from pyspark.sql import functions as F

from retainframe.llm import langid

FIRST = ("ka", "lo", "mi", "ne", "pu", "ra")
SECOND = ("tsch", "ung", "örg", "pfa", "ach", "zei")


def plain_bundle(text, width):
    symbols = ["" if not c.isalpha() else c for c in f" {(text or '').lower()} "]
    kept = [s or " " for i, s in enumerate(symbols) if s or i == 0 or symbols[i - 1]]
    sign = {s: langid.symbol_vectors(np.array([ord(s)], np.uint32), width)[0].astype(int) for s in set(kept)}
    total = np.zeros(width, dtype=int)
    for a, b, c in zip(kept, kept[1:], kept[2:]):
        total += np.roll(sign[a], 2) * np.roll(sign[b], 1) * sign[c]
    return total


def test_bundles_match_a_plain_version(monkeypatch):
    monkeypatch.setattr(langid, "RUNS", 7)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcé ß.1\n漢İ") for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", "x", "  .. "]
    got = langid.bundles(texts, 128)
    for text, row in zip(texts, got):
        assert (row == plain_bundle(text, 128)).all(), text
    assert langid.bundles([], 128).shape == (0, 128)


def test_letters_are_far_apart():
    signs = langid.symbol_vectors(np.arange(97, 123, dtype=np.uint32)).astype(float)
    near = np.abs(signs @ signs.T / langid.WIDTH - np.eye(26))
    assert near.max() < 0.2
    assert (langid.symbol_vectors(np.array([97], np.uint32)) == langid.symbol_vectors(np.array([120, 97], np.uint32))[1]).all()


def labelled(spark, n=200):
    rng = random.Random(5)
    rows = [(i, babble(rng, rng.randint(2, 40), FIRST if i % 3 else SECOND), "one" if i % 3 else "two") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_unseen_texts_get_their_language(spark):
    rows = labelled(spark)
    model = langid.fit(rows.where("doc_id % 4 <> 2"))
    assert model.langs == ["one", "two"]
    got = langid.predict(rows, model).join(rows, "doc_id").where("doc_id % 4 = 2")
    assert got.where("lang <> lang_pred").count() == 0
    assert got.where("score < 0.5 or score > 1").count() == 0


def test_order_and_partitions_do_not_matter(spark):
    rows = labelled(spark, 60)
    one, two = langid.fit(rows.coalesce(1)), langid.fit(rows.orderBy(F.desc("doc_id")).repartition(7))
    assert one.langs == two.langs and (one.away == two.away).all()


def test_edge_rows(spark):
    model = langid.fit(labelled(spark, 60))
    edge = edge_documents(spark, [(6, "... 123 _ 漢")])
    got = langid.predict(edge, model).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert by[6]["lang_pred"] in ("one", "two")
    nothing = langid.fit(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in langid.predict(edge, nothing).collect()} == {("und", 0.0)}
    only = langid.fit(labelled(spark, 60).where("lang = 'two'"))
    assert langid.predict(edge.where("doc_id = 5"), only).first()["lang_pred"] == "two"
    assert langid.fit(no_documents(spark).withColumn("lang", F.lit("x"))).langs == []
    assert langid.predict(no_documents(spark), model).count() == 0
