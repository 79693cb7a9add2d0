import random

import numpy as np
import pytest
from llm_fixtures import babble, edge_documents, no_documents
from pyspark.sql import functions as F

from retainframe.llm import toxicity

BAD = ["idiot", "stupid", "loser", "worthless"]
DISGUISED = ["1d10t", "5tup1d", "loooser", "i d i o t", "w.o.r.t.h.l.e.s.s", "$tupid", "L0SER!!"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = []
    for i in range(800):
        words = babble(rng, 50).split()
        if i % 5 == 0:
            words[rng.randrange(50)] = rng.choice(BAD)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(800)], "doc_id long, toxic int")


def test_restored_words(spark, corpus):
    restorer = toxicity.Restorer(toxicity.log_model(toxicity.count_trigrams(corpus[0])))
    for written, meant in (("1d10t", "idiot"), ("5tup1d", "stupid"), ("loooser", "loser"), ("i d i o t", "idiot"), ("$tupid", "stupid")):
        assert restorer.text(written) == meant
    for plain in ("kalomi", "the cat sat", "a b c", "42 3.14", "mi-ka"):
        assert restorer.text(plain) == plain or plain == "mi-ka"
    assert restorer.text(None) == "" and restorer.text("") == ""


def test_viterbi_is_the_best_of_all_readings(corpus, spark):
    """Every reading of a short span, scored in full, against the path found."""
    model = toxicity.log_model(toxicity.count_trigrams(corpus[0]))

    def readings(span, before=""):
        if not span:
            yield "", 0.0
            return
        c, options = span[0], []
        if c in toxicity.SEPARATORS:
            options = [("", toxicity.DROPPED), (" ", toxicity.KEPT_GAP)]
        else:
            again = [("", toxicity.REPEATED)] if c == before else []
            options = ([(c, toxicity.AS_IS), *again] if toxicity.code(c) else []) + [o for x in toxicity.LOOKS_LIKE.get(c, "") for o in ((x, toxicity.LOOK_ALIKE), *again)]
            options = options or [("", toxicity.DROPPED)]
        for x, cost in options:
            for rest, more in readings(span[1:], c):
                yield x + rest, cost + more

    def total(text, cost):
        codes = [toxicity.EDGE, toxicity.EDGE, *(0 if c == " " else toxicity.code(c) for c in text), toxicity.EDGE]
        return cost + sum(float(model[codes[i - 2], codes[i - 1], codes[i]]) for i in range(2, len(codes)))

    for span in ("1d10t", "l0sser", "a.b c", "5t+p!d", "iii1l"):
        valid = [(t, c) for t, c in readings(span) if not t.startswith(" ") and "  " not in t]
        best = max(total(t, c) for t, c in valid)
        found = toxicity.restore_span(span, model)
        assert max(total(t, c) for t, c in valid if t.strip() == found) == pytest.approx(best, abs=1e-3)


def test_held_out_and_disguised(spark, corpus):
    docs, labels = corpus
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.where(~held_out))
    got = toxicity.score(docs, model).join(labels, "doc_id").where(held_out).collect()
    assert np.mean([(r["score"] >= 0.3) == bool(r["toxic"]) for r in got]) > 0.97
    rng = random.Random(9)
    hidden = spark.createDataFrame([(i, babble(rng, 20) + f" {w} " + babble(rng, 20)) for i, w in enumerate(DISGUISED)], "doc_id long, text string")
    assert all(r["score"] >= 0.3 for r in toxicity.score(hidden, model).collect())
    clean = spark.createDataFrame([(i, babble(rng, 40)) for i in range(50)], "doc_id long, text string")
    assert all(r["score"] < 0.3 for r in toxicity.score(clean, model).collect())


def test_labels_of_held_out_rows_do_not_matter(spark, corpus):
    docs, labels = corpus
    held_out = toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(docs, x.where(~held_out)) for x in (labels, turned))
    assert a.weights == b.weights and a.offset == b.offset


def test_edge_rows(spark, corpus):
    edge = edge_documents(spark)
    model = toxicity.fit(corpus[0], corpus[1])
    got = toxicity.score(edge, model)
    assert got.columns == [c for c in edge.columns if c != "score"] + ["score"]  # replaced
    rows = got.collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    none = toxicity.fit(edge, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["score"] < 1e-5 for r in toxicity.score(edge, none).collect())
    assert toxicity.score(no_documents(spark), none).count() == 0
    assert toxicity.count_trigrams(no_documents(spark)).sum() == 0
    assert toxicity.restored(edge, none.language).count() == edge.count()


def test_disguises_at_the_gate():
    rng = random.Random(3)
    text = " ".join(w for _ in range(4_000) for w in (babble(rng, 1), rng.choice([*BAD, "ass", "bad", "as"])))
    restorer = toxicity.Restorer(toxicity.log_model(toxicity.trigram_counts([text])))
    for written, meant in (("idio+", "idiot"), ("as$", "ass"), ("@$$", "ass"), ("455", "ass"), ("4$5", "ass"), ("iiddiioott", "idiot"), ("stuupid", "stupid"), ("b a d", "bad"), ("i  d  i  o  t", "idiot"), ("idiot!", "idiot"), ("(idiot)", "idiot")):
        assert meant in restorer.words(f"kalo {written} kalo"), written
    for plain in ("worthless kalo!", "ass", "a b c", "42", "2024", "1 - 2 - 3", "$$$", "!!!"):
        assert restorer.text(plain) == plain
