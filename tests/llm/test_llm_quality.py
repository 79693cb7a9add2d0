import random
import re
from collections import Counter

import numpy as np
from llm_fixtures import babble, edge_documents, no_documents

from retainframe.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(hit)


def test_base_counts_match_a_plain_version():
    rng = random.Random(0)
    for _ in range(1_500):
        text = "".join(rng.choice(["a", "b", " ", " ", "\n", "é", "#", "\x0b", "\xa0", "\x1c", "<", "😀"]) for _ in range(rng.randint(0, 80)))
        assert quality.base_counts(text) == plain(text)
    many = " ".join(f"w{i}" for i in range(9_000)) + " w1 w2 w3 w4 w5"
    assert quality.base_counts(many) == plain(many)
    assert quality.base_counts(None) == (0, 0, 0, 0, 0)


def test_a_batch_is_scored_like_single_texts():
    model = quality.Model(np.random.default_rng(0).normal(size=quality.WIDTH).astype(np.float32), 0.1, 1.0, 0.0)
    texts = [b"", b"a", b"the cat the cat", "é à b".encode(), b" ", b"x" * 5000]
    together = model.probabilities(texts)
    assert np.allclose(together, [model.probabilities([t])[0] for t in texts])


def labelled(spark, n=600):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        text = babble(rng, 60)
        rows.append((i, text.upper().replace(" ", " !! ") if i % 4 == 0 else text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, n, 2)], "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    got = quality.quality_table(docs, quality.fit(docs, labels)).collect()
    unseen = [r for r in got if r["doc_id"] % 2]
    assert all(r["kept"] for r in unseen)  # odd ids are all good
    assert not any(r["kept"] for r in got if r["doc_id"] % 4 == 0)


def test_edge_rows(spark):
    docs, labels = labelled(spark, 100)
    edge = edge_documents(spark)
    got = quality.quality_table(edge, quality.fit(docs, labels)).collect()
    assert len(got) == edge.count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 10)
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(edge, nothing) is None
    assert all(r["p_good"] == 1.0 for r in quality.quality_table(edge, None).collect())
    assert quality.quality_table(no_documents(spark), None).count() == 0
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 5)], "doc_id long, quality int")
    assert quality.fit(edge, odd) is None
