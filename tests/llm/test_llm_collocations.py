import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import edge_documents, no_documents
from pyspark.sql import functions as F

from retainframe.llm import collocations


def plain(rows, least=10, top=2_000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i : i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) == 1 or a < least:
            continue
        if len(p) == 2 and any(x == lang and len(q) == 3 and b >= least and p in (q[:2], q[1:]) and 100 * b >= 50 * a for (x, q), b in f.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i, phrase.decode(), -a, left, right, n[lang], -s) for lang, rows in found.items() for i, (s, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)}


def found(df, **options):
    return {tuple(r) for r in collocations.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def some_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "x\x00y", "#1", "ÄB", "red", "hot"] + [f"w{i}" for i in range(12)]
    def sentence():
        out = [rng.choice(words[: rng.choice([3, 9, 21])]) for _ in range(rng.randint(0, 25))]
        return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for w in out)
    return [(sentence(), rng.choice(["en", "en", "fr", None])) for _ in range(n)]


@pytest.mark.parametrize("options", [{}, {"slots": 8}, {"budget": 200}, {"slots": 64, "budget": 40}, {"slots": 4, "budget": 20}])
def test_matches_a_plain_version(spark, options):
    rows = some_rows(len(options) + options.get("budget", 0))
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert found(df, least=3, top=50, **options) == plain(rows, 3, 50)


def test_a_phrase_that_fills_most_texts(spark):
    rows = [("over and over and over again " * 30, "en")] * 40 + some_rows(7, 20)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(df, least=4, slots=16, budget=60) == plain(rows, 4)


def test_groups_stay_within_the_budget():
    totals = np.random.default_rng(0).integers(0, 90, 1_000)
    group, end = collocations.pack(totals, 10, 100, start=7)
    assert (group[totals < 10] == collocations.RARE).all() and (group[totals > 50] == collocations.HEAVY).all()
    held = np.bincount(group[group >= 0] - 7, weights=totals[group >= 0])
    assert held.max() <= 100 and len(held) == end - 7
    assert collocations.pack(np.zeros(4, np.int64), 10, 100, 3)[1] == 3


def test_edge_rows(spark):
    edge = edge_documents(spark, [(7, "a b c. a b c! a b c? a b"), (8, "a b\tc")]).withColumn("lang", F.when(F.col("doc_id") < 6, "x"))
    assert found(edge, least=2) == plain([(r["text"], r["lang"]) for r in edge.collect()], 2)
    assert found(no_documents(spark).withColumn("lang", F.lit("x"))) == set()
    assert found(spark.createDataFrame([(None, None), ("", "x"), ("one", "x")], "text string, lang string")) == set()


def test_scores_pass_64_bits(spark):
    row = spark.createDataFrame([(3 * 10**12, 4 * 10**12, 5 * 10**12)], "a long, l long, r long")
    got = row.select(F.expr("(cast(1000000 as decimal(7,0)) * a * a) div (cast(l as decimal(19,0)) * r)")).first()[0]
    assert got == 1_000_000 * (3 * 10**12) ** 2 // (20 * 10**24)
