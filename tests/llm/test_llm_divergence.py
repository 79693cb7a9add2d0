import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import edge_documents, no_documents
from pyspark.sql import functions as F

from retainframe.llm import divergence


def plain(rows, least, smooth=5, top=50):
    """rows of (text, lang, source)"""
    n, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        for t in terms:
            n[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), k in docs.items():
        if k >= least:
            kept[lang].append(t)
    out = set()
    for lang in {g[0] for g in groups}:
        own = sorted(s for x, s in groups if x == lang)
        v = len(kept[lang])

        def shares(count):
            total = sum(count(t) for t in kept[lang])
            return {t: 1 + 1_000_000_000 * (count(t) + smooth) // (total + smooth * v) for t in kept[lang]}

        p = {s: shares(lambda t, s=s: n[lang, s, t]) for s in own}
        q = shares(lambda t: sum(n[lang, s, t] for s in own))
        for s in own:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept[lang]), o) for o in own if o != s]
            term = [(p[s][t] - q[t], t) for t in kept[lang] if n[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1) if part == "pair" or k <= top}
    return out


def some_rows(seed, n=160):
    rng = random.Random(seed)
    words = ["The", "the", "of", "é", "naïve", "x1y", "zz", "q-r", "Straße", "ÄB"] + [f"w{chr(97 + i)}" for i in range(20)]
    return [(" ".join(rng.choice(words[rng.randint(0, 9):]) for _ in range(rng.randint(0, 12))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", "é", None])) for _ in range(n)]


def found(df, **options):
    return {tuple(r) for r in divergence.divergences(df, **options).select("lang", "source", "part", "item", "value", "rank").collect()}


@pytest.mark.parametrize("terms, sources", [(2_048, 256), (3, 2)])
def test_matches_a_plain_version(spark, terms, sources):
    rows = some_rows(terms)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert found(df, least=9, top=4, terms=terms, sources=sources) == plain(rows, 9, top=4)


def test_shares_are_exact():
    for n, total, kept in [(0, 0, 1), (7, 9, 3), (10**15, 3 * 10**15, 10**9), (9 * 10**14, 9 * 10**14, 1)]:
        got = int(divergence.share(np.array([n]), np.array([total]), 5, np.int64(kept))[0])
        assert got == 1 + 1_000_000_000 * (n + 5) // (total + 5 * kept)


def test_edge_rows(spark):
    edge = edge_documents(spark).withColumn("lang", F.when(F.col("doc_id") < 3, None).otherwise("x")).withColumn("source", F.col("t"))
    assert found(edge, least=1) == plain([(r["text"], r["lang"], r["source"]) for r in edge.collect()], 1)
    assert found(edge, least=100) == plain([(r["text"], r["lang"], r["source"]) for r in edge.collect()], 100)
    empty = no_documents(spark).withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    assert found(empty) == set()


def test_a_group_without_terms_is_compared(spark):
    rows = [("word other", "en", "a")] * 3 + [("", "en", "b"), (None, None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert found(df, least=2) == plain(rows, 2)
