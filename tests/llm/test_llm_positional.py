import random
import re

from llm_fixtures import babble, edge_documents, no_documents
from oracle import compare, connect

from retainframe.llm import positional
from retainframe.llm.queries import QUERIES, SQL


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items, window=10):
    out = []
    for key, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, body in items:
            own = words_of(body)
            n = min(window, len(own))
            wanted = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
            for i in range(len(words) - n + 1) if n else ():
                if tuple(words[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        out.append((key, len(words), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()), key=str)


def test_matches_all_windows(spark):
    rng = random.Random(2)
    items = [(i, babble(rng, rng.choice([1, 3, 10, 12, 40]), ("ka", "lo", "mi"))) for i in range(20)]
    items += [(3, items[5][1]), (50, items[7][1]), (51, None), (52, " ,. "), (None, "a passage without an id of its own but of more than ten words")]
    docs = []
    for i in range(200):
        parts = [babble(rng, rng.randint(0, 30), ("ka", "lo", "mi"))]
        if i % 3 == 0:
            own = words_of(rng.choice(items[:20])[1])
            a = rng.randint(0, max(0, len(own) - 10))
            parts += [", ".join(own[a : a + rng.randint(8, 20)]).upper(), babble(rng, 5)]
        docs.append((i, " ".join(parts)))
    docs += [(200, items[4][1] * 2), (None, "A passage, without an id of its own; but of more than TEN words!"), (5, None), (6, "É é ÉÉ")]
    got = positional.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    # an item without an id marks documents but is in no list of ids
    want = [(k, n, hit, [i for i in found if i != "None"], bad) for k, n, hit, found, bad in plain(docs, items)]
    assert result(got) == sorted(want, key=str)


def test_shuffled_beyond_the_shared_size(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, babble(rng, 15)) for i in range(5)]
    docs = [(i, babble(rng, 5) + " " + items[i % 5][1][: 40 + i] + " " + items[i % 5][1]) for i in range(20)]
    monkeypatch.setattr(positional, "SHARED_ROWS", 0)
    got = positional.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert result(got) == plain(docs, items)


def test_edge_rows(spark):
    edge = edge_documents(spark, [(8, "one two three four five six seven eight nine ten eleven")])
    items = spark.createDataFrame([("i1", "ONE two three, four five six seven eight nine ten"), ("i2", None), ("i3", "word")], "item_id string, text string")
    got = {}
    for r in positional.decontaminate(edge, items).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == edge.count() and len(got[4]) == 2
    assert (got[1][0]["n_words"], got[1][0]["contaminated"]) == (0, False)
    assert (got[8][0]["n_hit"], got[8][0]["items"]) == (10, ["i1"])
    assert got[5][0]["n_hit"] == 30_000
    assert positional.decontaminate(no_documents(spark), items).count() == 0
    none = positional.decontaminate(edge, items.limit(0))
    assert not any(r["contaminated"] for r in none.collect()) and none.count() == edge.count()
    assert positional.decontaminate(edge, items, key="row").columns[0] == "row"


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta"), (2, "beta " + "x " * 30 + "alpha"), (3, "alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    index = positional.build(docs, items)
    assert [(r["key"], r["item_id"]) for r in positional.proximity(index, slop=5).collect()] == [(1, "7")]
    assert {r["key"] for r in positional.proximity(index, slop=40).collect()} == {1, 2}


def test_query_matches_sql_without_python(spark, sf_dir):
    df = QUERIES["op8_positional_index"](spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    equal, message = compare(df, connect(sf_dir), SQL["op8_positional_index"])
    assert equal, message


def test_proximity_with_an_unseen_word(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine changed"), (2, "nine " + "x " * 30 + "one"), (3, "apart")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three four five six seven eight nine ten"), (8, "apart unseen")], "item_id long, text string")
    found = positional.proximity(positional.build(docs, items), slop=10).collect()
    assert {(r["key"], r["item_id"]) for r in found} == {(1, "7")}
