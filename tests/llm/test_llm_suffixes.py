import hashlib
import random

import numpy as np
import pytest
from llm_fixtures import babble, edge_documents, no_documents
from oracle import compare, connect

from retainframe.llm import suffixes
from retainframe.llm.queries import QUERIES, SQL


def plain(rows, length=50):
    first = {}
    for key, text in rows:
        data, rank = (text or "").encode(), suffixes.LAST if key is None else key
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            first[s] = min(first.get(s, rank), rank)
    out = []
    for key, text in rows:
        data, rank = (text or "").encode(), suffixes.LAST if key is None else key
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < rank:
                gone[i : i + length] = b"\1" * length
        left = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    return sorted(out, key=str)


def result(df):
    return sorted(((r[0], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in df.collect()), key=str)


def test_sort_against_python():
    rng = random.Random(3)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(400)).encode() + b"\0" * 20, np.uint8)
    at = np.arange(400)
    segment = np.array([rng.randrange(3) for _ in range(400)])
    s = suffixes.Suffixes(data, at, segment, 20)
    order = s.sort()
    key = lambda i: (segment[i], bytes(data[i : i + 20]))
    assert [key(i) for i in order] == sorted(map(key, range(400)))
    group = s.groups(order)
    assert all((group[i] == group[i - 1]) == (key(order[i]) == key(order[i - 1])) for i in range(1, 400))


@pytest.mark.parametrize("block", [3_000, 1 << 20])
def test_matches_all_windows(spark, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 20_000)
    rng = random.Random(5)
    passages = [babble(rng, rng.randint(8, 40)) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [babble(rng, rng.randint(0, 20)) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, passages[0])
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts)), rng.choice(passages)[rng.randint(0, 30) :])
        rows.append((rng.randrange(1_000_000) - 500_000, "".join(parts)))
    rows += [(rows[0][0], rows[0][1]), (None, rows[1][1]), (None, "unlike all others é" * 9), (77, "ab" * 100), (78, "ab" * 60), (79, "é" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(suffixes.remove_repeats(docs)) == plain(rows)


def test_edge_rows(spark):
    edge = edge_documents(spark, [(6, "word " * 12)])
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    short = [(i, t) for i, t in rows if i != 5]
    got = suffixes.remove_repeats(edge).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[6]["n_removed"] == by[6]["n_bytes"] == 60 and by[6]["spans"] == [0, 60]
    assert by[5]["n_removed"] == 0 and by[1]["n_bytes"] == 0
    assert result(suffixes.remove_repeats(edge.where("doc_id is null or doc_id != 5"))) == plain(short)
    assert suffixes.remove_repeats(no_documents(spark)).count() == 0


def test_query_matches_sql(spark, sf_dir):
    equal, message = compare(QUERIES["op7_suffix_sort"](spark, sf_dir), connect(sf_dir), SQL["op7_suffix_sort"])
    assert equal, message
