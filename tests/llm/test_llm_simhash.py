import random

import pytest
import xxhash
from llm_fixtures import babble, components_of, edge_documents, no_documents

from retainframe.llm import simhash
from retainframe.llm.components import components


def plain_fingerprint(text, n):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_a_plain_version():
    rng = random.Random(2)
    for text in [None, "", " \n", "One", "One TWO", "É é É", *(babble(rng, rng.randint(1, 30)).upper() for _ in range(100))]:
        assert simhash.fingerprint(text, 3) & (1 << 64) - 1 == plain_fingerprint(text, 3)


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)] + [(7, 7)]
    want = components_of(range(700), links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert all(got.get(n, n) == want[n] for n in range(700))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def scattered():
    """Fingerprints alone, in families, and one crowd around a point."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(150)]
    found, hub = set(base), rng.getrandbits(64)
    for center, size, most in [(hub, 150, 3), *((b, 3, 4) for b in base[:40])]:
        for _ in range(size):
            x = center
            for _ in range(rng.randint(0, most)):
                x ^= 1 << rng.randrange(64)
            found.add(x)
    return [simhash._signed(x) for x in found]


@pytest.mark.parametrize("paired,parts,distance", [(1000, 3, 2), (20, 3, 2), (20, 4, 2), (1000, 2, 2), (20, 2, 2), (20, 2, 1), (5, 3, 1), (1000, 1, 0)])
def test_links_match_all_pairs(spark, scattered, paired, parts, distance):
    near = [(a, b) for i, a in enumerate(scattered) for b in scattered[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance]
    want = components_of(scattered, near)
    links = simhash.links(spark.createDataFrame([(x,) for x in scattered], "fp long"), distance, parts, paired)
    got = components_of(scattered, [(r["a"], r["b"]) for r in links.collect()])
    assert got == want


def test_thresholds_follow_the_costs():
    best = min((a + b + c, (i, j, k)) for i, a in enumerate([0, 5, 9, 20], -1) for j, b in enumerate([0, 1, 2, 4], -1) for k, c in enumerate([0, 50, 60, 90], -1) if i + j + k == 0)
    assert tuple(simhash.allocate([[0, 5, 9, 20], [0, 1, 2, 4], [0, 50, 60, 90]], 0)) == best[1]


def test_documents_match_brute_force(spark):
    rng = random.Random(8)
    texts = [babble(rng, 120) for _ in range(60)]
    texts += [t.rsplit(" ", 1)[0] for t in texts[:20]] + texts[:10] + [None, "", " "]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    fps = {i: plain_fingerprint(t, 3) for i, t in rows}
    want = components_of(sorted(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words_each=3).collect()}
    assert {i: r["component"] for i, r in got.items()} == want
    assert all(r["fp"] & (1 << 64) - 1 == fps[i] for i, r in got.items())


def test_edge_rows(spark):
    edge = edge_documents(spark)
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == edge.count()
    assert {r["component"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert [r["component"] for r in got if r["doc_id"] is None] == [None]
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(6)
    texts = [babble(rng, 200) for _ in range(60)]
    for t in texts[:30]:  # one word changed, another added
        words = t.split()
        words[rng.randrange(200)] = "changed"
        texts += [" ".join(words), f"{t} added"]
    texts += texts[:20] + ["", None]
    rows = [(1000 - i, t, "x") for i, t in enumerate(texts)]
    fps = {i: plain_fingerprint(t, 3) for i, t, _ in rows}
    root = components_of(sorted(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(4)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    found = {r["doc_id"]: r for r in kept.collect()}
    assert set(found) == {i for i, r in root.items() if i == r} and len(found) < 130
    assert all(found[i]["text"] == t for i, t, _ in rows if i in found)


def test_edge_rows_of_the_filter(spark):
    edge = simhash.drop_near_duplicates(edge_documents(spark))
    assert edge.columns == edge_documents(spark).columns
    assert sorted(r["doc_id"] for r in edge.collect() if r["doc_id"] is not None) == [1, 4, 5]  # texts without words are one group
    assert edge.count() == 4 and simhash.drop_near_duplicates(no_documents(spark)).count() == 0
