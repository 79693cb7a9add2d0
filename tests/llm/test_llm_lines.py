import os
import random

import pytest
from llm_fixtures import babble, components_of, edge_documents, no_documents

from retainframe.llm import common, components, lines


def plain(rows):
    """Kept texts by comparing all pairs of lines."""
    places = [(i, n, line) for i, t in rows for n, line in enumerate(lines.lines_of(t)) if line]
    known = sorted({x for _, _, x in places})
    root = components_of(known, [(a, b) for k, a in enumerate(known) for b in known[:k] if lines.jaccard(a, b) >= lines.THRESHOLD])
    first = {}
    for i, n, x in sorted(places):
        first.setdefault(root[x], (i, n))
    out = {}
    for i, t in rows:
        alone = lines.lines_of(t)
        out[i] = "\n".join(x for n, x in enumerate((t or "").split("\n")) if not alone[n : n + 1] or not alone[n] or first[root[alone[n]]] == (i, n)) if t else t
    return out


def varied(rng, line):
    words = line.split()
    words[rng.randrange(len(words))] = babble(rng, 1)
    return " ".join(words)


@pytest.mark.parametrize("paired", [8, 2])
def test_matches_all_pairs(spark, monkeypatch, paired):
    monkeypatch.setattr(lines, "PAIRED", paired)
    monkeypatch.setattr(lines, "BLOCK_BYTES", 4_000)
    rng = random.Random(1)
    common, pool = babble(rng, 40), [babble(rng, 30) for _ in range(30)]
    rows = []
    for i in range(120):
        own = [babble(rng, rng.randint(8, 25)) for _ in range(3)] + [rng.choice(pool), varied(rng, rng.choice(pool)), "short", ""]
        if i % 3 == 0:
            own.append(varied(rng, common) if i % 2 else common)
        rng.shuffle(own)
        rows.append((i, "\n".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    want = plain(rows)
    wrong = [i for i in want if got[i]["text"] != want[i]]
    assert len(wrong) <= 1, wrong  # banding may miss a pair near the threshold
    assert sum(r["n_removed"] for r in got.values()) > 100


def test_a_large_group_of_variants_matches_all_pairs(spark):
    """Variants of two related base lines: some like a base, some like other variants only, some like none."""
    rng = random.Random(5)
    base = babble(rng, 30)
    second = varied(rng, varied(rng, varied(rng, base)))
    known = {base, second}
    for _ in range(700):
        line = rng.choice((base, second))
        for _ in range(rng.choice((1, 1, 2, 3, 4, 5))):
            line = varied(rng, line)
        known.add(line)
        if rng.random() < 0.2:
            known.add(varied(rng, line))
    rows = list(enumerate(known))
    rng.shuffle(rows)
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    want = plain(rows)
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= 0.005 * len(rows), wrong  # banding may miss a pair near the threshold
    assert 1 < sum(bool(t) for t in got.values()) < 0.8 * len(rows)


def test_lines_within_the_threshold_but_apart_from_the_pivot_meet(spark):
    rng = random.Random(9)
    base = babble(rng, 25)
    known = {base}
    for _ in range(120):
        line = base
        for _ in range(rng.randint(1, 6)):
            line = varied(rng, line)
        known |= {line, varied(rng, line)}
    known = [base, *sorted(known - {base})]
    table = spark.createDataFrame(list(enumerate(known)), "h long, line string").repartition(3)
    near = [lines.jaccard(base, x) >= lines.THRESHOLD for x in known]
    rows = [(i, 0, 0 if near[i] else i, not near[i]) for i in range(1, len(known))]
    found = lines.differences(spark.createDataFrame(rows, "h long, pivot long, root long, apart boolean").repartition(3), table)
    for r in found.collect():
        x, p = lines.shingles(known[r["h"]]), lines.shingles(base)
        assert (r["pivot_size"], r["n_added"], r["n_lost"], len(r["differing"])) == (len(p), len(x - p), len(p - x), 8 * len(x ^ p))
    met = {(r["a"], r["b"]) for r in lines.meetings(lines.differing_rows(found)).collect()}
    pairs = [(i, j) for j in range(1, len(known)) for i in range(1, j)]
    want = {(i, j) for i, j in pairs if not (near[i] and near[j]) and lines.jaccard(known[i], known[j]) >= lines.THRESHOLD}
    assert len(want) > 30 and want <= met and len(met) < len(pairs) / 4


def test_meetings_lose_no_pair_of_the_threshold(spark):
    rng = random.Random(11)
    words = babble(rng, 40).split()
    swaps = [(i, babble(rng, 1)) for i in rng.sample(range(40), 12)]  # few edits, so that many variants share them
    pivot, made = " ".join(words), set()
    while len(made) < 150:
        one = list(words)
        for i, w in rng.sample(swaps, rng.randint(1, 8)):
            one[i] = w
        made.add(" ".join(one) + rng.choice(["", " and more", babble(rng, 2)]))
    known = {lines.line_hash(x)[0]: x for x in [pivot, *made]}
    top = lines.line_hash(pivot)[0]
    apart = {h: lines.jaccard(x, pivot) < lines.THRESHOLD for h, x in known.items()}
    roots = {h: h if apart[h] else top for h in known}
    members = spark.createDataFrame([(h, top, roots[h], apart[h]) for h in known if h != top], "h long, pivot long, root long, apart boolean")
    texts = spark.createDataFrame(list(known.items()), "h long, line string")
    met = {(r.a, r.b) for r in lines.meetings(lines.differing_rows(lines.differences(members, texts))).collect()}
    order = sorted(h for h in known if h != top)
    pairs = [(a, b) for k, b in enumerate(order) for a in order[:k] if roots[a] != roots[b] and (apart[a] or apart[b])]
    alike = {(a, b) for a, b in pairs if lines.jaccard(known[a], known[b]) >= lines.THRESHOLD}
    assert len(alike) > 20 and any(apart[a] != apart[b] for a, b in alike)
    assert alike <= met and len(met) < len(pairs) / 2


def test_groups_of_several_bands_about_one_text_are_one(spark):
    rows = [(band, pivot, h) for band, pivot in enumerate((1, 20, 21, 2)) for h in (1, 2, 3, 4, 20, 21)]  # two bands have a stranger for pivot
    rows += [(9, 30, h) for h in (30, 31)] + [(10, 1, h) for h in (1, 2, 3)]  # strangers only, and a group of one component
    found = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (3, 4)], "a long, b long")
    rooted = spark.createDataFrame([(b, p, h, 1 if h < 5 else h) for b, p, h in rows], "band long, pivot long, h long, root long")
    got = sorted(map(tuple, lines.around(rooted.repartition(3), found).select("h", "root", "main", "pivot").collect()))
    assert got == [(2, 1, 1, 1), (3, 1, 1, 1), (4, 1, 1, 1), (20, 20, 1, 1), (21, 21, 1, 1), (31, 31, 30, 30)]


def test_similarities_of_more_pairs_than_are_sorted_at_once():
    rng = random.Random(8)
    base = [babble(rng, 4) for _ in range(400)]
    x = [base[i % 400] for i in range(2 * lines.PAIRS + 5)]
    y = [base[i % 397] if i % 3 else varied(rng, x[i]) for i in range(len(x))]
    assert 2 * lines.PAIRS <= 1 << lines.PAIR_BITS  # the lines of a slice are numbered by so many bits
    assert lines.similarities(x, y).tolist() == [lines.jaccard(a, b) for a, b in zip(x, y)]


def test_similarities():
    rng = random.Random(4)
    x = [babble(rng, rng.randint(10, 30)) for _ in range(300)] + ["a" * 10, "a" * 50_000]
    y = [varied(rng, v) if v[0] != "a" and rng.random() < 0.7 else rng.choice(x) for v in x]
    assert lines.similarities(x, y).tolist() == [lines.jaccard(a, b) for a, b in zip(x, y)]
    assert lines.similarities([], []).tolist() == []


def test_jaccard_and_bands():
    a = "the quick brown fox jumps over the lazy dog and runs"
    assert lines.jaccard(a, a) == 1.0 and lines.jaccard(a, a[::-1]) == 0.0
    found = lines.bands([a, a, a.upper()])
    assert (found[0] == found[1]).all() and not (found[0] == found[2]).any()
    assert (lines.bands([a[:40], a])[1] == found[0]).all()  # the same alone and in company
    assert lines.bands([]).shape == (0, lines.BANDS)


def test_edge_rows(spark):
    line = "this very line occurs in several of the documents"
    edge = edge_documents(spark, [(9, f"{line}\n\n{line}\nshort"), (8, f"  {line} \nother")])
    out = lines.dedup_lines(edge)
    assert out.columns == [*edge.columns, "_n_lines", "n_removed"]  # a taken name is set apart
    got = out.collect()
    assert len(got) == edge.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[1] == [None] and by[2] == [""] and by[3] == [" \n\t"] and sorted(by[4]) == ["", "same row"]
    assert by[8] == [f"  {line} \nother"] and by[9] == ["\nshort"]
    assert len(by[5][0]) == 170_000
    assert lines.dedup_lines(no_documents(spark)).count() == 0
    twice = spark.createDataFrame([(1, line), (1, line), (None, line)], "doc_id long, text string")
    assert sorted(r["text"] for r in lines.dedup_lines(twice).collect()) == ["", "", line]


def test_short_lines(spark):
    rows = [(1, "All rights reserved.\nalone"), (2, "first\nAll rights reserved."), (3, "  All rights reserved. \nten chars!"), (4, "ten chars!\nlast")]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {1: (rows[0][1], 2, 0), 2: ("first", 2, 1), 3: ("ten chars!", 2, 1), 4: ("last", 2, 1)}
    rows = [(1, "}\nend\n\nEnd"), (2, "}\nend \n\nends"), (3, "}"), (4, "nine char\nnine chars")]  # below a shingle only equal lines are alike
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {1: rows[0][1], 2: "\nends", 3: "", 4: rows[3][1]}


def test_only_what_the_result_reads_is_kept(spark, monkeypatch):
    written, removed = [], []
    shared = common.shared_dir
    monkeypatch.setattr(common, "shared_dir", lambda spark, name: written.append(shared(spark, name)) or written[-1])
    docs = spark.createDataFrame([(1, "a line that occurs twice in here\nother text"), (2, "a line that occurs twice in here")], "doc_id long, text string")
    out = lines.dedup_lines(docs)
    removed = [path for path in written if not os.path.exists(path)]
    assert len(written) - len(removed) == 2 and len(removed) > 10
    assert sorted(r["n_removed"] for r in out.collect()) == [0, 1]
    assert not common._OPEN


def test_only_differences_at_which_lines_can_meet_are_given(spark):
    rng = random.Random(13)
    base = babble(rng, 40)
    one, other = varied(rng, base), babble(rng, 40)
    known = [base, *{varied(rng, one) for _ in range(60)}, *{varied(rng, other) for _ in range(6)}]
    near = [lines.jaccard(base, x) >= lines.THRESHOLD for x in known]
    assert 30 < sum(near) <= 61
    table = spark.createDataFrame(list(enumerate(known)), "h long, line string")
    rows = [(i, 0, 0 if near[i] else i, not near[i]) for i in range(1, len(known))]
    given = lines.differing_rows(lines.differences(spark.createDataFrame(rows, "h long, pivot long, root long, apart boolean"), table)).collect()
    of = {}
    for r in given:
        of.setdefault(r["difference"], []).append((r["apart"], r["first"]))
    # the variants of one edit share their differences with each other only, and need not meet
    for sides in of.values():
        assert any(apart for apart, _ in sides) and ((False, True) in sides or sides.count((True, True)) > 1)
    assert given


def test_components_that_are_stars_take_no_step(spark, monkeypatch):
    made, real = [], components.keep
    monkeypatch.setattr(components, "keep", lambda df, name: made.append(name) or real(df, name))
    found = components.components(spark.createDataFrame([(1, k) for k in range(2, 40)] + [(50, 51)], "a long, b long"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {(k, 1) for k in range(1, 40)} | {(50, 50), (51, 50)}
    assert made == ["edges"]
