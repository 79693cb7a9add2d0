"""Markup, lines, chunks, insights and retrieval on small texts."""

import itertools
import math
import pathlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retainframe.functions import chunking
from retainframe.functions.chunking import fixed_chunks, recursive_chunks
from retainframe.functions.markup import body_lines, html_text
from retainframe.operators.campaign import insight_text
from retainframe.operators.corpus import chunk, document_text, drop_copies, top_insights
from retainframe.operators.retrieval import fit_vocabulary, retrieve_by_text, retrieve_by_vector, vocabulary_vector
from retainframe.operators.text_index import build_index, search
from retainframe.plans.corpus import clean_corpus, insights, retrieve


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_visible_text_literal_cases(spark):
    nav = "<nav>" + " ".join(f'<a href="/{x}"><span>{x}</span></a>' for x in ("Home", "News", "Shop", "Help")) + "</nav>"
    assert one(spark, nav, html_text) == "\nHome News Shop Help\n"
    assert one(spark, nav, lambda c: body_lines(html_text(c))) == ""
    assert one(spark, "<p>a<b>b</b>c<path d='1'>d</p><pre>e</pre>", html_text) == "\nabcd\n\ne\n"
    assert one(spark, "&#65;&#x42;&#39;&#38;lt; &mdash; &eacute; &unknown; &#0; 1 < 2", html_text) == "AB'&lt; \u2014 \u00e9 &unknown; \ufffd 1 < 2"
    assert one(spark, "&#128512;&amp;#39;", html_text) == "\U0001f600&#39;"


def test_html_to_text(spark):
    html = "<title>A &amp;lt; B</title><SCRIPT x='1'>if(a<b){}</SCRIPT><style>\np{}</style><!-- no\n --><p>x&nbsp;y<b>z</b></p><br/>1 &lt; 2"
    assert one(spark, html, html_text) == "\nA &lt; B\n\nx\xa0yz\n\n1 < 2"


def test_body_lines(spark):
    nine, ten = " ".join(["w"] * 9), " ".join(["w"] * 10)
    double = " ".join(["w"] * 8) + "  w"  # the double space counts one piece more
    assert one(spark, f"{nine}\n\n\t{ten} \n{double}\n　{ten}\xa0", body_lines) == "\n\n".join([ten, double, ten])
    assert one(spark, nine, body_lines) == ""
    assert one(spark, "a  b", lambda t: body_lines(t, 3)) == "a  b"


def test_document_lines(spark):
    lines = [("d", 0, 0, "  abcdefghij-- "), ("d", 0, 1, "short"), ("d", 0, 2, "klmnopqrst"), ("d", 2, 0, "page two has text"), ("d", 1, 0, "page one has text"), ("e", 0, 0, "tiny"), ("f", 0, 0, "-" * 10)]
    frame = spark.createDataFrame(lines, "doc string, page_no int, line_no int, line string").repartition(5)
    assert {r["title"]: r["content"] for r in document_text(frame).collect()} == {"d": "abcdefghijklmnopqrst page one has text page two has text"}
    assert {r["title"]: r["content"] for r in document_text(frame, [2]).collect()} == {"d": "page two has text"}


def test_many_lines_keep_their_order(spark):
    lines = [("d", i // 20, i % 20, f"line number {i:05d}") for i in range(3000)]
    random.Random(1).shuffle(lines)
    frame = spark.createDataFrame(lines, "doc string, page_no int, line_no int, line string").repartition(7)
    assert document_text(frame).first()["content"] == " ".join(f"line number {i:05d}" for i in range(3000))


@pytest.mark.parametrize("length", [0, 1, 50, 51, 1450, 1500, 1501, 2950, 2951, 9000])
def test_fixed_chunks(spark, length):
    text = "".join(random.Random(length).choice("ab é\n😀") for _ in range(length))
    found = one(spark, text, fixed_chunks)
    expected = [text[i:i + 1500] for i in range(0, max(length - 50, 1), 1450)] if length else []
    assert found == expected
    if length:
        assert found[0] + "".join(c[50:] for c in found[1:]) == text


def test_recursive_chunks_by_hand(spark):
    def split(text, size, overlap):
        return one(spark, text, recursive_chunks(size, overlap))

    assert split("aa bb cc dd", 5, 0) == ["aa bb", "cc", "dd"]
    assert split("aa bb cc dd", 6, 3) == ["aa bb", "bb cc", "cc dd"]
    assert split("one\n\ntwo three four", 10, 0) == ["one", "two three", "four"]
    assert split("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert split("", 5, 0) == [] and split("  \n ", 5, 0) == []
    assert split("short", 50, 5) == ["short"]


def plain_cut(text, separators, size, overlap):
    """The rule piece by piece: cut at the first separator, pack what fits, cut the rest by the next ones."""
    separator, finer = separators[0], separators[1:]
    head, *rest = text.split(separator) if separator else [""] + list(text)
    pieces = [p for p in (head, *(separator + r for r in rest)) if p]
    held, out = [], []

    def flush():
        first = last = 0
        while last < len(held):
            if sum(map(len, held[first : last + 1])) > size and first < last:
                out.append("".join(held[first:last]))
                while first < last and (sum(map(len, held[first:last])) > overlap or sum(map(len, held[first : last + 1])) > size):
                    first += 1
            last += 1
        out.append("".join(held[first:last]))
        held.clear()

    for piece in pieces:
        if len(piece) < size or not finer:
            held.append(piece)
        else:
            flush()
            out.extend(plain_cut(piece, finer, size, overlap))
    flush()
    return [c.strip() for c in out if c.strip()]


@pytest.mark.parametrize("block", [64, 1 << 16])
def test_recursive_chunks_match_the_rule(spark, monkeypatch, block):
    monkeypatch.setattr(chunking, "BLOCK", block)
    rng = random.Random(block)

    def some_text():
        words = ["".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 5, 9, 14, 30]))) for _ in range(rng.randint(0, 60))]
        return "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\n\n", "\n\n\n", "\n\n\n\n", " \n", "\t"]) for w in words)

    texts = [some_text() for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    for size, overlap in ((20, 5), (12, 0), (40, 13)):
        for row in frame.select("i", recursive_chunks(size, overlap)(F.col("t")).alias("c")).collect():
            assert row["c"] == plain_cut(texts[row["i"]], chunking.SEPARATORS, size, overlap), texts[row["i"]]
    assert one(spark, None, recursive_chunks()) is None
    with pytest.raises(ValueError):
        recursive_chunks(50, 50)


def test_recursive_chunks_stay_in_the_jvm(spark):
    plan = spark.createDataFrame([("a",)], "t string").select(recursive_chunks()(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_recursive_chunks_cover_long_texts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 12))) for _ in range(4000)] + ["z" * 4000]
    text = "".join(w + rng.choice([" ", " ", " ", "\n", "\n\n"]) for w in words)
    chunks = one(spark, text, recursive_chunks())
    assert max(map(len, chunks)) <= 1500
    assert set(text.split()) - {"z" * 4000} <= set(" ".join(chunks).split())
    assert all(c in text for c in chunks)
    starts, place = [], 0
    for c in chunks:
        place = text.index(c, max(0, place - 50))  # a chunk reaches back by at most the overlap
        starts.append(place)
        place += len(c)
    gaps = [text[a + len(c):b] for a, c, b in zip(starts, chunks, starts[1:])]
    assert all(g.strip() == "" for g in gaps) and text[place:].strip() == ""


def test_chunk_rows(spark):
    rows = spark.createDataFrame([("t", "x" * 3000)], "title string, content string")
    assert [(r["title"], r["chunk_no"], len(r["text"])) for r in chunk(rows, "fixed").collect()] == [("t", 0, 1500), ("t", 1, 1500), ("t", 2, 100)]


def test_copies(spark):
    rows = spark.createDataFrame([(3, "A  b\n c"), (1, " a B c"), (2, "a b d")], "doc_id int, text string")
    assert {(r["doc_id"], r["copies"]) for r in drop_copies(rows, "doc_id").collect()} == {(1, 2), (2, 1)}


def greedy(rows, n, limit):
    taken = []
    for key, text, score in sorted(rows, key=lambda r: (-r[2], r[0])):
        words = set(text.split())
        if all(len(words & w) / len(words | w) < limit for _, w in taken):
            taken.append((key, words))
        if len(taken) == n:
            break
    return [k for k, _ in taken]


@pytest.mark.parametrize("batch", [2, 20])
def test_insights_match_greedy_choice(spark, batch):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.sample(vocabulary, 12)), float(rng.randint(0, 5))) for i in range(60)]
    rows += [(100 + i, rows[0][1], 9.0) for i in range(40)]  # a large group of copies on top
    rows += [(200 + i, rows[1][1] + " extra", 8.0) for i in range(3)]
    frame = spark.createDataFrame(rows, "chunk_id int, text string, score double").repartition(6)
    found = top_insights(frame, batch=batch).orderBy("insight_no").collect()
    assert [r["chunk_id"] for r in found] == greedy(rows, 5, 0.8)
    assert [r["insight_no"] for r in found] == [1, 2, 3, 4, 5]


def test_fewer_insights_than_asked(spark):
    rows = spark.createDataFrame([(1, "a b", 1.0), (2, "b a", 1.0), (3, "c", None)], "chunk_id int, text string, score double")
    assert [r["chunk_id"] for r in top_insights(rows).collect()] == [1]
    assert top_insights(rows.where("chunk_id = 3")).count() == 0
    text = insight_text(insights(rows)).first()[0]
    assert text == "ID: 1 | Insight: a b | Relevance: score 1.0000"


TEXTS = ["red apple pie", "green apple", "blue sky over the sea", "apple apple red", "nothing here"]


def tfidf(texts, query):
    rows = [Counter(re.findall(r"[^\W_]+", t.lower())) for t in texts]
    seen = Counter(i for r in rows for i in r)

    def unit(counts):
        v = {i: n * math.log((len(texts) + 1) / (seen[i] + 1)) for i, n in counts.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {i: x / length for i, x in v.items()} if length else v

    q = unit(Counter(re.findall(r"[^\W_]+", query.lower())))
    return [round(sum(x * q.get(i, 0) for i, x in unit(r).items()), 9) for r in rows]


def test_text_retrieval_matches_brute_force(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "chunk_id int, text string").repartition(3)
    scores = tfidf(TEXTS, "red apple")
    found = retrieve_by_text(frame, "red apple", k=3, threshold=0.3).collect()
    order = sorted(range(len(TEXTS)), key=lambda i: (-scores[i], i))[:3]
    assert {r["chunk_id"]: r["score"] for r in found} == pytest.approx({i: scores[i] for i in order if scores[i] >= 0.3})
    assert retrieve_by_text(frame, "?!", k=3).count() == 0


def some_corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    # a few words are nearly everywhere, one is everywhere
    return ["all " + " ".join(rng.choice(words[: rng.choice([3, 10, 60])]) for _ in range(rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("threshold, light, k", [(0.0, 5, 4), (0.3, 0, 50), (0.05, 10_000, 7), (0.5, 20, 3)])
def test_many_queries_match_brute_force(spark, threshold, light, k):
    texts, asked = some_corpus(1, 120), some_corpus(2, 25) + ["", "all", "never seen", "w1 never seen", "W1, w1! w50"]
    rows = spark.createDataFrame([(f"c{i:03d}", t) for i, t in enumerate(texts)], "chunk_id string, text string").repartition(5)
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string").repartition(3)
    index = build_index(rows)
    found = search(index, queries, k, threshold, light_rows=light).collect()
    got = {(r["query_id"], r["row"]): r["score"] for r in found}
    assert len(got) == len(found)
    for q, query in enumerate(asked):
        scores = tfidf(texts, query)
        order = sorted((i for i in range(len(texts)) if scores[i] > 0), key=lambda i: (-scores[i], i))[:k]
        expected = {f"c{i:03d}": scores[i] for i in order if scores[i] >= threshold}
        assert {row: s for (i, row), s in got.items() if i == q} == pytest.approx(expected, abs=2e-9), query


def test_common_terms_propose_nothing(spark):
    """A word of nearly every row is only looked up for rows that a rare word proposes."""
    texts = [f"common r{i}" for i in range(200)] + ["plain r7"]
    rows = spark.createDataFrame(list(enumerate(texts)), "chunk_id int, text string")
    index = build_index(rows)
    queries = spark.createDataFrame([(0, "common r7")], "query_id int, text string")
    kept = [r["row"] for r in search(index, queries, 5, 0.5).collect()]
    assert sorted(kept) == [7, 200]
    terms = {r["term"]: (r["n_rows"], r["peak"]) for r in index.terms.collect()}
    assert terms["common"][0] == 200 and terms["common"][1] < 0.05 and index.n == 201
    assert not any(f.name.startswith("hash") for f in index.postings.schema)


def test_text_index_edge_cases(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "?! --"), (4, "same same"), (5, "x" * 100_000), (6, "Straße 12 été")], "chunk_id int, text string")
    index = build_index(rows)
    queries = spark.createDataFrame([(1, None), (2, "same"), (3, "ÉTÉ straße"), (4, "x" * 100_000)], "query_id int, text string")
    assert {(r["query_id"], r["row"]) for r in search(index, queries).collect()} == {(2, 4), (3, 6), (4, 5)}
    assert search(build_index(rows.limit(0)), queries).count() == 0
    assert search(index, queries.limit(0)).count() == 0


@pytest.mark.parametrize("shared, asked_at_once", [(0, 1 << 17), (5, 40), (1 << 17, 1)])
def test_many_blocks_match_brute_force(spark, monkeypatch, shared, asked_at_once):
    """Rows in many blocks, queries in several parts, and terms that are not sent to every task."""
    from retainframe.operators import text_index

    for name, value in (("BLOCK_ROWS", 9), ("SHARED_TERMS", shared), ("ASKED_AT_ONCE", asked_at_once), ("LISTED_TERMS", 10)):
        monkeypatch.setattr(text_index, name, value)
    texts, asked = some_corpus(3, 90), some_corpus(4, 12) + ["", "all", "w1 w59 all never"]
    rows = spark.createDataFrame([(1000 - i, t) for i, t in enumerate(texts)], "chunk_id long, text string").repartition(4)
    index = build_index(rows)
    assert index.n_blocks == 10 and index.postings.count() == index.postings.select("block", "term").distinct().count()
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, text string")
    for threshold, light in ((0.0, 10_000), (0.2, 3)):
        got = {(r["query_id"], r["row"]): r["score"] for r in search(index, queries, 6, threshold, light_rows=light).collect()}
        for q, query in enumerate(asked):
            scores = tfidf(texts, query)
            order = sorted((i for i in range(len(texts)) if scores[i] > 0), key=lambda i: (-scores[i], 1000 - i))[:6]
            expected = {1000 - i: scores[i] for i in order if scores[i] >= threshold}
            assert {row: s for (i, row), s in got.items() if i == q} == pytest.approx(expected, abs=2e-9), query


def test_text_index_with_repeated_and_null_keys(spark):
    """Rows under one key are one row, whose length is that of all of them; null is a key."""
    rows = spark.createDataFrame([("a", "red apple"), ("a", "red pear"), ("b", "red apple"), (None, "green apple"), ("c", "blue")], "chunk_id string, text string").repartition(3)
    index = build_index(rows)
    queries = spark.createDataFrame([(1, "red apple"), (None, "blue")], "query_id int, text string")
    w = {t: math.log(6 / (n + 1)) for t, n in (("red", 3), ("apple", 3), ("pear", 1), ("green", 1))}
    both = math.sqrt(2 * w["red"] ** 2 + w["apple"] ** 2 + w["pear"] ** 2)
    expected = {
        "a": (2 * w["red"] + w["apple"]) / both / math.sqrt(2), "b": 1.0, None: w["apple"] / math.hypot(w["green"], w["apple"]) / math.sqrt(2),
    }
    assert {r["row"]: r["score"] for r in search(index, queries, 5, 0.0).collect()} == pytest.approx(expected, abs=2e-9)


def _shared(monkeypatch, folder):
    from retainframe import session

    numbers = itertools.count()
    monkeypatch.setattr(session, "shared_dir", lambda spark, name: f"{folder}/{name}-{next(numbers)}")


def _tables(folder):
    sizes = {}
    for path in folder.rglob("*.parquet"):
        name = path.relative_to(folder).parts[0].rsplit("-", 1)[0]
        sizes[name] = sizes.get(name, 0) + path.stat().st_size
    return sizes


def test_a_written_table_leaves_no_shuffle_files(spark):
    from retainframe.session import materialize

    places = [pathlib.Path(str(d)) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    shuffled = lambda: {f.name for d in places for f in d.rglob("shuffle_*.data")}
    before = shuffled()
    kept = materialize(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("x")).count(), "counts")
    assert sorted(tuple(r) for r in kept.collect())[0] == (0, 143)
    assert shuffled() <= before


def test_retrieval_leaves_only_what_is_read(spark, monkeypatch, tmp_path):
    """The corpus goes once it is cut, the index once it is searched."""
    _shared(monkeypatch, tmp_path)
    pages = spark.range(200).select(F.col("id").alias("doc_key"), F.lit("t").alias("title"), F.concat(F.lit("<p>one two three four five six seven eight nine w"), F.col("id").cast("string"), F.lit("</p>")).alias("html"))
    lines = spark.range(400).select((F.col("id") % 50).alias("doc"), F.lit(0).alias("page_no"), F.col("id").alias("line_no"), F.concat(F.lit("a line of text "), F.col("id").cast("string")).alias("line"))
    found = retrieve(pages, lines, "w7 33", threshold=0.1)
    assert set(_tables(tmp_path)) == {"chunks", "found"}
    assert {r["chunk_id"] for r in found.collect()} == {"web#7#0", "local#33#0"}


def test_text_index_takes_less_room_than_the_text(spark, monkeypatch, tmp_path):
    rng = random.Random(7)
    common = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(3000)]
    texts = [" ".join(rng.choice(common[: rng.choice([30, 300, 3000])]) for _ in range(120)) for _ in range(2000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string").repartition(4)
    rows.write.parquet(str(tmp_path / "text"))
    _shared(monkeypatch, tmp_path / "index")
    build_index(spark.read.parquet(str(tmp_path / "text")))
    assert 0 < sum(_tables(tmp_path / "index").values()) < sum(p.stat().st_size for p in (tmp_path / "text").rglob("*.parquet"))


def test_vocabulary_vectors(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    vocabulary = fit_vocabulary(frame, "text")
    vectors = {r["i"]: r["v"] for r in frame.select("i", vocabulary_vector(F.col("text"), vocabulary).alias("v")).collect()}
    for i, text in enumerate(TEXTS):
        assert sum(a * b for a, b in zip(vectors[i], vectors[3])) == pytest.approx(tfidf(TEXTS, TEXTS[3])[i])
    with pytest.raises(ValueError):
        fit_vocabulary(frame, "text", most=3)


def test_vector_retrieval_keeps_the_threshold(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "chunk_id int, vector array<double>")
    found = retrieve_by_vector(frame, [1.0, 0.0], k=3, threshold=0.7)
    assert {r["chunk_id"]: round(r["score"], 4) for r in found.collect()} == {1: 1.0, 2: 0.7071}
    assert retrieve_by_vector(frame, [1.0, 0.0], k=3, threshold=1.0).count() == 1


def test_retrieval_over_both_sources(spark):
    words = "the quick brown fox jumps over the lazy dog today"
    pages = spark.createDataFrame([("p1", "T", f"<p>{words}</p>"), ("p2", "U", "<p>too short</p>")], "doc_key string, title string, html string")
    lines = spark.createDataFrame([("d", 0, 0, "entirely different content line")], "doc string, page_no int, line_no int, line string")
    assert {(r["origin"], r["doc_key"]) for r in clean_corpus(pages, lines).collect()} == {("web", "p1"), ("local", "d")}
    found = retrieve(pages, lines, "quick brown fox", threshold=0.2).collect()
    assert [r["chunk_id"] for r in found] == ["web#p1#0"]
    assert retrieve(pages.limit(0), lines.limit(0), "quick").count() == 0


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_cleaned_once(spark):
    """The steps of a page's cleaning stand once in the plan of the corpus, and not at all in that of its chunks."""
    from retainframe.plans.corpus import clean_corpus, corpus_chunks

    words = "one two three four five six seven eight nine ten"
    pages = spark.range(3).select(
        F.col("id").alias("doc_key"), F.lit("t").alias("title"),
        F.concat(F.lit("<p>"), F.when(F.col("id") > 0, F.concat(F.lit(f"{words} &amp; "), F.col("id").cast("string"))).otherwise("few words"), F.lit("</p>")).alias("html"),
    )
    lines = spark.range(2).select(F.lit("d").alias("doc"), F.lit(0).alias("page_no"), F.col("id").alias("line_no"), F.concat(F.lit("a line of text "), F.col("id").cast("string")).alias("line"))
    corpus = clean_corpus(pages, lines)
    assert _plan(corpus).count("<script") == 1
    assert {(r["origin"], r["doc_key"], r["content"]) for r in corpus.collect()} == {
        ("web", "1", f"{words} & 1"), ("web", "2", f"{words} & 2"), ("local", "d", "a line of text 0 a line of text 1"),
    }
    chunks = corpus_chunks(corpus)
    assert "<script" not in _plan(chunks)
    assert sorted(r["chunk_id"] for r in chunks.collect()) == ["local#d#0", "web#1#0", "web#2#0"]


def test_terms_are_sorted_without_a_lambda(spark):
    """A text's words are compared natively, not by an interpreted function per comparison."""
    from retainframe.operators.text_index import terms_of

    counted = spark.range(1).select(terms_of(F.concat(F.col("id").cast("string"), F.lit(" Zoo b zoo é b B"))).alias("t"))
    assert "array_sort(" not in _plan(counted)
    assert [tuple(t) for t in counted.first()["t"]] == [("0", 1), ("b", 3), ("zoo", 2), ("é", 1)]
