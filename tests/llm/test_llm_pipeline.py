import corpus_pipeline
import pytest
from llm_fixtures import components_of, edge_documents, no_documents
from test_llm_lines import plain as plain_lines
from test_llm_positional import plain as plain_phrases
from test_llm_simhash import plain_fingerprint

from retainframe.llm.common import keep
from retainframe.llm.queries import TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], sf_dir), name))
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "bpe"]
    assert all(s.columns == COLUMNS for s in steps[:-1])
    assert ids(steps[5]) == ids(steps[4]) <= ids(steps[3]) <= ids(steps[2]) <= ids(steps[1]) <= ids(steps[0])


def test_toxic_documents_go_and_others_stay(spark, sf_dir, steps):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = ids(steps[1])
    assert sum(i in left for i, t in labels.items() if t) <= 0.1 * sum(labels.values())
    assert sum(i not in left for i, t in labels.items() if not t) <= 0.02 * len(labels)


def test_lines(steps):
    want = plain_lines([(r["doc_id"], r["text"]) for r in steps[1].collect()])
    got = {r["doc_id"]: r for r in steps[2].collect()}
    assert sum(got[i]["text"] != want[i] for i in got) <= 0.01 * len(got)
    assert all(len(r["text"]) == r["n_chars"] for r in got.values())
    assert all(not want[i].strip() for i in want if i not in got)


def test_near_copies(steps):
    fps = {r["doc_id"]: plain_fingerprint(r["text"], 3) for r in steps[2].collect()}
    root = components_of(sorted(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert ids(steps[3]) == {i for i, r in root.items() if i == r}


def test_contaminated_documents_go(spark, sf_dir, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {k for k, _, _, _, bad in plain_phrases([(r["doc_id"], r["text"]) for r in steps[3].collect()], items) if not bad}
    assert ids(steps[4]) == want


def test_tokens(steps):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(TOKENIZER)
    texts = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    for r in steps[5].collect():
        assert r["ids"] == theirs.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_edge_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edge_documents(spark), no_documents(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs, before = keep(stage(spark, docs, str(tmp_path)), name), docs
            assert docs.columns == before.columns and docs.count() <= n
        assert corpus_pipeline.tokens(spark, docs, str(tmp_path)).count() == docs.count()


def test_run_is_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_decontamination_does_not_write_the_documents_again(spark, tmp_path, monkeypatch):
    item = " ".join(f"word{i}" for i in range(12))
    rows = [(1, f"so {item} end"), (1, f"so {item} end"), (None, f"so {item} end"), (1, "clean"), (None, "clean"), (2, None), (3, "")]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    made = []
    monkeypatch.setattr(corpus_pipeline, "keep", lambda df, name: made.append(df.columns) or keep(df, name))
    left = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert left.columns == ["doc_id", "text"] and sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, rows[3:]))
    assert made and all("text" not in columns for columns in made)
