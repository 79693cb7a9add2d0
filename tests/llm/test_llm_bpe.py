import random

from llm_fixtures import edge_documents, no_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retainframe.llm import bpe
from retainframe.llm.queries import TOKENIZER


def test_same_ids_and_texts_as_the_library():
    theirs, ours, rng = Tokenizer.from_file(TOKENIZER), bpe.ByteBpe(TOKENIZER, remember=50), random.Random(1)
    parts = [*"ab c'sreé \n\t\r\x0b\x1c\x85\xa0 ​日Ⅻǅ😀.!-09\x00", "<|endoftext|>", "'ll", " the", "ing"]
    for _ in range(2_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids
        some = [rng.randint(0, 50_256) for _ in range(6)]
        assert ours.decode(some) == theirs.decode(some, skip_special_tokens=False)
        assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False) == text
    run = "ab" * 20_000
    assert ours.encode(run) == theirs.encode(run, add_special_tokens=False).ids


def test_edge_rows_round_trip(spark):
    docs = edge_documents(spark, [(6, "é😀<|endoftext|>�")])
    coded = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER)
    assert coded.columns == [*docs.columns, "ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == docs.count()
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert [r["ids"] for r in rows if not r["text"]] == [[], []]
    assert bpe.token_table(no_documents(spark), TOKENIZER).count() == 0
    replaced = bpe.encode(docs, TOKENIZER, ids="key")  # a column of that name is replaced
    assert dict(replaced.dtypes)["key"] == "array<int>" and len(replaced.columns) == len(docs.columns)


def test_token_table(spark):
    import hashlib

    theirs = Tokenizer.from_file(TOKENIZER)
    docs = spark.createDataFrame([(1, "Hello there, 42 ways."), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.token_table(docs, TOKENIZER).collect()}
    ids = theirs.encode("Hello there, 42 ways.", add_special_tokens=False).ids
    assert got[1]["n_tokens"] == len(ids) and got[2]["n_tokens"] == 0
    assert got[1]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert docs.select(F.sha2(F.encode("text", "UTF-8"), 256)).first()[0] == got[1]["decoded_sha256"]
