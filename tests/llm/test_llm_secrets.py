import base64
import hashlib
import math
import random
import re
import time
from collections import Counter

from llm_fixtures import edge_documents, no_documents

from retainframe.llm import secrets
from retainframe.llm.queries import QUERIES

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def plain(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        run = m[0]
        if len(run) < 20 or any(re.search(p, run) for p in secrets.ALLOWED):
            continue
        limit = 3.0 if re.fullmatch("[0-9a-fA-F]+", run) else 3.6 if re.fullmatch("[A-Z0-9]+", run) else 3.85
        spans = []
        for i in range(len(run) - 19):
            if -sum(n / 20 * math.log2(n / 20) for n in Counter(run[i : i + 20]).values()) >= limit - 1e-9:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + 20
                else:
                    spans.append([i, i + 20])
        out += [(m.start() + a, 3, m.start() + b) for a, b in spans]
    return sorted(out)


def test_matches_a_plain_version(spark):
    rng = random.Random(5)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ": ", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "0123abcdef", "deadbeef" * 3, "é", "😀", "\n", "x", "Zk3", "q9+/", "tok", "9f8e7d6c5b4a", "/usr/lib/"]
    texts = [None, "", "a"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += [base64.b64encode(bytes(rng.getrandbits(8) for _ in range(n))).decode() for n in (20, 40, 300, 3000)]
    df = secrets.secret_table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    for r in df.collect():
        want = plain(texts[r["doc_id"]])
        assert [tuple(x) for x in r["spans"]] == want
        assert [r[f"n_{k}"] for k in secrets.KINDS] == [sum(x[1] == k for x in want) for k in range(4)]


def test_allow_list(spark):
    allowed = ["example_key_0a9f8e7d6c5b4a39281", "0123456789abcdef0123456789ABCDEF", "11111111222222223333333344444444", "onlyLettersInThisVeryLongIdentifier", "path/of/words/only/here/v2", "123e4567-e89b-12d3-a456-426614174000"]
    found = secrets.secret_table(spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(allowed)] + [(99, "see aB3dE5gH7jK9mN2pQ4sT6vX8 here")], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_entropy"] for r in found.collect()} == {**dict.fromkeys(range(len(allowed)), 0), 99: 1}


def test_edge_rows(spark):
    secret = "password = hunter22 "
    edge = edge_documents(spark, [(8, secret * 2), (8, secret * 2)])
    got = {}
    for r in secrets.secret_table(edge).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == edge.count()
    assert [r["n_assign"] for r in got[8]] == [2, 2]
    assert got[1][0]["spans"] == [] == got[2][0]["spans"]
    assert secrets.secret_table(no_documents(spark)).count() == 0
    assert secrets.secret_table(edge, key="row").columns[0] == "row"
    many = spark.createDataFrame([(1, secret * 3_000)], "doc_id long, text string")
    assert secrets.secret_table(many).first()["n_assign"] == 3_000


def test_digests_of_the_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op3_entropy_windows"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        say = lambda xs: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in xs)
        assert r["spans"] == say(spans)
        assert r["base_sha256"] == hashlib.sha256(say(x for x in spans if x[1] < 3).encode()).hexdigest()


def test_harmless_text_does_not_hide_a_secret(spark):
    rng = random.Random(7)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    key = lambda among: "".join(rng.choice(among) for _ in range(40))
    kinds = {"sample_key=": letters + "0123456789", "/srv/example/": letters + "0123456789", "2024-01-01-": letters + "0123456789", "": letters}
    rows = [(1_000 * k + i, f"see {prefix}{key(among)} here") for k, (prefix, among) in enumerate(kinds.items()) for i in range(200)]
    found = {r["doc_id"] for r in secrets.secret_table(spark.createDataFrame(rows, "doc_id long, text string")).where("n_entropy > 0").collect()}
    shares = [sum(i // 1_000 == k for i in found) / 200 for k in range(len(kinds))]
    print(shares)
    assert min(shares) > 0.9
    harmless = ["wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "2024-01-01T10-00-00_build_of_the_day", "some_long_function_name_here", "HttpServerRequestHandlerFactory", "src/main/java/org/words/Thing12"]
    assert all(r["n_entropy"] == 0 for r in secrets.secret_table(spark.createDataFrame(list(enumerate(harmless)), "doc_id long, text string")).collect())


def test_a_very_long_candidate(spark):
    """The work of a step does not grow with the string: 200,000 characters within seconds, one span over all of them."""
    rng = random.Random(9)
    text = "".join(rng.choice(secrets.CHARACTERS) for _ in range(200_000))
    started = time.perf_counter()
    got = secrets.secret_table(spark.createDataFrame([(1, f"x {text} y")], "doc_id long, text string")).first()
    assert time.perf_counter() - started < 60
    spans = [(x["s"], x["e"]) for x in got["spans"] if x["kind"] == 3]
    assert sum(e - s for s, e in spans) > 199_000 and all(2 <= s < e <= 200_002 for s, e in spans)
