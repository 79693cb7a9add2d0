"""Registered queries over the documents and pages tables, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retainframe.session import shared_dir

from . import bpe, collocations, divergence, langid, lines, positional, quality, secrets, sharding, simhash, suffixes, toxicity, warc
from .common import table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SHARDS = 40


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of the trained model for every document."""
    documents = table(spark, sf_dir, "documents")
    return quality.quality_table(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op4_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels of three folds of four."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(documents, labels.where(~held_out))
    scored = toxicity.score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    pages = table(spark, sf_dir, "pages")
    read = warc.read_archives(warc.write_archives(pages, shared_dir(spark, "warc")), with_payload=False)
    return read.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT h, max(page_id) AS last FROM p GROUP BY h HAVING count(*) > 1
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    (((instr('0123456789abcdef', substr(p.h, (5 * i) // 4 + 1, 1)) - 1) * 16
      + instr('0123456789abcdef', substr(p.h || '0', (5 * i) // 4 + 2, 1)) - 1) >> (3 - (5 * i) % 4)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h"""


def op5_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_entropy_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and windows of high entropy."""
    found = secrets.secret_table(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"), "n_entropy")


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are near copies of earlier ones."""
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op7_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 50 bytes in documents with smaller ids cover."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False).drop("spans", "kept")


OP7_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), p AS (
  SELECT r, doc_id, i, substr(x, 2 * i + 1, 100) AS g FROM (SELECT *, unnest(range(greatest(0, length(x) // 2 - 49))) AS i FROM d)
), m AS (
  SELECT g, min(doc_id) AS least FROM p GROUP BY g HAVING min(doc_id) <> max(doc_id) OR bool_or(doc_id IS NULL)
), s AS (
  SELECT r, i FROM p JOIN m USING (g) WHERE least < coalesce(doc_id, 9223372036854775807)
), c AS (
  SELECT DISTINCT r, i + k AS b FROM s, (SELECT unnest(range(50)) AS k)
), runs AS (
  SELECT r, min(b) AS a, max(b) + 1 AS e FROM (SELECT r, b, b - row_number() OVER (PARTITION BY r ORDER BY b) AS run FROM c) GROUP BY r, run
), gaps AS (
  SELECT r, a AS until, coalesce(lag(e) OVER w, 0) AS since, e FROM runs WINDOW w AS (PARTITION BY r ORDER BY a)
), kept AS (
  SELECT r, sum(gaps.e - until) AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * since + 1, 2 * (until - since)), '' ORDER BY since) || substr(any_value(x), 2 * max(gaps.e) + 1) AS y
  FROM gaps JOIN d USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def op8_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases of ten words in every document."""
    found = positional.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark) WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM b)
), dw AS (
  SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)
), hit AS (
  SELECT r, s, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n
), h AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r
), i AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)"""


def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the public byte-level tokenizer."""
    return bpe.token_table(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the languages of three folds of four."""
    documents = table(spark, sf_dir, "documents")
    held_out = toxicity.held_out(F.col("doc_id"))
    model = langid.fit(documents.where(~held_out))
    return langid.predict(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that a source overuses most."""
    return divergence.divergences(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM (SELECT lang, source, r, unnest(w) AS term FROM (SELECT *, row_number() OVER () AS r FROM d)) GROUP BY ALL
), t AS (
  SELECT lang, term, sum(n) AS m FROM c GROUP BY ALL HAVING sum(docs) >= 30
), v AS (
  SELECT lang, count(*) AS kept, sum(m) AS lang_n FROM t GROUP BY lang
), g AS (
  SELECT lang, source, coalesce(sum(n) FILTER (m IS NOT NULL), 0) AS group_n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT c.*, m FROM c JOIN t USING (lang, term)) USING (lang, source) GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, t.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)::HUGEINT) // (group_n + 5 * kept)::HUGEINT AS p, 1 + (1000000000::HUGEINT * (m + 5)::HUGEINT) // (lang_n + 5 * kept)::HUGEINT AS q
  FROM g JOIN v USING (lang) JOIN t USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
), pair AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value
  FROM (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source)
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) USING (lang, source, item)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two and three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS s FROM (SELECT *, unnest([1, 2, 3]) AS k FROM w))
  ) GROUP BY ALL
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cut AS (
  SELECT lang, phrase, k, f AS a, j, array_to_string(w[1 : j], ' ') AS x, array_to_string(w[j + 1 : k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM c)
), s AS (
  SELECT cut.lang, cut.phrase, cut.k, a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = cut.x AND x.k = j JOIN f AS y ON y.lang = cut.lang AND y.phrase = cut.y AND y.k = cut.k - j
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, j) = 1
), big AS (
  SELECT lang, phrase, max(f) AS f FROM (SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT low.* FROM low LEFT JOIN big ON big.lang = low.lang AND big.phrase = low.phrase AND low.k = 2 WHERE big.f IS NULL OR 100 * big.f < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op4_noisy_channel": op4_noisy_channel,
    "op2_zip_archives": op2_zip_archives,
    "op3_entropy_windows": op3_entropy_windows,
    "op6_fuzzy_lines": op6_fuzzy_lines,
    "op7_suffix_sort": op7_suffix_sort,
    "op8_positional_index": op8_positional_index,
    "op5_simhash_pigeonhole": op5_simhash_pigeonhole,
    "op9_sampled_splitters": op9_sampled_splitters,
    "op10_bpe_segment_tree": op10_bpe_segment_tree,
    "op11_hyperdimensional_language": op11_hyperdimensional_language,
    "op12_source_divergence": op12_source_divergence,
    "op13_phrase_collocations": op13_phrase_collocations,
}
SQL: dict[str, str] = {"op2_zip_archives": OP2_SQL, "op7_suffix_sort": OP7_SQL, "op8_positional_index": OP8_SQL, "op12_source_divergence": OP12_SQL, "op13_phrase_collocations": OP13_SQL}
