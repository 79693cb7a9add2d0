"""Page and document text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.markup import ENTITIES, HTML_STEPS, body_lines
from ..functions.strings import WHITE_SPACE
from ..operators.campaign import insight_text
from ..operators.corpus import chunk, document_text, drop_copies, page_bodies, page_text, top_insights
from ..operators.retrieval import retrieve_many
from ..plans.corpus import clean_corpus, corpus_chunks, insights, retrieve
from ..session import Scratch, materialize
from . import inputs
from .inputs import rounded, table, tidy

RETRIEVAL_THRESHOLD = 0.05

# ---------------------------------------------------------------- Spark


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages with the title a search result would carry."""
    fetched = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "doc_key")
    return fetched.withColumn("title", F.regexp_extract("html", "<title>([^<]*)</title>", 1))


def page_texts(spark, sf_dir):
    return tidy(page_text(pages(spark, sf_dir)))


def page_body_lines(spark, sf_dir):
    return tidy(page_bodies(page_text(pages(spark, sf_dir))).select("doc_key", "content"))


def body_lines_of_documents(spark, sf_dir):
    return tidy(table(spark, sf_dir, "documents").select("doc_id", body_lines(F.col("text")).alias("content")))


def document_lines(spark, sf_dir):
    return tidy(document_text(inputs.lines(spark, sf_dir)))


def document_pages(spark, sf_dir):
    return tidy(document_text(inputs.lines(spark, sf_dir), page_numbers=[0, 2]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("title"), F.col("text").alias("content"))


def chunk_fixed(spark, sf_dir):
    return tidy(chunk(documents(spark, sf_dir), "fixed"))


def chunk_recursive(spark, sf_dir):
    return tidy(chunk(documents(spark, sf_dir), "recursive"))


def distinct_texts(spark, sf_dir):
    return tidy(drop_copies(table(spark, sf_dir, "documents"), "doc_id"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a stand-in score: words per line."""
    docs = table(spark, sf_dir, "documents")
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return docs.select(
        F.col("doc_id").alias("chunk_id"), "text", F.round((spaces + 1) / (breaks + 1), 6).alias("score")
    )


def best_insights(spark, sf_dir):
    return tidy(top_insights(scored_documents(spark, sf_dir)).select("insight_no", "chunk_id", "score"))


def insight_prompt(spark, sf_dir):
    return tidy(insight_text(insights(scored_documents(spark, sf_dir))))


def corpus(spark, sf_dir):
    return tidy(clean_corpus(pages(spark, sf_dir), inputs.lines(spark, sf_dir)))


def chunks_of_corpus(spark, sf_dir):
    lines = inputs.lines(spark, sf_dir)
    return tidy(corpus_chunks(clean_corpus(pages(spark, sf_dir), lines), "fixed"))


def corpus_retrieve(spark, sf_dir):
    """Chunks that resemble the longest benchmark passage."""
    query = table(spark, sf_dir, "benchmark").agg(F.max_by("text", F.struct(F.length("text"), "item_id"))).first()[0]
    return tidy(retrieve(pages(spark, sf_dir), inputs.lines(spark, sf_dir), query, 50, RETRIEVAL_THRESHOLD))


def corpus_retrieve_many(spark, sf_dir):
    """For every benchmark passage the chunks that resemble it."""
    with Scratch(spark) as scratch:
        chunks = scratch.hold(materialize(corpus_chunks(clean_corpus(pages(spark, sf_dir), inputs.lines(spark, sf_dir))), "chunks"))
    passages = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return tidy(retrieve_many(chunks, passages, 10, RETRIEVAL_THRESHOLD))


QUERIES = {
    "page_text": page_texts,
    "page_body_lines": page_body_lines,
    "body_lines": body_lines_of_documents,
    "document_lines": document_lines,
    "document_page_selection": document_pages,
    "chunk_fixed": chunk_fixed,
    "chunk_recursive": chunk_recursive,
    "distinct_texts": distinct_texts,
    "top_insights": best_insights,
    "insight_text": insight_prompt,
    "clean_corpus": corpus,
    "corpus_chunks": chunks_of_corpus,
    "corpus_retrieve": corpus_retrieve,
    "corpus_retrieve_many": corpus_retrieve_many,
}

# ---------------------------------------------------------------- SQL

BLANKS = "'" + WHITE_SPACE + "'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def html_sql(html: str) -> str:
    for pattern, replacement in HTML_STEPS:
        html = f"regexp_replace({html}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    for entity, character in ENTITIES:
        html = f"replace({html}, {quoted(entity)}, {quoted(character)})"
    return html


def body_sql(text: str) -> str:
    lines = f"list_transform(string_split({text}, chr(10)), lambda l: trim(l, {BLANKS}))"
    kept = f"list_filter({lines}, lambda l: length(l) - length(replace(l, ' ', '')) + 1 >= 10)"
    return f"coalesce(array_to_string({kept}, chr(10) || chr(10)), '')"


PAGES_SQL = f"""
fetched AS (
  SELECT page_id AS doc_key, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, {html_sql('html')} AS text FROM pages),
bodies AS (SELECT doc_key, title, {body_sql('text')} AS content FROM fetched)"""


def document_sql(where: str = "TRUE", name: str = "local_texts") -> str:
    return f"""{inputs.LINES_SQL},
pieces AS (
  SELECT doc, page_no, line_no, CASE WHEN ends_with(clean, '-') THEN rtrim(clean, '-') ELSE clean || ' ' END AS piece
  FROM (SELECT *, trim(line, {BLANKS}) AS clean FROM lines) t WHERE length(clean) >= 10 AND {where}),
{name} AS (
  SELECT title, content FROM (
    SELECT doc AS title, trim(string_agg(piece, '' ORDER BY page_no, line_no), {BLANKS}) AS content FROM pieces GROUP BY 1) t
  WHERE content <> '')"""


def fixed_sql(rows: str, columns: str) -> str:
    return f"""SELECT {columns}, CAST(n AS BIGINT) AS chunk_no, substring(content, 1 + n * 1450, 1500) AS text
FROM (SELECT *, unnest(range(greatest(1, CAST(ceil((length(content) - 50) / 1450.0) AS BIGINT)))) AS n
      FROM {rows} WHERE content <> '') t"""


def recursive_sql(rows: str, columns: str, size: int = 1500, overlap: int = 50) -> str:
    """Common table expressions up to ``chunked``: pieces by separator, runs of pieces that fit, and a chunk per recursion step."""
    parts = [f"cut0 AS (SELECT row_number() OVER () AS r, CAST([] AS BIGINT[]) AS path, content AS t, {columns} FROM {rows})"]
    todo, packs = "cut0", []
    for i, separator in enumerate(("chr(10) || chr(10)", "chr(10)", "' '", None)):
        if separator is None:
            parts.append(f"""run{i} AS (
  SELECT r, path, t, FALSE AS long, range(0, length(t) + 1) AS b FROM {todo})""")
        else:
            parts.append(f"""run{i} AS (
  SELECT r, list_append(path, run) AS path, string_agg(p, '' ORDER BY j) AS t, bool_or(long) AS long,
    list_append(list(CAST(upto - length(p) AS BIGINT) ORDER BY j), CAST(max(upto) AS BIGINT)) AS b
  FROM (
    SELECT *, sum(length(p)) OVER (PARTITION BY r, path, run ORDER BY j) AS upto FROM (
      SELECT *, CAST(sum(CASE WHEN long OR before THEN 1 ELSE 0 END) OVER (PARTITION BY r, path ORDER BY j) AS BIGINT) AS run FROM (
        SELECT *, coalesce(lag(long) OVER (PARTITION BY r, path ORDER BY j), FALSE) AS before FROM (
          SELECT *, length(p) >= {size} AS long FROM (
            SELECT r, path, j, CASE WHEN j = 1 THEN x ELSE {separator} || x END AS p FROM (
              SELECT r, path, unnest(string_split(t, {separator})) AS x, unnest(range(1, len(string_split(t, {separator})) + 1)) AS j FROM {todo}))
          WHERE p <> ''))))
  GROUP BY r, path, run)""")
        packs.append(f"SELECT r, path, t, b FROM run{i} WHERE NOT long")
        todo = f"(SELECT r, path, t FROM run{i} WHERE long) l{i}"
    return ",\n".join(parts) + f""",
packs AS ({" UNION ALL ".join(packs)}),
steps AS (
  SELECT r, path, t, b, 0 AS k, CAST(0 AS BIGINT) AS s, list_max(list_filter(b, lambda x: x <= {size})) AS e FROM packs
  UNION ALL
  SELECT r, path, t, b, k + 1, s, list_max(list_filter(b, lambda x: x <= s + {size})) FROM (
    SELECT r, path, t, b, k, list_min(list_filter(b, lambda x: x >= greatest(e - {overlap}, n - {size}))) AS s FROM (
      SELECT *, list_min(list_filter(b, lambda x: x > e)) AS n FROM steps WHERE e < length(t)) a) c),
chunked AS (
  SELECT {columns}, row_number() OVER (PARTITION BY r ORDER BY place, k) - 1 AS chunk_no, text FROM (
    SELECT r, path AS place, k, trim(substring(t, s + 1, e - s), {BLANKS}) AS text FROM steps) s JOIN cut0 USING (r) WHERE text <> '')"""


CORPUS_SQL = f"""{PAGES_SQL},{document_sql()},
corpus AS (
  SELECT 'web' AS origin, CAST(doc_key AS VARCHAR) AS doc_key, title, content FROM bodies WHERE content <> ''
  UNION ALL SELECT 'local', CAST(title AS VARCHAR), CAST(title AS VARCHAR), content FROM local_texts)"""


CHUNKS_SQL = f"""{CORPUS_SQL},{recursive_sql("corpus", "origin, doc_key, title")},
chunks AS (SELECT *, origin || '#' || doc_key || '#' || CAST(chunk_no AS VARCHAR) AS chunk_id FROM chunked)"""


def tfidf_sql(queries: str, k: int) -> str:
    """``found``: query_id, chunk_id, score of the k best chunks of the table ``chunks`` for every row of ``queries``."""
    def terms(rows: str, key: str) -> str:
        words = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
        return f"SELECT {key}, term, count(*) AS c FROM (SELECT {key}, unnest({words}) AS term FROM {rows}) u GROUP BY ALL"

    return f"""
tf AS ({terms('chunks', 'chunk_id')}),
df AS (SELECT term, count(*) AS d FROM tf GROUP BY term),
w AS (SELECT chunk_id, term, c * ln(((SELECT count(*) FROM chunks) + 1) / (d + 1)::DOUBLE) AS w FROM tf JOIN df USING (term)),
qw AS (
  SELECT query_id, term, c * ln(((SELECT count(*) FROM chunks) + 1) / (coalesce(d, 0) + 1)::DOUBLE) AS w
  FROM ({terms(queries, 'query_id')}) q LEFT JOIN df USING (term)),
scored AS (
  SELECT query_id, chunk_id, round(sum(w.w * qw.w) / any_value(wn) / any_value(qn), 9) AS score
  FROM qw JOIN w USING (term) JOIN (SELECT chunk_id, sqrt(sum(w * w)) AS wn FROM w GROUP BY 1) USING (chunk_id)
    JOIN (SELECT query_id, sqrt(sum(w * w)) AS qn FROM qw GROUP BY 1) USING (query_id)
  GROUP BY query_id, chunk_id HAVING sum(w.w * qw.w) > 0),
found AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS place FROM scored) t
  WHERE place <= {k} AND score >= {RETRIEVAL_THRESHOLD})"""


def insights_sql(n: int = 5) -> str:
    """Best row, then the rows not too similar to it, n times over."""
    similar = """len(list_intersect(r.w, b.w)) / (len(r.w) + len(b.w) - len(list_intersect(r.w, b.w)))::DOUBLE"""
    parts = ["""scored AS (
  SELECT doc_id AS key, text, round((length(text) - length(replace(text, ' ', '')) + 1)
      / (length(text) - length(replace(text, chr(10), '')) + 1)::DOUBLE, 6) AS score,
    list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w
  FROM documents)"""]
    rest = "scored"
    for i in range(1, n + 1):
        parts.append(f"best{i} AS MATERIALIZED (SELECT * FROM {rest} ORDER BY score DESC, key LIMIT 1)")
        parts.append(f"rest{i} AS MATERIALIZED (SELECT r.* FROM {rest} r, best{i} b WHERE coalesce({similar}, 1) < 0.8::DOUBLE)")
        rest = f"rest{i}"
    picked = " UNION ALL ".join(f"SELECT {i} AS insight_no, key, text, score FROM best{i}" for i in range(1, n + 1))
    return ",\n".join(parts) + f",\npicked AS ({picked})"


SQL = {
    "page_text": f"WITH {PAGES_SQL} SELECT doc_key, url, title, text FROM fetched",
    "page_body_lines": f"WITH {PAGES_SQL} SELECT doc_key, content FROM bodies",
    "body_lines": f"SELECT doc_id, {body_sql('text')} AS content FROM documents",
    "document_lines": f"WITH {document_sql()} SELECT * FROM local_texts",
    "document_page_selection": f"WITH {document_sql('page_no IN (0, 2)')} SELECT * FROM local_texts",
    "chunk_fixed": fixed_sql("(SELECT doc_id, source AS title, text AS content FROM documents) d", "doc_id, title"),
    "distinct_texts": f"""SELECT min(doc_id) AS doc_id, count(*) AS copies,
  sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'), {BLANKS})) AS text_hash FROM documents GROUP BY text_hash""",
    "top_insights": f"WITH {insights_sql()} SELECT CAST(insight_no AS BIGINT) AS insight_no, key AS chunk_id, score FROM picked",
    "insight_text": f"""WITH {insights_sql()}
SELECT string_agg('ID: ' || CAST(key AS VARCHAR) || ' | Insight: ' || text || ' | Relevance: score ' || printf('%.4f', score),
  chr(10) ORDER BY insight_no) AS insights FROM picked""",
    "clean_corpus": f"WITH {CORPUS_SQL} SELECT * FROM corpus",
    "chunk_recursive": f"""WITH RECURSIVE {recursive_sql("(SELECT doc_id, source AS title, text AS content FROM documents WHERE text IS NOT NULL)", "doc_id, title")}
SELECT doc_id, title, chunk_no, text FROM chunked""",
    "corpus_retrieve": f"""WITH RECURSIVE {CHUNKS_SQL},
asked AS (SELECT 0 AS query_id, max_by(text, (length(text), item_id)) AS text FROM benchmark),{tfidf_sql("asked", 50)}
SELECT chunks.*, {rounded("score")} AS score FROM found JOIN chunks USING (chunk_id)""",
    "corpus_retrieve_many": f"""WITH RECURSIVE {CHUNKS_SQL},
asked AS (SELECT item_id AS query_id, text FROM benchmark),{tfidf_sql("asked", 10)}
SELECT query_id, chunk_id, {rounded("score")} AS score FROM found""",
    "corpus_chunks": f"""WITH {CORPUS_SQL}
SELECT *, origin || '#' || doc_key || '#' || CAST(chunk_no AS VARCHAR) AS chunk_id FROM ({fixed_sql('corpus', 'origin, doc_key, title')}) c""",
}
