"""Query-to-chunk retrieval: by embedding columns, or by TF-IDF over an inverted index where only text exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bind
from ..functions.vectors import as_doubles, cosine, unit
from ..session import Scratch
from .text_index import TextIndex, build_index, idf, search, terms_of

# Places of a dense text vector; texts with more terms bring an embedding of their own.
MOST_TERMS = 4_096


def keep_similar(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scored.where(F.col("score") >= threshold)


def top_rows(scored: DataFrame, k: int, tie: str) -> DataFrame:
    """Best ``k`` rows by score; every task keeps k rows, nothing is sorted as a whole."""
    return scored.orderBy(F.desc("score"), tie).limit(k)


def retrieve_by_vector(
    chunks: DataFrame, query: Sequence[float], k: int = 50, threshold: float = 0.5,
    vector: str = "vector", tie: str = "chunk_id", digits: int = 9,
) -> DataFrame:
    """Top ``k`` chunks for one query vector, then those at or above the threshold."""
    wanted = F.array(*(F.lit(float(x)) for x in query))
    score = F.round(cosine(as_doubles(F.col(vector)), wanted), digits)
    scored = chunks.withColumn("score", score).where(F.col("score").isNotNull())
    return keep_similar(top_rows(scored, k, tie), threshold)


def retrieve_by_text(
    chunks: DataFrame, query: str, k: int = 50, threshold: float = 0.5, text: str = "text", tie: str = "chunk_id",
    index: TextIndex | None = None,
) -> DataFrame:
    """Top ``k`` chunks by TF-IDF cosine with the query text, then those at or above the threshold.

    ``tie`` is the chunks' unique key. An ``index`` built before serves any number of calls. Chunks without a weighted term
    of the query are not listed.
    """
    asked = chunks.sparkSession.createDataFrame([(0, query)], "query_id int, text string")
    found = _found(chunks, asked, k, threshold, text, tie, index)
    best = found.select(F.col("row").alias(tie), "score")
    return chunks.join(F.broadcast(best), tie).select(*chunks.columns, "score")  # at most k rows


def retrieve_many(
    chunks: DataFrame, queries: DataFrame, k: int = 50, threshold: float = 0.5, text: str = "text", tie: str = "chunk_id",
    index: TextIndex | None = None,
) -> DataFrame:
    """(query_id, ``tie``, score) for every row of ``queries`` (query_id, text), each as in :func:`retrieve_by_text`."""
    return _found(chunks, queries, k, threshold, text, tie, index).withColumnRenamed("row", tie)


def _found(chunks: DataFrame, queries: DataFrame, k: int, threshold: float, text: str, tie: str, index: TextIndex | None) -> DataFrame:
    # an index built here serves this search alone, and goes with it
    with Scratch(chunks.sparkSession) as scratch:
        return scratch.hold(search(index or build_index(chunks, tie, text), queries, k, threshold))


def fit_vocabulary(rows: DataFrame, text: str, most: int = MOST_TERMS) -> list[tuple[str, float]]:
    """(term, idf) of every term of a text column with a closed vocabulary, in term order; at most ``most`` of them."""
    n = rows.count()
    counted = rows.select(F.explode(terms_of(F.col(text))["term"]).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_rows"))
    found = counted.select("term", idf(F.col("n_rows"), n).alias("idf")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{text} holds more than {most} terms: give an embedding column instead")
    return sorted((r["term"], r["idf"]) for r in found)


def vocabulary_vector(text: Column, vocabulary: list[tuple[str, float]]) -> Column:
    """Unit-length TF-IDF vector with one place for every term of the vocabulary."""
    known = F.array(*(F.struct(F.lit(t).alias("term"), F.lit(w).alias("idf")) for t, w in vocabulary))

    def placed(counts: Column) -> Column:
        return F.transform(known, lambda t: F.coalesce(F.element_at(counts, t["term"]), F.lit(0)) * t["idf"])

    weights = bind(F.map_from_entries(terms_of(text)), placed) if vocabulary else F.array().cast("array<double>")
    return unit(weights)
