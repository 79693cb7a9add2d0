"""Clean text, chunk it, retrieve by a query and pick the top insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.corpus import chunk, document_text, page_bodies, page_text, top_insights
from ..operators.counts import StageCounts, counted
from ..operators.retrieval import retrieve_by_text
from ..session import Scratch, materialize


def clean_corpus(pages: DataFrame, lines: DataFrame, min_words: int = 10, min_length: int = 10) -> DataFrame:
    """(origin, doc_key, title, content) of fetched pages (doc_key, title, html) and of document lines."""
    # empty bodies go by an outer explode: a filter on the content would clean every page a second time
    some = F.explode_outer(F.filter(F.array("content"), lambda c: c != "")).alias("content")
    web = page_bodies(page_text(pages), min_words).select(
        F.lit("web").alias("origin"), F.col("doc_key").cast("string").alias("doc_key"), "title", some
    )
    name = F.col("title").cast("string")
    local = document_text(lines, min_length=min_length).select(
        F.lit("local").alias("origin"), name.alias("doc_key"), name.alias("title"), "content"
    )
    return web.where(F.col("content").isNotNull()).unionByName(local)


def corpus_chunks(corpus: DataFrame, method: str = "recursive", **sizes: int) -> DataFrame:
    """Chunk rows with a stable id made of origin, document key and place.

    The corpus is written first: the chunk expressions mention a text many times, and would clean it as often.
    """
    chunks = chunk(materialize(corpus, "corpus"), method, **sizes)
    return chunks.withColumn("chunk_id", F.concat_ws("#", "origin", "doc_key", F.col("chunk_no").cast("string")))


def retrieve(
    pages: DataFrame, lines: DataFrame, query: str, k: int = 50, threshold: float = 0.5, method: str = "recursive",
    counts: StageCounts | None = None,
) -> DataFrame:
    """Chunks of both sources that answer the query, best first by score.

    The chunk table is rebuilt in the shared folder and indexed by term; see ``operators/text_index.py``.
    ``counts`` counts the rows of the stages corpus and chunks while that table is written.
    """
    with Scratch(pages.sparkSession) as scratch:
        corpus = counted(clean_corpus(pages, lines), counts, "corpus")
        chunks = scratch.hold(materialize(counted(corpus_chunks(corpus, method), counts, "chunks"), "chunks"))
    return retrieve_by_text(chunks, query, k, threshold)


def insights(chunks: DataFrame, n: int = 5, **options) -> DataFrame:
    """Top insights in insight_no order: insight_id, key_insight_content, strategic_relevance."""
    best = top_insights(chunks, n, **options)
    return best.select(
        "insight_no",
        F.col("chunk_id").cast("string").alias("insight_id"),
        F.col("text").alias("key_insight_content"),
        F.format_string("score %.4f", F.col("score").cast("double")).alias("strategic_relevance"),
    )
