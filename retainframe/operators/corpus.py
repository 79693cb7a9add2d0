"""Page and document text, chunks, duplicates and top insights."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bind
from ..functions.chunking import CHUNK_OVERLAP, CHUNK_SIZE, fixed_chunks, recursive_chunks
from ..functions.markup import body_lines, document_piece, html_text
from ..functions.strings import strip
from ..session import materialize


def page_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Visible text of every fetched page in ``text``."""
    return pages.withColumn("text", html_text(F.col(html))).drop(html)


def page_bodies(pages: DataFrame, min_words: int = 10) -> DataFrame:
    """Body lines of the page text in ``content``."""
    return pages.withColumn("content", body_lines(F.col("text"), min_words)).drop("text")


def select_pages(lines: DataFrame, page_numbers: Sequence[int] | None = None) -> DataFrame:
    """Lines of the given zero-based pages, or all lines."""
    return lines if page_numbers is None else lines.where(F.col("page_no").isin(list(page_numbers)))


def document_text(lines: DataFrame, page_numbers: Sequence[int] | None = None, min_length: int = 10) -> DataFrame:
    """(doc, page_no, line_no, line) rows to one (title, content) row per non-empty document.

    Lines are cleaned before any shuffle and joined in two steps, first within a page and then
    across the pages, so a document with very many lines is not gathered line by line in one task.
    """
    pieces = (
        select_pages(lines, page_numbers)
        .select("doc", "page_no", "line_no", document_piece(F.col("line"), min_length).alias("piece"))
        .where(F.col("piece").isNotNull())
    )
    pages = pieces.groupBy("doc", "page_no").agg(_joined("line_no", "piece").alias("piece"))
    documents = pages.groupBy("doc").agg(strip(_joined("page_no", "piece")).alias("content"))
    return documents.where(F.col("content") != "").select(F.col("doc").alias("title"), "content")


def _joined(order: str, text: str) -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(ordered, lambda part: part[text]), "")


def chunk(
    documents: DataFrame, method: str = "recursive", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, text: str = "content"
) -> DataFrame:
    """One row per chunk: the document's other columns, chunk_no from 0, text."""
    split = recursive_chunks(size, overlap) if method == "recursive" else lambda t: fixed_chunks(t, size, overlap)
    kept = [c for c in documents.columns if c != text]
    return documents.select(*kept, F.posexplode(split(F.col(text))).alias("chunk_no", "text"))


def normalised(text: Column) -> Column:
    """Lower case, white space runs as one space, stripped."""
    return strip(F.regexp_replace(F.lower(text), r"\s+", " "))


def drop_copies(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row, the smallest key, per distinct normalised text, with the number of copies.

    Only keys and hashes are shuffled, and map-side counting reduces a large group of copies to one
    row per task before that.
    """
    return texts.groupBy(F.sha2(normalised(F.col(text)), 256).alias("text_hash")).agg(
        F.min(key).alias(key), F.count(F.lit(1)).alias("copies")
    )


def words(text: Column) -> Column:
    """Distinct lower-case words, hashed to 64 bits."""
    found = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(found, lambda w: F.xxhash64(w)))


def jaccard(left: Column, right: Column) -> Column:
    common = F.size(F.array_intersect(left, right))
    return F.coalesce(F.try_divide(common, F.size(left) + F.size(right) - common), F.lit(1.0))


def top_insights(
    chunks: DataFrame, n: int = 5, key: str = "chunk_id", text: str = "text", score: str = "score",
    max_similarity: float = 0.8, batch: int = 20,
) -> DataFrame:
    """The ``n`` best chunks by score, skipping any too similar to one already taken.

    Similarity is the Jaccard share of common words, so copies and near copies are merged into the
    best-scored one. Rows are visited in (score descending, key) order. A pass takes the next
    ``batch`` rows that resemble nothing taken so far, each task keeping at most ``batch`` rows, and
    settles them among themselves; passes go on until ``n`` are found or no row is left. The input is written
    once to the shared folder, so that a pass does not repeat what is behind it. Everything
    compared is one row against at most ``n`` taken ones: no pairs are formed, and a group of copies
    of any size disappears in one filter.
    """
    chunks = materialize(chunks, "insights")
    candidates = chunks.select(F.col(key).alias("key"), F.col(score).alias("score"), F.col(text).alias("text"))
    candidates = candidates.where(F.col("score").isNotNull())
    own_words = words(F.col("text"))
    taken: list = []
    last = None
    while len(taken) < n:
        rest = candidates
        if last is not None:
            after = (F.col("score") < F.lit(last["score"])) | (
                (F.col("score") == F.lit(last["score"])) & (F.col("key") > F.lit(last["key"]))
            )
            rest = rest.where(after)
        if taken:
            rest = rest.where(bind(own_words, lambda own: _unlike(own, taken, max_similarity)))
        best = rest.orderBy(F.desc("score"), "key").limit(batch)
        page = best.select("key", "score", own_words.alias("words")).collect()
        for row in page:
            if len(taken) < n and all(_alike(row["words"], other["words"]) < max_similarity for other in taken):
                taken.append(row)
        if len(page) < batch:
            break
        last = page[-1]
    if not taken:
        return chunks.limit(0).withColumn("insight_no", F.lit(0))
    places = F.lit(None).cast("int")
    for place, row in enumerate(taken, 1):
        places = F.when(F.col(key) == F.lit(row["key"]), place).otherwise(places)
    return chunks.where(F.col(key).isin([row["key"] for row in taken])).withColumn("insight_no", places)


def _unlike(own: Column, taken: list, max_similarity: float) -> Column:
    similar = (jaccard(own, _literal_words(row["words"])) >= max_similarity for row in taken)
    return ~functools.reduce(operator.or_, similar)


def _literal_words(values: Sequence[int]) -> Column:
    # one folded literal instead of an expression per word
    joined = ",".join(map(str, values))
    return F.split(F.lit(joined), ",").cast("array<bigint>") if joined else F.array().cast("array<bigint>")


def _alike(left: Sequence[int], right: Sequence[int]) -> float:
    a, b = set(left), set(right)
    return len(a & b) / len(a | b) if a | b else 1.0
