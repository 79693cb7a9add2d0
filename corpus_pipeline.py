"""Corpus pipeline: toxicity, line dedup, near-duplicate documents, benchmark decontamination, tokens.

Every stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept and returns those it
keeps, with the columns of ``documents``; the last returns their tokens. Nulls, empty texts, repeated rows and empty
tables are handled as the operators state; a null text is kept by every stage but the near-duplicate one, for which all
texts without words are copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retainframe.llm import bpe, lines, positional, simhash, toxicity
from retainframe.llm.common import Scratch, free_name, keep, table
from retainframe.llm.queries import TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the limit."""
    score = free_name(docs, "score")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, name=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are near copies of earlier ones; one that has nothing left goes.

    ``n_chars`` follows the text where lines were cut.
    """
    out = lines.dedup_lines(docs)
    cut = out.columns[-1]
    out = out.where((F.col(cut) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at two or fewer bits."""
    return simhash.drop_near_duplicates(docs, words_each=3, distance=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    That depends on the text alone, so the contaminated ones are named by a digest of it and the documents need not be written again.
    """
    digest = free_name(docs, "digest")
    named = docs.withColumn(digest, F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32)))
    with Scratch(spark) as scratch:
        found = positional.decontaminate(named, table(spark, sf_dir, "benchmark"), key=digest).where("contaminated").select(digest).distinct()
        found = scratch.hold(keep(found, "contaminated"))
    return named.join(found, digest, "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text they decode to."""
    coded = bpe.encode(docs.select("doc_id", "text"), TOKENIZER).select("doc_id", "ids")
    decoded = bpe.decode(coded, TOKENIZER)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", bpe.ids_digest().alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash", drop_near_copies), ("decontamination", drop_contaminated), ("bpe", tokens)]
#: Models, hashes of lines and fingerprints have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with Scratch(spark) as scratch:
            docs = scratch.hold(keep(stage(spark, docs, sf_dir), name))
    return docs
