"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

Method: the documents' words that occur in the benchmark are stored as postings (document, position, term). For
each window of an item the occurrences of its rarest term, counted over all documents, are shifted to where the
item would begin; they are intersected with the shifted list of the second rarest term, and what is left is
checked against the shifted lists of all words of the item. Runs of matched words as long as a window are
exact phrase matches. ``proximity`` returns documents that hold the two rarest terms (of those that any document holds) of a window near each other.

Edge cases: null and empty texts have no words (0 hits, not contaminated); an item without words has no window; an
item shorter than a window is one window; repeated documents and items are rows of their own, repeated item ids
count once; null keys are allowed; empty tables give empty or unmarked results. Only key and text columns are read.

The benchmark's vocabulary and windows are broadcast while they have at most ``SHARED_ROWS`` rows and joined by
shuffle beyond that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window, and rows up to which a table made from the benchmark is broadcast.
WINDOW, SHARED_ROWS = 10, 200_000
#: Stands after the last word of every document, so that each has a posting; no word can hold a space.
END = " "


def words(text: str) -> Column:
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def shared(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SHARED_ROWS else df


@dataclass
class Index:
    """postings (row, pos, term, key): term -1 at the end of each document; items (item, ipos, term, n_words, item_id)."""

    postings: DataFrame
    items: DataFrame
    frequency: DataFrame


def build(documents: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> Index:
    items = keep(
        benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_key).cast("string").alias("item_id"), words(item_text).alias("words"))
        .select("item", "item_id", F.size("words").alias("n_words"), F.posexplode("words").alias("ipos", "word")),
        "item-words",
    )
    terms = items.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
    terms = keep(terms.unionByName(documents.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(-1).cast("long").alias("term"))), "terms")
    found = (
        documents.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words(text).alias("words"))
        .select("row", "key", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "word"))
        .join(shared(terms), "word")
        .select("row", "pos", "term", F.when(F.col("term") == -1, F.col("key")).alias("key"))
    )
    postings = keep(found, "postings")
    frequency = keep(postings.where("term >= 0").groupBy("term").agg(F.count("*").alias("frequency")), "frequency")
    return Index(postings, keep(items.join(terms, "word").drop("word"), "items"), frequency)


def rarest_pairs(index: Index, window: int = WINDOW, whole: bool = True) -> DataFrame:
    """(item, p1, t1, p2, t2): places and terms of the rarest two words of each window.

    Windows with an unseen word are left out if ``whole``; else the two are the rarest of the words that documents hold.
    """
    known = index.items.join(index.frequency, "term", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    size = F.least(F.lit(window), F.col("n_words"))
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("ipos") - size + 1), F.least(F.col("ipos"), F.col("n_words") - size)))
    inside = Window.partitionBy("item", "start")
    # of a window of one word, that one stands for both
    placed = known.withColumn("start", starts).withColumn("seen", F.count_if(F.col("frequency") > 0).over(inside)).where("frequency > 0")
    ranked = (
        placed.where(F.col("seen") >= (size if whole else F.least(F.lit(2), size)))
        .withColumn("rank", F.row_number().over(inside.orderBy("frequency", "ipos")))
        .where("rank <= 2")
    )
    both = ranked.groupBy("item", "start").agg(
        F.min_by("ipos", "rank").alias("p1"), F.min_by("term", "rank").alias("t1"), F.max_by("ipos", "rank").alias("p2"), F.max_by("term", "rank").alias("t2")
    )
    return keep(both.select("item", "p1", "t1", "p2", "t2").distinct(), "rarest")


def phrases(index: Index, window: int = WINDOW) -> DataFrame:
    """(row, item, first, last): the runs of document words that hold exact occurrences of an item's windows."""
    rarest = rarest_pairs(index, window)
    of = lambda df, name: shared(df.select(F.col(name).alias("term")).distinct())
    listed = index.postings.where("term >= 0").drop("key")
    first = listed.join(shared(rarest.withColumnRenamed("t1", "term")), "term").select("row", "item", (F.col("pos") - F.col("p1")).alias("delta"), (F.col("pos") - F.col("p1") + F.col("p2")).alias("pos"), F.col("t2").alias("term"))
    second = listed.join(of(rarest, "t2"), "term", "left_semi")
    aligned = keep(first.join(second, ["row", "pos", "term"], "left_semi").select("row", "item", "delta").distinct(), "aligned")
    wanted = aligned.join(shared(index.items.select("item", "ipos", "term", "n_words")), "item").withColumn("pos", F.col("delta") + F.col("ipos"))
    there = listed.join(aligned.select("row").distinct(), "row", "left_semi")
    matched = wanted.join(there, ["row", "pos", "term"]).select("row", "item", "delta", "ipos", "n_words")
    run = F.col("ipos") - F.row_number().over(Window.partitionBy("row", "item", "delta").orderBy("ipos"))
    runs = matched.withColumn("run", run).groupBy("row", "item", "delta", "run").agg(F.min("ipos").alias("a"), F.max("ipos").alias("b"), F.count("*").alias("n"), F.first("n_words").alias("n_words"))
    exact = runs.where(F.col("n") >= F.least(F.lit(window), F.col("n_words")))
    return exact.select("row", "item", (F.col("delta") + F.col("a")).alias("first"), (F.col("delta") + F.col("b")).alias("last"))


def proximity(index: Index, slop: int = 20, window: int = WINDOW) -> DataFrame:
    """(key, item_id, pos, other): documents in which the rarest two words of a window stand at most ``slop`` words apart."""
    rarest = rarest_pairs(index, window, whole=False)
    listed = index.postings.where("term >= 0").drop("key")
    cell = lambda c: F.floor(F.col(c) / slop)
    first = listed.join(shared(rarest.withColumnRenamed("t1", "term")), "term").select("row", "item", "pos", F.col("t2").alias("term")).distinct()
    first = first.withColumn("cell", F.explode(F.array(cell("pos") - 1, cell("pos"), cell("pos") + 1)))
    second = listed.join(shared(rarest.select(F.col("t2").alias("term")).distinct()), "term", "left_semi").select("row", "term", F.col("pos").alias("other"), cell("pos").alias("cell"))
    near = first.join(second, ["row", "term", "cell"]).where(F.abs(F.col("pos") - F.col("other")) <= slop)
    keys = index.postings.where("term = -1").select("row", "key")
    ids = shared(index.items.select("item", "item_id").distinct())
    return near.select("row", "item", "pos", "other").distinct().join(ids, "item").join(keys, "row").select("key", "item_id", "pos", "other")


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """key, n_words, n_hit, items (sorted ids with an occurrence) and contaminated for every document."""
    index = build(documents, benchmark, text, key)
    found = keep(phrases(index, window), "phrases")
    hit = found.select("row", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    ids = found.select("row", "item").distinct().join(shared(index.items.select("item", "item_id").distinct()), "item")
    items = ids.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    ends = index.postings.where("term = -1").select("row", "key", F.col("pos").cast("long").alias("n_words"))
    out = ends.join(hit, "row", "left").join(items, "row", "left")
    return out.select(F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")).withColumn("contaminated", F.col("n_hit") > 0)
