"""Source divergence audit: how far the word use of each source lies from its language and from the other sources.

Method: an Arrow compute pipeline (``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``)
inside ``mapInArrow`` turns texts into partial counts per language, source and term; Spark adds them up. The terms that
enough documents of a language hold are then merged into columnar shards, one per block of terms and tile of two blocks
of sources: a matrix of smoothed shares, in which the distances of all sources of the tile are sums over rows. A shard holds
``TERMS`` terms and twice ``SOURCES`` sources at most on average, whatever the corpus; a term that no source of the
tile has stands in all of them at the share of count 0, so those terms are counted, not listed.

Shares are whole numbers of billionths, computed by long division in 64 bits, so everything is exact.

Edge cases: null text, language and source are read as empty strings; texts without a term still make their group
occur; repeated rows count each; terms in too few documents are nowhere counted; a language without kept terms has
distances of 0 and no term rows; an empty table gives an empty result. Only the three named columns are read, so other
columns cannot clash. Counts up to 9 * 10**15 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, keep

#: Documents of a language that a kept term is in, count added to every term, unit of the shares, term rows of each group.
LEAST, SMOOTH, UNIT, TOP = 30, 5, 1_000_000_000, 50
#: What lies between terms: ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms and sources of a shard.
TERMS, SOURCES = 2_048, 256


def partial_counts(texts: pa.Array, langs: pa.Array, sources: pa.Array) -> pa.Table:
    """lang, source, term, n, docs of some rows; the empty term, with n = 0, stands for each occurring group."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(texts), BETWEEN)
    row, words = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    said = pc.not_equal(words, "")
    row, words = row.filter(said), words.filter(said).dictionary_encode()
    terms = pa.concat_arrays([words.dictionary, pa.array([""], words.dictionary.type)])
    each = pa.table([row, words.indices], names=["row", "w"]).group_by(["row", "w"], use_threads=False).aggregate([([], "count_all")])
    coded = [langs.dictionary_encode(), sources.dictionary_encode()]
    marks = pa.table([c.indices for c in coded], names=["lang", "source"]).group_by(["lang", "source"], use_threads=False).aggregate([])
    cells = pa.table([*(c.indices.take(each.column("row").combine_chunks()) for c in coded), each.column("w"), each.column("count_all")], names=["lang", "source", "w", "n"])
    sums = cells.group_by(["lang", "source", "w"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    none = pa.array(np.zeros(marks.num_rows, np.int64))
    at = [pa.concat_arrays([*sums.column(c).chunks, *marks.column(c).chunks]) for c in ("lang", "source")]
    word = pa.concat_arrays([*sums.column("w").chunks, pa.array(np.full(marks.num_rows, len(terms) - 1, np.int32))])
    counts = [pa.concat_arrays([*sums.column(c).chunks, none]) for c in ("n_sum", "count_all")]
    return pa.table([c.dictionary.take(i) for c, i in zip(coded, at)] + [terms.take(word), *counts], names=["lang", "source", "term", "n", "docs"])


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows); term '' with n = 0 for every occurring group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in chunks(batch, "text"):
                part = batch.slice(i, j - i)
                yield from partial_counts(*(part.column(c) for c in ("text", "lang", "source"))).combine_chunks().to_batches()

    rows = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))))
    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: np.ndarray, total: np.ndarray, smooth: int, kept: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (n + smooth) / (total + smooth * kept)), three digits at a time, as the product passes 64 bits."""
    rest, below = n + smooth, total + smooth * kept
    out = np.zeros(np.broadcast(rest, below).shape, np.int64)
    for _ in range(3):  # UNIT is 1000 ** 3
        out = out * 1000 + rest * 1000 // below
        rest = rest * 1000 % below
    return out + 1


def _share(n: str, total: str, smooth: int) -> F.Column:
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * cast({n} + {smooth} as decimal(19,0))) div cast({total} + {smooth} * kept as decimal(19,0))")


def divergences(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, smooth: int = SMOOTH, top: int = TOP, terms: int = TERMS, sources: int = SOURCES) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: distances to the other sources, and overused terms."""
    counts = keep(term_counts(df, text, lang, source), "counts")
    spread = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= least)
    spread = keep(spread.select("lang", "term", "all_n"), "terms")
    of_lang = spread.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("lang_n"))
    cells = counts.where("term <> ''").drop("docs").join(spread, ["lang", "term"])
    cells = keep(cells, "cells")
    held = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = counts.where("term = ''").select("lang", "source").join(held, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.fillna(0, ["group_n", "kept", "lang_n"])
    # place of a source in its language: block of sources = place div sources; shards of a language = kept div terms
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("place", place).withColumn("last", F.max("place").over(Window.partitionBy("lang")))
    groups = keep(groups.withColumn("shards", F.expr(f"cast(greatest(1, ceil(kept / {terms})) as int)")), "groups")
    pair = _pairs(cells, groups, smooth, sources).withColumn("part", F.lit("pair"))
    over = cells.join(groups.select("lang", "source", "group_n", "lang_n", "kept"), ["lang", "source"]).where("n > 0")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (_share("n", "group_n", smooth) - _share("all_n", "lang_n", smooth)).alias("value")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    over = over.withColumn("rank", rank).where(F.col("rank") <= top)
    return pair.withColumn("rank", rank).select(*columns).unionByName(over.select(*columns))


def _pairs(cells: DataFrame, groups: DataFrame, smooth: int, sources: int) -> DataFrame:
    """lang, source, item, value of every two sources of a language, in both directions."""
    block, blocks = F.expr(f"cast(place div {sources} as int)"), F.expr(f"cast(last div {sources} as int)")
    # a source meets every block: tile (low, high) holds blocks low and high
    tiles = F.transform(F.sequence(F.lit(0), blocks), lambda b: F.struct(F.least(block, b).alias("low"), F.greatest(block, b).alias("high")))
    shard = F.expr("cast(pmod(xxhash64(term), shards) as int)")
    placed = groups.select("lang", "source", "place", "shards", "last")
    left = cells.join(placed, ["lang", "source"]).withColumn("tile", F.explode(tiles)).select("lang", "tile.low", "tile.high", shard.alias("shard"), F.col("place").alias("seat"), "term", "n")
    right = groups.withColumn("tile", F.explode(tiles)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    right = right.select("lang", "tile.low", "tile.high", "shard", "place", "source", "group_n", "kept")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("place").combine_chunks()
        place, names = right.column("place").to_numpy(), right.column("source").combine_chunks()
        total, kept = right.column("group_n").to_numpy(), int(right.column("kept")[0].as_py())
        lang, shard = right.column("lang")[0].as_py(), right.column("shard")[0].as_py()
        low, high = right.column("low")[0].as_py(), right.column("high")[0].as_py()
        coded = left.column("term").combine_chunks().dictionary_encode()
        matrix = np.zeros((len(coded.dictionary), len(place)), np.int64)
        matrix[coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(place, left.column("seat").to_numpy())] = left.column("n").to_numpy()
        shares = share(matrix, total[None, :], smooth, kept) if kept else matrix
        absent = share(np.zeros(len(place), np.int64), total, smooth, kept) if kept else np.zeros(len(place), np.int64)
        # terms of the language that no source of this tile has are counted once, in its first shard
        unseen = (kept if shard == 0 else 0) - len(matrix)
        own = place // sources
        first = np.flatnonzero(own == low)
        other = np.flatnonzero(own == high)
        out = []
        for a in first:
            rest = other[other > a] if low == high else other
            value = np.abs(shares[:, a, None] - shares[:, rest]).sum(axis=0) + unseen * np.abs(absent[a] - absent[rest])
            out.append((np.full(len(rest), a), rest, value))
        a, b, value = (np.concatenate([o[k] for o in out]).astype(np.int64) if out else np.zeros(0, np.int64) for k in range(3))
        one, two = names.take(pa.array(np.concatenate([a, b]))), names.take(pa.array(np.concatenate([b, a])))
        return pa.table([pa.array([lang] * len(one), pa.string()), one, two, pa.array(np.concatenate([value, value]))], names=["lang", "source", "item", "value"])

    key = ["lang", "low", "high", "shard"]
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # both come from ``groups``: new columns
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
