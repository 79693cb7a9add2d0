"""Exact TF-IDF search over an inverted index that lies in blocks of rows: a list of places and counts per term and block.

Weights are count * ln((n + 1) / (rows with the term + 1)), scaled to length one per row; there are no hash slots, so
distinct terms never share a weight. The index holds counts and a length per row, from which weights follow.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bind
from ..session import Scratch, materialize

# Rows and characters of a block of the index, on average; places in a block are kept in 16 bits.
BLOCK_ROWS = 8_192
BLOCK_CHARS = 1 << 24
# Terms that are sent to every task at most, the most common ones; and weights of queries that a block is searched for at a time.
SHARED_TERMS = 1 << 17
ASKED_AT_ONCE = 1 << 17
# Terms in at most this many rows are scored first, to learn how good a query's k-th row is at least.
LIGHT_ROWS = 10_000
# Queries with at most this many terms in all filter the index files by them.
LISTED_TERMS = 1_000
# Sums of rounded scores may differ by this much from the bounds they are compared with.
SLACK = 1e-7


def words_of(text: Column) -> Column:
    """Array of the lower-case runs of letters and digits, in order of place; null gives none."""
    # array_remove compares natively; filter would run a lambda per word
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def terms_of(text: Column) -> Column:
    """Array of (term, count), terms being the lower-case runs of letters and digits; null gives none."""
    # sort_array compares natively; array_sort would run a lambda per comparison
    found = F.sort_array(words_of(text))

    def counted(words: Column) -> Column:
        # positions where a new word starts in the sorted array; a word's count is the distance to the next
        places = F.filter(F.sequence(F.lit(0), F.size(words)), lambda i: (i == 0) | ~F.get(words, i).eqNullSafe(F.get(words, i - 1)))
        return bind(places, lambda starts: F.transform(
            F.filter(starts, lambda i: i < F.size(words)),
            lambda i, k: F.struct(F.get(words, i).alias("term"), (F.get(starts, k + 1) - i).alias("count")),
        ))

    return bind(found, counted)


@dataclass(frozen=True)
class TextIndex:
    """``postings``: block, term, places, counts, in term order within a block. ``rows``: block, place, row, copies, length.

    ``terms``: term, n_rows, peak (the greatest weight, or null). ``n``: rows indexed. ``n_blocks``: blocks are numbered from 0.
    A row's weight for a term is count * idf / length; places follow the order of the rows.
    """

    postings: DataFrame
    rows: DataFrame
    terms: DataFrame
    n: int
    n_blocks: int


def idf(n_rows: Column, n: int) -> Column:
    return F.log((F.lit(n) + 1) / (n_rows + 1))


def build_index(rows: DataFrame, key: str = "chunk_id", text: str = "text") -> TextIndex:
    """Index the ``text`` of every row under its ``key``, which must be unique.

    Texts are dealt to blocks by their key and turned into lists there, the only time that all of them are shuffled. Lengths need
    the rows with each term: the most common terms are sent to every task, so only postings of the others are shuffled, one by one.
    """
    with Scratch(rows.sparkSession) as scratch:
        texts = rows.select(F.col(key).alias("row"), F.col(text).alias("text"))
        n, size = texts.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
        n_blocks = max(1, math.ceil(n / BLOCK_ROWS), math.ceil((size or 0) / BLOCK_CHARS))
        dealt = texts.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")).repartition("block").sortWithinPartitions("block")
        words = dealt.select("block", "row", words_of(F.col("text")).alias("words"))
        result = T.StructType([
            T.StructField("block", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("places", T.ArrayType(T.ShortType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("row", rows.schema[key].dataType),
        ])
        lists = scratch.hold(materialize(words.groupBy("block").applyInArrow(_inverter(_arrow_schema(result)), result), "postings"))
        postings = lists.where("term is not null").drop("row")
        found = materialize(postings.groupBy("term").agg(F.sum(F.size("counts")).alias("n_rows")), "term_rows")
        lengths = _lengths(postings, found, n)
        keyed = lists.where("term is null").select("block", F.get("places", F.lit(0)).alias("place"), "row", F.get("counts", F.lit(0)).alias("copies"))
        held = scratch.hold(materialize(keyed.join(lengths, ["block", "place"]), "index_rows"))
        cells = postings.unionByName(held.drop("row", "copies"), allowMissingColumns=True)
        tops = cells.groupBy("block").applyInArrow(_tops, "term string, top double").groupBy("term").agg(F.max("top").alias("top"))
        # a term of every row has no weight, but is known
        weight = idf(F.col("n_rows"), n)
        terms = found.join(tops, "term", "left").select("term", "n_rows", F.when(weight > 0, F.col("top") * weight).alias("peak"))
        return TextIndex(postings, held, scratch.hold(materialize(terms, "terms")), n, n_blocks)


def _lengths(postings: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """block, place, length of the rows that hold a term with a weight."""
    # the most common terms by quarters of a power of two, as many as may be sent to every task
    step = F.floor(F.log2("n_rows") * 4)
    left, least = SHARED_TERMS, math.inf
    for s, n_terms in sorted(found.groupBy(step.alias("step")).count().collect(), reverse=True):
        left -= n_terms
        if left < 0:
            break
        least = s
    weights = found.select("term", (step >= F.lit(float(least))).alias("common"), idf(F.col("n_rows"), n).alias("idf"))
    common = F.broadcast(weights.where("common").drop("common"))

    def squares(found: DataFrame) -> DataFrame:
        each = found.select("block", "idf", F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("counts").alias("count"))))
        return each.groupBy("block", "place").agg(F.sum(F.pow(F.col("count") * F.col("idf"), 2)).alias("square"))

    parts = squares(postings.join(common, "term"))
    others = postings.join(common.select("term"), "term", "left_anti").join(weights.where("not common").drop("common"), "term")
    whole = parts.unionByName(squares(others)).groupBy("block", "place").agg(F.sqrt(F.sum("square")).alias("length"))
    return whole.where("length > 0")


def _arrow_schema(result: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(result)


def _listed(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind.value_type), type=kind)


def _inverter(schema: pa.Schema):
    """The rows of a block to a list per term, terms in order, and after those a line per distinct row: its place and copies."""
    places_kind, counts_kind = schema.field("places").type, schema.field("counts").type

    def invert(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        keys = rows.column("row").combine_chunks().dictionary_encode(null_encoding="encode")
        order = pc.array_sort_indices(keys.dictionary, null_placement="at_start").to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        if len(order) > np.iinfo(np.int16).max:
            raise ValueError("a block of the text index has too many rows")
        place = rank[keys.indices.to_numpy(zero_copy_only=False)]
        by_place = np.argsort(place, kind="stable")
        words = rows.column("words").combine_chunks()
        found = words.flatten().dictionary_encode()
        sorted_terms = pc.array_sort_indices(found.dictionary)
        code = np.empty(len(sorted_terms), dtype=np.int64)
        code[sorted_terms.to_numpy()] = np.arange(len(sorted_terms))
        # a number for each word's term and row, rows in order of place: equal numbers are counted
        nth = np.empty(len(place), dtype=np.int64)
        nth[by_place] = np.arange(len(place))
        of_row = np.repeat(nth, pc.list_value_length(words).to_numpy(zero_copy_only=False))
        both, counts = np.unique(code[found.indices.to_numpy(zero_copy_only=False)] * len(place) + of_row, return_counts=True)
        starts = np.searchsorted(both, np.arange(len(code) + 1) * len(place))
        n = len(order)
        ones = np.arange(n + 1)
        lists = [
            pa.array(np.full(len(code), block, dtype=np.int32)), found.dictionary.take(sorted_terms),
            _listed(starts, place[by_place][both % len(place)], places_kind), _listed(starts, counts, counts_kind), pa.nulls(len(code), schema.field("row").type),
        ]
        lines = [
            pa.array(np.full(n, block, dtype=np.int32)), pa.nulls(n, pa.string()), _listed(ones, np.arange(n), places_kind),
            _listed(ones, np.bincount(place, minlength=n), counts_kind), keys.dictionary.take(pa.array(order)),
        ]
        return pa.concat_tables(pa.table([c.cast(f.type) for c, f in zip(part, schema)], schema=schema) for part in (lists, lines))

    return invert


@dataclass(frozen=True)
class _Cell:
    """Lists of a block, with what a row's count is worth at each place: the count by the row's length, or 0 without a length."""

    terms: pa.Array
    starts: np.ndarray
    places: np.ndarray
    shares: np.ndarray
    rows: pa.Table
    n: int

    @staticmethod
    def of(cell: pa.Table) -> _Cell:
        rows, lists = cell.filter(pc.is_null(cell.column("term"))), cell.filter(pc.is_valid(cell.column("term")))
        at = rows.column("place").to_numpy()
        places, counts = lists.column("places").combine_chunks(), lists.column("counts").combine_chunks()
        starts = np.r_[0, np.cumsum(pc.list_value_length(places).to_numpy(zero_copy_only=False))].astype(np.int64)
        places, counts = places.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy()
        n = 1 + max(int(at.max(initial=-1)), int(places.max(initial=-1)))
        worth = np.zeros(n)
        worth[at] = 1 / rows.column("length").to_numpy()
        return _Cell(lists.column("term").combine_chunks(), starts, places, counts * worth[places], rows, n)


def _tops(cell: pa.Table) -> pa.Table:
    """The greatest share of each list; repeated places are one row."""
    it = _Cell.of(cell)
    first = np.ones(len(it.places), dtype=bool)
    first[1:] = it.places[1:] != it.places[:-1]
    first[it.starts[:-1]] = True
    firsts = np.flatnonzero(first)
    if not len(firsts):
        return pa.table({"term": pa.array([], pa.string()), "top": pa.array([], pa.float64())})
    top = np.maximum.reduceat(np.add.reduceat(it.shares, firsts), np.searchsorted(firsts, it.starts[:-1]))
    return pa.table({"term": it.terms.cast(pa.string()), "top": top})


def query_weights(index: TextIndex, queries: DataFrame) -> DataFrame:
    """query_id, term, weight, n_rows, peak of (query_id, text) rows; terms that no row holds only lengthen the query."""
    asked = queries.select("query_id", F.inline(terms_of(F.col("text")))).join(index.terms, "term", "left").fillna(0, ["n_rows"])
    whole = Window.partitionBy("query_id").orderBy("term").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.col("count") * idf(F.col("n_rows"), index.n)
    unit = asked.withColumn("weight", weight).withColumn("weight", F.try_divide("weight", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(whole))))
    return unit.where("n_rows > 0 and weight > 0").select("query_id", "term", "weight", "n_rows", "peak")


def search(
    index: TextIndex, queries: DataFrame, k: int = 50, threshold: float = 0.5, digits: int = 9, light_rows: int = LIGHT_ROWS
) -> DataFrame:
    """The ``k`` best rows of every query, then those at or above the threshold: query_id, row, score.

    ``queries``: unique query_id, text. Rows that share no weighted term with a query are not listed. Ties go to the smaller row.

    Exact: lists of the asked terms are brought together by block and every block is searched for all queries, so no posting is
    shuffled by itself and a block gives back ``k`` rows per query at most. Within a block a query's rare terms give
    a floor under its k-th score. The most common terms that together, by their greatest weights or by the length of
    the query's part, cannot lift a row over that floor (or the threshold) propose no rows; they are only looked
    up if the other terms propose a row.
    """
    with Scratch(queries.sparkSession) as scratch:
        # a query that is given twice counts twice
        weights = query_weights(index, queries).where("query_id is not null").groupBy("query_id", "term")
        asked = materialize(weights.agg(F.sum("weight").alias("weight"), F.first("n_rows").alias("n_rows"), F.first("peak").alias("peak")), "asked")
        terms = asked.select("term").distinct()
        postings, n_terms = index.postings, terms.count()
        if n_terms <= LISTED_TERMS:
            postings = postings.where(F.col("term").isin([r["term"] for r in terms.collect()])) if n_terms else postings.limit(0)
        else:
            postings = postings.join(F.broadcast(terms) if n_terms <= SHARED_TERMS else terms, "term", "left_semi")
        n_parts = max(1, math.ceil(asked.count() / ASKED_AT_ONCE))
        every = F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part")
        held = postings.unionByName(index.rows, allowMissingColumns=True).select("*", every)
        put = asked.select(
            "*", idf(F.col("n_rows"), index.n).alias("idf"), F.pmod(F.xxhash64("query_id"), F.lit(n_parts)).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0), F.lit(index.n_blocks - 1))).alias("block"),
        )
        result = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("row", index.rows.schema["row"].dataType), T.StructField("score", T.DoubleType())])
        found = held.groupBy("block", "part").cogroup(put.groupBy("block", "part")).applyInArrow(_finder(_arrow_schema(result), k, threshold, digits, light_rows), result)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "row")
        best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
        return scratch.hold(materialize(best, "found"))


def _finder(schema: pa.Schema, k: int, threshold: float, digits: int, light_rows: int):
    """A block and the weights of queries to the k best rows of each query that reach the threshold."""
    scale = 10.0**digits

    def find(cell: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(cell) or not len(asked):
            return schema.empty_table()
        it = _Cell.of(cell)
        key_at = np.empty(it.n, dtype=np.int64)
        key_at[it.rows.column("place").to_numpy()] = np.arange(len(it.rows))
        copies = it.rows.column("copies").to_numpy().max(initial=1)
        list_of = pc.fill_null(pc.index_in(asked.column("term"), value_set=it.terms), -1).combine_chunks().to_numpy()
        query = asked.column("query_id").combine_chunks().dictionary_encode().indices.to_numpy()
        weight, n_rows, worth = (asked.column(c).to_numpy() for c in ("weight", "n_rows", "idf"))
        reach = weight * asked.column("peak").to_numpy()
        order = np.lexsort((n_rows, query))
        order = order[list_of[order] >= 0]
        firsts = np.flatnonzero(np.r_[True, query[order][1:] != query[order][:-1]]) if len(order) else order
        ids, rows, scores = [], [], []
        for mine in np.split(order, firsts[1:]) if len(order) else ():
            score = np.zeros(it.n)

            def add(entries: np.ndarray, score: np.ndarray = score) -> None:
                for e in entries:
                    part = slice(it.starts[list_of[e]], it.starts[list_of[e] + 1])
                    np.add.at(score, it.places[part], weight[e] * worth[e] * it.shares[part])

            # what a term and all more common ones can add at most together; copies of a row lengthen it
            most = np.minimum(np.cumsum(reach[mine][::-1]), np.sqrt(np.cumsum(weight[mine][::-1] ** 2) * copies))[::-1]
            light = int(np.searchsorted(n_rows[mine], light_rows, side="right"))
            add(mine[:light])
            floor = np.partition(score, it.n - k)[it.n - k] if 0 < k <= it.n else 0.0
            limit = max(threshold, floor) - SLACK
            upto = max(light, int(np.count_nonzero(most >= limit)))
            add(mine[light:upto])
            rest = most[upto] if upto < len(mine) else 0.0
            some = np.flatnonzero((score > 0) & (score + rest >= limit))
            if not len(some):
                continue
            add(mine[upto:])
            rounded = np.floor(score[some] * scale + 0.5) / scale
            some, rounded = some[rounded >= threshold], rounded[rounded >= threshold]
            if len(some) > k:
                top = np.lexsort((some, -rounded))[:k]
                some, rounded = some[top], rounded[top]
            ids.append(np.full(len(some), mine[0]))
            rows.append(key_at[some])
            scores.append(rounded)
        if not ids:
            return schema.empty_table()
        found = [asked.column("query_id").take(pa.array(np.concatenate(ids))), it.rows.column("row").take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(scores))]
        return pa.table([c.cast(f.type) for c, f in zip(found, schema)], schema=schema)

    return find
