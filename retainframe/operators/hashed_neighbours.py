"""Approximate nearest neighbours by cosine: random-projection hashing with several tables and probes.

A table cuts the space by random hyperplanes; a row's code holds the sides it lies on. A query looks into its own bucket
of every table, and into those across the planes it lies nearest to. Rows found are scored exactly, so only
rows can be missing, never scores wrong. More tables, more probes or fewer bits raise the recall and the work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .neighbours import BLOCK_BYTES, _arrow_schema, _matrix, _prepared, _shape, _top, numbers

# Tables, buckets probed in each, and rows that a bucket holds on average.
TABLES, PROBES, BUCKET_ROWS = 12, 6, 256
# Sizes of buckets are sent to every task up to this many buckets of all tables.
SHARED_BUCKETS = 1 << 20


def hashed_neighbours(
    queries: DataFrame, base: DataFrame, k: int = 10, carry: Sequence[str] = (), tables: int = TABLES, probes: int = PROBES,
    bits: int | None = None, digits: int = 9, block_bytes: int = BLOCK_BYTES, seed: int = 7,
) -> DataFrame:
    """query_id, base_id, carry columns, score: the best ``k`` rows among those that share a probed bucket with the query.

    Columns, scores and ties are as in :func:`~retainframe.operators.neighbours.nearest_neighbours`. ``bits`` follows from the number
    of base rows by default. A bucket with many rows, such as those of equal vectors, is cut into blocks by key on both
    sides, and a block gives back k rows per query at most.
    """
    queries = queries.select("query_id", numbers(queries)).where("vector is not null")
    base = base.select("base_id", numbers(base), *carry).where("vector is not null")
    n_base, dims, _ = _shape(base)
    result = T.StructType(
        [T.StructField("query_id", queries.schema["query_id"].dataType)]
        + [T.StructField(f.name, f.dataType) for f in base.schema if f.name != "vector"]
        + [T.StructField("score", T.DoubleType())]
    )
    if not n_base:
        return queries.sparkSession.createDataFrame([], result)
    bits = max(1, min(30, round(math.log2(max(n_base / BUCKET_ROWS, 2))))) if bits is None else bits
    planes = np.random.default_rng(seed).normal(size=(dims, tables * bits))
    block_rows = max(1, block_bytes // (8 * max(dims, 1)))

    def placed(side: DataFrame, probes: int) -> DataFrame:
        schema = T.StructType([*side.schema, T.StructField("buckets", T.ArrayType(T.LongType()))])
        return side.mapInArrow(_coder(planes, tables, bits, probes), schema).withColumn("bucket", F.explode("buckets")).drop("buckets")

    left, right = placed(queries, probes), placed(base, 1)
    count = lambda side, name: side.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(name))
    sizes = count(left, "query_blocks").join(count(right, "base_blocks"), "bucket")
    if tables << bits <= SHARED_BUCKETS:  # otherwise every vector would be shuffled by bucket before it is by cell
        sizes = F.broadcast(sizes)
    own = lambda key, blocks: F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    keys = ["bucket", "query_block", "base_block"]
    asked = left.join(sizes, "bucket").withColumn("query_block", own("query_id", "query_blocks")).withColumn("base_block", each("base_blocks"))
    held = right.join(sizes, "bucket").withColumn("base_block", own("base_id", "base_blocks")).withColumn("query_block", each("query_blocks"))
    asked, held = asked.select("query_id", "vector", *keys), held.select(*base.columns, *keys)
    schema = _arrow_schema(result)

    def cell(q: pa.Table, b: pa.Table) -> pa.Table:
        return _top(_prepared(q.drop_columns(keys), "query_id"), _prepared(b.drop_columns(keys), "base_id"), k, digits, schema)

    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(cell, result)
    # one shuffle by query serves both the copies and the ranks
    found = found.repartition("query_id").dropDuplicates(["query_id", "base_id"])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "base_id")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")


def _coder(planes: np.ndarray, tables: int, bits: int, probes: int):
    """The buckets of each row: its own of every table, then those across its nearest planes, alone and in pairs."""
    weight = 1 << np.arange(bits, dtype=np.int64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            away = (_matrix(table) @ planes).reshape(-1, tables, bits)
            own = ((away >= 0) * weight).sum(axis=2)
            order = np.argsort(np.abs(away), axis=2, kind="stable")
            near = weight[order[:, :, : min(bits, max(probes, 1))]]
            # the nearest planes one by one, and the nearest together with the second, which is about as near as the third alone
            flips = [np.zeros_like(own), *(near[:, :, i] for i in range(near.shape[2]))]
            if near.shape[2] > 1:
                flips.insert(3, near[:, :, 0] ^ near[:, :, 1])
            buckets = np.stack([own ^ f for f in flips[:probes]], axis=2) + (np.arange(tables, dtype=np.int64) << 32)[None, :, None]
            flat = buckets.reshape(len(own), -1)
            offsets = np.arange(len(own) + 1, dtype=np.int32) * flat.shape[1]
            yield from table.append_column("buckets", pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))).to_batches()

    return code
