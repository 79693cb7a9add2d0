"""Shards of near-equal bytes by sampled splitters.

Method: a size-weighted sample of record keys is drawn, its quantiles become range boundaries, records are
range-partitioned by them, and ranges that turn out overfull get splitters of their own until none is left
that can be divided. Exact byte and row offsets of the ranges then give every record its place in the total
order, and the place gives shard and slot.

The order is (hash of the text, key, number of the row), so equal texts lie side by side; the row number makes
every record a key of its own, hence a text or key that a third of all records share is divided like any
other range. Only keys and sizes are shuffled, never texts.

Edge cases: null and empty texts count as no bytes; a null key comes before all others; repeated rows are
records of their own; an empty table gives an empty result; a record larger than a shard's share fills the
shard it begins in. Only the key and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

#: Bytes that each record takes beside its text.
OVERHEAD = 16
#: Ranges per shard, sampled keys per range, and how far over the mean a range counts as overfull.
RANGES, SAMPLES, OVERFULL = 16, 16, 2.0
_KEY = ("h", "k0", "k", "row")


def _weight_order() -> Column:
    """Exponential clock of each record: the smallest are a sample in which the chance grows with the size."""
    uniform = (F.pmod(F.xxhash64("h", "k", "row"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / F.col("size")


def _range_of(splitters: list[tuple]) -> Column:
    """Number of the range of a record: how many splitters are not beyond its key."""

    @F.pandas_udf("int")
    def found(h: pd.Series, k0: pd.Series, k: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(splitters, x) for x in zip(h, k0, k, row)], dtype="int32")

    return found(*[F.col(c) for c in _KEY])


def _keys(rows) -> list[tuple]:
    return sorted({tuple(r[c] for c in _KEY) for r in rows})


def _splitters(slim: DataFrame, ranges: int) -> list[tuple]:
    """Quantile boundaries of a size-weighted sample; overfull ranges are divided until none can be."""
    drawn = _keys(slim.orderBy(_weight_order(), *_KEY).limit(ranges * SAMPLES).select(*_KEY).collect())
    splitters = drawn[SAMPLES::SAMPLES] if len(drawn) == ranges * SAMPLES else drawn
    while True:
        full = slim.withColumn("range", _range_of(splitters)).groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        sizes = full.collect()  # at most one row per range
        mean = sum(r["bytes"] for r in sizes) / ranges
        parts = {r["range"]: int(r["bytes"] / mean) + 1 for r in sizes if r["bytes"] > OVERFULL * mean and r["n"] > 1}
        if not parts:
            return splitters
        again = slim.withColumn("range", _range_of(splitters)).where(F.col("range").isin(list(parts)))
        more: list[tuple] = []
        # the sum of all shares is bounded by the number of ranges, so this sample is bounded too
        wanted = sum(parts.values()) * SAMPLES
        extra = again.orderBy(_weight_order(), *_KEY).limit(wanted).collect()
        for number in parts:
            inside = _keys(r for r in extra if r["range"] == number)
            more += inside[SAMPLES // 2 :: SAMPLES] or inside[len(inside) // 2 : len(inside) // 2 + 1]
        grown = sorted({*splitters, *more})
        if len(grown) == len(splitters):  # only single records larger than a range are left
            return splitters
        splitters = grown


def assign_shards(df: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, size, text_crc32, shard and slot of every record; sizes of the shards are near equal."""
    slim = keep(
        df.select(
            F.col(key).alias("key"),
            F.xxhash64(F.col(text)).alias("h"),
            F.col(key).isNotNull().cast("int").alias("k0"),
            F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("k"),
            (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(OVERHEAD)).alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-keys",
    )
    ranges = shards * RANGES
    splitters = _splitters(slim, ranges)
    inside = Window.partitionBy("range").orderBy(*_KEY)
    ranged = slim.withColumn("range", _range_of(splitters))
    offsets = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    at_bytes, at_rows, table = 0, 0, []
    for r in sorted(offsets, key=lambda r: r["range"]):  # one row per range: bounded
        table.append((r["range"], at_bytes, at_rows))
        at_bytes, at_rows = at_bytes + r["bytes"], at_rows + r["n"]
    spark = df.sparkSession
    offset = F.broadcast(spark.createDataFrame(table, "range int, before_bytes long, before_rows long"))
    placed = (
        ranged.withColumn("bytes", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("n", F.row_number().over(inside))
        .join(offset, "range")
        .withColumn("position", F.col("before_rows") + F.col("n") - 1)
        # the shard that holds the record's middle byte: half a record is the most a shard is off
        .withColumn("middle", F.col("before_bytes") + F.coalesce("bytes", F.lit(0)) + F.col("size") / 2)
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor(F.col("middle") * shards / F.lit(max(at_bytes, 1)))).cast("int"))
        .select("key", "size", "text_crc32", "shard", "position")
    )
    placed = keep(placed, "shard-places")
    first = F.broadcast(placed.groupBy("shard").agg(F.min("position").alias("first")))  # one row per shard
    return placed.join(first, "shard").select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write ``df`` (keys unique) as one folder ``shard=n`` per shard and return the written table."""
    places = assign_shards(df, shards, text, key).select(F.col(key).alias("_place_key"), "shard")
    df.join(places, F.col(key).eqNullSafe(F.col("_place_key"))).drop("_place_key").repartition(shards * 4, "shard", F.pmod(F.xxhash64(key), F.lit(4))).write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)
