"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from retainframe.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_path = path
    if _OPEN:
        _OPEN[-1].paths.add(path)
    return out


class Scratch:
    """A ``with`` block at whose end the tables kept inside are removed, but for those given to ``hold``.

    Only what a later plan reads needs holding; held tables pass to the block around, if there is one.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, set()

    def __enter__(self) -> Scratch:
        _OPEN.append(self)
        return self

    def hold(self, df: DataFrame) -> DataFrame:
        self.paths.discard(df.kept_path)
        outer = _OPEN[: _OPEN.index(self)]
        if outer:
            outer[-1].paths.add(df.kept_path)
        return df

    def __exit__(self, *error) -> None:
        _OPEN.remove(self)
        context = self.spark.sparkContext
        for path in sorted(self.paths):
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


_OPEN: list[Scratch] = []


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunks(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts take about ``limit`` bytes, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser that spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: An odd base, so that its powers have inverses modulo 2**64.
BASE = 0x9E3779B97F4A7C15


class RollingHash:
    """Prefix sums of byte * base**i modulo 2**64: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray, base: int = BASE):
        n = len(data)
        inverse = pow(base, -1, 1 << 64)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, n), out=self.prefix[1:])
        self.back = powers(inverse, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.back[start])
