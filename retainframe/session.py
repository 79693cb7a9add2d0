"""Session helpers for tests and the benchmark; on a cluster the caller brings its own session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    # worker processes import this package by name, from wherever the session was started
    paths = [ROOT, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(p for p in paths if p))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("retainframe")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_FALLBACK: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent and Spark runs in this process alone (tests, laptops) it is a temporary
    folder of this process, removed at its end; on a cluster executors would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _FALLBACK:
            _FALLBACK.append(tempfile.mkdtemp(prefix="retainframe-"))
            atexit.register(shutil.rmtree, _FALLBACK[0], ignore_errors=True)
        base = _FALLBACK[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Spark removes a query's shuffle files at its end where this is set, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result feeds several jobs: the written table survives lost executors and cuts the
    lineage, so later jobs do not recompute the shuffles behind it. Those are removed once it is written.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    if _OPEN:
        _OPEN[-1].paths.add(path)
    return out


class Scratch:
    """A ``with`` block at whose end the tables that ``materialize`` wrote inside are removed, but for those given to ``hold``.

    Only what a later plan reads needs holding; held tables pass to the block around, if there is one.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, set()

    def __enter__(self) -> Scratch:
        _OPEN.append(self)
        return self

    def hold(self, df: DataFrame) -> DataFrame:
        self.paths.discard(df.written_path)
        outer = _OPEN[: _OPEN.index(self)]
        if outer:
            outer[-1].paths.add(df.written_path)
        return df

    def __exit__(self, *error) -> None:
        _OPEN.remove(self)
        context = self.spark.sparkContext
        for path in sorted(self.paths):
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


_OPEN: list[Scratch] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of a running session, where it is not installed on them."""
    folder = tempfile.mkdtemp(prefix="retainframe-package-")
    path = shutil.make_archive(f"{folder}/retainframe", "zip", ROOT, "retainframe")
    spark.sparkContext.addPyFile(path)
