"""Files: CSV input with chosen columns, Parquet tables between stages, vector tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import parse_date, parse_timestamp
from .schemas import VISIT_FILES


CORRUPT = "corrupt_record"


def read_csv(
    spark: SparkSession, path: str, columns: Mapping[str, str], header: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Chosen columns of a CSV file under new names, all as strings, and ``corrupt_record``.

    ``header`` is the full column list of the file; without it the first line is read for it. Nothing is inferred
    from the data, types come from :func:`typed`. Quotes are doubled inside quoted values. A line with too few or too
    many values keeps its text in ``corrupt_record``, else that is null. ``multi_line=False`` lets Spark
    split large files, for files known to have no line breaks inside quotes.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = header or reader.csv(path).columns
    reader = reader.option("enforceSchema", header is None).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    # without column pruning every line is counted out, also for columns that are not asked for
    reader = reader.option("columnPruning", False).schema(", ".join(f"`{name}` string" for name in [*names, CORRUPT]))
    # Spark does not read the corrupt record alone, so it takes no characters of the first column along
    nothing = F.left(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), F.lit(0))
    return reader.csv(path).select(*(F.col(f"`{old}`").alias(new) for old, new in columns.items()), F.concat(F.col(CORRUPT), nothing).alias(CORRUPT))


def typed(rows: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): columns cast to ``types``; a row with a value that does not fit is rejected.

    An empty value is a null, not a misfit. Rejected rows keep their strings and name the columns; a corrupt line
    names ``corrupt_record``, which good rows do not have.
    """

    def cast(name: str):
        if types[name] == "date":
            return parse_date(F.col(name))
        return parse_timestamp(F.col(name)) if types[name] == "timestamp" else F.col(name).try_cast(types[name])

    corrupt = [F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))] if CORRUPT in rows.columns else []
    wrong = [F.when(F.col(c).isNotNull() & cast(c).isNull(), F.lit(c)) for c in types] + corrupt
    misfits = F.filter(F.array(*wrong).cast("array<string>"), lambda c: c.isNotNull())
    marked = rows.withColumn("misfits", misfits)
    good = marked.where(F.size("misfits") == 0).drop("misfits", CORRUPT).withColumns({c: cast(c) for c in types})
    return good, marked.where(F.size("misfits") > 0)


def read_visit_tables(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The vehicle, member, purchase and visit tables of a folder of CSV files, and their rejected rows."""
    good, rejected = {}, {}
    for name, (file, columns, types) in VISIT_FILES.items():
        rows = read_csv(spark, f"{folder.rstrip('/')}/{file}", columns)
        good[name], rejected[name] = typed(rows, types)
    return good, rejected


def write_csv(rows: DataFrame, path: str) -> None:
    """Result table as CSV; arrays become ``;``-joined strings."""
    flat = [
        F.array_join(name, ";").alias(name) if dtype == "array<string>" else F.col(name) for name, dtype in rows.dtypes
    ]
    writer = rows.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_table(rows: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and return the written table."""
    rows.write.mode("overwrite").parquet(path)
    return read_table(rows.sparkSession, path, rows.schema)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_vectors(rows: DataFrame, path: str, max_rows_per_file: int = 1_000_000) -> DataFrame:
    """Vector table (id, vector, text, metadata); file size takes the place of insert batches."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
    return read_table(rows.sparkSession, path, rows.schema)


# Names under a vector table's folder; Spark's readers of the folder itself skip what begins with an underscore.
COMMITTED, VERSION = "_committed", "_version"


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def vector_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions of a rebuilt vector table, in order."""
    files, place = _files(spark, f"{path}/{COMMITTED}")
    return sorted(int(f.getPath().getName()) for f in files.listStatus(place)) if files.exists(place) else []


def read_vectors(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The current version of a vector table: the newest complete rebuild, else what :func:`write_vectors` wrote."""
    versions = vector_versions(spark, path)
    return read_table(spark, f"{path}/{VERSION}-{versions[-1]}" if versions else path, schema)


def rebuild_vectors(first: DataFrame, second: DataFrame, path: str, keep_versions: int = 2) -> DataFrame:
    """Replace the vector table by the rows of both sources, and return it.

    The rows are written beside the current version. Only when all are there an empty file with the new number is created,
    which no second rebuild can create too; from then on :func:`read_vectors` finds the new version. A rebuild
    that fails leaves the table as it was. Plans made before go on reading the version they were made for; of those
    the last ``keep_versions`` stay.
    """
    spark, rows = first.sparkSession, first.unionByName(second)
    number = (vector_versions(spark, path) or [0])[-1] + 1
    write_vectors(rows, f"{path}/{VERSION}-{number}")
    files, mark = _files(spark, f"{path}/{COMMITTED}/{number}")
    files.create(mark, False).close()  # fails where the number is taken
    for old in vector_versions(spark, path)[:-keep_versions]:
        for gone in (f"{path}/{COMMITTED}/{old}", f"{path}/{VERSION}-{old}"):
            files.delete(_files(spark, gone)[1], True)
    return read_vectors(spark, path, rows.schema)
