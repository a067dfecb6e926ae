"""Table sinks: Parquet and ORC stores, CSV and JSON exports."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STORE_FORMATS = ("parquet", "orc")
EXPORT_FORMATS = ("csv", "json")

# Writer and reader must agree on these, or texts with quotes, line breaks or outer spaces,
# empty texts and NULLs come back changed.
_CSV_OPTIONS = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\u0001",
}


_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Files of several authors that a task keeps open at once; it sorts only what is left when it meets more authors.
MOST_OPEN_FILES = 32


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str, given: bool) -> Iterator[None]:
    """Set ``key`` for a while, unless the session has its own value (``given``)."""
    if not given:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if not given:
            spark.conf.unset(key)


@contextmanager
def open_files(spark: SparkSession, most: int = MOST_OPEN_FILES) -> Iterator[None]:
    """Let tasks of partitioned writes keep ``most`` files open, if the session has not set a number itself.

    Without, Spark sorts the rows of each task by author before they are written, which for tokens is what
    a task holds most of.
    """
    with _setting(spark, _OPEN_FILES, str(most), int(spark.conf.get(_OPEN_FILES, "0")) != 0):
        yield


@contextmanager
def removed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let each job remove its shuffle files when it ends, if the session has not said so itself.

    Spark removes them when the driver's garbage collector finds their plan, which may be after the session's last job: until then
    the files of all tables of a long job add up on disk. A plan that is run again makes them again.
    """
    with _setting(spark, _REMOVE_SHUFFLES, "true", spark.conf.get(_REMOVE_SHUFFLES, "false") == "true"):
        yield


def _write(df: DataFrame, path: str, fmt: str, partition_by: str | None, cluster: bool) -> None:
    if partition_by is not None and cluster:
        # Groups rows by partition value to avoid a file per task and value; Spark splits
        # the partitions of a hot value by size, so it does not become one task.
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**_CSV_OPTIONS)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    with open_files(df.sparkSession), removed_shuffles(df.sparkSession):
        writer.save(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | None = "author",
    cluster: bool = True,
) -> None:
    """Overwrite ``path`` with ``df`` as Parquet or ORC, partitioned by author.

    ``cluster=False`` skips the clustering shuffle, for rows that already arrive grouped.
    """
    fmt = fmt.lower()
    if fmt not in STORE_FORMATS:
        raise ValueError(f"fmt must be one of {STORE_FORMATS}")
    _write(df, path, fmt, partition_by, cluster)


def save_corpus(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store the document table."""
    write_table(df, path, fmt)


def export_corpus(df: DataFrame, path: str, fmt: str, partition_by: str = "author") -> None:
    """Export the document table as quoted CSV with header, or as JSON lines."""
    fmt = fmt.lower()
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"fmt must be one of {EXPORT_FORMATS}")
    _write(df, path, fmt, partition_by, cluster=True)


def read_export(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Read an export back. Texts contain line breaks, hence multi-line CSV."""
    reader = spark.read.schema(schema)
    if fmt.lower() == "csv":
        reader = reader.options(**_CSV_OPTIONS, multiLine=True)
    return reader.format(fmt.lower()).load(path)
