"""Corpus directories and document tables as sources."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.operators.enrich import enrich_corpus
from lexiloom.schemas import DOCUMENT_SCHEMA


def missing_path(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def plain_path(encoded: Column) -> Column:
    """File path without scheme and URL escapes, from ``_metadata.file_path``."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def path_parts(path: Column) -> dict[str, Column]:
    """Parent directory, file name and stem of a corpus path."""
    return {
        "directory": F.element_at(F.split(path, "/"), -2),
        "filename": F.element_at(F.split(path, "/"), -1),
        "document_id": F.regexp_replace(
            F.element_at(F.split(path, "/"), -1), r"(?s)(?<=.)\.[^.]+\z", ""
        ),
    }


def _corpus_pattern(data_dir: str) -> str | None:
    """What the path of a corpus file matches, None for a folder that is relative or a pattern itself."""
    base = re.sub(r"^(file:(?=/)|[A-Za-z][A-Za-z0-9+.-]*://[^/]*)", "", data_dir).rstrip("/")
    base = re.sub("^/+", "/", base)
    if not base.startswith("/") or re.search(r"[*?\[\]{}\\%]|//|/\.{1,2}(/|$)", base):
        return None
    return rf"(?s)\A([A-Za-z][A-Za-z0-9+.-]*://[^/]*)?{re.escape(base)}/[^/]+/[^/]+\.txt\z"


def read_corpus_files(spark: SparkSession, data_dir: str, fmt: str, **options) -> DataFrame:
    """The rows of every ``<data_dir>/<author>/<title>.txt`` in a file format of Spark's.

    Folders are listed as a whole and their files chosen by path: a pattern of files makes Spark's driver
    look up and list each file by itself, once per reading.
    """
    reader = spark.read.format(fmt).options(**options)
    wanted = _corpus_pattern(data_dir)
    if wanted is None:
        return reader.load(f"{data_dir}/*/*.txt")
    files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(data_dir)
    return files.where(plain_path(F.col("_metadata.file_path")).rlike(wanted))


def listed_files(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """``binaryFile`` rows of every ``<data_dir>/<author>/<title>.txt``, and ``source_path`` of all of them.

    Spark's file sources leave out files of zero length. The second table has them as well, from the listing of
    paths that Spark's driver holds for any scan of files; the names stay in the JVM, where one call makes a table of them.
    """
    absent = f"No .txt files found under {data_dir}"
    try:
        files = read_corpus_files(spark, data_dir, "binaryFile")
    except AnalysisException as error:
        if missing_path(error):
            raise FileNotFoundError(absent) from error
        raise
    jvm = spark.sparkContext._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    names = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING()).toDF()
    listed = DataFrame(names, spark).toDF("name").select(plain_path(F.col("name")).alias("source_path"))
    wanted = _corpus_pattern(data_dir)
    if wanted is not None:
        listed = listed.where(F.col("source_path").rlike(wanted))
    if listed.isEmpty():
        raise FileNotFoundError(absent)
    return files, listed


def source_path() -> Column:
    return plain_path(F.col("_metadata.file_path")).alias("source_path")


def corpus_contents(spark: SparkSession, data_dir: str) -> DataFrame:
    """``source_path`` and ``content`` (bytes) of every ``<data_dir>/<author>/<title>.txt``, each file read once.

    Files are read as bytes: Spark's text source sets up a Hadoop job for each file, which for small ones
    takes several times as long as reading them.
    """
    files, listed = listed_files(spark, data_dir)
    unread = listed.join(files.select(source_path()), "source_path", "left_anti")
    return files.select(source_path(), "content").union(unread.select("source_path", F.lit("").cast("binary")))


def corpus_fingerprint(spark: SparkSession, data_dir: str) -> str:
    """Number, names, sizes and times of the files of a corpus directory, as a short text.

    Only the listing is read. A file that is added, removed, renamed or written again gives another one.
    """
    files, listed = listed_files(spark, data_dir)
    version = F.concat_ws(":", "length", F.unix_micros("modificationTime"))
    versions = listed.join(files.select(source_path(), version.alias("version")), "source_path", "left")
    return table_fingerprint(versions.select("source_path", F.coalesce("version", F.lit("0")).alias("version")))


def table_fingerprint(df: DataFrame) -> str:
    """Number of rows and two sums of their hashes, the same in any order of rows."""
    value = F.xxhash64(*df.columns)
    total = F.sum(value.cast("decimal(38,0)"))
    return ":".join(map(str, df.agg(F.count("*"), F.bit_xor(value), total).first()))


def read_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per ``<data_dir>/<author>/<title>.txt``, decoded as strict UTF-8.

    The author is the lower-cased directory name. Files are listed by Spark and read whole
    by its tasks, one row per file. A file that is not valid UTF-8 fails the job with its
    path.
    """
    files = corpus_contents(spark, data_dir).withColumn("value", F.col("content").cast("string"))
    path = F.col("source_path")
    invalid = F.raise_error(F.concat(F.lit("Not valid UTF-8: "), path)).cast("string")
    content = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(invalid)
    return (
        files.withColumns(path_parts(path))
        .withColumn("raw_text", content)
        .select(
            txt.unix_newlines(F.col("raw_text")).alias("raw_text"),
            "source_path",
            F.lower("directory").alias("author"),
            "filename",
            "document_id",
        )
    )


def read_corpus(
    spark: SparkSession,
    data_dir: str,
    languages: DataFrame | None = None,
    overrides: DataFrame | None = None,
    eras: DataFrame | None = None,
) -> DataFrame:
    """Document table of a corpus directory, with language and era."""
    documents = enrich_corpus(read_files(spark, data_dir), languages, overrides, eras)
    return documents.select(*DOCUMENT_SCHEMA.fieldNames())


def corpus_view(
    df: DataFrame, author: str, document_id: str, text: str, language: str
) -> DataFrame:
    """Any table with a text column as ``raw_text, author, document_id, language``."""
    return df.select(
        F.col(text).alias("raw_text"),
        F.col(author).cast("string").alias("author"),
        F.col(document_id).cast("string").alias("document_id"),
        F.col(language).alias("language"),
    )
