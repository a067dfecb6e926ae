"""Checks of corpus files against a manifest, and storage sizes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.local import local_table
from lexiloom.operators.enrich import unique
from lexiloom.schemas import require_columns
from lexiloom.sources.corpus import corpus_contents, listed_files, missing_path, path_parts, read_corpus_files, source_path

_KEY = ["author", "document_id"]
HEAD_BYTES = 200
HTML_MARKS = ("<!DOCTYPE", "<html")
#: Files of at most so many bytes are judged as a whole, in one pass; larger ones by lines, in splits.
WHOLE_BYTES = 1 << 20


def binary_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """``author, document_id, content`` of all corpus files, undecoded.

    The author is the directory name as it is, because a manifest names exact paths.
    """
    parts = path_parts(F.col("source_path"))
    return corpus_contents(spark, data_dir).select(
        parts["directory"].alias("author"),
        parts["document_id"].alias("document_id"),
        "content",
    )


def _html_mark(head: Column) -> Column:
    html = F.lit(False)
    for mark in HTML_MARKS:
        html = html | F.contains(head, F.lit(mark.encode()))
    return html


def _verdict(html: Column, valid: Column) -> Column:
    return F.when(html, "HTML_ERR").when(~valid, "ENCODING").otherwise("ok").alias("_verdict")


def _word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[^{txt.BLANK}]+"))


def _judged(content: Column) -> list[Column]:
    """Verdict and number of words of a file's bytes."""
    text = content.cast("string")
    html = _html_mark(F.substring(content, 1, HEAD_BYTES))
    return [_verdict(html, F.is_valid_utf8(text)), _word_count(text).alias("_words")]


def file_verdicts(spark: SparkSession, data_dir: str) -> DataFrame:
    """(author, document_id, _verdict, size_kb, _words) of all corpus files.

    Files of at most ``WHOLE_BYTES`` are read as a whole, larger ones by lines.
    """
    files, listed = listed_files(spark, data_dir)
    # Spark chooses files by their listed size, before it makes tasks.
    size = F.col("_metadata.file_size")
    whole = files.where(size <= WHOLE_BYTES)
    judged = whole.select(source_path(), F.col("length").alias("size"), *_judged(F.col("content")))
    if not files.where(size > WHOLE_BYTES).isEmpty():
        judged = judged.union(_line_verdicts(spark, data_dir, WHOLE_BYTES))
    # A file of zero length is in the listing only.
    found = listed.join(judged, "source_path", "left")
    parts = path_parts(F.col("source_path"))
    return found.select(
        parts["directory"].alias("author"),
        parts["document_id"].alias("document_id"),
        F.coalesce("_verdict", F.lit("ok")).alias("_verdict"),
        F.floor(F.coalesce("size", F.lit(0)) / 1024).alias("size_kb"),
        F.coalesce("_words", F.lit(0)).cast("long").alias("_words"),
    )


def _line_verdicts(spark: SparkSession, data_dir: str, least: int) -> DataFrame:
    """(source_path, size, _verdict, _words) of the corpus files of more than ``least`` bytes, read by lines and not as a whole.

    A large file is read in splits by several tasks; a row is a line, which Spark cuts the same way
    wherever a split ends. No character of UTF-8 has the byte of a line end inside, so a file is valid if all its lines
    are, and no word goes over a line end, so words add up. Only the first lines of a file are put in order, for its
    first bytes. Spark leaves out a byte order mark, three bytes: then a file is larger than its lines.
    """
    files = read_corpus_files(spark, data_dir, "text", lineSep="\n").where(F.col("_metadata.file_size") > least)
    lines = files.select(
        source_path(),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nr"),
        F.col("value").alias("line"),
    )
    lines = lines.withColumn("bytes", F.octet_length("line") + 1)
    whole = lines.groupBy("source_path", "size").agg(
        F.bool_and(F.is_valid_utf8("line")).alias("valid"),
        F.sum(_word_count(F.col("line")).cast("long")).alias("words"),
        F.sum("bytes").alias("bytes"),
    )
    # A line has a byte at least, so no later one reaches into the first bytes.
    order = Window.partitionBy("source_path").orderBy("nr")
    first = lines.where("split = 0").select(
        "source_path",
        "nr",
        "bytes",
        F.rlike("line", F.lit(rf"\A([{txt.BLANK}]|\z)")).alias("blank"),
        F.substring(F.col("line").cast("binary"), 1, HEAD_BYTES).alias("line"),
    )
    first = first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HEAD_BYTES)
    first = first.withColumn("at", F.sum("bytes").over(order) - F.col("bytes"))

    def html_in(head_bytes: int) -> Column:
        left = F.greatest(F.lit(0), head_bytes - F.col("at")).cast("int")
        return F.bool_or(_html_mark(F.substring("line", F.lit(1), left)))

    heads = first.groupBy("source_path").agg(
        html_in(HEAD_BYTES).alias("html"),
        html_in(HEAD_BYTES - 3).alias("html_after_mark"),
        F.bool_or((F.col("place") == 1) & F.col("blank")).alias("blank"),
    )
    # A file is larger than its lines only by such a mark.
    marked = F.col("size") > F.col("bytes")
    # A byte order mark before a blank is a word of its own.
    alone = marked & F.coalesce("blank", F.lit(True))
    html = F.when(marked, F.col("html_after_mark")).otherwise(F.col("html"))
    return whole.join(heads, "source_path", "left").select(
        "source_path",
        "size",
        _verdict(F.coalesce(html, F.lit(False)), F.col("valid")),
        (F.col("words") + F.when(alone, 1).otherwise(0)).alias("_words"),
    )


def validate_corpus(manifest: DataFrame, data_dir: str) -> DataFrame:
    """:func:`validate_files` of a corpus directory, for files of any size."""
    require_columns(manifest, _KEY, "manifest")
    return _against(manifest, file_verdicts(manifest.sparkSession, data_dir))


def validate_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Status of every manifest entry: MISSING, HTML_ERR, ENCODING or ok, in this order.

    File bytes are judged where they are read; only the small verdict rows are joined to
    the manifest. An entry or a file that occurs twice fails the job.
    """
    require_columns(manifest, _KEY, "manifest")
    require_columns(files, {*_KEY, "content"}, "files")
    judged = files.select(*_KEY, F.floor(F.octet_length("content") / 1024).alias("size_kb"), *_judged(F.col("content")))
    return _against(manifest, judged)


def _against(manifest: DataFrame, judged: DataFrame) -> DataFrame:
    return (
        unique(manifest.select(*_KEY), *_KEY)
        .join(unique(judged, *_KEY), _KEY, "left")
        .select(
            *_KEY,
            F.coalesce("_verdict", F.lit("MISSING")).alias("status"),
            F.when(F.col("_verdict").isin("ok", "HTML_ERR"), F.col("size_kb")).alias("size_kb"),
            F.when(F.col("_verdict") == "ok", F.col("_words")).alias("word_count"),
        )
    )


def manifest_missing(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Manifest entries without a file."""
    require_columns(manifest, _KEY, "manifest")
    return manifest.select(*_KEY).join(files.select(*_KEY), _KEY, "left_anti")


def storage_footprint(spark: SparkSession, datasets: Iterable[tuple[str, str]]) -> DataFrame:
    """Size in MB of each ``(label, directory)`` that exists, largest first.

    Only file listings are read. Files that Spark hides (names starting with ``_`` or
    ``.``) are not counted.
    """
    sizes = None
    for label, path in datasets:
        try:
            files = (
                spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            )
        except AnalysisException as error:
            if missing_path(error):
                continue
            raise
        rows = files.select(
            F.lit(label).alias("dataset"), F.lit(path).alias("folder"), "length"
        )
        sizes = rows if sizes is None else sizes.unionByName(rows)
    if sizes is None:
        return local_table(spark, [], "dataset string, folder string, size_mb double")
    return (
        sizes.groupBy("dataset", "folder")
        .agg((F.rint(F.sum("length") / 1_048_576 * 100.0) / 100.0).alias("size_mb"))
        .orderBy(F.desc("size_mb"), "dataset")
    )
