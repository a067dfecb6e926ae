"""Batch jobs: from files to the token checkpoint and from there to the result tables.

Each stage reads a stored table and writes one, so a lost executor costs the tasks it ran.
A finished stage leaves a mark with a fingerprint of its input and settings, by which a job
that was stopped goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.operators.annotate import LANGUAGES, annotate_chunks
from lexiloom.operators.chunk import chunk_corpus
from lexiloom.operators.clean import clean_corpus, corpus_statistics, strip_boilerplate
from lexiloom.operators.diagnostics import tokens_by_author, verify_tokens
from lexiloom.operators.dialog import dialog_summary, label_dialog, tasks_for
from lexiloom.operators.lexical import pos_distribution, type_token_ratio, zipf
from lexiloom.operators.readability import (
    WINDOW_SIZES,
    chunk_stats,
    global_from_stats,
    sliding_from_stats,
)
from lexiloom.sources.corpus import (
    corpus_fingerprint,
    missing_path,
    read_corpus,
    table_fingerprint,
)
from lexiloom.sources.sinks import removed_shuffles, save_corpus, write_table
from lexiloom.sources.tables import read_documents, read_table, read_tokens, scratch_dir


@dataclass
class Layout:
    """Output folders below one root."""

    root: str
    corpus_parquet: str = field(init=False)
    corpus_orc: str = field(init=False)
    tokens: str = field(init=False)
    readability_global: str = field(init=False)
    readability_sliding: str = field(init=False)
    zipf: str = field(init=False)
    dialog: str = field(init=False)
    ttr: str = field(init=False)
    pos: str = field(init=False)

    def __post_init__(self):
        # Folder names of the stored tables.
        self.corpus_parquet = f"{self.root}/corpus_parquet"
        self.corpus_orc = f"{self.root}/corpus_orc"
        self.tokens = f"{self.root}/corpus_annotated"
        self.readability_global = f"{self.root}/readability_global"
        self.readability_sliding = f"{self.root}/readability_sliding"
        self.zipf = f"{self.root}/stylometry_zipf"
        self.dialog = f"{self.root}/stylometry_dialog"
        self.ttr = f"{self.root}/stylometry_ttr"
        self.pos = f"{self.root}/stylometry_pos"


def write_tokens(
    clean_df: DataFrame,
    path: str,
    max_chars: int = txt.DEFAULT_CHUNK_CHARS,
    lexicon: DataFrame | None = None,
) -> None:
    """Annotate a clean document table into the token checkpoint.

    Chunks, not tokens, are grouped by author for the partitioned write: they are several
    times smaller, and annotation after the shuffle is narrow. A hot author is split by
    size, and so is a huge document, whose chunks are rows of their own. Raises when no
    document has a supported language or any text, before a table already there is
    overwritten.
    """
    documents = clean_df.select("author", "document_id", "language", "text_clean")
    chunks = chunk_corpus(documents.where(documents["language"].isin(*LANGUAGES)), max_chars)
    with removed_shuffles(clean_df.sparkSession):
        empty = chunks.isEmpty()
    if empty:
        raise RuntimeError("No documents were annotated.")
    tokens = annotate_chunks(chunks.hint("rebalance", "author"), lexicon)
    write_table(tokens, path, cluster=False)


def run_readability(
    spark: SparkSession,
    tokens_dir: str,
    global_dir: str,
    sliding_dir: str,
    window_sizes: Sequence[int] = WINDOW_SIZES,
) -> None:
    """Both readability tables from one scan of the token checkpoint.

    The chunk statistics, about one row per 700 tokens, are a stored table between the two.
    """
    stats = chunk_stats(read_tokens(spark, tokens_dir))
    path = scratch_dir(spark, "chunk-stats")
    write_table(stats, path, partition_by=None)
    stats = read_table(spark, path, stats.schema)
    write_table(global_from_stats(stats), global_dir)
    write_table(sliding_from_stats(stats, window_sizes), sliding_dir)


def run_stylometry(
    spark: SparkSession, tokens_dir: str, zipf_dir: str, dialog_dir: str, ttr_dir: str, pos_dir: str
) -> None:
    """The four stylometry tables; each scans only the columns it needs."""
    tokens = read_tokens(spark, tokens_dir)
    write_table(zipf(tokens), zipf_dir)
    write_table(dialog_summary(label_dialog(tokens, partitions=tasks_for(tokens))), dialog_dir)
    write_table(type_token_ratio(tokens), ttr_dir)
    write_table(pos_distribution(tokens), pos_dir)


def _mark(spark: SparkSession, root: str, stage: str, value: str) -> None:
    row = spark.range(1).select(F.lit(value).alias("value"))
    row.coalesce(1).write.mode("overwrite").text(f"{root}/finished/{stage}")


def _is_finished(spark: SparkSession, root: str, stage: str, value: str, tables: Sequence[str]) -> bool:
    """Whether the stage's mark has this value and its tables are there."""
    try:
        marks = spark.read.text(f"{root}/finished/{stage}").where(F.col("value") == value)
        for path in tables:
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return not marks.isEmpty()
    except AnalysisException as error:
        if missing_path(error):
            return False
        raise


def forget(spark: SparkSession, root: str, stage: str) -> None:
    """Take a stage's mark away, before its tables are written by anything but :func:`run_all`."""
    _mark(spark, root, stage, "")


def run_all(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    languages: DataFrame | None = None,
    overrides: DataFrame | None = None,
    eras: DataFrame | None = None,
    window_sizes: Sequence[int] = WINDOW_SIZES,
    resume: bool = False,
) -> dict[str, DataFrame]:
    """Corpus directory to all stored tables; returns the two overview reports.

    With ``resume`` a stage is left out if it has finished with the same files, by name, size and time, the
    same dimension tables and settings. A stage's mark is taken away before its tables are written.
    """
    out = Layout(out_dir)
    tables = (languages, overrides, eras)
    dimensions = [None if t is None else table_fingerprint(t) for t in tables]
    source = [corpus_fingerprint(spark, data_dir), *dimensions]

    def run(stage, tables, action, settings=()):
        value = sha256(repr((stage, source, settings)).encode()).hexdigest()
        if resume and _is_finished(spark, out.root, stage, value, tables):
            return
        forget(spark, out.root, stage)
        action()
        _mark(spark, out.root, stage, value)

    def store_corpus():
        save_corpus(read_corpus(spark, data_dir, languages, overrides, eras), out.corpus_parquet)

    run("corpus_parquet", [out.corpus_parquet], store_corpus)
    corpus = read_documents(spark, out.corpus_parquet)
    run("corpus_orc", [out.corpus_orc], lambda: save_corpus(corpus, out.corpus_orc, "orc"))

    clean = clean_corpus(strip_boilerplate(corpus))
    run("tokens", [out.tokens], lambda: write_tokens(clean, out.tokens), (txt.DEFAULT_CHUNK_CHARS,))
    tokens = verify_tokens(read_tokens(spark, out.tokens))

    scores = (out.readability_global, out.readability_sliding)
    run(
        "readability",
        scores,
        lambda: run_readability(spark, out.tokens, *scores, window_sizes),
        tuple(window_sizes),
    )
    style = (out.zipf, out.dialog, out.ttr, out.pos)
    run("stylometry", style, lambda: run_stylometry(spark, out.tokens, *style))
    return {
        "corpus_statistics": corpus_statistics(clean),
        "tokens_by_author": tokens_by_author(tokens),
    }
