"""A token table kept up to date: only authors whose documents have changed are annotated again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as txt
from lexiloom.operators.annotate import LANGUAGES, annotate_chunks
from lexiloom.operators.chunk import chunk_corpus
from lexiloom.plans.jobs import write_tokens
from lexiloom.schemas import require_columns
from lexiloom.sources.corpus import missing_path
from lexiloom.sources.sinks import open_files, write_table
from lexiloom.sources.tables import read_table, read_tokens, scratch_dir

DIGEST_SCHEMA = "document_id string, language string, digest string, copies bigint, author string"
_PENDING = "pending"


def digests_path(path: str) -> str:
    """Where the digests of a token table's documents are stored, next to the table."""
    return f"{path}_documents"


def document_digests(
    clean_df: DataFrame, max_chars: int = txt.DEFAULT_CHUNK_CHARS, version: str = ""
) -> DataFrame:
    """(document_id, language, digest, copies, author) of the documents that give tokens.

    The digest covers the text and what else decides on its tokens: chunk size and ``version``, which
    names the lexicon in use. Equal rows are counted. Other languages and blank or null texts give no tokens, so
    no row. An empty author is stored as a null one, as the token table does.
    """
    require_columns(
        clean_df, {"author", "document_id", "language", "text_clean"}, "document_digests"
    )
    kept = F.col("language").isin(*LANGUAGES) & F.rlike("text_clean", F.lit(rf"[^{txt.BLANK}]"))
    settings = F.lit(f"{version}\n{max_chars}\n")
    return (
        clean_df.where(kept)
        .groupBy(
            F.col("document_id").cast("string").alias("document_id"),
            "language",
            F.sha2(F.concat(settings, "text_clean"), 256).alias("digest"),
            F.nullif(F.col("author").cast("string"), F.lit("")).alias("author"),
        )
        .agg(F.count("*").alias("copies"))
        .select("document_id", "language", "digest", "copies", "author")
    )


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """Digests of what the token table at ``path`` holds, None unless both are there."""
    try:
        read_tokens(spark, path)
        stored = spark.read.schema(DIGEST_SCHEMA).parquet(digests_path(path))
    except AnalysisException as error:
        if missing_path(error):
            return None
        raise
    return None if stored.isEmpty() else stored


def _replace(df: DataFrame, path: str) -> None:
    """Overwrite the partitions of the authors in ``df``, and no others."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with open_files(df.sparkSession):
        writer.partitionBy("author").parquet(path)


def update_tokens(
    clean_df: DataFrame,
    path: str,
    max_chars: int = txt.DEFAULT_CHUNK_CHARS,
    lexicon: DataFrame | None = None,
    version: str = "",
) -> DataFrame:
    """Make the token table at ``path`` that of ``clean_df``; returns the authors written, as a stored table.

    Documents are compared by digest with those the table was made of. An author with a new, changed or
    missing document is annotated again and takes the place of its folder; the others are not touched.
    A table without digests, or one with an author that has no document left, is written as a whole.

    An author's digests are marked as pending before its tokens are replaced and stored after, so an update
    that was stopped half-way is taken up by the next one. Two updates must not run at once.
    Give another ``version`` with another ``lexicon``. Raises when nothing can be annotated, before anything is overwritten.
    """
    spark = clean_df.sparkSession
    digests = digests_path(path)
    scratch = scratch_dir(spark, "digests")
    document_digests(clean_df, max_chars, version).write.parquet(scratch)
    current = spark.read.schema(DIGEST_SCHEMA).parquet(scratch)
    if current.isEmpty():
        raise RuntimeError("No documents were annotated.")
    authors = current.select("author").distinct()

    stored = _stored(spark, path)
    if stored is None or not stored.select("author").subtract(authors).isEmpty():
        write_table(current.where("false"), digests)
        write_tokens(clean_df, path, max_chars, lexicon)
        write_table(current, digests)
        return authors

    differing = current.subtract(stored).union(stored.subtract(current))
    scratch = scratch_dir(spark, "changed-authors")
    differing.select("author").distinct().write.parquet(scratch)
    changed = read_table(spark, scratch)
    if changed.isEmpty():
        return changed
    pending = changed.selectExpr(
        "'' AS document_id", "'' AS language", f"'{_PENDING}' AS digest", "0L AS copies", "author"
    )
    _replace(pending, digests)
    wanted = changed.withColumnRenamed("author", "_changed")

    def of_changed(df: DataFrame) -> DataFrame:
        author = F.nullif(F.col("author").cast("string"), F.lit(""))
        return df.join(wanted, author.eqNullSafe(F.col("_changed")), "left_semi")

    documents = clean_df.select("author", "document_id", "language", "text_clean")
    documents = of_changed(documents.where(F.col("language").isin(*LANGUAGES)))
    chunks = chunk_corpus(documents, max_chars)
    _replace(annotate_chunks(chunks.hint("rebalance", "author"), lexicon), path)
    _replace(of_changed(current), digests)
    return changed
