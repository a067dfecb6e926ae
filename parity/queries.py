"""Registered queries: one per operator or result table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import tags
from lexiloom.functions import text as txt
from lexiloom.operators import annotate as ann
from lexiloom.operators import chunk as chk
from lexiloom.operators import clean as cln
from lexiloom.operators import diagnostics as diag
from lexiloom.operators import dialog as dlg
from lexiloom.operators import enrich as enr
from lexiloom.operators import lemmas as lem
from lexiloom.operators import lexical as lex
from lexiloom.operators import readability as rdb
from lexiloom.operators import sentences as snt
from lexiloom.operators import tagger as tgr
from lexiloom.plans import jobs, report
from lexiloom.plans.updates import update_tokens
from lexiloom.schemas import DOCUMENT_SCHEMA
from lexiloom.sources import sinks, validation
from lexiloom.sources.corpus import read_files
from lexiloom.sources.tables import read_documents, read_table, read_tokens, scratch_dir
from parity import inputs as src

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Logarithms may differ in the last bit between engines.
def _rounded_logs(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.round(name, 6) for name in ("log_rank", "log_frequency")}
    )


# --- ingestion and cleaning -------------------------------------------------------------


@query
def corpus_ingest_enrich(spark, sf_dir):
    docs = src.documents(spark, sf_dir)
    overrides = docs.where(F.col("language") != "en").select(
        "author", "document_id", "language"
    )
    return enr.enrich_corpus(
        docs.select("author", "document_id", F.length("raw_text").alias("raw_chars")),
        languages=src.author_languages(spark),
        overrides=overrides,
        eras=src.eras(spark),
    )


@query
def strip_boilerplate(spark, sf_dir):
    return cln.strip_boilerplate(src.marked_documents(spark, sf_dir)).select(
        "author", "document_id", "raw_text"
    )


@query
def clean_stats(spark, sf_dir):
    return cln.clean_corpus(src.spaced_documents(spark, sf_dir)).select(
        "author",
        "document_id",
        "language",
        "text_clean",
        "char_count",
        "word_count",
        "sentence_count",
        "avg_words_per_sentence",
    )


@query
def sentence_split(spark, sf_dir):
    return src.clean_documents(spark, sf_dir).select(
        "author", "document_id", F.posexplode("sentences").alias("sentence_id", "sentence")
    )


@query
def clean_top_words(spark, sf_dir):
    clean = enr.add_era(src.clean_documents(spark, sf_dir), src.eras(spark))
    return cln.corpus_statistics(clean, top=100)


@query
def corpus_validation(spark, sf_dir):
    return validation.validate_files(
        src.corpus_manifest(spark, sf_dir), src.corpus_files(spark, sf_dir)
    )


@query
def corpus_file_sizes(spark, sf_dir):
    """Documents written as files by source, judged line by line where they are read."""
    path = scratch_dir(spark, "judged-files")
    docs = src.table(spark, sf_dir, "documents").select(
        F.col("source").alias("author"), F.col("text").alias("value")
    )
    src.write_files(docs, path)
    return validation.file_verdicts(spark, path).groupBy(
        F.regexp_replace("author", "^author=", "").alias("author"), F.col("_verdict").alias("status")
    ).agg(F.count("*").alias("files"), F.sum("size_kb").alias("size_kb"), F.sum("_words").alias("word_count"))


@query
def manifest_missing(spark, sf_dir):
    return validation.manifest_missing(
        src.corpus_manifest(spark, sf_dir), src.corpus_files(spark, sf_dir)
    )


# --- sinks ------------------------------------------------------------------------------


def _stored(spark, sf_dir, fmt):
    docs = src.documents(spark, sf_dir)
    path = scratch_dir(spark, f"corpus-{fmt}")
    if fmt in sinks.STORE_FORMATS:
        sinks.save_corpus(docs, path, fmt)
        return spark.read.schema(docs.schema).format(fmt).load(path), path
    sinks.export_corpus(docs, path, fmt)
    return sinks.read_export(spark, path, fmt, docs.schema), path


def _roundtrip(fmt):
    def run(spark, sf_dir):
        stored, _ = _stored(spark, sf_dir, fmt)
        return stored.select("author", "document_id", "language", "raw_text")

    return run


for _fmt in (*sinks.STORE_FORMATS, *sinks.EXPORT_FORMATS):
    QUERIES[f"format_roundtrip_{_fmt}"] = _roundtrip(_fmt)


@query
def storage_footprint(spark, sf_dir):
    datasets = [
        (f"Ingested corpus, {fmt}", _stored(spark, sf_dir, fmt)[1])
        for fmt in (*sinks.STORE_FORMATS, *sinks.EXPORT_FORMATS)
    ]
    sizes = validation.storage_footprint(spark, [*datasets, ("Never written", f"{sf_dir}/none")])
    return sizes.select("dataset", "size_mb")


@query
def storage_footprint_text(spark, sf_dir):
    """Sizes of plain text files, which are the bytes of the texts and their line ends."""
    datasets = []
    for name, column in (("documents", "text"), ("pages", "html"), ("conversations", "text")):
        path = scratch_dir(spark, f"plain-{name}")
        src.table(spark, sf_dir, name).select(column).write.text(path)
        datasets.append((name, path))
    sizes = validation.storage_footprint(spark, datasets)
    return sizes.select("dataset", "size_mb")


@query
def corpus_scan(spark, sf_dir):
    """Documents written as one file each by author, and read as a corpus directory."""
    path = scratch_dir(spark, "corpus-files")
    docs = src.table(spark, sf_dir, "documents").select(
        F.col("source").alias("author"), F.col("text").alias("value")
    )
    src.write_files(docs, path, "\r\n")
    return read_files(spark, path).select(
        F.regexp_replace("author", "^author=", "").alias("author"), "raw_text"
    )


@query
def job_corpus_tokens(spark, sf_dir):
    """Documents of authors whose names look like numbers: stored, read back, annotated."""
    path = scratch_dir(spark, "job-corpus")
    docs = src.documents(spark, sf_dir).select(
        F.concat(F.lit("0"), F.regexp_replace("author", "src", "")).alias("author"),
        "document_id",
        "language",
        "raw_text",
    )
    stored = docs.withColumns(
        {name: F.lit("") for name in ("source_path", "filename", "era")}
    ).select(*DOCUMENT_SCHEMA.fieldNames())
    sinks.save_corpus(stored, path)
    clean = cln.clean_corpus(cln.strip_boilerplate(read_documents(spark, path)))
    return ann.annotate(clean).groupBy("author", "document_id", "language").agg(
        F.count("*").alias("token_rows")
    )


@query
def job_updated_tokens(spark, sf_dir):
    """A token table made of older documents, brought up to date with the tables' own."""
    path = scratch_dir(spark, "job-updated")
    docs = src.clean_documents(spark, sf_dir)
    same = F.col("author") < "src2"
    older = docs.where(same | (F.col("language") != "fr")).withColumn(
        "text_clean", F.when(same, F.col("text_clean")).otherwise(F.upper("text_clean"))
    )
    update_tokens(older, path)
    update_tokens(docs, path)
    return read_tokens(spark, path).groupBy("author", "document_id", "language").agg(
        F.count("*").alias("token_rows"), F.sum(F.length("token")).alias("token_chars")
    )


@query
def job_readability(spark, sf_dir):
    """The document table of the readability job, from a stored token table."""
    root = scratch_dir(spark, "job-readability")
    jobs.write_tokens(src.clean_documents(spark, sf_dir), f"{root}/tokens")
    jobs.run_readability(spark, f"{root}/tokens", f"{root}/global", f"{root}/sliding")
    return read_table(spark, f"{root}/global")


@query
def job_stylometry(spark, sf_dir):
    """Rows and a sum per document of each of the four tables of the stylometry job."""
    root = scratch_dir(spark, "job-stylometry")
    jobs.write_tokens(src.clean_documents(spark, sf_dir), f"{root}/tokens")
    # A column of each result table that is added up.
    sums = {"zipf": "frequency", "dialog": "dialog_tokens", "ttr": "unique_lemmas", "pos": "token_count"}
    jobs.run_stylometry(spark, f"{root}/tokens", *[f"{root}/{name}" for name in sums])
    found = [
        read_table(spark, f"{root}/{name}")
        .groupBy("author", "document_id")
        .agg(F.count("*").alias("n"), F.sum(column).cast("long").alias("total"))
        .withColumn("result", F.lit(name))
        for name, column in sums.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def job_all(spark, sf_dir):
    """Documents written as files by source and language, through all stages, and once more with ``resume``."""
    root = scratch_dir(spark, "job-all")
    docs = src.table(spark, sf_dir, "documents").select(
        F.concat_ws("-", "source", "lang").alias("author"), F.col("text").alias("value")
    )
    src.write_files(docs, f"{root}/raw")
    folder = F.concat(F.lit("author="), F.concat_ws("-", "source", "lang")).alias("author")
    authors = src.table(spark, sf_dir, "documents").select(folder, F.col("lang").alias("language")).distinct()
    dimensions = (
        authors,
        authors.selectExpr("author", "'' AS document_id", "language").where("false"),
        authors.selectExpr("author", "'any' AS era", "author AS author_label"),
    )
    jobs.run_all(spark, f"{root}/raw", f"{root}/out", *dimensions)
    overview = jobs.run_all(spark, f"{root}/raw", f"{root}/out", *dimensions, resume=True)
    return overview["tokens_by_author"].withColumn("author", F.regexp_replace("author", "^author=", ""))


# --- chunks and tokens ------------------------------------------------------------------


@query
def chunk_corpus(spark, sf_dir):
    return chk.chunk_corpus(src.clean_documents(spark, sf_dir)).select(
        "author",
        "document_id",
        "language",
        "chunk_id",
        "text_clean",
        F.length("text_clean").alias("chunk_chars"),
    )


@query
def chunk_plan(spark, sf_dir):
    return chk.chunk_plan(
        chk.chunk_corpus(src.clean_documents(spark, sf_dir), src.SMALL_CHUNK)
    )


@query
def tokenize(spark, sf_dir):
    return ann.tokenize(chk.chunk_corpus(src.clean_documents(spark, sf_dir))).drop("previous")


@query
def annotate_tokens(spark, sf_dir):
    return ann.annotate(src.clean_documents(spark, sf_dir))


@query
def explode_annotations(spark, sf_dir):
    chunks = chk.chunk_corpus(src.clean_documents(spark, sf_dir))
    words = txt.tokens(F.col("text_clean"))
    arrays = chunks.select(
        "document_id", "author", "language", "chunk_id", words.alias("token_out")
    ).withColumns(
        {
            "lemma_out": F.transform("token_out", lambda t: F.lower(t)),
            "pos_out": F.transform(
                "token_out", lambda t: F.when(t.rlike(r"^\p{Lu}"), "PROPN").otherwise("NOUN")
            ),
        }
    )
    return ann.explode_annotations(arrays)


@query
def abbreviation_scores(spark, sf_dir):
    """Words before full stops, with their counts and how much they look like abbreviations."""
    scores = snt.abbreviation_scores(snt.stop_counts(src.chunks(spark, sf_dir)))
    return scores.withColumn("score", F.round("score", 6))


@query
def lexicon_lemmas(spark, sf_dir):
    """Tokens with the lemmas of a lexicon that holds every long form of the corpus."""
    return lem.with_lemmas(src.tokens(spark, sf_dir), src.lexicon_lemmas(spark, sf_dir))


@query
def sentence_tokens(spark, sf_dir):
    return src.sentence_tokens(spark, sf_dir)


@query
def tag_transitions(spark, sf_dir):
    return tgr.tag_transitions(src.tagged_sentences(spark, sf_dir))


@query
def tag_emissions(spark, sf_dir):
    return tgr.tag_emissions(src.tagged_sentences(spark, sf_dir))


@query
def learned_tags(spark, sf_dir):
    """All French and English tokens, tagged by a model learned from what the built-in rules tag."""
    model = src.tag_model(spark, sf_dir)
    sentences = src.sentence_tokens(spark, sf_dir).where(F.col("language").isin(*ann.LANGUAGES))
    return tgr.tag_sentences(sentences, model)


@query
def entity_flag(spark, sf_dir):
    return (
        src.tokens(spark, sf_dir)
        .groupBy("author", "document_id", "pos", tags.entity_flag(F.col("pos")).alias("ner"))
        .agg(F.count("*").alias("token_rows"))
    )


@query
def row_counts(spark, sf_dir):
    counts = [
        src.documents(spark, sf_dir).agg(F.count("*").alias("row_count")).select(
            F.lit("documents").alias("table_name"), "row_count"
        ),
        src.tokens(spark, sf_dir).agg(F.count("*").alias("row_count")).select(
            F.lit("tokens").alias("table_name"), "row_count"
        ),
    ]
    return counts[0].unionByName(counts[1])


@query
def tokens_by_author(spark, sf_dir):
    return diag.tokens_by_author(src.tokens(spark, sf_dir))


@query
def doc_filter(spark, sf_dir):
    author, document_id = src.longest_document(spark, sf_dir)
    return diag.document_tokens(src.tokens(spark, sf_dir), author, document_id)


# --- readability ------------------------------------------------------------------------


@query
def syllables(spark, sf_dir):
    return (
        src.tokens(spark, sf_dir)
        .groupBy(
            "language",
            "token",
            txt.syllables(F.col("token"), F.col("language")).alias("syllables"),
        )
        .agg(F.count("*").alias("token_rows"))
    )


@query
def chunk_stats(spark, sf_dir):
    return rdb.chunk_stats(src.tokens(spark, sf_dir))


@query
def readability_global(spark, sf_dir):
    return rdb.global_readability(src.tokens(spark, sf_dir)).orderBy("author", "document_id")


@query
def readability_report(spark, sf_dir):
    return report.readability_table(
        rdb.global_readability(src.tokens(spark, sf_dir)), src.eras(spark)
    )


@query
def readability_sliding(spark, sf_dir):
    return rdb.sliding_readability(src.small_chunk_tokens(spark, sf_dir))


@query
def sliding_series(spark, sf_dir):
    return report.sliding_series(
        rdb.sliding_readability(src.small_chunk_tokens(spark, sf_dir))
    ).select("document_id", "chunk_id", "window_size_label", "readability_score")


@query
def sliding_selected(spark, sf_dir):
    """The series of the longest document of each author only."""
    sliding = rdb.sliding_readability(src.small_chunk_tokens(spark, sf_dir))
    return report.sliding_series(sliding, src.longest_documents(spark, sf_dir)).select(
        "author", "document_id", "chunk_id", "window_size_label", "readability_score"
    )


@query
def sliding_summary(spark, sf_dir):
    return report.sliding_summary(
        rdb.sliding_readability(src.small_chunk_tokens(spark, sf_dir))
    )


# --- stylometry -------------------------------------------------------------------------


@query
def zipf(spark, sf_dir):
    return _rounded_logs(lex.zipf(src.tokens(spark, sf_dir)))


@query
def zipf_top500(spark, sf_dir):
    return _rounded_logs(lex.zipf(src.tokens(spark, sf_dir), max_rank=500))


@query
def zipf_top20(spark, sf_dir):
    """A rank that most vocabularies exceed, so the cut takes rows away."""
    return _rounded_logs(lex.zipf(src.tokens(spark, sf_dir), max_rank=20))


@query
def zipf_reps(spark, sf_dir):
    return _rounded_logs(
        report.zipf_curves(
            src.tokens(spark, sf_dir), src.longest_documents(spark, sf_dir), src.eras(spark)
        )
    )


def _labelled(tokens, **options):
    """Labels of a stored token table, dealt to tasks by its number of rows."""
    return dlg.label_dialog(tokens, partitions=dlg.tasks_for(tokens), **options)


@query
def dialog_tokens(spark, sf_dir):
    return _labelled(src.conversation_tokens(spark, sf_dir))


@query
def dialog_tokens_split(spark, sf_dir):
    """The same labels with documents cut into blocks of two chunks."""
    return _labelled(
        src.conversation_tokens(spark, sf_dir), block_tokens=5
    )


@query
def dialog_summary(spark, sf_dir):
    return dlg.dialog_summary(_labelled(src.conversation_tokens(spark, sf_dir)))


@query
def dialog_report(spark, sf_dir):
    segments = _labelled(src.tokens(spark, sf_dir))
    return report.dialog_table(dlg.dialog_summary(segments), src.eras(spark))


@query
def ttr(spark, sf_dir):
    return lex.type_token_ratio(src.tokens(spark, sf_dir))


@query
def lemma_sketches(spark, sf_dir):
    """Distinct lemmas by author, counted, and whether the estimate from the documents' sketches is within 5 %."""
    tokens = src.tokens(spark, sf_dir)
    path = scratch_dir(spark, "lemma-sketches")
    lex.lemma_sketches(tokens).write.parquet(path)
    merged = lex.merged_type_token_ratio(read_table(spark, path), "author")
    counted = lex.type_token_ratio(tokens.withColumns({"document_id": F.lit(""), "language": F.lit("")}))
    close = F.abs(F.col("m.unique_lemmas") - F.col("c.unique_lemmas")) <= 0.05 * F.col("c.unique_lemmas")
    return (
        merged.alias("m")
        .join(counted.alias("c"), F.col("m.author").eqNullSafe(F.col("c.author")), "full")
        .select("c.author", "m.total_tokens", "c.unique_lemmas", close.alias("is_close"))
    )


@query
def ttr_normalised(spark, sf_dir):
    """Type-token ratio with Penn punctuation mapped and left out."""
    return lex.type_token_ratio(src.tokens(spark, sf_dir), normalise_pos=True)


@query
def ttr_by_era(spark, sf_dir):
    return report.ttr_by_era(
        lex.type_token_ratio(src.tokens(spark, sf_dir)), src.eras(spark)
    )


@query
def corpus_size(spark, sf_dir):
    return report.corpus_size(
        lex.type_token_ratio(src.tokens(spark, sf_dir)), src.eras(spark)
    )


@query
def pos_distribution(spark, sf_dir):
    return lex.pos_distribution(src.tokens(spark, sf_dir))


@query
def pos_by_author(spark, sf_dir):
    return report.pos_by_author(
        lex.pos_distribution(src.tokens(spark, sf_dir)), src.eras(spark)
    )


@query
def pos_pivot(spark, sf_dir):
    return report.pos_heatmap(pos_by_author(spark, sf_dir))


# --- diagnostics ------------------------------------------------------------------------


@query
def quote_counts_global(spark, sf_dir):
    return diag.quote_counts(src.conversation_tokens(spark, sf_dir))


@query
def quote_counts_doc(spark, sf_dir):
    return diag.quote_counts_by_document(src.conversation_tokens(spark, sf_dir))


@query
def quote_samples(spark, sf_dir):
    return diag.quote_samples(src.conversation_tokens(spark, sf_dir))
