"""The test tables seen as corpora, and derived inputs for rules the raw text lacks."""

from __future__ import annotations

import os
import re

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.local import local_table
from lexiloom.operators.annotate import LANGUAGES, annotate, annotate_chunks, rule_tags
from lexiloom.operators.chunk import chunk_corpus
from lexiloom.operators.clean import clean_corpus, strip_boilerplate
from lexiloom.operators.lemmas import form_counts, form_lemmas
from lexiloom.operators.sentences import abbreviations, sentence_offsets, stop_counts, with_sentences
from lexiloom.operators.tagger import TagModel, learn_tags, tag_emissions, tag_transitions
from lexiloom.sources.corpus import corpus_view
from lexiloom.sources.sinks import write_table
from lexiloom.sources.tables import read_table, read_tokens, scratch_dir

SMALL_CHUNK = 300
#: Files that a task writes, on average.
FILES_PER_TASK = 1000
#: Chunks whose token rows one task sorts, on average.
CHUNKS_PER_TASK = 1000

_checkpoints: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_view(
        table(spark, sf_dir, "documents"),
        author="source",
        document_id="doc_id",
        text="text",
        language="lang",
    )
    return docs.repartition("document_id")


def write_files(df: DataFrame, path: str, line_sep: str = "\n") -> None:
    """Rows (author, value) as text files, ``<path>/author=<author>/<name>.txt`` with one row each.

    On a local or mounted file system tasks write the bytes themselves: for every file Spark's sink starts two processes there, for permissions
    of the file and its checksums, and renames it on the driver. On any other one the sink is used. Rows are dealt evenly and put in
    order, so a task that runs again writes the same files.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-df.count() // FILES_PER_TASK))
    dealt = df.repartition(tasks)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() != "file":
        dealt.write.partitionBy("author").option("maxRecordsPerFile", 1).option("lineSep", line_sep).text(path)
        return
    system.mkdirs(folder)
    root = folder.toUri().getPath()
    end = line_sep.encode()

    # Inside, since workers may not find this module.
    def named(author):
        escaped = re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", author or "")
        return f"author={escaped or '__HIVE_DEFAULT_PARTITION__'}"

    def write(rows):
        task = TaskContext.get().partitionId()
        made = {}
        for n, (author, value) in enumerate(rows):
            if author not in made:
                made[author] = f"{root}/{named(author)}"
                os.makedirs(made[author], exist_ok=True)
            with open(f"{made[author]}/part-{task:05d}-{n:06d}.txt", "wb") as file:
                file.write(bytes(value or b"") + end)

    dealt.select("author", F.col("value").cast("binary")).sortWithinPartitions("author", "value").foreachPartition(write)


def eras(spark: SparkSession) -> DataFrame:
    rows = [
        (f"src{i}", "romantic" if i < 10 else "realist", f"Source {i}") for i in range(20)
    ]
    return local_table(spark, rows, "author string, era string, author_label string")


def author_languages(spark: SparkSession) -> DataFrame:
    rows = [(f"src{i}", "en") for i in range(20)]
    return local_table(spark, rows, "author string, language string")


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_corpus(strip_boilerplate(documents(spark, sf_dir)))


def marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents wrapped in licence markers, in five forms by ``doc_id``."""
    book = F.concat(F.lit(" PROJECT GUTENBERG EBOOK "), "document_id", F.lit(" ***\r\n"))
    start = F.concat(F.lit("licence\r\n*** START OF THE"), book)
    end = F.concat(F.lit("\r\n*** END OF THE"), book, F.lit("more licence"))
    form = F.col("document_id").cast("long") % 5
    body = F.col("raw_text")
    return documents(spark, sf_dir).withColumn(
        "raw_text",
        F.when(form == 0, F.concat(start, body, end))
        .when(form == 1, F.concat(start, body))
        .when(form == 2, F.concat(body, end))
        .when(form == 3, F.concat(F.lower(start), body, F.replace(end, F.lit("THE"), F.lit("THIS"))))
        .otherwise(body),
    )


def spaced_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with tabs, doubled spaces, carriage returns and blank lines added."""
    text = F.replace(F.col("raw_text"), F.lit(". "), F.lit(".  \t"))
    text = F.replace(text, F.lit("\n"), F.lit("\r\n\n\r"))
    return documents(spark, sf_dir).withColumn("raw_text", text)


def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents and turns as chunks, user turns marked as speech.

    ``conv_id`` chooses guillemets, curly quotes, straight quotes, one of six leading dashes,
    or a dash before a quote.
    """
    style = F.col("conv_id") % 10
    said = (
        F.when(style == 0, F.concat(F.lit("« "), "text", F.lit(" »")))
        .when(style == 1, F.concat(F.lit("“ "), "text", F.lit(" ”")))
        .when(style == 2, F.concat(F.lit('" '), "text", F.lit(' "')))
        .when(style == 3, F.concat(F.lit("— "), "text"))
        .when(style == 4, F.concat(F.lit("-- "), "text"))
        .when(style == 5, F.concat(F.lit("- - "), "text"))
        .when(style == 6, F.concat(F.lit(":--"), "text"))
        .when(style == 7, F.concat(F.lit("– "), "text"))
        .when(style == 8, F.concat(F.lit("― "), "text"))
        .otherwise(F.concat(F.lit("— “ "), "text", F.lit(" ”")))
    )
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("document_id"),
        F.concat(F.lit("style"), style.cast("string")).alias("author"),
        F.when(F.floor(F.col("conv_id") / 4) % 2 == 0, "en").otherwise("fr").alias("language"),
        F.col("turn").cast("int").alias("chunk_id"),
        F.when(F.col("role") == "user", said).otherwise(F.col("text")).alias("text_clean"),
    )


def _checkpoint(spark: SparkSession, sf_dir: str, kind: str, build) -> DataFrame:
    """Token table stored once per application below the shared checkpoint folder.

    It is the hub that all token queries read, as in a production run.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _checkpoints:
        path = scratch_dir(spark, f"tokens-{kind}")
        write_table(build(), path, cluster=False)
        _checkpoints[key] = path
    return read_tokens(spark, _checkpoints[key])


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checkpoint(
        spark, sf_dir, "documents", lambda: annotate(clean_documents(spark, sf_dir))
    )


def _stored(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """A table written once below the shared folder and read back, as a job keeps what several others read."""
    path = scratch_dir(spark, name)
    write_table(df, path, partition_by=None, cluster=False)
    return read_table(spark, path)


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks stored once per application: several passes read them, and cleaning costs more than reading."""
    return _kept(spark, sf_dir, "chunks", lambda: chunk_corpus(clean_documents(spark, sf_dir)))


def _kept(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table stored once per application, for what several passes of a job read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _checkpoints:
        path = scratch_dir(spark, name)
        write_table(build(), path, partition_by=None, cluster=False)
        _checkpoints[key] = path
    return read_table(spark, _checkpoints[key])


def sentence_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token rows with the sentences that abbreviations learned from the same documents leave."""
    own = chunks(spark, sf_dir)
    counts = _kept(spark, sf_dir, "stop-counts", lambda: stop_counts(own))
    known = _kept(spark, sf_dir, "abbreviations", lambda: abbreviations(counts))
    offsets = _kept(spark, sf_dir, "sentence-offsets", lambda: sentence_offsets(own, known))
    tasks = max(spark.sparkContext.defaultParallelism, -(-offsets.count() // CHUNKS_PER_TASK))
    return with_sentences(own, known, offsets, tasks)


def corpus_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon of the corpus's own forms of five characters or more, with every case of entries by length."""
    form, size = F.lower("token"), F.length("form")
    seen = tokens(spark, sf_dir).select("language", form.alias("form"), "pos").distinct().where(size >= 5)
    entry = {
        # An entry per tag, one for any tag, two and one of a tag that no token has, and both kinds.
        "own": (size == 5) | (size > 8),
        "any": (size == 6) | (size > 8),
        "one": (size == 7) | (size == 8),
        "two": size == 7,
    }
    tag = {"own": F.col("pos"), "any": F.lit(None).cast("string")}
    kinds = F.array_compact(
        F.array(
            *[
                F.when(
                    when,
                    F.struct(
                        F.concat("form", F.lit("/" + kind), F.when(F.lit(kind == "own"), F.col("pos")).otherwise("")).alias("lemma"),
                        tag.get(kind, F.lit("OTHER")).alias("pos"),
                    ),
                )
                for kind, when in entry.items()
            ]
        )
    )
    return seen.select("language", "form", F.explode(kinds).alias("entry")).select("language", "form", "entry.*")


def lexicon_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _stored(spark, "form-counts", form_counts(tokens(spark, sf_dir)))
    return _stored(spark, "form-lemmas", form_lemmas(counts, corpus_lexicon(spark, sf_dir)))


def tagged_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """French and English tokens with their sentences and the tags of the built-in rules.

    The rules look at a token, the one before it and the language only, so they are applied where the sentences are made. Tokens
    that share their place take each other's tags, as from a join by place with a token table stored by author.
    """
    place = ["author", "document_id", "chunk_id", "token_id"]
    named = sentence_tokens(spark, sf_dir).where((F.col("author") != "") & F.col("document_id").isNotNull())
    tag = F.when(F.col("language").isin(*LANGUAGES), F.col("pos"))
    rows = rule_tags(named).withColumn("_tags", F.collect_list(tag).over(Window.partitionBy(*place)))
    return rows.select(*named.columns, F.explode("_tags").alias("pos"))


def tag_model(spark: SparkSession, sf_dir: str) -> TagModel:
    tagged = _stored(spark, "tagged", tagged_sentences(spark, sf_dir))
    transitions = _stored(spark, "transitions", tag_transitions(tagged))
    model = learn_tags(transitions, _stored(spark, "emissions", tag_emissions(tagged)))
    return TagModel(
        *[_stored(spark, name, getattr(model, name)) for name in ("languages", "forms", "endings")]
    )


def small_chunk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens over 300-character chunks, so that sliding frames have neighbours."""
    return _checkpoint(
        spark,
        sf_dir,
        "small-chunks",
        lambda: annotate(clean_documents(spark, sf_dir), max_chars=SMALL_CHUNK),
    )


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checkpoint(
        spark,
        sf_dir,
        "conversations",
        lambda: annotate_chunks(conversation_chunks(spark, sf_dir).repartition("document_id")),
    )


def longest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest French or English document of each author."""
    return (
        table(spark, sf_dir, "documents")
        .where(F.col("lang").isin("fr", "en"))
        .groupBy(F.col("source").alias("author"))
        .agg(F.max_by("doc_id", F.struct("n_chars", "doc_id")).cast("string").alias("document_id"))
    )


def longest_document(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Author and id of the longest French or English document."""
    found = (
        table(spark, sf_dir, "documents")
        .where(F.col("lang").isin("fr", "en"))
        .agg(F.max(F.struct("n_chars", "doc_id", "source")).alias("top"))
        .select("top.source", F.col("top.doc_id").cast("string"))
    )
    return tuple(found.first())


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of files: documents, web pages, and conversation turns in a broken encoding."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("author"),
        F.col("doc_id").cast("string").alias("document_id"),
        F.encode("text", "UTF-8").alias("content"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit("web").alias("author"),
        F.col("page_id").cast("string").alias("document_id"),
        F.encode("html", "UTF-8").alias("content"),
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("chat").alias("author"),
        F.concat_ws("_", "conv_id", "turn").alias("document_id"),
        F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF"))).alias("content"),
    )
    return docs.unionByName(pages).unionByName(turns)


def corpus_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files above, and benchmark items as entries that were never fetched."""
    expected = table(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("author"),
        F.col("item_id").cast("string").alias("document_id"),
    )
    present = corpus_files(spark, sf_dir).select("author", "document_id")
    return present.unionByName(expected)
