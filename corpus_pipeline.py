"""A training corpus from documents: stages that read what the one before has kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``; the last one returns the mixture, one row per document and epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import stage, table, unused
from lexiloom.llm.decontaminate import decontaminate
from lexiloom.llm.language import UNKNOWN, identify
from lexiloom.llm.lines import dedup_lines
from lexiloom.llm.queries import mixture
from lexiloom.llm.simhash import simhash_groups

#: The language of a document with a lower score is not known; prose of a known language has 0.4 and more.
LEAST_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and is like one of the languages learned from all labelled rows.

    A null or letterless text goes, and one whose n-grams are out of place in all languages. If no row
    has a label, nothing can be learned and everything goes. A label that differs from the prediction is
    no reason to reject a document, nor is a missing one; labels are kept as they are.
    """
    lang, score = unused(docs, "lang_pred", "lang_score")
    found = identify(docs, pred_column=lang, score_column=score)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of similar lines stays, the first by document and line number.

    ``n_chars`` follows the text. Documents that lose every line stay as rows, with what blank lines they had.
    """
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest id.

    Rows that repeat its id stay with it; without any id in a group, all its rows stay.
    """
    groups = simhash_groups(docs)
    (head,) = unused(docs, "head_id")
    heads = groups.where("component_id is null or doc_id = component_id").select(F.col("doc_id").alias(head)).distinct()
    return docs.join(heads, F.col("doc_id").eqNullSafe(F.col(head)), "left_semi")


def remove_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with an item of ``benchmark``."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of what is left, to the target weights; documents without words are not part of it."""
    return mixture(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("simhash_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_texts),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs


#: Learned profiles and signatures are not for SQL; the stages are tested against brute force.
ORACLE_SQL = None
