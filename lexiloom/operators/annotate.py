"""From chunks to the token table: tokens, lemmas, parts of speech, entity flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import tags
from lexiloom.functions import text as txt
from lexiloom.functions.lexicon import builtin_lexicon, suffix_of, suffix_table
from lexiloom.operators.chunk import chunk_corpus
from lexiloom.schemas import require_columns

LANGUAGES = ("fr", "en")

_CHUNK = ["document_id", "author", "language", "chunk_id"]

# A token after one of these (or at the start of a chunk) may be capitalised without
# being a name.
_BEFORE_CAPITAL = [*tags.SENTENCE_END, "«", "»", "“", "”", '"', "—", "–", "-", "--"]


def tokenize(chunks: DataFrame) -> DataFrame:
    """One row per token with its position in the chunk and the token before it.

    Narrow: a chunk's tokens are produced by the task that holds the chunk. The previous
    token comes from the same array, so no window is needed for it.
    """
    require_columns(chunks, {*_CHUNK, "text_clean"}, "tokenize")
    found = chunks.select(*_CHUNK, txt.tokens(F.col("text_clean")).alias("_tokens"))
    shifted = F.slice(
        F.concat(F.array(F.lit(None).cast("string")), "_tokens"), 1, F.size("_tokens")
    )
    return (
        found.select(
            *_CHUNK,
            F.posexplode(
                F.arrays_zip(F.col("_tokens").alias("token"), shifted.alias("previous"))
            ).alias("token_id", "_token"),
        )
        .select(*_CHUNK, "token_id", "_token.token", "_token.previous")
    )


def _distinct_forms(lexicon: DataFrame) -> DataFrame:
    """One entry per language and form, so that look-ups never multiply tokens."""
    entry = F.struct("lemma", "pos")
    return (
        lexicon.where(F.col("form").isNotNull())
        .groupBy("language", "form")
        .agg(F.min(entry).alias("_entry"))
        .select("language", "form", "_entry.lemma", "_entry.pos")
    )


def annotate_chunks(chunks: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Token table of a chunk table; languages other than French and English drop out.

    English gets Penn tags, French universal ones. A form in the lexicon takes lemma and
    tag from there. Otherwise marks and numbers are tagged by their characters,
    capitalised words inside a sentence are names, and other words follow their suffix.

    The built-in tables are local relations of short rows, so Spark broadcasts them and
    the whole annotation stays one narrow stage. Keeping the rules in tables also keeps
    the generated code of that stage small enough to be compiled. A caller's ``lexicon``
    (``language, form, lemma, pos``) is joined without a hint: broadcast below Spark's
    size threshold, otherwise shuffled with skewed forms split.
    """
    require_columns(chunks, {*_CHUNK, "text_clean"}, "annotate_chunks")
    words = rule_tags(tokenize(chunks.where(F.col("language").isin(*LANGUAGES))), lexicon)
    return words.select(*_CHUNK, "token_id", "token", "lemma", "pos").withColumn("ner", tags.entity_flag(F.col("pos")))


def rule_tags(tokens: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """French and English token rows, which have the token before them as ``previous``, with ``lemma`` and ``pos``
    by the rules of :func:`annotate_chunks`."""
    require_columns(tokens, {"language", "token", "previous"}, "rule_tags")
    spark = tokens.sparkSession
    if lexicon is None:
        known = builtin_lexicon(spark)
    else:
        require_columns(lexicon, {"language", "form", "lemma", "pos"}, "lexicon")
        known = _distinct_forms(lexicon)
    known = known.select(
        "language",
        F.col("form").alias("_low"),
        F.col("lemma").alias("_known_lemma"),
        F.col("pos").alias("_known_pos"),
    )
    rules = suffix_table(spark).select(
        "language",
        F.col("suffix").alias("_suffix"),
        F.col("pos").alias("_rule_pos"),
        F.col("cut").alias("_cut"),
        F.col("ending").alias("_ending"),
    )

    token, low = F.col("token"), F.col("_low")
    french = F.col("language") == "fr"
    words = (
        tokens.withColumn("_low", F.lower("token"))
        .withColumn(
            "_suffix",
            F.when(french, suffix_of(low, "fr")).otherwise(suffix_of(low, "en")),
        )
        .join(known, ["language", "_low"], "left")
        .join(rules, ["language", "_suffix"], "left")
    )
    name = token.rlike(r"^\p{Lu}") & ~F.coalesce(
        F.col("previous").isin(_BEFORE_CAPITAL), F.lit(True)
    )
    number = token.rlike(r"^\p{Nd}")
    by_shape = F.when(
        ~token.rlike(r"^[\p{L}\p{M}]"),
        F.when(number, F.when(french, "NUM").otherwise("CD"))
        .when(french & token.rlike(r"^\p{P}"), "PUNCT")
        .otherwise("SYM"),
    ).when(name, F.when(french, "PROPN").otherwise("NNP"))
    stem = F.concat(F.left(low, F.length(low) - F.col("_cut")), F.col("_ending"))
    by_rule = F.coalesce("_known_pos", "_shape_pos").isNull()
    return (
        words.withColumn("_shape_pos", F.when(F.col("_known_pos").isNull(), by_shape))
        .select(
            *tokens.columns,
            F.coalesce("_known_lemma", F.when(by_rule, stem), low).alias("lemma"),
            F.coalesce(
                "_known_pos",
                "_shape_pos",
                "_rule_pos",
                F.when(french, "NOUN").otherwise("NN"),
            ).alias("pos"),
        )
    )


def annotate(
    clean_df: DataFrame,
    max_chars: int = txt.DEFAULT_CHUNK_CHARS,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Chunk and annotate a clean document table."""
    return annotate_chunks(chunk_corpus(clean_df, max_chars), lexicon)


def explode_annotations(df: DataFrame) -> DataFrame:
    """Token table of chunk rows that carry parallel arrays of tokens, lemmas and tags.

    For annotations made elsewhere: ``token_out, lemma_out, pos_out`` are zipped by
    position; a shorter array gives NULL.
    """
    require_columns(
        df, {*_CHUNK, "token_out", "lemma_out", "pos_out"}, "explode_annotations"
    )
    return (
        df.select(
            *_CHUNK,
            F.posexplode(F.arrays_zip("token_out", "lemma_out", "pos_out")).alias(
                "token_id", "_token"
            ),
        )
        .select(
            *_CHUNK,
            "token_id",
            F.col("_token.token_out").alias("token"),
            F.col("_token.lemma_out").alias("lemma"),
            F.col("_token.pos_out").alias("pos"),
        )
        .withColumn("ner", tags.entity_flag(F.col("pos")))
    )
