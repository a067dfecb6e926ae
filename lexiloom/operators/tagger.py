"""A part-of-speech tagger learned from tagged tokens: counts as aggregations, the best path as a fold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import tags
from lexiloom.operators.sentences import CHUNK_KEY
from lexiloom.schemas import require_columns

START = "<s>"
#: Words of at most so many occurrences teach the endings, which tag the words that aren't in the table of forms.
RARE = 10
#: Lengths of endings, the longest known one decides; 0 stands for the shape alone.
ENDINGS = (3, 2, 1, 0)
#: Forms and endings that a model keeps, the most frequent ones of each language; what tasks hold is bounded by them.
MOST_FORMS = 100_000
MOST_ENDINGS = 20_000
#: Tags that a form or an ending may take, the most frequent ones.
MOST_TAGS = 6
#: Added to every count of two tags in a row.
SMOOTHING = 0.1
#: A sentence is also cut at every so many tokens of its chunk, which bounds what is folded at once.
BLOCK = 256

_SENTENCE = [*CHUNK_KEY, "sentence_id"]


def shape(token: Column) -> Column:
    return (
        F.when(token.rlike(r"^\p{Lu}"), "A").when(token.rlike(r"^[\p{L}\p{M}]"), "a").when(token.rlike(r"^\p{Nd}"), "0").otherwise(".")
    )


def tag_transitions(tagged: DataFrame) -> DataFrame:
    """(language, previous, pos, n): how often a tag follows another one inside a sentence of a chunk, or begins it.

    Sentences are spread over tasks, so a long document is not one of them. Tokens without a tag count for nothing
    and are passed over.
    """
    require_columns(tagged, {*_SENTENCE, "language", "token_id", "pos"}, "tag_transitions")
    order = Window.partitionBy(*_SENTENCE).orderBy("token_id")
    rows = tagged.where(F.col("pos").isNotNull()).select("language", "pos", F.lag("pos", 1, START).over(order).alias("previous"))
    return rows.groupBy("language", "previous", "pos").agg(F.count("*").alias("n"))


def tag_emissions(tagged: DataFrame) -> DataFrame:
    """(language, form, shape, pos, n): how often a lower-cased form, written in a shape, has a tag."""
    require_columns(tagged, {"language", "token", "pos"}, "tag_emissions")
    rows = tagged.where(F.col("pos").isNotNull() & F.col("token").isNotNull())
    return rows.groupBy("language", F.lower("token").alias("form"), shape(F.col("token")).alias("shape"), "pos").agg(F.count("*").alias("n"))


def tag_endings(emissions: DataFrame) -> DataFrame:
    """(language, shape, size, ending, pos, n): the tags of rare forms by their last characters and their shape."""
    total = F.sum("n").over(Window.partitionBy("language", "form"))
    rare = emissions.withColumn("_total", total).where(F.col("_total") <= RARE)
    sized = rare.select("language", "shape", "pos", "n", "form", F.explode(F.array(*map(F.lit, ENDINGS))).alias("size"))
    long = sized.where(F.col("size") <= F.length("form"))
    ending = F.when(F.col("size") == 0, "").otherwise(F.expr("right(form, size)"))
    return long.groupBy("language", "shape", "size", ending.alias("ending"), "pos").agg(F.sum("n").alias("n"))


@dataclass
class TagModel:
    """``languages`` (language, tags, moves), ``forms`` (language, form, choices) and ``endings`` (language,
    shape, size, ending, choices); choices are (t, e): the tag's place in ``tags`` and its log weight, and ``moves``
    holds log weights from tag to tag, row by row, the last row from the start of a sentence."""

    languages: DataFrame
    forms: DataFrame
    endings: DataFrame


def _choices(counts: DataFrame, key: list[str], single: DataFrame, most: int) -> DataFrame:
    """``counts`` (key, pos, n) as one row per key with its most frequent tags, for the ``most`` frequent keys of a language.

    The weight of a tag is its share among the key's tags over its share among all, as a logarithm.
    """
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "t", "single"))), 1, MOST_TAGS)
    rows = counts.join(single, ["language", "pos"]).groupBy(*key).agg(best.alias("_best"), F.sum("n").alias("_n"))
    weight = lambda x: F.struct(x["t"].alias("t"), F.log(-x["o"] / F.col("_n") / x["single"]).alias("e"))
    rows = rows.select(*key, "_n", F.transform("_best", weight).alias("choices"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("_n"), *[x for x in key if x != "language"]))
    return rows.withColumn("_place", place).where(F.col("_place") <= most).select(*key, "choices")


def learn_tags(transitions: DataFrame, emissions: DataFrame, most_forms: int = MOST_FORMS, most_endings: int = MOST_ENDINGS) -> TagModel:
    """The model of stored counts (:func:`tag_transitions`, :func:`tag_emissions`), whose tables the caller may store."""
    tag_counts = emissions.groupBy("language", "pos").agg(F.sum("n").alias("n"))
    every = Window.partitionBy("language")
    single = tag_counts.select(
        "language",
        "pos",
        (F.row_number().over(every.orderBy("pos")) - 1).alias("t"),
        (F.col("n") / F.sum("n").over(every)).alias("single"),
    )
    ranked = F.sort_array(F.collect_list(F.struct("t", "pos")))
    languages = single.groupBy("language").agg(F.transform(ranked, lambda x: x["pos"]).alias("tags"))
    # A tag set is small: one row per language holds all its pairs.
    seen = transitions.groupBy("language").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\t", "previous", "pos").alias("k"), "n"))).alias("_seen")
    )
    known = languages.join(seen, "language")
    n = lambda a, b: F.coalesce(F.element_at("_seen", F.concat_ws("\t", a, b)), F.lit(0)) + SMOOTHING
    rows_of = F.concat("tags", F.array(F.lit(START)))
    counted = F.transform(rows_of, lambda a: F.transform("tags", lambda b: n(a, b)))
    shares = F.transform("_counted", lambda r: F.transform(r, lambda x: F.log(x / F.aggregate(r, F.lit(0.0), lambda s, y: s + y))))
    known = known.withColumn("_counted", counted).select("language", "tags", F.flatten(shares).alias("moves"))
    of_forms = emissions.groupBy("language", "form", "pos").agg(F.sum("n").alias("n"))
    forms = _choices(of_forms, ["language", "form"], single, most_forms)
    endings = _choices(tag_endings(emissions), ["language", "shape", "size", "ending"], single, most_endings)
    return TagModel(known, forms, endings)


def best_path(tokens: str = "_tokens", moves: str = "moves", size: Column | None = None) -> Column:
    """The places of the best tags for an array of tokens with ``choices``, as a fold over it and one back.

    Each step holds, for every choice of its token, the weight of the best path to it and the tag before it on
    that path; equal weights go to the tag that comes first. The second fold walks back from the best last tag.
    """
    count = F.size("tags") if size is None else size
    begin = F.array(F.array(F.struct(count.alias("t"), F.lit(0.0).alias("s"), F.lit(-1).alias("f"))))

    def step(done: Column, token: Column) -> Column:
        def reach(choice: Column) -> Column:
            ways = F.transform(
                F.element_at(done, -1),
                lambda p: F.struct((p["s"] + F.get(moves, p["t"] * count + choice["t"])).alias("s"), (-p["t"]).alias("o")),
            )
            return F.struct(choice["t"].alias("t"), choice["e"].alias("e"), F.array_max(ways).alias("b"))

        reached = F.transform(token["choices"], reach)
        new = F.transform(reached, lambda r: F.struct(r["t"].alias("t"), (r["b"]["s"] + r["e"]).alias("s"), (-r["b"]["o"]).alias("f")))
        return F.concat(done, F.array(new))

    def back(path: Column, column: Column) -> Column:
        last = F.array_max(F.transform(column, lambda x: F.struct(x["s"].alias("s"), (-x["t"]).alias("o"), x["f"].alias("f"))))
        wanted = F.filter(column, lambda x: x["t"] == F.element_at(path, -1)["f"])
        first = F.struct((-last["o"]).alias("t"), last["f"].alias("f"))
        then = F.struct(F.get(wanted, 0)["t"].alias("t"), F.get(wanted, 0)["f"].alias("f"))
        return F.concat(path, F.array(F.when(F.size(path) == 0, first).otherwise(then)))

    empty = F.array().cast("array<struct<t: int, f: int>>")

    def walk(steps: Column) -> Column:
        path = F.aggregate(F.slice(steps, F.lit(1), F.size(steps) - 1), empty, back)
        return F.reverse(F.transform(path, lambda x: x["t"]))

    # The steps are bound to a variable, or they would be worked out once for each mention.
    return F.transform(F.array(F.reverse(F.aggregate(tokens, begin, step))), walk)[0]


def tag_sentences(tokens: DataFrame, model: TagModel) -> DataFrame:
    """Token rows with sentences (:func:`lexiloom.operators.sentences.with_sentences`), their ``pos`` and ``ner``.

    The best tag sequence of every sentence under a first-order hidden Markov model; a sentence is cut at the ends of chunks and
    at every ``BLOCK`` tokens of one. Forms outside the model take the tags of their longest known ending in
    their shape, and those without any all tags of the language. Languages the model doesn't know get NULL tags.

    The model's tables carry no hint and are bounded, so they are broadcast where they measure small. Tokens that
    are still spread by chunk, as ``with_sentences`` leaves them, are grouped into sentences where they are: the plan has no shuffle of
    tokens.
    """
    require_columns(tokens, {*_SENTENCE, "language", "token_id", "token"}, "tag_sentences")
    rows = tokens.select(*_SENTENCE, "language", "token_id", "token", F.lower("token").alias("_low"), shape(F.col("token")).alias("_shape"))
    forms = model.forms.select("language", F.col("form").alias("_low"), F.col("choices").alias("_known"))
    rows = rows.join(forms, ["language", "_low"], "left")
    found = [F.col("_known")]
    for size in ENDINGS:
        # Only tokens without a form look for an ending.
        ending = F.when(F.col("_known").isNull() & (F.length("_low") >= size), F.lit("") if size == 0 else F.right("_low", F.lit(size)))
        table = model.endings.where(F.col("size") == size).select("language", F.col("shape").alias("_shape"), F.col("ending").alias(f"_end{size}"), F.col("choices").alias(f"_by{size}"))
        rows = rows.withColumn(f"_end{size}", ending).join(table, ["language", "_shape", f"_end{size}"], "left")
        found.append(F.col(f"_by{size}"))
    rows = rows.withColumn("choices", F.coalesce(*found)).withColumn("_block", F.floor(F.col("token_id") / BLOCK))
    sentences = rows.groupBy(*_SENTENCE, "language", "_block").agg(
        F.sort_array(F.collect_list(F.struct("token_id", "token", "choices"))).alias("_tokens"),
        F.max(F.coalesce(F.size("choices"), F.lit(0)) != 1).alias("_open"),
    )
    # The weights of a language are many numbers: they are met by sentences, not by tokens.
    sentences = sentences.join(model.languages, "language", "left")
    anything = F.transform("tags", lambda x, t: F.struct(t.alias("t"), F.lit(0.0).alias("e")))
    sentences = sentences.withColumn("_choices", F.transform("_tokens", lambda x: F.struct(F.coalesce(x["choices"], anything).alias("choices"))))
    untagged = F.transform("_tokens", lambda _: F.lit(None).cast("int"))
    # Where every token has one choice there is one path, and nothing to weigh.
    only = F.transform("_tokens", lambda x: F.get(x["choices"], 0)["t"])
    path = F.when(F.col("tags").isNull(), untagged).when(F.col("_open"), best_path("_choices")).otherwise(only)
    tagged = sentences.select(*_SENTENCE, "language", "tags", F.explode(F.arrays_zip("_tokens", path.alias("_path"))).alias("_row"))
    pos = F.get("tags", F.col("_row._path"))
    return tagged.select(
        *CHUNK_KEY, "language", "sentence_id", F.col("_row._tokens.token_id").alias("token_id"), F.col("_row._tokens.token").alias("token"), pos.alias("pos")
    ).withColumn("ner", tags.entity_flag(F.col("pos")))
