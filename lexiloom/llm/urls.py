"""URL filter with DataFrame functions only: rules first, then boosted trees on lexical features."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.common import stage

BLOCK, ALLOW = "block", "allow"
#: Distinct labelled URLs the trees are fitted on at most, of each label those with the smallest hashes.
MOST_LABELLED = 20_000
TREES, DEPTH, SEED = 12, 4, 5
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digits", "marks", "hyphens", "entropy", "parameters", "fragment",
    "suffix_share", "suffix_blocked", "site_share",
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: what follows the first ``://`` up to ``/?#``, in lower case, and then up to ``?#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule (verdict, host, path) that fits, null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. The rules are program text,
    so they are part of the expression; of equally long ones the first wins.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, kind).otherwise(verdict)
    return text, verdict


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)
    chars = F.array_distinct(F.split(text, ""))

    def term(c: Column) -> Column:
        share = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return F.when(share > 0, -share * F.log2(share)).otherwise(0.0)

    return F.when(size > 0, F.aggregate(F.transform(F.filter(chars, lambda c: c != ""), term), F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def lexical_features(rows: DataFrame) -> DataFrame:
    """Features of (url, host, path, ...): lengths, depth, ratios, entropy, counts, and the suffixes."""
    url = F.coalesce("url", F.lit(""))
    size = F.length(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return rows.select(
        "*",
        size.cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        F.regexp_count("path", F.lit("/[^/]")).cast("double").alias("depth"),
        F.regexp_count("host", F.lit("[^.]+")).cast("double").alias("labels"),
        _ratio(F.regexp_count(url, F.lit("[0-9]")), size).cast("double").alias("digits"),
        _ratio(F.regexp_count(url, F.lit("[^0-9A-Za-z]")), size).cast("double").alias("marks"),
        F.regexp_count("host", F.lit("-")).cast("double").alias("hyphens"),
        _entropy(F.concat("host", "path")).alias("entropy"),
        F.when(query != "", F.regexp_count(query, F.lit("&")) + 1).otherwise(0).cast("double").alias("parameters"),
        F.contains(url, F.lit("#")).cast("double").alias("fragment"),
        F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"),
        F.regexp_extract("host", r"([^.]*\.?[^.]*)$", 1).alias("site"),
    )


def _statistics(rows: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Per suffix its share in all URLs and how much of its labelled ones is blocked, per site its share.

    One row per key; a suffix with a third of all URLs is combined before the shuffle. A suffix without
    labels is half blocked, however many URLs it has.
    """
    suffixes = rows.groupBy("suffix").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("bad")
    )
    blocked = (F.col("bad") + 1) / (F.col("labelled") + 2)
    suffixes = suffixes.select("suffix", (F.col("n") / total).alias("suffix_share"), blocked.alias("suffix_blocked"))
    return suffixes, rows.groupBy("site").agg((F.count("*") / total).alias("site_share"))


def _assembled(rows: DataFrame, suffixes: DataFrame, sites: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows.join(suffixes, "suffix").join(sites, "site"))


def labelled_sample(labelled: DataFrame, most: int = MOST_LABELLED) -> DataFrame | None:
    """(url, label, weight) of at most ``most`` distinct URLs of (url, label), none unless both labels occur.

    Copies of a URL are one URL. Each label has half of the places, and those the other one leaves; in it
    the URLs with the smallest hashes are taken. Weights give the labels the shares they have in all URLs.
    """
    distinct = stage(labelled.select("url", "label").distinct(), "labelled")
    counts = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    half, sample = max(1, most // 2), None
    for label, n in sorted(counts.items()):
        taken = min(n, max(half, most - (sum(counts.values()) - n)))
        part = distinct.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(taken).withColumn("weight", F.lit(n / taken))
        sample = part if sample is None else sample.union(part)
    return sample


def fit_trees(sample: DataFrame) -> GBTClassificationModel:
    """Boosted trees on rows with ``features``, ``label`` and ``weight``."""
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1)
    return trees.fit(stage(sample.select("features", "label", "weight"), "sample"))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    labels: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """(id, host, path, rule, verdict, score) per row of ``pages``.

    The verdict is that of the longest rule that fits the URL, else that of the trees: ``block`` from a
    probability (``score``) of 0.5. ``labels`` (url, label 0 or 1) are the labelled URLs the trees are fitted on,
    by default all URLs of ``pages`` that a rule decides. Without both labels there are no trees, and URLs without
    rule are allowed with a null score. A null URL, or one without ``://``, has an empty host and path, which fit no
    rule. Repeated rows get equal verdicts; other columns are not read.
    """
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"))
    host, path = url_parts(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    if labels is None:
        rows = rows.withColumn("label", F.when(F.col("ruled") == BLOCK, 1.0).when(F.col("ruled") == ALLOW, 0.0))
    else:
        known = labels.groupBy(F.col("url").alias("_url")).agg(F.max("label").cast("double").alias("label"))
        rows = rows.join(known, F.col("url") == F.col("_url"), "left").drop("_url")
    rows = lexical_features(rows)
    rows = stage(rows, "features")
    total = max(1, rows.count())
    statistics = _statistics(rows, total)
    assembled = _assembled(rows, *statistics)
    sample = labelled_sample(rows.where("label is not null"), most_labelled)
    trees = None
    if sample is not None:
        host, path = url_parts(F.col("url"))
        trees = fit_trees(_assembled(lexical_features(sample.withColumns({"host": host, "path": path})), *statistics))
    score = F.lit(None).cast("double")
    if trees is not None:
        assembled = trees.transform(assembled)
        score = vector_to_array("probability")[1]
    judged = F.coalesce("ruled", F.when(score >= 0.5, BLOCK).otherwise(ALLOW))
    return assembled.select(F.col("id").alias(id_column), "host", "path", "rule", judged.alias("verdict"), score.alias("score"))
