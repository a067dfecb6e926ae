"""Registered queries of the subpackage, each over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.common import table
from lexiloom.llm.decontaminate import contamination
from lexiloom.llm.embeddings import embedding_groups
from lexiloom.llm.language import identify_held_out
from lexiloom.llm.lines import line_classes
from lexiloom.llm.mixing import mix
from lexiloom.llm.negatives import hard_negatives
from lexiloom.llm.personal import find_personal
from lexiloom.llm.ranking import ranked_search
from lexiloom.llm.secrets import find_secrets
from lexiloom.llm.simhash import simhash_groups
from lexiloom.llm.substrings import remove_repeats
from lexiloom.llm.urls import ALLOW, BLOCK, judge_urls
from lexiloom.llm.warc import round_trip

#: Rules of the URL filter: verdict, host, path.
RULES = [(BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/")]
#: Target weights of the mixture; sources weigh alike.
WEIGHTS = {"domain": {"d0": 1, "d1": 6, "d2": 3}, "lang": {"en": 4, "fr": 2, "de": 2, "es": 3}}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def named(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.withColumn("spans", F.array_join(F.transform("spans", named), ","))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).drop("payload")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def _weight(column: str, weights: dict[str, int]) -> Column:
    """A level's weights by name; other names weigh 1."""
    named = F.lit(1)
    for name, weight in weights.items():
        named = F.when(F.col(column) == name, weight).otherwise(named)
    return named


def mixture(docs: DataFrame) -> DataFrame:
    """Half of all tokens, at most two epochs, over a tree of source group, language and source.

    Sources are grouped into domains by the number in their name, modulo 3.
    """
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1)
    domain = F.when(number != "", F.concat(F.lit("d"), (F.try_to_number(number, F.lit("999999999")) % 3).cast("int").cast("string")))
    weights = {x: _weight(x, WEIGHTS.get(x, {})) for x in ("domain", "lang", "source")}
    return mix(docs.withColumn("domain", F.coalesce(domain, F.lit("other"))), weights)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_held_out(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    def named(s):
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    found = find_personal(table(spark, sf_dir, "documents"))
    return found.withColumn("spans", F.array_join(F.transform("spans", named), ","))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash": op2_simhash,
    "op3_secrets": op3_secrets,
    "op4_decontamination": op4_decontamination,
    "op5_url_filter": op5_url_filter,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_warc": op7_warc,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_personal_data": op12_personal_data,
    "op13_ranked_search": op13_ranked_search,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"



def _case(column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS[column].items()) + " ELSE 1 END"


def _fill(name: str, nodes: str, parent: str, key: str) -> str:
    """CTEs that hand the budget of ``parent`` down to its children, as in ``water_fill``."""
    by = f"PARTITION BY {parent}"
    up = "ORDER BY ratio, " + key
    return f"""
{name}_a AS (
  SELECT *, capacity / CAST(weight AS DOUBLE) AS ratio FROM ({nodes})),
{name}_b AS (
  SELECT *, coalesce(sum(capacity) OVER ({by} {up} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS filled,
    (sum(weight) OVER ({by} {up} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS rest
  FROM {name}_a),
{name}_c AS (SELECT *, capacity * rest <= (budget - filled) * weight AS is_full FROM {name}_b),
{name}_d AS (
  SELECT *, budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({by}) AS remains,
    greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}), 1) AS open,
    coalesce(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by} {up} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM {name}_c),
{name} AS (
  SELECT *, CAST(CASE WHEN is_full THEN capacity
    ELSE least(capacity, remains * (b + weight) // open - remains * b // open) END AS BIGINT) AS given
  FROM {name}_d)"""


_DOMAIN = "CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN 'other' ELSE 'd' || CAST(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT) % 3 END"
_MIX = f"""
WITH rows AS (
  SELECT doc_id, {_DOMAIN} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n
  FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(n) * 2 AS BIGINT) AS capacity FROM rows WHERE n > 0 GROUP BY ALL),
total AS (SELECT CAST(sum(tokens) // 2 AS BIGINT) AS budget FROM leaf),
{_fill("top", f"SELECT domain, 0 AS root, {_case('domain')} AS weight, CAST(sum(capacity) AS HUGEINT) AS capacity, any_value(budget) AS budget FROM leaf, total GROUP BY domain", "root", "domain")},
{_fill("mid", f"SELECT domain, lang, {_case('lang')} AS weight, CAST(sum(leaf.capacity) AS HUGEINT) AS capacity, any_value(given) AS budget FROM leaf JOIN top USING (domain) GROUP BY domain, lang", "domain", "lang")},
{_fill("low", "SELECT domain, lang, source, 1 AS weight, CAST(sum(leaf.capacity) AS HUGEINT) AS capacity, any_value(given) AS budget FROM leaf JOIN mid USING (domain, lang) GROUP BY domain, lang, source", "domain, lang", "source")},
given AS (SELECT domain, lang, source, tokens, given // tokens AS whole, given % tokens AS rest FROM low JOIN leaf USING (domain, lang, source)),
full_epochs AS (
  SELECT doc_id, domain, lang, source, unnest(range(whole)) AS epoch, n AS n_tokens, n AS n_taken
  FROM rows JOIN given USING (domain, lang, source) WHERE n > 0),
part AS (
  SELECT doc_id, domain, lang, source, whole AS epoch, n, rest,
    coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), n
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_n
  FROM rows JOIN given USING (domain, lang, source) WHERE n > 0 AND rest > 0)
SELECT * FROM full_epochs
UNION ALL
SELECT doc_id, domain, lang, source, epoch, n, CAST(least(n, rest - before_n) AS BIGINT) FROM part WHERE before_n < rest"""

ORACLE: dict[str, str] = {
    "op9_mixing": _MIX,
    "op4_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM bw) AS l, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op6_embedding_dedup": """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v,
    label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e AS a JOIN e AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN counts USING (vec_id)""",
    "op7_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (
  SELECT page_id, h, octet_length(b) AS n,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST(('0x' || substr(h, 1 + 10 * (i // 8), 10)) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)
      FOR i IN range(32)], '') AS d
  FROM p),
f AS (SELECT h, n, min(page_id) AS first FROM bits GROUP BY h, n)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits JOIN f USING (h, n)""",
    "op11_hard_negatives": """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.vec_id) AS place,
    s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10""",
    "op13_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
total AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT i, item_id, term, CAST(count(*) AS BIGINT) AS c FROM (
  SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term),
m AS (SELECT r, doc_id, 100 - 75 + (75 * CAST(len(t) AS BIGINT) * n_docs) // n_terms AS m FROM d, total WHERE len(t) > 0),
s AS (
  SELECT i, item_id, doc_id, r, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0) WHERE place <= 10""",
    "op8_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS g
  FROM d, unnest(range(1, greatest(len(w) - 33, 1))) AS t(i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, p FROM again, unnest(range(i, i + 35)) AS t(p)),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
}
