"""Registered queries against their SQL on the smallest test tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from parity import inputs as src
from parity.check import compare, duck
from parity.oracle import ORACLE
from parity.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_registry(spark):
    queries, sql = QUERIES, ORACLE
    assert set(queries) <= set(driver.queries()) and set(sql) <= set(driver.oracle_sql())
    assert set(sql) <= set(queries)
    # File sizes depend on the writer, and the best tags are a fold; both are tested otherwise.
    assert set(queries) - set(sql) == {"storage_footprint", "learned_tags"}
    sizes = [r["size_mb"] for r in queries["storage_footprint"](spark, SF_DIR).collect()]
    assert len(sizes) == 4 and sizes == sorted(sizes, reverse=True) and sizes[-1] > 0


def test_learned_tags(spark):
    """The model mostly repeats the rules it has learned from, for every token of theirs."""
    place = ["author", "document_id", "chunk_id", "token_id"]
    rules = src.tokens(spark, SF_DIR).select(*place, "token", F.col("pos").alias("rule"))
    both = QUERIES["learned_tags"](spark, SF_DIR).join(rules, [*place, "token"], "full")
    share = both.agg(F.count("*"), F.count("pos"), F.count("rule"), F.avg((F.col("pos") == F.col("rule")).cast("int"))).first()
    assert share[0] == share[1] == share[2] and share[3] > 0.95


def test_tagged_sentences_without_a_join_by_token(spark, tmp_path):
    """Repeated documents, and rows without a key, give the rows of a join by place with the stored tokens."""
    rows = [(1, "a", "en", "The dog. It ran!"), (1, "a", "en", "The dog. It ran!"), (2, "a", "de", "Der Hund."), (3, "a", "fr", "Le chat."), (3, "a", "de", "Le chat dort."), (4, None, "en", "No one.")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    place = ["author", "document_id", "chunk_id", "token_id"]
    got = src.tagged_sentences(spark, str(tmp_path))
    expected = src.sentence_tokens(spark, str(tmp_path)).join(src.tokens(spark, str(tmp_path)).select(*place, "pos"), place)
    key = lambda r: str(sorted(r.asDict().items(), key=str))
    assert sorted(map(key, got.collect())) == sorted(map(key, expected.collect()))
    assert got.count() == 4 * 6 + 3 + 3
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) > 100
    assert [(r["author"], r["document_id"]) for r in rows] == sorted(
        (r["author"], r["document_id"]) for r in rows
    )


def test_files_are_written_as_by_the_sink(spark, tmp_path):
    """A file per row, in the folders and with the bytes of Spark's sink, and evenly from any number of partitions."""
    rows = [(f"x{chr(n)}y", f"{chr(n)}\n") for n in (1, 32, 34, 37, 47, 58, 61, 91, 127, 233)]
    rows = [*rows, (None, "none"), ("", "empty"), ("a", None), ("a", ""), *[("b", "same")] * 3]
    docs = spark.createDataFrame(rows, "author string, value string").coalesce(1)
    docs = docs.union(spark.sql("SELECT 'raw', CAST(X'61FF62' AS STRING)"))
    src.write_files(docs, f"{tmp_path}/own", "\r\n")
    docs.write.partitionBy("author").option("maxRecordsPerFile", 1).option("lineSep", "\r\n").text(f"{tmp_path}/sink")
    found = {name: sorted((f.parent.name, f.read_bytes()) for f in (tmp_path / name).glob("*/*.txt")) for name in ("own", "sink")}
    assert len(found["own"]) == len(rows) + 1 and found["own"] == found["sink"]
    assert len({f.name for f in (tmp_path / "own").glob("*/*.txt")}) == len(rows) + 1
