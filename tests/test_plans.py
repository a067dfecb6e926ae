"""Physical plans: what moves between tasks, and what stays in the JVM."""

from __future__ import annotations

import contextlib
import io
import re
import time

import pytest

from lexiloom.operators.annotate import annotate
from lexiloom.operators.dialog import dialog_summary, label_dialog
from lexiloom.operators.lemmas import with_lemmas
from lexiloom.operators.lexical import pos_distribution, type_token_ratio, zipf
from lexiloom.operators.readability import (
    chunk_stats,
    global_readability,
    sliding_readability,
)
from lexiloom.sources.sinks import write_table
from lexiloom.sources.tables import read_table, read_tokens
from parity.inputs import clean_documents
from parity.queries import QUERIES
from tests.helpers import token_rows, token_table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def static(spark):
    """Plans as first made, before runtime changes."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    write_table(token_table(spark, token_rows([["a", "."], ["b"]])), path)
    return path


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def count(text, node):
    return len(re.findall(rf"(?:[+:]- |^|\s)(?:\*\(\d+\) )?{node}\b", text))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_runs_python_rows(spark, name):
    assert "EvalPython" not in plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan(QUERIES[name](spark, SF_DIR))


def test_dialog_scans(static, stored):
    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(dialog_summary(label_dialog(read_tokens(static, stored))))
    assert count(text, "FileScan") <= 2


@pytest.mark.parametrize(
    "operator, exchanges, sorts, windows",
    [
        (chunk_stats, 1, 0, 0),
        (global_readability, 2, 0, 0),
        (sliding_readability, 2, 1, 1),
        (pos_distribution, 1, 0, 0),
        (type_token_ratio, 2, 0, 0),
    ],
)
def test_movement(static, stored, operator, exchanges, sorts, windows):
    text = plan(operator(read_tokens(static, stored)))
    assert count(text, "Exchange") == exchanges
    assert count(text, "Sort") == sorts
    assert count(text, "Window") == windows


def test_lemmas_move_tokens_once(static, stored):
    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lemmas = static.createDataFrame([], "language string, form string, pos string, lemma string, frequent boolean")
    text = plan(with_lemmas(read_tokens(static, stored), lemmas))
    # The rest of the tokens and the table of their forms; frequent forms are broadcast to both branches.
    assert count(text, "Exchange") == 2
    assert count(text, "BroadcastHashJoin") == 2 and count(text, "SortMergeJoin") == 1


def test_annotation_is_one_narrow_stage(static):
    text = plan(annotate(clean_documents(static, SF_DIR)))
    # The only shuffle spreads the one-file test table; look-ups are broadcast.
    assert count(text, "Exchange") == 1
    assert count(text, "BroadcastHashJoin") == 2
    assert "PushedFilters: [In(lang, [en,fr])]" in text


def test_annotation_code_is_small_enough_to_compile(static):
    text = plan(annotate(clean_documents(static, SF_DIR)), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_zipf_counts_terms_once(static, stored):
    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(zipf(read_tokens(static, stored)))
    assert count(text, "FileScan") == 1
    assert count(text, "ReusedExchange") == 1
    # The only window sorts the frequency histogram, not the vocabulary.
    window = text[text.index("Window"):]
    assert "HashAggregate(keys=[author" in window and "frequency" in window.split("\n")[0]


def test_scans_are_pruned(static, stored):
    columns = {
        pos_distribution: {"document_id", "language", "pos"},
        type_token_ratio: {"document_id", "language", "lemma", "pos"},
        zipf: {"document_id", "language", "token", "pos"},
    }
    for operator, wanted in columns.items():
        schema = re.search(r"ReadSchema: struct<(.*?)>", plan(operator(read_tokens(static, stored))))
        assert {field.split(":")[0] for field in schema[1].split(",")} == wanted


def test_author_filter_prunes_partitions(static, stored):
    tokens = read_tokens(static, stored).where("author = 'a'")
    assert re.search(r"PartitionFilters: \[.*author.* = a", plan(tokens))


def test_filters_on_clean_text_keep_the_plan_small(static):
    clean = clean_documents(static, SF_DIR)
    text = plan(clean.where("word_count > 3 AND sentence_count > 1").select("sentences"), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_path):
    from lexiloom.sources import sinks

    key = "spark.sql.maxConcurrentOutputFileWriters"
    assert int(spark.conf.get(key, "0")) == 0
    with sinks.open_files(spark):
        assert int(spark.conf.get(key)) == sinks.MOST_OPEN_FILES
    assert int(spark.conf.get(key, "0")) == 0
    rows = [(f"a{n % 50}", "d", "en", 0, n, "x", "x", "NN", "O") for n in range(200)]
    path = str(tmp_path / "t")
    write_table(token_table(spark, rows).coalesce(1), path, cluster=False)  # more authors than open files
    assert read_tokens(spark, path).count() == 200
    assert {r[0] for r in read_tokens(spark, path).select("author").distinct().collect()} == {f"a{n}" for n in range(50)}


@pytest.mark.parametrize("operator", [zipf, type_token_ratio])
def test_terms_are_spread_before_they_are_counted(static, stored, operator):
    static.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(operator(read_tokens(static, stored)))
    # Nothing is held per term in the task that scans.
    assert "HashAggregate" not in text[text.rindex("Exchange hashpartitioning", 0, text.index("FileScan")):text.index("FileScan")]


def test_chunks_are_cleaned_once(static):
    from parity import inputs

    assert "regexp" not in plan(inputs.chunks(static, SF_DIR), "extended").split("Physical Plan")[1]


def test_stripping_needs_no_pattern(spark):
    from lexiloom.functions import text as txt
    from pyspark.sql import functions as F

    blanks = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    df = spark.createDataFrame([(blanks + "é ​" + blanks,), (blanks,), ("",), (None,)], "t string")
    assert "regexp" not in plan(df.select(txt.strip_blank(F.col("t"))), "extended")
    assert [r[0] for r in df.select(txt.strip_blank(F.col("t"))).collect()] == ["é ​", "", "", None]
    texts = [(f"a{x}b{x}{y}c{x} {y}{x}é{y} é",) for x in blanks for y in blanks]
    packed = spark.createDataFrame(texts, "t string").select(txt.single_spaced(F.col("t")).alias("t")).distinct().collect()
    assert [r["t"] for r in packed] == ["a b c é é"]
    normal = spark.createDataFrame([("\ta \tb  c\t d e\n\n\n\nf ",)], "t string").select(txt.normalised(F.col("t"))).first()[0]
    assert normal == "a b c d e\n\nf"


def test_a_write_removes_its_shuffle_files(spark, tmp_path):
    """Files of a finished job's shuffles are not left until the driver collects its garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = shuffles(), spark.conf.get(key)
    rows = spark.range(1000).selectExpr("id % 7 AS author", "id").repartition(5, "id").groupBy("author", "id").count()
    write_table(rows, f"{tmp_path}/t")
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == own
    assert read_table(spark, f"{tmp_path}/t").count() == 1000
