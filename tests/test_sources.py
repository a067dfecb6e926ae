from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexiloom import dimensions
from lexiloom.local import local_table
from lexiloom.operators.enrich import add_era, enrich_corpus
from lexiloom.schemas import DOCUMENT_SCHEMA
from lexiloom.sources import sinks, tables, validation
from lexiloom.sources.corpus import read_corpus, read_files
from tests.helpers import token_rows, token_table


@pytest.fixture
def corpus_dir(tmp_path):
    files = {
        "Zola/nana.txt": "Nana\r\nrit.\rFin",
        "zola/germinal.v2.txt": "Étienne « Oui »",
        "hugo/le père+fils 100%.txt": "text",
        "hugo/empty.txt": "",
        "hugo/vide é+1.txt": "",
        "hugo/notes.md": "ignored",
        "hugo/deep/er.txt": "ignored",
        "top.txt": "ignored",
    }
    for name, content in files.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode())
    return tmp_path / "raw"


def test_corpus_directory(spark, corpus_dir):
    df = read_corpus(spark, str(corpus_dir))
    assert df.columns == DOCUMENT_SCHEMA.fieldNames()
    got = {(r["author"], r["document_id"]): r for r in df.collect()}
    assert {k: (r["raw_text"], r["filename"], r["language"], r["era"]) for k, r in got.items()} == {
        ("zola", "nana"): ("Nana\nrit.\nFin", "nana.txt", "fr", "realist"),
        ("zola", "germinal.v2"): ("Étienne « Oui »", "germinal.v2.txt", "en", "realist"),
        ("hugo", "le père+fils 100%"): ("text", "le père+fils 100%.txt", "en", "romantic"),
        ("hugo", "empty"): ("", "empty.txt", "en", "romantic"),
        ("hugo", "vide é+1"): ("", "vide é+1.txt", "en", "romantic"),
    }
    assert read_files(spark, str(corpus_dir)).count() == 5
    assert got[("zola", "nana")]["source_path"] == str(corpus_dir / "Zola" / "nana.txt")


def test_empty_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No .txt files found under"):
        read_corpus(spark, str(tmp_path))


def test_broken_encoding_fails(spark, tmp_path):
    (tmp_path / "zola").mkdir()
    (tmp_path / "zola" / "x.txt").write_bytes(b"bad \xff")
    with pytest.raises(Exception, match="Not valid UTF-8: .*x.txt"):
        read_corpus(spark, str(tmp_path)).collect()


def test_enrichment(spark):
    keys = "author string, document_id string"
    known = local_table(spark, [("zola", "nana"), ("zola", "x"), ("stendhal", "y")], keys)
    got = {tuple(r) for r in enrich_corpus(known).collect()}
    assert got == {
        ("zola", "nana", "fr", "realist"),
        ("zola", "x", "en", "realist"),
        ("stendhal", "y", "fr", "romantic"),
    }
    unknown = local_table(spark, [("nobody", "x")], keys)
    with pytest.raises(Exception, match="Missing (era|language) mapping for author: nobody"):
        enrich_corpus(unknown).collect()
    eras = dimensions.era_dim(spark, {"nobody": "modern"}, {})
    with pytest.raises(Exception, match="Missing language mapping for author: nobody"):
        enrich_corpus(unknown, eras=eras).collect()
    override = dimensions.override_dim(spark, {("nobody", "x"): "fr"})
    assert enrich_corpus(unknown, overrides=override, eras=eras).collect()[0]["language"] == "fr"
    assert add_era(unknown).collect()[0]["era"] is None


TEXTS = ['a "quoted" \\ back\nline', "", "x,y;\ttab", "é\r\nü", "'\"\"\\\"", " pad "]


@pytest.mark.parametrize("fmt", ["parquet", "ORC", "csv", "json"])
def test_round_trip(spark, tmp_path, fmt):
    rows = [(f"00{i % 2}", f"d{i}", t) for i, t in enumerate([*TEXTS, None])]
    df = local_table(spark, rows, "author string, document_id string, raw_text string")
    path = str(tmp_path / "out")
    for _ in range(2):  # the second write replaces the first
        if fmt.lower() in sinks.STORE_FORMATS:
            sinks.save_corpus(df, path, fmt)
        else:
            sinks.export_corpus(df, path, fmt)
    back = sinks.read_export(spark, path, fmt, df.schema)
    assert {tuple(r) for r in back.select(*df.columns).collect()} == set(rows)
    assert (tmp_path / "out" / "author=000").is_dir()


def test_hot_author_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("author"),
        F.sha2(F.col("id").cast("string"), 256).alias("raw_text"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        sinks.save_corpus(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set(key, before)
    files = {a: len(list((tmp_path / "t" / f"author={a}").glob("*.parquet"))) for a in ("hot", "rare")}
    assert files["hot"] > 3 * files["rare"] >= 3
    assert spark.read.parquet(str(tmp_path / "t")).distinct().count() == 60_000


def test_unknown_formats(spark, tmp_path):
    df = local_table(spark, [("a",)], "author string")
    with pytest.raises(ValueError, match="fmt must be"):
        sinks.save_corpus(df, str(tmp_path / "x"), "csv")
    with pytest.raises(ValueError, match="fmt must be"):
        sinks.export_corpus(df, str(tmp_path / "x"), "parquet")


def test_numeric_author_stays_text(spark, tmp_path):
    tokens = token_table(spark, token_rows([["a"]], author="007"))
    sinks.write_table(tokens, str(tmp_path / "t"))
    back = tables.read_tokens(spark, str(tmp_path / "t"))
    assert [r["author"] for r in back.collect()] == ["007"]
    assert back.columns[-1] == "author"


def test_file_validation(spark, tmp_path):
    files = {
        "a/ok.txt": "ok é x".encode() + b" y" * 600,
        "a/bad.txt": b"bad \xff",
        "a/page.txt": b"\n<!DOCTYPE html>" + b"x" * 3000,
        "a/late.txt": b"x" * 196 + b"<html",
        "a/edge.txt": b"x" * 195 + b"<html",
        "a/case.txt": b"<HTML \xff",
        "a/htmlbad.txt": b"<html \xff",
        "a/empty.txt": b"",
    }
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content)
    names = ["ok", "bad", "page", "late", "edge", "case", "htmlbad", "empty", "gone"]
    manifest = local_table(spark, [("a", n) for n in names], "author string, document_id string")
    found = validation.binary_files(spark, str(tmp_path))
    got = {r["document_id"]: tuple(r)[2:] for r in validation.validate_files(manifest, found).collect()}
    assert got == {
        "ok": ("ok", 1, 603),
        "bad": ("ENCODING", None, None),
        "page": ("HTML_ERR", 2, None),
        "late": ("ok", 0, 1),
        "edge": ("HTML_ERR", 0, None),
        "case": ("ENCODING", None, None),
        "htmlbad": ("HTML_ERR", 0, None),
        "empty": ("ok", 0, 0),
        "gone": ("MISSING", None, None),
    }
    missing = validation.manifest_missing(manifest, found).collect()
    assert [r["document_id"] for r in missing] == ["gone"]


def test_default_manifest(spark):
    manifest = dimensions.manifest_dim(spark)
    assert manifest.count() == 18
    assert manifest.join(dimensions.era_dim(spark), "author", "left_anti").isEmpty()
    reps = dimensions.representative_dim(spark)
    assert reps.join(manifest, ["author", "document_id"], "left_anti").isEmpty()


def test_storage_footprint(spark, tmp_path):
    for name, size in {"big/a/x.bin": 3_000_000, "big/y.bin": 500_000, "small/z.bin": 10_486}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"\0" * size)
    got = validation.storage_footprint(
        spark, [("Small", f"{tmp_path}/small"), ("None", f"{tmp_path}/none"), ("Big", f"{tmp_path}/big")]
    )
    assert [(r["dataset"], r["size_mb"]) for r in got.collect()] == [("Big", 3.34), ("Small", 0.01)]
    assert validation.storage_footprint(spark, [("None", f"{tmp_path}/none")]).count() == 0


def test_scratch_is_below_the_checkpoint_folder(spark):
    first, second = (tables.scratch_dir(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(spark.conf.get(tables.CHECKPOINT_DIR))


def test_every_manifest_entry_has_a_verdict(spark):
    manifest = spark.createDataFrame([("a", f"d{i}") for i in range(150)], "author string, document_id string")
    files = spark.createDataFrame([("a", "d3", bytearray(b"ok"))], "author string, document_id string, content binary")
    found = validation.validate_files(manifest, files)
    assert found.count() == 150 and found.where("status = 'ok'").count() == 1
    with pytest.raises(Exception, match="Duplicate look-up key: a, d3"):
        validation.validate_files(manifest, files.union(files)).collect()
    with pytest.raises(Exception, match="Duplicate look-up key: a, d7"):
        validation.validate_files(manifest.union(manifest.where("document_id = 'd7'")), files).collect()


def test_duplicate_look_ups_fail(spark):
    from lexiloom.operators.enrich import add_era, enrich_corpus

    docs = spark.createDataFrame([("a", "x")], "author string, document_id string")
    eras = spark.createDataFrame([("a", "e", "A")], "author string, era string, author_label string")
    languages = spark.createDataFrame([("a", "en")], "author string, language string")
    none = spark.createDataFrame([], "author string, document_id string, language string")
    some = spark.createDataFrame([("a", "x", "fr")] * 2, "author string, document_id string, language string")
    assert enrich_corpus(docs, languages, none, eras).collect()[0]["era"] == "e"
    for args in ((languages.union(languages), none, eras), (languages, some, eras), (languages, none, eras.union(eras))):
        with pytest.raises(Exception, match="Duplicate look-up key: a"):
            enrich_corpus(docs, *args).collect()
    with pytest.raises(Exception, match="Duplicate look-up key: a"):
        add_era(docs, eras.union(eras)).collect()


def test_files_are_judged_by_lines_as_by_bytes(spark, tmp_path):
    """Every verdict of the line-wise validation is that of the whole bytes, also with splits inside lines and characters."""
    bom = b"\xef\xbb\xbf"
    long = ("é日𝄞 mot\n" * 40_000).encode()
    cases = {
        "plain": b"one two\nthree", "end": b"one\n\n", "blank": b" \n\t\n", "empty": b"", "newline": b"\n",
        "cr": b"one\rtwo\r\nthree\r\n", "bom": bom + b"one two", "bom_blank": bom + b" one", "bom_line": bom + b"\none", "only_bom": bom,
        "bad": b"one\nbad \xff\n", "cut": "é".encode()[:1], "cut_line": "é".encode()[:1] + b"\n" + "é".encode()[1:], "bad_html": b"<html>\xff",
        "html": b"\n" * 195 + b"<html>", "late": b"\n" * 196 + b"<html>", "lines": b"ab\n" * 60 + b"<!DOCTYPE x", "late_lines": b"ab\n" * 64 + b"<!DOCTYPE x",
        "bom_html": bom + b"\n" * 192 + b"<html", "bom_late": bom + b"\n" * 193 + b"<html", "long": long, "long_bad": long + b"\xe9", "one_line": b"word " * 200_000,
        "early_in_long": b"<html>" + long, "nul": b"a\x00b\n\x00",
    }
    (tmp_path / "raw" / "a").mkdir(parents=True)
    for name, data in cases.items():
        (tmp_path / "raw" / "a" / f"{name}.txt").write_bytes(data)
    raw = str(tmp_path / "raw")
    manifest = spark.createDataFrame([("a", name) for name in [*cases, "absent"]], "author string, document_id string")
    expected = sorted(map(tuple, validation.validate_files(manifest, validation.binary_files(spark, raw)).collect()))
    statuses = {r[1]: r[2] for r in expected}
    assert (statuses["html"], statuses["late"], statuses["bom_html"], statuses["bom_late"], statuses["long_bad"]) == ("HTML_ERR", "ok", "HTML_ERR", "ok", "ENCODING")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (kept, "1000", "65537"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert sorted(map(tuple, validation.validate_corpus(manifest, raw).collect())) == expected
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_corpus_folder_is_listed_as_a_whole(spark, corpus_dir, monkeypatch):
    from lexiloom.sources.corpus import read_corpus_files

    # A pattern of files makes each one a path of its own, which the driver lists one by one.
    files = read_corpus_files(spark, str(corpus_dir), "binaryFile")
    assert "InMemoryFileIndex(1 paths)" in files._jdf.queryExecution().executedPlan().toString()
    names = {"nana.txt", "germinal.v2.txt", "le père+fils 100%.txt"}
    for folder in (corpus_dir, f"{corpus_dir}/", f"file://{corpus_dir}", f"{corpus_dir.parent}/r*", f"{corpus_dir}/../raw"):
        paths = [r["source_path"] for r in read_files(spark, str(folder)).collect()]
        assert len(paths) == 5 and names < {p.rsplit("/", 1)[1] for p in paths}
    (corpus_dir.parent / "flat").mkdir()
    (corpus_dir.parent / "flat" / "x.txt").write_text("x")
    with pytest.raises(FileNotFoundError, match="No .txt files found under"):
        read_files(spark, f"{corpus_dir.parent}/flat")


def test_small_files_are_read_as_a_whole_and_large_ones_by_lines(spark, tmp_path, monkeypatch):
    bom = b"\xef\xbb\xbf"
    cases = {
        "empty": b"", "one": b"a", "only_bom": bom, "plain": b"one two\nthree", "bom": bom + b"one two", "bom_blank": bom + b" one",
        "bad": b"one\nbad \xff\n", "html": b"\n" * 195 + b"<html>", "bom_late": bom + b"\n" * 193 + b"<html", "long": "é日 mot\n".encode() * 400,
    }
    (tmp_path / "a").mkdir()
    for name, data in cases.items():
        (tmp_path / "a" / f"{name}.txt").write_bytes(data)
    whole = validation.file_verdicts(spark, str(tmp_path))
    expected = sorted(map(tuple, whole.collect()))
    assert len(expected) == len(cases) and ("a", "long", "ok", 3, 800) in expected and ("a", "empty", "ok", 0, 0) in expected
    assert "FileScan text" not in whole._jdf.queryExecution().executedPlan().toString()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for least in (3, 100, 1200):
        monkeypatch.setattr(validation, "WHOLE_BYTES", least)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        try:
            found = validation.file_verdicts(spark, str(tmp_path))
            assert "FileScan text" in found._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, found.collect())) == expected
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_corpus_files_are_read_once_as_bytes(spark, corpus_dir, monkeypatch):
    """The listing of paths stays in the JVM, and no file is opened by Spark's text source."""
    monkeypatch.setattr(type(spark.range(0)), "inputFiles", None)
    (corpus_dir / "zola" / "nothing.txt").write_bytes(b"")
    files = read_files(spark, str(corpus_dir))
    assert "FileScan text" not in files._jdf.queryExecution().executedPlan().toString()
    texts = {r["document_id"]: r["raw_text"] for r in files.collect()}
    assert len(texts) == 6 and texts["nothing"] == ""
