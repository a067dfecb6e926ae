from __future__ import annotations

import pytest

from lexiloom.__main__ import main
from lexiloom.operators.clean import clean_corpus
from lexiloom.operators.diagnostics import (
    document_tokens,
    quote_counts,
    quote_counts_by_document,
    quote_samples,
    tokens_by_author,
    verify_tokens,
)
from lexiloom.operators.dialog import dialog_summary, label_dialog
from lexiloom.operators.lexical import pos_distribution, type_token_ratio, zipf
from lexiloom.operators.readability import global_readability, sliding_readability
from lexiloom.plans import report
from lexiloom.plans.jobs import Layout, run_all, write_tokens
from lexiloom.sources.corpus import read_corpus
from lexiloom.sources.tables import read_table, read_tokens
from tests.helpers import token_rows, token_table

BOOK = (
    "Licence\r\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\r\n{}\r\n"
    "*** END OF THE PROJECT GUTENBERG EBOOK X ***\r\nMore licence"
)
TEXTS = {
    "zola/nana.txt": "Nana riait. — Oui, dit-elle ! Les chevaux dormaient. " * 200,
    "hugo/les_miserables.txt": "“Stop!” he cried. The dogs were running quickly. " * 200,
    "dickens/bleak_house.txt": '"Fog," said he. Fog everywhere -- Fog up the river. ' * 100,
}


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    for name, text in TEXTS.items():
        path = root / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(BOOK.format(text), newline="")
    overview = run_all(spark, str(root / "raw"), str(root / "out"))
    return Layout(str(root / "out")), overview


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert left.select(columns).exceptAll(right.select(columns)).isEmpty()
    assert right.select(columns).exceptAll(left.select(columns)).isEmpty()


def test_stored_tables_equal_operators(spark, finished):
    out, _ = finished
    tokens = read_tokens(spark, out.tokens)
    assert tokens.count() > 5000
    same(read_table(spark, out.readability_global), global_readability(tokens))
    same(read_table(spark, out.readability_sliding), sliding_readability(tokens))
    same(read_table(spark, out.zipf), zipf(tokens))
    same(read_table(spark, out.dialog), dialog_summary(label_dialog(tokens)))
    same(read_table(spark, out.ttr), type_token_ratio(tokens))
    same(read_table(spark, out.pos), pos_distribution(tokens))
    same(read_table(spark, out.corpus_parquet), spark.read.orc(out.corpus_orc))


def test_overview(finished):
    _, overview = finished
    stats = overview["corpus_statistics"].collect()
    # 8 words and 3 sentence ends per repetition, licence text removed.
    assert [(r["document_id"], r["word_count"]) for r in stats] == [
        ("nana", 1800), ("les_miserables", 1600), ("bleak_house", 1000),
    ]
    authors = [r["author"] for r in overview["tokens_by_author"].collect()]
    assert sorted(authors) == ["dickens", "hugo", "zola"]


def test_reports(spark, finished):
    out, _ = finished
    tokens = read_tokens(spark, out.tokens)
    assert report.readability_table(read_table(spark, out.readability_global)).count() == 3
    sliding = read_table(spark, out.readability_sliding)
    assert report.sliding_summary(sliding).count() == 6
    series = report.sliding_series(sliding, ["nana"])
    assert {r[0] for r in series.select("window_size_label").distinct().collect()} == {
        "5 chunks", "10 chunks", "20 chunks",
    }
    assert report.zipf_curves(tokens).select("document_id").distinct().count() == 2
    ttr = read_table(spark, out.ttr)
    assert [r["era"] for r in report.ttr_by_era(ttr).collect()] == ["realist", "realist", "romantic"]
    totals = [r["total_tokens"] for r in report.corpus_size(ttr).collect()]
    assert totals == sorted(totals, reverse=True)
    ratios = [r["dialog_ratio"] for r in report.dialog_table(read_table(spark, out.dialog)).collect()]
    assert ratios == sorted(ratios, reverse=True) and ratios[0] > 0


def test_nothing_to_annotate(spark, tmp_path):
    path = tmp_path / "raw" / "zola" / "x.txt"
    path.parent.mkdir(parents=True)
    path.write_text("   ")
    clean = clean_corpus(read_corpus(spark, str(tmp_path / "raw")))
    with pytest.raises(RuntimeError, match="No documents were annotated"):
        write_tokens(clean, str(tmp_path / "tokens"))


def test_diagnostics(spark):
    rows = token_rows([["«", "l'an", "»"], ["-", "x", "«"]], "a", "d1")
    rows += token_rows([["mot", '"']], "b", "d2")
    tokens = token_table(spark, rows)
    assert [tuple(r) for r in quote_counts(tokens).collect()] == [
        ("«", 2), ('"', 1), ("-", 1), ("l'an", 1), ("»", 1),
    ]
    assert [tuple(r) for r in quote_counts_by_document(tokens).collect()] == [
        ("a", "d1", "«", 2), ("a", "d1", "-", 1), ("a", "d1", "l'an", 1), ("a", "d1", "»", 1),
        ("b", "d2", '"', 1),
    ]
    samples = quote_samples(tokens, rows=4).collect()
    assert [(r["chunk_id"], r["token_id"]) for r in samples] == [(0, 0), (0, 1), (0, 2), (1, 0)]
    assert [tuple(r) for r in tokens_by_author(tokens).collect()] == [("a", 6), ("b", 2)]
    assert document_tokens(tokens, "b", "d2").count() == 2
    with pytest.raises(ValueError, match=r"token table missing required columns: \['token_id'\]"):
        verify_tokens(tokens.drop("token_id"))


def test_command_line(spark, finished, capsys):
    out, _ = finished
    raw = out.root.replace("/out", "/raw")

    def run(*arguments):
        main([*arguments, "--data", raw, "--out", out.root])
        return capsys.readouterr().out

    before = read_table(spark, out.readability_sliding).count()
    run("readability", "--windows", "5")
    assert read_table(spark, out.readability_sliding).count() == before // 3
    run("stylometry")
    assert read_table(spark, out.ttr).count() == 3
    validated = run("validate")
    assert validated.count("|ok ") == 3 and validated.count("|MISSING") == 15
    assert "in text order" in run("diagnose")
    run("export")
    sizes = run("footprint")
    assert "corpus_annotated" in sizes and "corpus_csv" in sizes


def test_authors_are_kept_as_written(spark, tmp_path):
    for author, text in (("007", "The spy came in. He sat down."), ("07", "Le chat dort. Il rit.")):
        (tmp_path / "raw" / author).mkdir(parents=True)
        (tmp_path / "raw" / author / "x.txt").write_text(text)
    languages = spark.createDataFrame([("007", "en"), ("07", "fr")], "author string, language string")
    overrides = spark.createDataFrame([], "author string, document_id string, language string")
    eras = spark.createDataFrame(
        [("007", "e1", "A"), ("07", "e2", "B")], "author string, era string, author_label string"
    )
    run_all(spark, str(tmp_path / "raw"), str(tmp_path / "out"), languages, overrides, eras)
    out = Layout(str(tmp_path / "out"))
    for path in [getattr(out, name) for name in vars(out) if name not in ("root", "corpus_orc")]:
        assert {r["author"] for r in read_table(spark, path).select("author").collect()} == {"007", "07"}, path


def test_nothing_is_overwritten_by_an_empty_corpus(spark, tmp_path):
    schema = "author string, document_id string, language string, text_clean string"
    path = str(tmp_path / "tokens")
    write_tokens(spark.createDataFrame([("a", "x", "en", "One two.")], schema), path)
    with pytest.raises(RuntimeError):
        write_tokens(spark.createDataFrame([("a", "x", "xx", "One two.")], schema), path)
    assert read_tokens(spark, path).count() == 3
