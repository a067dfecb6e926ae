"""Token tables kept up to date, and jobs taken up again after a stop."""

from __future__ import annotations

import os

import pytest

from lexiloom.operators.annotate import annotate
from lexiloom.plans import jobs, updates
from lexiloom.plans.jobs import Layout, run_all
from lexiloom.plans.updates import digests_path, update_tokens
from lexiloom.sources.tables import read_table, read_tokens

SCHEMA = "author string, document_id string, language string, text_clean string"
DOCS = [
    ("zola", "nana", "fr", "Nana riait. Oui, dit-elle !"),
    ("zola", "germinal", "fr", "Les chevaux dormaient."),
    ("hugo", "one", "en", "The dogs were running."),
    ("007", "spy", "en", "The spy came in. He sat down."),
    (None, "lost", "en", "Nobody wrote this."),
    ("dickens", "blank", "en", " \t "),
    ("dickens", "none", "en", None),
    ("goethe", "faust", "de", "Habe nun, ach."),
]


def frame(spark, docs):
    return spark.createDataFrame(docs, SCHEMA)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def contents(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def check(spark, path, docs):
    assert contents(read_tokens(spark, path)) == contents(annotate(frame(spark, docs)))


def authors(found):
    return {r.author for r in found.collect()}


def test_only_changed_authors_are_written(spark, tmp_path):
    path = str(tmp_path / "tokens")
    assert authors(update_tokens(frame(spark, DOCS), path)) == {"zola", "hugo", "007", None}
    check(spark, path, DOCS)
    before = files(tmp_path)
    # Nothing has changed, only the order of rows and languages without tokens.
    same = [*reversed(DOCS), ("goethe", "werther", "de", "Wie froh bin ich.")]
    assert authors(update_tokens(frame(spark, same), path)) == set()
    assert files(tmp_path) == before

    steps = [
        ({"zola"}, [(*d[:3], d[3] + " Fin.") if d[1] == "germinal" else d for d in DOCS]),
        ({"zola"}, [d for d in DOCS if d[1] != "germinal"]),
        ({"hugo", "austen"}, [d for d in DOCS if d[1] != "germinal"] + [("hugo", "two", "en", "A second book."), ("austen", "emma", "en", "Handsome, clever.")]),
        ({None}, [d for d in DOCS if d[1] not in ("germinal", "lost")] + [("hugo", "two", "en", "A second book."), ("austen", "emma", "en", "Handsome, clever."), ("", "lost", "en", "Nobody.")]),
    ]
    for changed, docs in steps:
        before = files(path)
        assert authors(update_tokens(frame(spark, docs), path)) == changed
        kept = {f: t for f, t in files(path).items() if f in before}
        folders = {f"author={a}" if a else "author=__HIVE_DEFAULT_PARTITION__" for a in changed}
        assert {f for f in before if f not in kept} == {f for f in before if os.path.basename(os.path.dirname(f)) in folders}
        assert all(before[f] == t for f, t in kept.items())
        expected = [(d[0] or None, *d[1:]) for d in docs]
        check(spark, path, expected)


def test_repeated_documents_and_settings(spark, tmp_path):
    path = str(tmp_path / "tokens")
    update_tokens(frame(spark, DOCS), path)
    twice = [*DOCS, DOCS[2]]
    assert authors(update_tokens(frame(spark, twice), path)) == {"hugo"}
    check(spark, path, twice)
    everyone = {"zola", "hugo", "007", None}
    assert authors(update_tokens(frame(spark, twice), path, max_chars=10)) == everyone
    assert contents(read_tokens(spark, path)) == contents(annotate(frame(spark, twice), max_chars=10))
    assert authors(update_tokens(frame(spark, twice), path, max_chars=10, version="2")) == everyone


def test_an_author_without_documents_goes(spark, tmp_path):
    path = str(tmp_path / "tokens")
    update_tokens(frame(spark, DOCS), path)
    left = [d for d in DOCS if d[0] != "hugo"]
    update_tokens(frame(spark, left), path)
    check(spark, path, left)


def test_nothing_to_annotate_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    update_tokens(frame(spark, DOCS), path)
    before = files(tmp_path)
    for docs in ([], [("a", "x", "de", "Text.")]):
        with pytest.raises(RuntimeError, match="No documents were annotated"):
            update_tokens(frame(spark, docs), path)
    assert files(tmp_path) == before


def test_a_stopped_update_is_taken_up(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "tokens")
    update_tokens(frame(spark, DOCS), path)
    changed = [(*d[:3], "Other words.") if d[1] == "one" else d for d in DOCS]
    replace = updates._replace

    def stop(df, target):
        if target == path:
            raise OSError("stopped")
        replace(df, target)

    monkeypatch.setattr(updates, "_replace", stop)
    with pytest.raises(OSError, match="stopped"):
        update_tokens(frame(spark, changed), path)
    monkeypatch.setattr(updates, "_replace", replace)
    # Back to the first texts: the author is still written again, since its folder is not known to be whole.
    assert authors(update_tokens(frame(spark, DOCS), path)) == {"hugo"}
    check(spark, path, DOCS)
    assert read_table(spark, digests_path(path)).where("digest = 'pending'").isEmpty()


def test_a_stopped_job_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for name, text in {"zola/nana.txt": "Nana riait. — Oui, dit-elle !", "hugo/les_miserables.txt": "“Stop!” he cried."}.items():
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_text(text)
    stylometry, tokens = jobs.run_stylometry, jobs.write_tokens

    def stop(*_):
        raise OSError("stopped")

    monkeypatch.setattr(jobs, "run_stylometry", stop)
    with pytest.raises(OSError, match="stopped"):
        run_all(spark, str(raw), out, resume=True)
    monkeypatch.setattr(jobs, "run_stylometry", stylometry)
    before = files(Layout(out).tokens)
    monkeypatch.setattr(jobs, "write_tokens", stop)
    overview = run_all(spark, str(raw), out, resume=True)
    assert files(Layout(out).tokens) == before and overview["tokens_by_author"].count() == 2
    whole = str(tmp_path / "whole")
    monkeypatch.setattr(jobs, "write_tokens", tokens)
    run_all(spark, str(raw), whole)
    for name in ("tokens", "readability_global", "readability_sliding", "zipf", "dialog", "ttr", "pos"):
        assert contents(read_table(spark, getattr(Layout(out), name))) == contents(read_table(spark, getattr(Layout(whole), name))), name

    # Other windows only redo what they decide on; another file, also an empty one, redoes all.
    run_all(spark, str(raw), out, window_sizes=(5,), resume=True)
    assert files(Layout(out).tokens) == before
    assert {r[0] for r in read_table(spark, Layout(out).readability_sliding).select("window_size").distinct().collect()} == {5}
    (raw / "zola" / "empty.txt").write_text("")
    run_all(spark, str(raw), out, window_sizes=(5,), resume=True)
    assert not set(files(Layout(out).tokens)) & set(before)
    assert read_table(spark, Layout(out).corpus_parquet).count() == 3
