"""The pipeline's stages on a small corpus with one case of each kind, and its registration."""

import os
import shutil

import pytest

import __spark_entry__
import corpus_pipeline

ENGLISH = "the river runs past the old mill and the children of the village swim there in the summer when it is warm"
FRENCH = "la rivière passe devant le vieux moulin et les enfants du village y nagent en été quand il fait chaud"


def prose(text, n, seed):
    words = text.split()
    return " ".join(words[(i * i + seed * i + seed) % len(words)] + ("" if i % 5 else str(seed * 7 + i)) for i in range(n))


ITEM = "which of these seven colours did the painter choose for the roof of the little house"


@pytest.fixture(scope="module")
def rows():
    out = [(i, prose(ENGLISH, 80, i), "en", f"src{i % 3}", 9) for i in range(1, 13)]
    out += [(20 + i, prose(FRENCH, 80, i), "fr", f"src{i % 3}", 9) for i in range(1, 13)]
    out += [(100, None, "en", "src1", 0), (101, "", None, None, 0), (102, "12 34 !!", "en", "src0", 8), (103, "日本語" * 30, None, "src0", 9)]
    out += [(110, out[0][1], "en", "src2", 9), (111, out[2][1] + "\n" + prose(ENGLISH, 70, 40), "en", "src2", 9)]
    out += [(120, prose(ENGLISH, 60, 50) + " " + ITEM.upper() + " " + prose(ENGLISH, 30, 51), "en", "src0", 9)]
    return out


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, head_id string, score double")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    yield path
    shutil.rmtree(path, ignore_errors=True)


def test_stages(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, folder), name)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == names
    clean = {r[0] for r in rows if r[0] < 100}
    assert set(kept["language_id"]) == clean | {110, 111, 120}
    lines = kept["line_dedup"]
    assert set(lines) == set(kept["language_id"])
    assert lines[110].text == "" and lines[110].n_chars == 0
    assert lines[111].text == prose(ENGLISH, 70, 40)
    assert all(lines[i].text == text for i, text, *_ in rows if i in clean)
    assert set(kept["simhash_dedup"]) == set(kept["line_dedup"])
    assert set(kept["decontamination"]) == clean | {110, 111}
    mixed = kept["mixing"]
    assert mixed and 110 not in mixed and set(mixed) <= clean | {111}


def test_near_duplicates_leave_one(spark, rows, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = sorted(r.doc_id for r in corpus_pipeline.remove_near_duplicates(spark, docs, folder).collect())
    # 110 repeats 1; 100, 101 have no words.
    assert 110 not in kept and 1 in kept and 100 in kept and 101 not in kept


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in names)] == []
    assert names["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
    assert os.path.exists(corpus_pipeline.__file__)
