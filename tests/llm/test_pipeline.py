"""The stages one after the other, each against a plain version of it on its own input."""

import re

import pytest
from test_operators import brute_classes, brute_runs, norm, words

import corpus_pipeline
from shardloom.llm import mil, units

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf).write.parquet(path)
        out.append((name, docs, after := spark.read.parquet(path)))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_columns_stay(steps, spark, sf):
    columns = spark.read.parquet(f"{sf}/documents.parquet").dtypes
    for name, (_, after) in steps.items():
        if name != "encode":
            assert after.dtypes == columns, name
    assert steps["encode"][1].columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_quality(steps, spark, sf):
    before, after = steps["quality"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model, vectors = mil.fit_quality(before, labels), mil.Passages()
    want = {r.doc_id for r in before.collect() if model.scores([vectors.vectors(r.text)])[0] >= mil.QUALITY_LEAST}
    assert {r.doc_id for r in after.collect()} == want
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(want & good) / len(good) > 0.95


def test_line_dedup(steps):
    before, after = steps["line_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    gone = brute_runs(rows, units.MIN_LINES, units.RUN_WORDS)
    want = {d: "\n".join(u for i, u in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    got = {r.doc_id: r for r in after.collect()}
    assert {d: r.text for d, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    assert gone and all(norm(u) for d, i in gone for u in [dict(rows)[d].split("\n")[i]])


def test_near_dedup(steps):
    before, after = steps["near_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    root = brute_classes(rows)
    assert {r.doc_id for r in after.collect()} == {rows[k][0] for k in root}


def test_decontaminate(steps, spark, sf):
    before, after = steps["decontaminate"]
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {" ".join(w[i : i + 10]) for i in range(max(len(w) - 9, 1))} - {""}
    held = re.compile("|".join(rf"(?<!\S){re.escape(x)}(?!\S)" for x in windows))
    want = {r.doc_id for r in before.collect() if not held.search(" ".join(words(r.text)))}
    assert {r.doc_id for r in after.collect()} == want


def test_encode(steps):
    from tokenizers import Tokenizer

    from shardloom.llm import bpe

    ref, (before, after) = Tokenizer.from_file(bpe.default_path()), steps["encode"]
    texts = {r.doc_id: r.text for r in before.collect()}
    got = {r.doc_id: r.ids for r in after.collect()}
    assert got == {d: ref.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


def test_run_is_the_stages(steps, spark, sf):
    want = {(r.doc_id, r.ids_sha256) for r in steps["encode"][1].collect()}
    assert {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()} == want


def test_awkward_documents(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c d e f g h i j k", "en", None, 21), (2, "a b c d e f g h i j k", "en", None, 21)]
    for docs in (spark.createDataFrame(rows, TABLE), spark.createDataFrame([], TABLE)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, sf)
            assert after.count() <= docs.count()
            assert name == "encode" or after.columns == docs.columns
