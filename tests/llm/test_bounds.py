"""What operators hold and send is bounded: samples by rows and bytes, automata by memory, license joins by runs."""

import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import common, decontaminate, licenses, mil


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_a_sample_has_a_row_for_each_id_and_bounded_bytes(spark):
    """Repeated ids, with one text or several, are one row; bytes are bounded in order of the ids' hashes."""
    rows = [(i, f"text {i} " + "x" * 100) for i in range(200)] * 2 + [(7, "another text"), (None, "none"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in mil.labelled(docs, labels, "quality", 4, 2, 1000).collect()}
    kept = {r.doc_id for r in labels.where(F.col("doc_id").isNotNull() & (common.doc_crc(F.col("doc_id")) % 4 != 2)).collect()}
    assert {*got} == kept and got[3].y == 1 if 3 in kept else True
    assert mil.labelled(docs, labels, "quality", 4, 2, 1000).count() == len(kept)
    few = mil.labelled(docs, labels, "quality", 4, 2, 1000, most_bytes=2_000).collect()
    assert 10 < len(few) < 20 and sum(len(r.text.encode()) for r in few) <= 2_000
    order = [r.doc_id for r in docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id")).collect() if r.doc_id in kept]
    assert {r.doc_id for r in few} == {*order[: len(few)]}
    assert {r.doc_id for r in mil.labelled(docs, labels, "quality", 4, 2, 1000, most_bytes=2_000).collect()} == {r.doc_id for r in few}


def test_an_automaton_at_its_limit_stays_small():
    """A worker that holds an automaton of MOST_BLOCK_BYTES of words without rule."""
    code = """
import numpy as np, resource, sys
from shardloom.llm import decontaminate
r = np.random.default_rng(0)
n = decontaminate.MOST_BLOCK_BYTES // 100
items, left = [], decontaminate.MOST_BLOCK_BYTES
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
i = 0
while left > 0:
    text = " ".join(f"w{x:06d}" for x in r.integers(0, 200_000, 400))
    items.append((i, text)); left -= len(text); i += 1
w = decontaminate.Windows(items)
text = items[3][1].encode()
assert w.scan(b"before it " + text)[1] == [(2, 402)]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env={**os.environ, "PYTHONPATH": root})
    assert told.returncode == 0, told.stderr
    assert float(told.stdout) < 500


def brute_scan(text):
    """labels and score of a text: every template's runs laid on it, by diagonals."""
    w, labels, shares = words(text), set(), [0.0]
    for phrase, label in licenses.PHRASES:
        own = phrase.split(" ")
        if any(w[p : p + len(own)] == own for p in range(len(w))):
            labels.add(label)
            shares.append(1.0)
    for notice, label in licenses.NOTICES:
        own, k = notice.split(" "), licenses.NOTICE_RUN
        runs = len(own) - k + 1
        votes = Counter(p - at for p in range(len(w) - k + 1) for at in range(runs) if w[p : p + k] == own[at : at + k])
        groups, last = [], None
        for d in sorted(votes):
            if last is None or d - last > licenses.NEIGHBOURS:
                groups.append(0)
            groups[-1] += votes[d]
            last = d
        for n in groups:
            share = min(1.0, n / runs)
            shares.append(share)
            if share >= licenses.LEAST_SHARE:
                labels.add(label)
    return ",".join(sorted(labels)), max(shares)


@pytest.mark.parametrize("most", [200_000, 1])
def test_labels_and_scores_by_brute_force(spark, sf, monkeypatch, most):
    """Whole notices, cut ones, ones with words between, several in a text, rows that repeat; by both joins."""
    monkeypatch.setattr(licenses, "MOST_BROADCAST_RUNS", most)
    r = np.random.default_rng(3)
    texts = [None, "", "MIT License", "gnu general public"]
    for notice, _ in licenses.NOTICES:
        own = notice.split(" ")
        for _ in range(6):
            start, stop = sorted(r.integers(0, len(own) + 1, 2).tolist())
            cut = own[start:stop] if r.random() < 0.6 else own
            for _ in range(int(r.integers(0, 4))):
                cut = [*cut[: (at := int(r.integers(0, len(cut) + 1)))], "between", *cut[at:]]
            texts.append(" ".join(["word"] * int(r.integers(0, 5)) + cut + ["and"] + (own if r.random() < 0.2 else [])))
    rows = [*enumerate(texts)] + [(5, texts[5])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id") + 10_000, "text")).repartition(4)
    got = Counter((x.doc_id, x.labels, round(x.score, 9)) for x in licenses.scan(docs).collect())
    assert got == Counter((x.doc_id, brute_scan(x.text)[0], round(brute_scan(x.text)[1], 9)) for x in docs.collect())


def test_shuffled_places_hold_no_text(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MOST_BROADCAST_RUNS", 1)
    df = spark.createDataFrame([(1, "mit license of a kind")], "doc_id long, text string")
    plan = licenses.scan(df)._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.splitlines() if "Join Inner" in x)
    assert "h#" in join


def test_arrow_functions_work_on_few_rows_at_a_time():
    """What a function makes of texts stands in a worker for SLICE_ROWS rows, however many the batch has, and is the same."""
    import pyarrow as pa

    from shardloom.llm import common, units

    seen = []

    def tell(texts):
        seen.append(len(texts))
        return units.tell(texts)

    texts = pa.array([None if i % 7 == 0 else f"line {i % 5}\n\nlong line {i}" for i in range(1_300)])
    assert common.sliced(tell)(texts).to_pylist() == units.tell(texts).to_pylist()
    assert seen == [512, 512, 276]
    assert len(common.sliced(tell)(texts.slice(0, 0))) == 0
