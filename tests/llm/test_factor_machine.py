"""The factorisation machine: its identity, held-out accuracy and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm.factor_machine import Features, fit, is_held_out, keep_good, score, train, untrained
from tradeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op4_factor_machine"](spark, SF).collect()


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in scored if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in held]
    good = [r.predicted for r in held if labels[r.doc_id] == 1]
    assert np.mean(right) >= 0.95 and np.mean(good) >= 0.98


def test_reruns_agree(spark, scored):
    again = QUERIES["op4_factor_machine"](spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, scored))


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = train(docs, labels), train(docs, flipped)
    assert a.bias == b.bias and (a.vectors == b.vectors).all() and (a.weights == b.weights).all()


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    machine = untrained(0.3)
    machine.weights[:] = rng.normal(size=machine.weights.shape)
    machine.vectors[:] = rng.normal(size=machine.vectors.shape) / 10
    ids, values = Features().of("Some words, some WORDS!! 12\nand lines", 38)
    want = 0.3 + float(machine.weights[ids] @ values)
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            want += float(machine.vectors[ids[i]] @ machine.vectors[ids[j]]) * values[i] * values[j]
    assert machine.raw(ids, values) == pytest.approx(want, rel=1e-3)


def test_one_class_or_none():
    x = Features().of("a b c", 5)
    assert fit([], np.zeros(0)).score(*x) == pytest.approx(0.5)
    assert fit([x, x], np.ones(2)).score(*x) > 0.7


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (3, 7)], "doc_id long, quality int")
    rows = [(1, "fine words here", "en", "a", 15), (2, None, None, None, None), (2, None, None, None, None), (None, "", "en", "a", 0), (4, "x" * 100_000 + " \x00 é" * 50_000, "en", "a", -5)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit("z"), "score": F.lit(1), "recorded": F.lit(2)})
    machine = train(docs, labels)
    found = score(docs, machine).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    kept = keep_good(docs, machine, accept=0.0)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert keep_good(docs, machine, accept=1.1).count() == 0
    assert score(docs.where("false"), train(docs, labels.where("false"))).count() == 0
    assert keep_good(docs.where("false"), machine).count() == 0
