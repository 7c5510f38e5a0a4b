"""Mixing beside a plain computation of sizes and targets, and its invariants."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import pivotal
from tradeloom.llm.pivotal import Unfinished, fair_shares, meet, mix, mixed_documents, numbered
from tradeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_targets(sizes):
    """sizes: source -> words; the rounds of the contract, one after the other."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, open_ones, left = {}, set(names), float(sum(sizes.values()))
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        shares = {s: left * weight[s] / total for s in open_ones}
        full = {s for s in open_ones if shares[s] > 3 * sizes[s]}
        if not full:
            return target | shares
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ones -= full
    return target


def check(docs, rows):
    sizes = {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    targets = plain_targets(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], abs=1e-6)
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        rate = r.target / r.source_size if r.source_size else 1
        if r.size:
            assert abs(r.taken / r.size - rate) < 1
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = {}
    for r in rows:
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for source, words in taken.items():
        assert abs(words - targets[source]) <= largest[source] + 1e-6, source


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = QUERIES["op9_pivotal_mix"](spark, SF).collect()
    want = sorted((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs)
    assert sorted((r.doc_id, r.size) for r in rows) == want
    check(docs, rows)
    assert sorted(map(tuple, QUERIES["op9_pivotal_mix"](spark, SF).collect())) == sorted(map(tuple, rows))


def test_tree_of_parts_does_not_move_the_sum(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), "en", f"s{i % 50 % 4}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mix(docs, part_rows=4).withColumn("taken", F.col("size") * F.col("copies")).collect()
    assert len(found) == len(rows)
    check(docs.collect(), found)


def test_expected_copies():
    """Rounding is fair: over many keys each document keeps its fraction."""
    rng = random.Random(1)
    counts, runs = [0, 0, 0], 4000
    for run in range(runs):
        done, left = [], None
        for i, (size, p) in enumerate([(5.0, 0.3), (9.0, 0.6), (2.0, 0.8)]):
            new = Unfinished(run * 10 + i, size, p)
            left = new if left is None else meet(left, new, done)
        if left is not None:
            done.append((left, int(rng.random() < left.p)))
        for document, extra in done:
            counts[document.key % 10] += extra
    for count, p in zip(counts, (0.3, 0.6, 0.8), strict=True):
        assert abs(count / runs - p) < 0.035


def test_documents_that_share_a_key(spark, monkeypatch):
    monkeypatch.setattr(pivotal, "draw_key", lambda doc_id, key, source: F.pmod(doc_id, F.lit(2)))
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 3}", 0) for i in range(200)]
    rows += [(i, "other words here", "en", "s0", 0) for i in range(20)]  # a repeated id with another text
    found = mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len({(r.id, r.text_key, r.source) for r in found}) == len(rows)
    for source in ("s0", "s1", "s2"):
        part = [r for r in found if r.source == source]
        assert abs(sum(r["size"] * r.copies for r in part) - part[0].target) <= 7


def test_edge_rows(spark):
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "x y z", "en", None, 0), (3, "x y z", "en", None, 0),
        (4, "one\x1ctwo three", None, "b", None), (None, "some words here", "en", "é", 1), (5, " \t", "en", "z", 1),
        (6, "w " * 100_000, "en", "b", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit("q"), "copies": F.lit(9), "size": F.lit(1)})
    found = mix(docs).withColumn("taken", F.col("size") * F.col("copies"))
    assert found.agg(F.sum("n")).first()[0] == len(rows)
    by = {(r.id, r.source): r for r in found.collect()}
    assert by[(4, "b")]["size"] == 2 and by[(1, "a")].copies == 1 and by[(3, None)].n == 2
    assert all(0 <= r.copies <= 3 for r in by.values())
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == found.agg(F.sum(F.col("n") * F.col("copies"))).first()[0]
    taken = mixed.where("doc_id = 6").count()
    assert taken == by[(6, "b")].copies


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mix(docs).count() == 0 and mixed_documents(docs).count() == 0


def test_shares_and_ranks(spark):
    names = spark.createDataFrame([("b", 10), ("a", 1000), (None, 1), ("Z", 0)], "source string, size long")
    ranked = numbered(names, "source")
    assert {r.source: r["rank"] for r in ranked.collect()} == {"Z": 0, "a": 1, "b": 2, None: 3}
    weighed = ranked.withColumn("weight", F.col("rank") % 3 + 1)
    got = {r.source: r.target for r in fair_shares(weighed, 1011.0).collect()}
    assert got == {"Z": 0.0, "b": 30.0, None: 3.0, "a": pytest.approx(978.0)}
