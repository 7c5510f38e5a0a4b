"""Ranked search beside brute force over all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tradeloom.llm.term_tree import Best, Tree, _term_blocks, search, terms

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total = sum(sum(c.values()) for _, c in counts)
    holding = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in set(items):
        found = []
        for doc, c in counts:
            m = 100 - 25 + 25 * sum(c.values()) * len(counts) // total
            score = 0
            for w in words(text):
                if w in c:
                    weight = math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * holding[w] + 1)))
                    score += weight * (10**9 * c[w] // (1000 * c[w] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort()
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(found[:top], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    found = search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    return sorted(map(tuple, found.collect()), key=str)


def made(seed, n):
    rng = random.Random(seed)
    bag = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Élan", "x-y", "A1", "été"]
    docs = [(i, " ".join(rng.choices(bag, k=rng.randrange(1, 40)))) for i in range(n)]
    docs += [(i + n, docs[i % 7][1]) for i in range(n // 3)]  # copies and ties
    docs += [(None, docs[3][1]), (5, docs[5][1]), (n * 2, ""), (n * 2 + 1, None), (n * 2 + 2, "... --")]
    items = [(i, " ".join(rng.choices(bag, k=rng.randrange(1, 12)))) for i in range(15)]
    return docs, [*items, (3, items[3][1]), (3, "w1 w1 w2"), (None, "w1"), (90, ""), (91, None), (92, "unseen")]


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    docs, items = made(seed, 300)
    assert got(spark, docs, items) == brute(docs, items)


def test_item_groups_and_small_top(spark):
    docs, items = made(4, 60)
    assert got(spark, docs, items, top=3, group_terms=6) == brute(docs, items, 3)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries()["op11_term_tree"](spark, SF)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(docs, items)


def test_tree_bounds_and_pruning():
    rng = np.random.default_rng(5)
    size, n = 60, 4000
    paths, counts = [], []
    for _ in range(n):
        path = np.unique(np.minimum(rng.geometric(0.08, 8) - 1, size - 1))
        paths.append(path)
        counts.append(rng.integers(1, 5, len(path)))
    paths += [paths[0]] * 500
    counts += [counts[0]] * 500
    factors = rng.integers(75, 200, len(paths))
    tree = Tree(paths, counts, factors, size)
    asked, worth = np.array([2, 30, 41, 55]), np.array([300, 4000, 5000, 7000])
    bounds = tree.bounds(asked, worth)
    scores = np.zeros(len(paths), np.int64)
    for i, (path, tf) in enumerate(zip(paths, counts, strict=True)):
        for t, w in zip(asked, worth, strict=True):
            for c in tf[path == t]:
                scores[i] += w * (10**9 * int(c) // (1000 * int(c) + 12 * int(factors[i])))
    for node, leaf in enumerate(tree.leaves):
        if leaf:
            assert bounds[node] >= scores[tree.order[leaf[0] : leaf[1]]].max()
        else:
            assert bounds[node] >= bounds[tree.children[node]].max()
    best = Best(20)
    best.ids = list(range(len(paths)))
    scored = tree.search(asked, worth, np.zeros(size, np.int64), best)
    best.settle()
    want = sorted((-int(s), False, i) for i, s in enumerate(scores) if s > 0)[:20]
    assert best.found == want
    assert scored < sum(leaf is not None for leaf in tree.leaves) * 2 / 3


def test_terms_in_blocks(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choices("abC É-_ \n.9\x7f", k=5000))
    monkeypatch.setattr("tradeloom.llm.term_tree.SLICE_BYTES", 7)
    assert [w for b in _term_blocks(text) for w in b] == terms(text) == [w.encode() for w in words(text)]


def test_long_text(spark):
    docs = [(1, "alpha beta " * 600_000), (2, "alpha")]
    assert got(spark, docs, [(1, "alpha"), (2, "beta alpha")]) == brute(docs, [(1, "alpha"), (2, "beta alpha")])


def test_empty_and_extra_columns(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a")], []) == []
    docs = spark.createDataFrame([(1, "a"), (2, "b")], DOCS).withColumns({c: F.lit(1) for c in ("id", "terms", "n", "item", "rank")})
    items = spark.createDataFrame([(7, "A")], ITEMS).withColumns({c: F.lit(2) for c in ("id", "doc_id", "score")})
    assert [(r.item_id, r.rank, r.id) for r in search(docs, items).collect()] == [(7, 1, 1)]
