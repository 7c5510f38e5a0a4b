"""Near copies beside brute-force Jaccard similarities."""

import random

import pytest

import corpus_pipeline
from tradeloom.llm.near_copies import one_per_group

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_kept(rows):
    """Ids that stay: the smallest of every group connected by a similarity of 0.8."""
    sets, parent = {}, {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} - {()}
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i for i in sets if root(i) == i}


def made(seed):
    rng = random.Random(seed)
    common = [f"line{k}" for k in range(40)]
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 5, 30, 90, 150]))]
        if g % 3 == 0:
            base = common + base
        texts += [" ".join(base), " ".join(base).upper()]
        for _ in range(rng.choice([2, 20])):
            copy = list(base)
            for _ in range(rng.randrange(1, 8)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy[: rng.choice([len(copy), len(copy) - 1, len(copy) * 9 // 10])]))
    rng.shuffle(texts)
    return [*enumerate([*texts, None, "", " \n", "one", "One"])]


@pytest.mark.parametrize("max_list", [64, 2])
def test_groups_equal_brute_force(spark, max_list):
    rows = made(3)
    want = brute_kept(rows)
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS)
    assert {r.doc_id for r in one_per_group(docs, max_list=max_list).collect()} == want
    assert 12 < len(want) < len(rows) - 20


def test_pipeline_stage_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(1000)
    kept = corpus_pipeline.distinct_documents(spark, docs, "")
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id for r in kept.collect()} == brute_kept(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c d e f", None, None, 1), (None, None, None, None, 1), (7, "a b  C d e f", "en", "a", 1), (7, "a b  C d e f", "en", "a", 1), (8, "alone", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text) == [("7", "a b  C d e f"), ("8", "alone")]
    assert kept.count() == 3 and one_per_group(docs.where("false")).count() == 0
