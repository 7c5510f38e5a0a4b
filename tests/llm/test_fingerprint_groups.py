"""The near-copy stage goes through the pivot search and keeps its exact result."""

import random

from test_near_copies import brute_kept

import corpus_pipeline
from tradeloom.llm.near_copies import one_per_group
from tradeloom.llm.simhash_pivots import near_duplicates, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng, found = random.Random(3), []
    for i in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(200)]
        found.append(" ".join(words))
        for at in (0, 199, 60, 100)[: i % 5]:  # one word changed: near copies, within two bits or beyond
            found.append(" ".join([*words[:at], "other", *words[at + 1 :]]))
    return [*enumerate(found), (90, ""), (91, None), (92, "one two"), (93, "two one"), (94, found[0]), (None, found[3]), (None, "alone")]


def test_stage_links_by_pivots_and_keeps_one_of_each_group(spark, monkeypatch):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS)
    searched = []

    def search(frame):
        # whatever a search groups is verified: here everything is one group
        searched.append(frame)
        found = near_duplicates(frame)
        return found.selectExpr("id", "key", "fp", "0L AS component_id") if len(searched) > 1 else found

    monkeypatch.setattr(corpus_pipeline, "near_duplicates", search)
    known = [(i, t or "") for i, t in rows if i is not None]
    want = brute_kept(known)
    for _ in range(2):
        kept = corpus_pipeline.distinct_documents(spark, docs, "").collect()
        assert {r.doc_id for r in kept if r.doc_id is not None} == set(want)
        assert [r.text for r in kept if r.doc_id is None] == ["alone"]
    assert len(searched) == 2


def test_links_of_fingerprints_alone_join_groups_too(spark):
    rng = random.Random(5)

    def text(g, words=6):
        """Mostly a repeated line: fingerprints agree, sets of shingles do not."""
        line = " ".join(f"g{g}line{k}" for k in range(9))
        return " ".join([line] * 60 + [f"w{rng.randrange(10**6)}" for _ in range(words)])

    a, b, far = text(1, 30), text(1, 30), text(2)
    changed = a.split()
    changed[-1] = "other"  # a near copy of the first text, linked to the second through it
    texts = [a, b, " ".join(changed), far, "alone in its group of words", text(2, 30)]
    prints = [simhash(t) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= 2 and (prints[3] ^ prints[5]).bit_count() <= 2
    assert brute_kept([*enumerate(texts)]) == {0, 1, 3, 4, 5}
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    assert {r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, "").collect()} == {0, 3, 4}
    assert sorted(r.doc_id for r in one_per_group(docs).collect()) == [0, 1, 3, 4, 5]
