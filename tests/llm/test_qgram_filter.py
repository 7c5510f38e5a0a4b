"""Passages found by the filter beside a full alignment of every passage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import qgram_filter
from tradeloom.llm.qgram_filter import (
    Passages,
    banded_alignment,
    codes_of,
    drop_contaminated,
    edit_budget,
    find_passages,
    normal,
    passages_of,
)
from tradeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def full_distance(passage, text):
    """Fewest edits between the passage and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, start=1):
        new = [i]
        for j, b in enumerate(text, start=1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyzé")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyzé"))
    return "".join(chars)


@pytest.fixture(scope="module")
def prose(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    return [(r.item_id, r.text) for r in items], [r.text for r in docs]


def test_edited_passages_are_found(prose):
    items, texts = prose
    rng = random.Random(5)
    index = Passages(items[:12])
    made, want = [], []
    for n in range(60):
        key, passage = items[n % 12]
        budget = edit_budget(len(normal(passage)))
        changed = edited(rng, passage.upper() if n % 5 == 0 else passage, rng.choice([0, 2, budget, budget + 12]))
        made.append(f"{texts[n][:150]} {changed} {texts[n + 1][:150]}")
        hits = set()
        for k, p in items[:12]:
            p = normal(p)
            if full_distance(p, normal(made[-1])) <= edit_budget(len(p)):
                hits.add(k)
        want.append(hits)
    got = [{r.item for r in regions} for regions in index.find_all(made)]
    assert got == want
    assert 20 < sum(map(len, want)) < 60


def test_regions_hold_the_passage(prose):
    items, texts = prose
    index = Passages(items)
    text = f"{texts[3][:400]}\n {items[7][1]} \t{texts[4][:300]} {items[2][1]} {texts[5][:100]}"
    found = {r.item: normal(text)[r.start : r.end] for r in index.find(text)}
    assert found[items[7][0]] == normal(items[7][1]) and found[items[2][0]] == normal(items[2][1])


def test_banded_distance_equals_full():
    rng = random.Random(2)
    for _ in range(150):
        passage = "".join(rng.choice("abc") for _ in range(rng.randrange(4, 20)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 30)))
        want = full_distance(passage, text)
        got = banded_alignment(codes_of(passage), codes_of(text), -len(passage), len(text), len(passage))
        assert got[0] == want


def test_blocks_of_long_texts(prose, monkeypatch):
    items, texts = prose
    monkeypatch.setattr(qgram_filter, "_TEXT_BLOCK", 1000)
    index = Passages(items)
    filler = " ".join(texts[:20])
    for at in range(900, 1100, 23):
        text = filler[:at] + " " + items[3][1] + " " + filler[at : at + 3000]
        assert {r.item for r in index.find(text)} >= {items[3][0]}


def test_query_equals_whole_search(spark, prose):
    items, _ = prose
    got = {r.doc_id: r for r in QUERIES["op6_qgram_lemma"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    wanted = {r.doc_id: sorted(k for k, p in items if normal(p) in normal(r.text or "")) for r in docs}
    for key, held in wanted.items():
        assert set(held) <= set(got[key].item_ids) and got[key].contaminated == (not got[key].kept)
        assert got[key].contaminated == bool(got[key].item_ids)
    assert any(wanted.values())
    assert sum(r.contaminated for r in got.values()) == sum(map(bool, wanted.values()))


def test_edge_rows(spark, prose):
    items, texts = prose
    passage = items[0][1]
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, f"x {passage.upper()} y"), (5, texts[0] * 200), (6, "clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "regions": F.lit("r")})
    bench = spark.createDataFrame([*items, (900, None), (901, ""), (902, "short"), items[0]], "item_id long, text string")
    found = find_passages(docs, bench).collect()
    assert len(found) == len(rows)
    flagged = sorted(str(r.id) for r in found if r.regions)
    assert flagged == ["3", "3", "None"]
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 6]
    none = bench.where("false")
    assert drop_contaminated(docs, none).count() == len(rows)
    assert find_passages(docs.where("false"), bench).count() == 0


def test_hashes_tell_grams_apart():
    codes = codes_of("abcdefghabcdefgh")
    hashes = qgram_filter.qgram_hashes(codes, 8)
    assert hashes[0] == hashes[8] and len(np.unique(hashes)) == 8


def test_cut_items_lose_nothing():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 1500)
        parts = passages_of("".join(rng.choice("abcd") for _ in range(n)))
        whole = parts[::2]
        sizes = [len(p) for p in whole]
        assert sum(sizes) == n and max(map(len, parts)) <= qgram_filter.PASSAGE_CHARS
        # however the allowed edits fall, one passage keeps within its own budget
        assert sum(edit_budget(size) + 1 for size in sizes) > edit_budget(n)


def test_quotes_of_most_of_an_item(spark, prose):
    items, texts = prose
    rng = random.Random(4)
    long = [(k, t) for k, t in items if len(normal(t)) > qgram_filter.PASSAGE_CHARS]
    rows = []
    for key, text in long:
        text = normal(text)
        size = int(0.85 * len(text))
        at = rng.randrange(len(text) - size + 1)
        rows.append((key, f"{texts[key][:200]} {text[at : at + size]} {texts[key + 1][:200]}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.id: {x.item_id for x in r.regions} for r in find_passages(docs, bench).collect()}
    assert len(rows) > 10 and all(key in got[key] for key, _ in rows)


def test_many_chunks_equal_one(spark, prose, monkeypatch):
    items, texts = prose
    made = [(n, f"{t[:500]} {items[n % len(items)][1]} {items[n % 7][1]} {t[:90]}") for n, t in enumerate(texts[:40])]
    docs = spark.createDataFrame([*made, (None, None), (41, ""), (42, texts[0][:60]), made[0]], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (None, "an item that has no id " * 30)], "item_id long, text string")
    docs = docs.unionByName(spark.createDataFrame([(43, "x " + "an item that has no id " * 30)], docs.schema))

    def found():
        return sorted(str((r.id, sorted(map(str, r.regions)))) for r in find_passages(docs, bench).collect())

    one, kept = found(), sorted(r.doc_id for r in drop_contaminated(docs, bench).where("doc_id > 0").collect())
    assert kept == [41, 42] and any("item_id=None" in r for r in one)
    monkeypatch.setattr(qgram_filter, "CHUNK_CHARS", 1500)
    assert len(list(qgram_filter._chunks(bench, 8))) > 5
    assert found() == one
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).where("doc_id > 0").collect()) == kept


def test_pairs_in_blocks(prose, monkeypatch):
    items, texts = prose
    index = Passages(items)
    made = [f"{t[:300]} {items[n % len(items)][1]} {t[300:900]}" for n, t in enumerate(texts[:60])]
    whole = index.find_all(made)
    monkeypatch.setattr(qgram_filter, "_PAIR_BLOCK", 50)
    assert index.find_all(made) == whole and all(whole)
