"""The language model beside plain sums and softmaxes."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tradeloom.llm import log_bilinear as lb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def tokens(text):
    return [*lb._lowered(text or "").split(), lb.END_WORD]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute_base(docs):
    c = Counter()
    for i, t in docs:
        if not held_out(i):
            c.update(tokens(t))
    total, kinds = sum(c.values()), len(c)
    out = []
    for i, t in docs:
        words = tokens(t)
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        out.append((i, held_out(i), len(words), sum(c[w] > 0 for w in words), total, base))
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[5]))


def check_base(got, docs):
    got = sorted(map(tuple, got), key=lambda r: (str(r[0]), r[2], r[5]))
    want = brute_base(docs)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)
    return got


def made(seed, n):
    """Texts of two tongues whose words follow one another."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        tongue = rng.choice("ab")
        docs.append((i, " ".join(f"{tongue}{int(rng.paretovariate(0.8))}" for _ in range(rng.randrange(1, 120)))))
    return [*docs, (None, "a1 A1\tb2"), (7, docs[7][1]), (n, ""), (n + 1, None), (n + 2, "\x0b \x0c")]


@pytest.fixture(scope="module")
def scored(spark):
    docs = made(1, 400)
    return docs, lb.score(spark.createDataFrame(docs, DOCS), head=300, words=100).collect()


def test_base(scored):
    docs, got = scored
    check_base(got, docs)


def test_model_beats_counts_on_unseen_texts(scored):
    _, got = scored
    unseen = [r for r in got if r.held_out]
    assert len(unseen) > 20
    gain = sum(r.score - r.base_score for r in unseen) / sum(r.n_tokens for r in unseen)
    assert gain > 0.1


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries()["op12_log_bilinear"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = check_base(found.collect(), docs)
    unseen = [r for r in got if r[1]]
    assert sum(r[6] for r in unseen) > sum(r[5] for r in unseen)
    assert all(r[6] < 0 for r in got)


def learned(spark, docs, head, words):
    rows = lb.id_and_text(spark.createDataFrame(docs, DOCS), "doc_id", "text")
    known = lb.vocabulary(lb.word_counts(rows), head, words)
    return rows, known, lb.train(rows, known)


def test_scores_are_normalised_softmaxes(spark):
    docs = made(2, 80)
    rows, known, model = learned(spark, docs, 60, 20)
    counts = Counter(w for _, t in docs for w in tokens(t))
    symbols = known.size
    own = {w: known.symbol[i] for w, i in known.place.items() if known.symbol[i] < symbols - lb.CLASSES}

    def probabilities(two, one):
        hidden = model.context[one].astype(float) @ model.near + model.context[two].astype(float) @ model.far
        raw = np.exp(model.target @ hidden + model.bias)
        return raw / raw.sum()

    def of(word):
        return own[word] if word in own else symbols - lb.CLASSES + lb._class_of(word)

    def within(word):
        if word in own:
            return 1.0
        same = [w for w in counts if w not in own and lb._class_of(w) == lb._class_of(word)]
        return (counts[word] + 0.1) / (sum(counts[w] for w in same) + 0.1 * len(same) + 0.1)

    # all words and one unseen word per class share the whole probability
    for cls in {lb._class_of(w) for w in counts if w not in own}:
        same = [w for w in counts if w not in own and lb._class_of(w) == cls]
        unseen = 0.1 / known.mass[cls]
        assert abs(sum(map(within, same)) + unseen - 1) < 1e-9
    got = lb._scored(rows.withColumn("held_out", F.lit(False)), known, model).collect()
    texts = {(i, t or "") for i, t in docs}
    by_size = Counter()
    for i, text in texts:
        two = one = lb.END
        total = 0.0
        for word in tokens(text):
            total += math.log10(probabilities(two, one)[of(word)] * within(word))
            two, one = one, of(word)
            if word not in known.place:
                total -= math.log10(counts[word] + 0.1)  # joined later
        by_size[i, len(tokens(text)), round(total, 2)] += 1
    assert {(r.id, r.n_tokens) for r in got} == {k[:2] for k in by_size}
    for r in got:
        assert any(k[0] == r.id and k[1] == r.n_tokens and abs(k[2] - r.model) < 0.02 + 1e-4 * r.n_tokens for k in by_size)


def test_blocks_do_not_matter(spark, monkeypatch):
    _, known, _ = learned(spark, made(3, 30), 40, 10)
    texts = ["a1 a2 b3 zz a1", "", "b1", "a1 " * 9, " "]
    whole = list(lb.Reader(known).blocks(texts))
    monkeypatch.setattr(lb, "_MOST_TOKENS", 2)
    monkeypatch.setattr("tradeloom.llm.common._BLOCK_BYTES", 3)
    parts = list(lb.Reader(known).blocks(texts))
    assert len(whole) == 1 and len(parts) > 5
    for at in range(5):
        assert np.array_equal(whole[0][at], np.concatenate([p[at] for p in parts]))
    assert whole[0].rare == [w for p in parts for w in p.rare]


def test_few_words_in_the_head(spark):
    docs = made(4, 60)
    check_base(lb.score(spark.createDataFrame(docs, DOCS), head=3, words=2).collect(), docs)


def test_models_are_averaged_in_levels(spark, monkeypatch):
    monkeypatch.setattr(lb, "_FAN", 3)
    known = lb.vocabulary(lb.word_counts(spark.createDataFrame([("a b",)], "text string")), 10, 5)
    start = lb.Model.start(known.noise)
    rows = [(float(n), bytearray((start.flat() * n).tobytes())) for n in range(1, 21)]
    mean = lb._averaged(spark.createDataFrame(rows, "tokens double, model binary").repartition(20), known.size, start)
    share = sum(n * n for n in range(1, 21)) / sum(range(1, 21))
    assert np.allclose(mean.flat(), start.flat() * share, rtol=1e-4)


def test_empty_tables_and_extra_columns(spark):
    assert lb.score(spark.createDataFrame([], DOCS)).collect() == []
    unseen = next(i for i in range(100) if held_out(i))
    (row,) = lb.score(spark.createDataFrame([(unseen, "never seen")], DOCS)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and abs(row.base_score) < 1e-12 and row.score < 0
    docs = [(1, "a b"), (2, "a")]
    frame = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("id", "n", "word", "row", "rare", "base", "model")})
    check_base(lb.score(frame).collect(), docs)


def test_long_text(spark):
    docs = [(1, "one two three " * 400_000), (2, "x" * 2_000_000), (3, "one")]
    check_base(lb.score(spark.createDataFrame(docs, DOCS)).collect(), docs)
