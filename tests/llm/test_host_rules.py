"""Host rules beside their SQL, plain Python counts and odd rows."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from check_sql import compare
from tradeloom.llm import host_rules
from tradeloom.llm.host_rules import beta_prior, host_rates, judge
from tradeloom.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    name = "op5_host_rules"
    text, _, ok = compare(spark, f"/root/testdata/{sf}", name, QUERIES[name], SQL[name])
    assert ok, text


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def test_counts(spark):
    rng = random.Random(4)
    alphabet = ["a", "b", "é#", "the", "\x1c", "<x>", "\n", "\n\n", " \t", "\x0b"]
    texts = [" ".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += [None, "", " \n ", "a b", "a b c", "a a a a", "a b c a b c", "x\nx\nx", "x\r\nx", "w " * 3000]
    rows = [(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)]
    got = judge(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(texts[r.id]), texts[r.id]


def test_windows_of_equal_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(host_rules, "window_hash", lambda *words: F.char_length(words[0]).cast("long"))
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["a", "b", "cc", "dd"]) for _ in range(rng.randrange(2, 40))) for _ in range(60)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    for r in judge(spark.createDataFrame(rows, DOCS)).collect():
        assert r.n_repeat_words == plain(texts[r.id])[4]


def test_a_text_of_a_million_words(spark):
    rng = random.Random(10)
    words = [f"{rng.randrange(400)}" for _ in range(1_000_000)]
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[w] > 1 for k in range(3)}
    (row,) = judge(spark.createDataFrame([(1, " ".join(words), "en", "s", 0)], DOCS)).collect()
    assert (row.n_words, row.n_repeat_words) == (len(words), len(covered))


def test_rates_are_shrunk_and_reach_the_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 else "bad", "en", "large", 0) for i in range(100)]
    rows += [(200 + i, good if i % 8 == 0 else "bad", "en", "spam", 0) for i in range(80)]
    rows += [(400, "bad", "en", "tiny", 0), (401, good, "en", None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    found = judge(docs)
    rates = {r.host: r.rate for r in host_rates(found).collect()}
    assert 0.8 < rates["spam"] < 0.875 and 0.1 < rates["large"] < 0.14 and 0.6 < rates["tiny"] < 1
    kept = {r.host: r.n for r in found.where("kept").groupBy("host").agg(F.count("*").alias("n")).collect()}
    assert kept == {"large": 90, None: 1}
    prior = beta_prior(found.groupBy("host").agg(F.lit(4).alias("documents"), F.lit(2).alias("failures")))
    assert prior.a == prior.b == 5000


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "x y " * 40_000, "en", None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit("q"), "host": F.lit("h"), "words": F.lit(1)})
    got = judge(docs).collect()
    assert len(got) == 4 and all(r.base_failed and not r.kept for r in got)
    assert max(r.n_repeat_words for r in got) == 80_000
    assert judge(docs.where("false")).count() == 0
