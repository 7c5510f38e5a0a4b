"""Prefix tables beside the library, prefix by prefix."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeloom.llm.prefix_counts import PrefixCounter, longest_within, prefix_tables, truncations, unpack
from tradeloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = PrefixCounter(PATH, max_known=200)
PIECES = [" ", " ", "  ", "\n", "\t", "\x85", " ", "the", "The", "ing", "don", "'re", "'ll", "'s", "'", "é", "中文", "ß", "42", "!", "##", "<|endoftext|>", "<|endof", "\x1f", "\x00", "\U0001f600", "ৰ", "՘", "²", "_", "x" * 9]


def size(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=16).map("".join))
def test_every_prefix(text):
    ((table, total),) = OWN.tables([text])
    assert unpack(table).tolist() == [size(text[:i]) for i in range(len(text) + 1)]
    assert total == size(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert unpack(OWN.tables([text])[0][0]).tolist() == [size(text[:i]) for i in range(len(text) + 1)]


def test_prose_and_budgets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20).collect()
    for r in docs:
        ((table, total),) = OWN.tables([r.text])
        counts = unpack(table)
        assert total == counts[-1] == size(r.text)
        for at in range(0, len(r.text), 97):
            assert counts[at] == size(r.text[:at])
        cut = longest_within(table, 50)
        assert size(r.text[:cut]) <= 50 and (counts[cut + 1 :] > 50).all()


def test_large_differences_widen_the_table():
    own = PrefixCounter(PATH)
    own._learn({"ab", " cd"})
    own.known[" cd"] = None
    own.counts = lambda text: list(np.cumsum([500] * len(text)))
    ((table, total),) = own.tables(["ab cd"])
    assert table[0] == 2 and total == 2500 and unpack(table).tolist() == [0, 500, 1000, 1500, 2000, 2500]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_query_equals_library(spark):
    got = {r.doc_id: r for r in QUERIES["op7_prefix_counts"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        found = got[r.doc_id]
        assert (found.n_bytes, found.n_tokens) == (len(r.text.encode()), size(r.text))
        assert found.over_limit == (found.n_tokens > 512)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (None, "word"), (5, "x " * 60_000), (6, "a" * 20_000), (7, " " * 3000 + "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_bytes": F.lit("q"), "prefixes": F.lit(1)})
    found = truncations(prefix_tables(docs, PATH), 3).collect()
    assert len(found) == len(rows)
    by = {r.id: r for r in found}
    for key, text in rows:
        assert by[key].n_tokens == size(text or "") == unpack(bytes(by[key].prefixes))[-1]
        assert by[key].n_chars == len(text or "")
    assert by[5].chars_within == 5 and by[1].chars_within == 0
    assert prefix_tables(docs.where("false"), PATH).count() == 0
