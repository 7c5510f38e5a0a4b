"""Token files: ids beside the library, exact round trips, random access."""

import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeloom.llm.common import text_slices
from tradeloom.llm.direct_codes import CodeFile, tokens_on_disk, write_codes
from tradeloom.llm.queries import QUERIES
from tradeloom.llm.vocabulary import Encoder

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "\n", "\t", "the", "The", "don't", "é", "ß", "中文", "42", "!", "<|endoftext|>", "<|end", "\x1f", "\x85", " ", "'", "'s", "\U0001f600", "x"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    path = public_tokenizers.path(name)
    own, lib = Encoder(path, max_known=50), Tokenizer.from_file(path)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=6))
    def same(texts):
        for got, text in zip(own.encode(texts), texts, strict=True):
            assert got.tolist() == lib.encode(text, add_special_tokens=False).ids

    same()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 600), max_size=40), max_size=6), st.booleans())
def test_round_trip_and_access(documents, null_id):
    out = io.BytesIO()
    ids = [None if null_id and i == 0 else i for i in range(len(documents))]
    write_codes(out, ids, [np.array(d, dtype=np.uint32) for d in documents])
    read = CodeFile(out.getvalue())
    assert [(k, t.tolist()) for k, _, t in read.documents()] == list(zip(ids, documents, strict=True))
    flat = [t for d in documents for t in d]
    assert [read.token(i) for i in range(len(flat))] == flat
    with pytest.raises(IndexError):
        read.token(len(flat))


def test_access_over_many_blocks():
    values = np.random.default_rng(3).integers(0, 70_000, 5_000).astype(np.uint32)
    out = io.BytesIO()
    write_codes(out, [1], [values])
    read = CodeFile(out.getvalue())
    assert [read.token(i) for i in range(5_000)] == values.tolist()


def wanted(library, rows):
    start, out = 0, []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op8_direct_codes"](spark, SF).orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == wanted(library, [(r.doc_id, r.text) for r in docs])


def test_edge_rows(spark, library):
    rows = [(3, "c"), (1, None), (2, ""), (2, "two"), (2, "two"), (7, "x " * 50_000), (None, "no id"), (5, " <|endoftext|> ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(0), "path": F.lit("p")})
    got = tokens_on_disk(docs, PATH, file_tokens=4).orderBy("start").collect()
    order = {None: 0}
    want = wanted(library, sorted(rows, key=lambda r: order.get(r[0], r[0])))
    assert [r.id for r in got] == [w[0] for w in want]
    assert sorted(r.n_tokens for r in got) == sorted(w[2] for w in want)
    assert sum(r.n_tokens for r in got) == got[-1].start + got[-1].n_tokens
    assert {(r.id, r.ids_crc32) for r in got} == {(w[0], w[3]) for w in want}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens_on_disk(docs, PATH).count() == 0


def test_the_first_word_of_a_text_is_remembered_within_bounds(monkeypatch):
    own = Encoder(public_tokenizers.path("byte_bpe_50k.json"), max_known=2)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["The cat sat", "The dog sat", "A cat", "One cat", f"{'x' * 90} cat", "The cat"]
    alone = []
    real = own.whole
    monkeypatch.setattr(own, "whole", lambda text: alone.append(text) or real(text))
    for text in texts:
        (found,) = own.encode([text])
        assert found.tolist() == lib.encode(text, add_special_tokens=False).ids
    assert alone.count("The") == 2 and len(own.firsts) <= 2  # forgotten once, when there were too many


def test_words_met_again_stay_when_others_are_forgotten(monkeypatch):
    own = Encoder(PATH, max_known=8)
    lib = Tokenizer.from_file(PATH)
    learnt = []
    real = own._learn
    monkeypatch.setattr(own, "_learn", lambda words: learnt.extend(words) or real(words))
    for i in range(30):
        text = f"a cat{i}" if i % 2 else f"a often cat{i}"
        assert own.encode([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
        assert len(own.known) + len(own.older) <= 8
    assert learnt.count("often") == 1


def test_texts_are_sliced_by_the_bytes_asked_for():
    texts = ["w" * 300, None, "", "é" * 200, "x" * 2000, "y"]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(6)), "text": pa.array(texts, pa.string())})
    slices = [s.to_pydict() for s in text_slices([batch], "text", 750)]
    assert [len(s["id"]) for s in slices] == [4, 1, 1]
    assert [t for s in slices for t in s["text"]] == texts
