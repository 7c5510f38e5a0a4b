"""The pipeline beside plain versions of its stages."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from test_near_copies import brute_kept
from test_pivotal import WORD, plain_targets
from tokenizers import Tokenizer

import corpus_pipeline
from tradeloom.llm.factor_machine import Features, train
from tradeloom.llm.qgram_filter import normal

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark):
    from tradeloom.llm.common import stage

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, apply in corpus_pipeline.STAGES:
        out.append(docs)
        docs = stage(apply(spark, docs, SF), name)
    return [*out, docs]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_filters(spark, steps):
    raw, good, distinct, unseen, mixed, _ = steps
    assert good.columns == distinct.columns == unseen.columns == mixed.columns == raw.columns
    machine, features = train(raw, spark.read.parquet(f"{SF}/labels.parquet")), Features()
    want = [r for r in raw.collect() if machine.score(*features.of(r.text, r.n_chars)) >= 0.3]
    assert rows(good) == sorted(map(tuple, want), key=str) and 0 < len(want) < raw.count()

    kept = brute_kept([(r.doc_id, r.text) for r in want])
    first = [r for r in want if r.doc_id in kept]
    assert rows(distinct) == sorted(map(tuple, first), key=str) and len(first) < len(want)

    passages = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r for r in first if not any(p in normal(r.text) for p in passages)]
    assert rows(unseen) == sorted(map(tuple, clean), key=str) and len(clean) < len(first)


def test_mix(steps):
    _, _, _, unseen, mixed, _ = steps
    docs, taken = unseen.collect(), mixed.collect()
    sizes, words, largest = {}, {}, {}
    for r in docs:
        n = len(WORD.findall(r.text))
        sizes[r.source] = sizes.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    for r in taken:
        words[r.source] = words.get(r.source, 0) + len(WORD.findall(r.text))
    for source, target in plain_targets(sizes).items():
        assert abs(words.get(source, 0) - target) <= largest[source] + 1e-6
    assert {tuple(r) for r in taken} <= {tuple(r) for r in docs}


def test_tokens(steps):
    mixed, tokens = steps[4].orderBy("doc_id").collect(), steps[5].orderBy("start").collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for r in mixed:
        ids = library.encode(r.text, add_special_tokens=False).ids + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens] == want


def test_run_is_the_stages(spark, steps):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps[5])


def test_odd_rows_pass_every_stage(spark):
    odd = [
        (None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "w " * 60_000, "en", None, 1),
        (3, "Plain words in a plain line of text.", "en", "b", 36), (3, "Another text under that number.", "en", "b", 31),
    ]
    docs = spark.createDataFrame(odd, DOCS)
    for frame in (docs, docs.where("false")):
        for _, apply in corpus_pipeline.STAGES:
            out = apply(spark, frame, SF).collect()
            assert len(out) <= 3 * len(odd) and (out or frame is not docs)
