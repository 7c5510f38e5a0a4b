"""SimHash and components beside brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.queries import QUERIES
from tradeloom.llm.simhash_pivots import near_duplicates, one_per_group, simhash

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(items):
    """items: (id, fp); smallest id reachable over links of at most two bits."""
    parent = {fp: fp for _, fp in items}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = sorted(parent)
    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                parent[root(a)] = root(b)
    lowest = {}
    for key, fp in items:
        if key is not None:
            lowest[root(fp)] = min(key, lowest.get(root(fp), key))
    return [lowest.get(root(fp)) for _, fp in items]


def unsigned(fp):
    return fp % (1 << 64)


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op10_simhash_pivots"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    want = brute_components(items)
    assert len(got) == len(docs)
    for (key, fp), component in zip(items, want, strict=True):
        assert (got[key].fingerprint, got[key].component_id) == (f"{fp:016x}", component)
    assert len(set(want)) < len(want)


def test_long_text_is_read_in_blocks():
    rng = np.random.default_rng(1)
    text = " ".join(rng.choice(["the", "Of", "ééé", "x\n"], 400_000))
    assert simhash(text) == brute_fingerprint(text)


def planted(fp_rows):
    """Texts cannot be made to order, so links are tested on given fingerprints."""
    return [(i, fp) for i, fp in enumerate(fp_rows)]


@pytest.mark.parametrize("max_file", [64, 2])
def test_links_lose_nothing(spark, max_file):
    from tradeloom.llm.simhash_pivots import links, signed

    rng = np.random.default_rng(7)
    centres = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    prints = set(centres)
    for c in centres:
        for _ in range(60):  # chains and balls around each centre
            x = c
            for _ in range(rng.integers(1, 5)):
                x ^= 1 << int(rng.integers(0, 64))
            prints.add(x)
    items = [(fp, fp) for fp in sorted(prints)]
    frame = spark.createDataFrame([(signed(fp),) for fp in sorted(prints)], "fp long")
    found = components(links(frame, max_file)).collect()
    label = {unsigned(r.node): unsigned(r.label) for r in found}
    groups, want = {}, {}
    for fp, root in zip(sorted(prints), brute_components(items), strict=True):
        want.setdefault(root, set()).add(fp)
        groups.setdefault(label.get(fp, fp), set()).add(fp)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_edge_rows(spark):
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n", None, None, None),
        (4, "One two three four", "en", "a", 1), (4, "One two three four", "en", "a", 1),
        (5, "one TWO three four", "en", "a", 1), (None, "one two three four", "en", "a", 1),
        (None, "only here", "en", "a", 1), (9, "Ébc d", "en", "a", 1), (8, "ébc d", "en", "a", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit("x"), "fp": F.lit(1), "key": F.lit(2)})
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {(r.id, r.component_id) for r in got}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, 4), (None, None), (9, 9), (8, 8)} == by
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 8, 9]
    assert kept.where("doc_id is null").count() == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert near_duplicates(docs).count() == 0 and one_per_group(docs).count() == 0


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(900, 901), (5, 5), (None, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}
