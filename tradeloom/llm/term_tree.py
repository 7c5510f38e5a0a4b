"""Ranked lexical search over frequent-pattern trees of documents.

The items' terms are the vocabulary. A document is its counts of these terms,
the term of most documents first; documents that begin with the same terms
share a path. A task takes its documents in blocks, builds the tree of each
and answers every item by depth-first branch and bound:

* A node knows the largest count of every term and the smallest length factor
  in its subtree. The score these would give bounds every document below.
* Children are visited by falling bound. A subtree whose bound is under the
  item's score on place ``top`` is left out; this score carries over from block
  to block of a task.
* Neighbouring paths share a leaf of up to 64 documents, which is scored at once.

All scores are 64-bit integers, so the bounds are exact. The best of every task
are ranked per item in the end. Items come in groups of a bounded size, one
pass over the documents each, so there may be any number of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import SLICE_BYTES, stage, text_slices

TOP = 20
LEAF = 64
GROUP_TERMS = 1 << 16  # different terms of a group of items, at least those of one item
TREE_CELLS = 1 << 23  # nodes times terms of a tree
MOST_DOCUMENTS = 1 << 16
# Terms are runs of ASCII letters and digits and all other characters; A-Z are lower-cased.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split()


def _term_blocks(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded number of characters at a time."""
    rest = b""
    for at in range(0, len(text), SLICE_BYTES):
        block = rest + text[at : at + SLICE_BYTES].encode("utf-8", "replace").translate(_FOLD)
        found = block.split()
        rest = found.pop() if found and block[-1] != 32 and at + SLICE_BYTES < len(text) else b""
        yield found


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Tree:
    """Documents sorted by their paths, in leaves, under nodes with bounds.

    ``paths`` are the sorted term ranks of each document, ``counts`` theirs,
    ``factors`` the length factors.
    """

    def __init__(self, paths: list[np.ndarray], counts: list[np.ndarray], factors: np.ndarray, size: int) -> None:
        keys = [p.astype(">u4").tobytes() for p in paths]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        sorted_paths = [paths[i] for i in self.order]
        lengths = np.array([len(p) for p in sorted_paths], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.terms = np.concatenate(sorted_paths).astype(np.int64)
        tf = np.concatenate([counts[i] for i in self.order]).astype(np.int64)
        self.factors = factors[self.order].astype(np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        self.gains = _gain(tf, self.factors[owner])
        shared = np.zeros(len(keys), np.int64)
        for i in range(1, len(keys)):
            shared[i] = _shared(sorted_paths[i - 1], sorted_paths[i])
        self.children: list[list[int]] = []
        self.leaves: list[tuple[int, int] | None] = []
        self.root = self._grow(0, len(keys), shared)
        self._summarise(tf, owner, size)

    def _node(self, leaf: tuple[int, int] | None) -> int:
        self.children.append([])
        self.leaves.append(leaf)
        return len(self.leaves) - 1

    def _grow(self, lo: int, hi: int, shared: np.ndarray) -> int:
        """The node of documents lo to hi, which begin alike; parents come before children."""
        root = self._node(None)
        waiting = [(root, lo, hi)]
        while waiting:
            node, lo, hi = waiting.pop()
            if hi - lo <= LEAF:
                self.leaves[node] = (lo, hi)
                continue
            inner = shared[lo + 1 : hi]
            cuts = np.flatnonzero(inner == inner.min()) + lo + 1
            ends = [lo, *cuts.tolist(), hi]
            first = 0
            for i in range(1, len(ends)):
                # small neighbours share a leaf, a large subtree stands alone
                if i + 1 < len(ends) and ends[i + 1] - ends[first] <= LEAF:
                    continue
                child = self._node(None)
                self.children[node].append(child)
                waiting.append((child, ends[first], ends[i]))
                first = i
        return root

    def _summarise(self, tf: np.ndarray, owner: np.ndarray, size: int) -> None:
        nodes = len(self.leaves)
        leaf_of = np.zeros(len(self.factors), np.int64)
        self.most = np.zeros((nodes, size), np.int32)
        self.least = np.full(nodes, np.iinfo(np.int64).max)
        for node, leaf in enumerate(self.leaves):
            if leaf:
                leaf_of[leaf[0] : leaf[1]] = node
                self.least[node] = self.factors[leaf[0] : leaf[1]].min()
        np.maximum.at(self.most.ravel(), leaf_of[owner] * size + self.terms, np.minimum(tf, 2**31 - 1).astype(np.int32))
        for node in range(nodes - 1, -1, -1):
            if self.children[node]:
                self.most[node] = self.most[self.children[node]].max(axis=0)
                self.least[node] = self.least[self.children[node]].min()

    def bounds(self, item_terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node a score that no document below it exceeds."""
        return (_gain(self.most[:, item_terms].astype(np.int64), self.least[:, None]) * weights).sum(axis=1)

    def search(self, item_terms: np.ndarray, weights: np.ndarray, full: np.ndarray, best: Best) -> int:
        """Offer to ``best`` every document that can enter; the leaves scored."""
        bounds = self.bounds(item_terms, weights)
        full[item_terms] = weights
        waiting, scored = [self.root], 0
        while waiting:
            node = waiting.pop()
            if bounds[node] < best.least:
                continue
            leaf = self.leaves[node]
            if leaf is None:
                waiting += sorted(self.children[node], key=bounds.__getitem__)  # the last is visited first
                continue
            scored += 1
            lo, hi = leaf
            a, b = self.starts[lo], self.starts[hi]
            scores = np.add.reduceat(full[self.terms[a:b]] * self.gains[a:b], self.starts[lo:hi] - a)
            for at in np.flatnonzero(scores >= best.least).tolist():
                best.offer(int(scores[at]), int(self.order[lo + at]))
            if len(best.found) > best.top:
                best.settle()
        full[item_terms] = 0
        return scored


def _gain(tf: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * factor)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


class Best:
    """The ``top`` best documents of one item so far, equal scores by id, NULL last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.found: list[tuple[int, bool, int]] = []
        self.least = 1
        self.ids: list[int | None] = []

    def offer(self, score: int, at: int) -> None:
        doc = self.ids[at]
        self.found.append((-score, doc is None, doc or 0))

    def settle(self) -> None:
        self.found.sort()
        del self.found[self.top :]
        if len(self.found) == self.top:
            self.least = max(1, -self.found[-1][0])


def _vectors(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(id, n, terms, counts)``: the number of all terms, and the counts of those in the vocabulary."""
    known = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        for batch in text_slices(batches, "text"):
            sizes, found, counts = [], [], []
            for text in batch.column("text").to_pylist():
                seen: Counter = Counter()
                size = 0
                for block in _term_blocks(text or ""):
                    size += len(block)
                    seen.update(map(place.get, block))
                seen.pop(None, None)
                sizes.append(size)
                found.append(list(seen))
                counts.append(list(seen.values()))
            columns = [
                batch.column("id"),
                pa.array(sizes, pa.int64()),
                pa.array(found, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"])

    return rows.mapInArrow(run, "id long, n long, terms array<int>, counts array<long>")


def _searched(vectors: DataFrame, shared, top: int) -> DataFrame:
    """``(item, id, score)``: the best documents of every task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, total, rank, weights, items = shared.value
        size = len(weights)
        most = max(LEAF, min(MOST_DOCUMENTS, TREE_CELLS // max(size, 1) * LEAF // 4))
        best = [Best(top) for _ in items]
        full = np.zeros(size, np.int64)
        asked = []
        for item in items:
            places, times = np.unique(rank[item], return_counts=True)
            asked.append((places, weights[places] * times))

        def flush(ids, sizes, paths, counts) -> None:
            factors = 75 + (25 * np.array(sizes, object) * documents // total).astype(np.int64)
            tree = Tree(paths, counts, factors, size)
            for (places, worth), found in zip(asked, best, strict=True):
                found.ids = ids
                tree.search(places, worth, full, found)
                found.settle()

        held: tuple[list, list, list, list] = ([], [], [], [])
        for batch in batches:
            ids, sizes = batch.column("id").to_pylist(), batch.column("n").to_pylist()
            ends = batch.column("terms").value_lengths().to_numpy().cumsum()
            flat = rank[batch.column("terms").flatten().to_numpy()]
            numbers = batch.column("counts").flatten().to_numpy()
            start = 0
            for doc, n, end in zip(ids, sizes, ends.tolist(), strict=True):
                order = np.argsort(flat[start:end])
                for into, value in zip(held, (doc, n, flat[start:end][order], numbers[start:end][order]), strict=True):
                    into.append(value)
                start = end
                if len(held[0]) >= most:
                    flush(*held)
                    held = ([], [], [], [])
        if held[0]:
            flush(*held)
        out = [(at, None if none else doc, -score) for at, b in enumerate(best) for score, none, doc in b.found]
        if out:
            kinds = [pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "id", "score"])

    return vectors.where(F.size("terms") > 0).mapInArrow(run, "item int, id long, score long")


def _groups(items: DataFrame, most: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with terms, in groups of a bounded number of different terms."""
    group: list[tuple[int | None, list[bytes]]] = []
    seen: set[bytes] = set()
    for row in items.toLocalIterator():
        words = list(chain.from_iterable(_term_blocks(row["text"])))
        if group and len(seen | set(words)) > most:
            yield group
            group, seen = [], set()
        if words:
            group.append((row["id"], words))
            seen |= set(words)
    if group:
        yield group


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    group_terms: int = GROUP_TERMS,
) -> DataFrame:
    """``(item_id, rank, id, score)``: the ``top`` best documents of every item.

    A document's score is the sum over the item's terms, repeats included, of
    the term's weight times its gain, which grows with the term's count and
    falls with the document's length. Documents with score 0 are left out.
    Equal scores are ranked by id, NULL last. NULL texts have no terms.
    Repeated document rows are ranked each; items of equal id and text are
    asked once, items of equal id and different texts are ranked each. Texts
    are read in blocks, whatever their length. Empty tables give no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    asked = items.select(items[item_id_col].cast("long").alias("id"), items[item_text_col].cast("string").alias("text"))
    asked = stage(asked.where("text is not null").distinct(), "items")
    out = None
    for group in _groups(asked.orderBy("id", "text"), group_terms):
        vocabulary = {w: i for i, w in enumerate(sorted(set().union(*(words for _, words in group))))}
        vectors = stage(_vectors(rows, vocabulary), "vectors")
        worded = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        documents, total = worded[0], worded[1] or 0
        holding = np.zeros(len(vocabulary), np.int64)
        counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
        counted = counted.toArrow()  # one row per term of the group at most
        holding[counted["term"].to_numpy()] = counted["n"].to_numpy()
        rank = np.empty(len(vocabulary), np.int64)
        by_frequency = np.argsort(-holding, kind="stable")
        rank[by_frequency] = np.arange(len(vocabulary))
        weights = np.array([weight(documents, int(holding[t])) for t in by_frequency], np.int64)
        places = [np.array([vocabulary[w] for w in words]) for _, words in group]
        shared = spark.sparkContext.broadcast((documents, total, rank, weights, places))
        found = stage(_searched(vectors, shared, top), "found")
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, g[0]) for i, g in enumerate(group)], "item int, item_id long")
        named = ranked.join(F.broadcast(names), "item")  # one row per item of the group
        named = named.select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")
        out = named if out is None else out.unionByName(named)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, id long, score long")
