"""Find benchmark passages in documents by the q-gram lemma.

A passage of ``m`` characters that occurs in a text with at most ``k`` edits
shares at least ``m + 1 - q * (k + 1)`` of its q-grams with that text, and the
shared ones lie on neighbouring diagonals (text position minus passage
position), at most ``k`` away from where the occurrence starts. Per passage,
hits are counted in bands of ``4k + 2`` diagonals that overlap by half, so
that some band holds all of an occurrence; within a band only hits inside a
stretch as long as an occurrence count together. Regions that reach the bound
are verified by an alignment limited to the band's diagonals.

Texts are compared in lower case with white space runs as one space. The edit
budget is a tenth of the passage's length by default, less where so many edits
would leave no q-gram.

An item of more than ``PASSAGE_CHARS`` characters is cut into passages of equal
length, and again half a passage further on. One of the former has at most a
tenth of its characters edited wherever the item as a whole has, so cutting
loses nothing, and a quote of one and a half passages in a row is found also
where the rest of the item is missing.

Passages are looked for in chunks of ``CHUNK_CHARS`` characters, the most that
a task holds an index of: one pass over the texts per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import id_and_text, release_memory, stage, text_slices
from tradeloom.session import scratch_path

Q = 8
EDIT_RATE = 0.1
TABLE_BITS = 22
PASSAGE_CHARS = 160
CHUNK_CHARS = 4_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TEXT_BLOCK = 1 << 20
_GROUP_CHARS = 1 << 18
_SLOT_BITS = 18
_PAIR_BLOCK = 1 << 22
_BUCKETS = 1 << 16
_OUTSIDE = 0xFFFFFFFF  # no code point


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def qgram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of every q-gram: a polynomial in the code points modulo 2^64."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(codes) - q + 1, dtype=np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    for i in range(q):
        out *= _FACTOR
        out += wide[i : i + len(out)]
    return out


def edit_budget(length: int, rate: float = EDIT_RATE, q: int = Q) -> int:
    """Edits allowed; -1 if the passage has no q-gram at all."""
    return min(int(rate * length), length // q - 1)


def passages_of(item: str, length: int = PASSAGE_CHARS) -> list[str]:
    """The passages that stand for an item, given and returned in normal form."""
    count = -(-len(item) // length)
    if count < 2:
        return [item]
    edges = [len(item) * i // (2 * count) for i in range(2 * count + 1)]
    return [item[edges[i] : edges[i + 2]] for i in range(2 * count - 1)]


def banded_alignment(
    passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int
) -> tuple[int, int] | None:
    """Fewest edits that turn ``passage`` into some part of ``text``, and its end.

    Only cells with ``low <= text position - passage position <= high`` are
    looked at. None if more than ``most`` edits are needed.
    """
    width, never, rows = high - low + 1, most + 1, len(passage)
    # outside the text stands a character that matches nothing
    padded = np.full(rows + width, _OUTSIDE, dtype=np.uint32)
    first, last = max(low, 0), min(rows + high, len(text))
    if last > first:
        padded[first - low : last - low] = text[first:last]
    offsets = np.arange(width, dtype=np.int32)
    row = np.zeros(width, dtype=np.int32)
    for i, code in enumerate(passage.tolist()):
        new = row + (padded[i : i + width] != code)  # along the diagonal
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # a passage character without partner
        # text characters without partner: a running minimum along the row
        new -= offsets
        row = np.minimum.accumulate(new)
        row += offsets
        if i % 8 == 7 and row.min() >= never:
            return None
    at = int(row.argmin())
    return (int(row[at]), low + rows + at) if row[at] <= most else None


@dataclass(frozen=True)
class Region:
    item: int | None
    start: int  # in the normal form of the text
    end: int
    edits: int


class Passages:
    """The q-gram index of a chunk of passages, built once per Python worker."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.items = [(key, codes) for key, text in items if len(codes := codes_of(normal(text))) >= q]
        self.lengths = np.array([len(c) for _, c in self.items], dtype=np.int64)
        self.budgets = np.array([edit_budget(n, rate, q) for n in self.lengths], dtype=np.int64)
        self.bounds = self.lengths + 1 - q * (self.budgets + 1)
        hashes = [qgram_hashes(c, q) for _, c in self.items]
        sizes = np.array([len(h) for h in hashes], dtype=np.int64)
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        number = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(joined)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.keys, self.first, self.count = np.unique(joined[order], return_index=True, return_counts=True)
        self.posting_item, self.posting_place = number[order], place[order]
        self.maybe = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.maybe[self._slot(self.keys)] = True
        self.least = int(self.bounds.min()) if len(self.items) else 0
        self.reach = int((self.lengths + self.budgets).max()) if len(self.items) else 0

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text positions whose q-gram some passage has, and its key number."""
        hashes = qgram_hashes(codes, self.q)
        at = np.flatnonzero(self.maybe[self._slot(hashes)])
        key = np.searchsorted(self.keys, hashes[at])
        key[key == len(self.keys)] = 0
        real = self.keys[key] == hashes[at]
        return at[real], key[real]

    def _crowded(self, at: np.ndarray) -> np.ndarray:
        """Hits that lie in some stretch of ``reach`` with ``least`` hits.

        A region needs that many, so the others cannot be part of one.
        """
        if len(at) < self.least:
            return np.zeros(len(at), dtype=bool)
        close = at[self.least - 1 :] - at[: len(at) - self.least + 1] < self.reach
        marks = np.zeros(len(at) + 1, dtype=np.int64)
        begins = np.flatnonzero(close)
        np.add.at(marks, begins, 1)
        np.add.at(marks, begins + self.least, -1)
        return np.cumsum(marks[:-1]) > 0

    def _pairs(self, at: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Hits with the passages that hold them, in blocks:
        ``(item, half band, text position, place in the passage)``."""
        counts = self.count[key]
        block = (np.cumsum(counts) - counts) // _PAIR_BLOCK
        for own in np.split(np.arange(len(at)), np.flatnonzero(np.diff(block)) + 1):
            held = counts[own]
            text_at = np.repeat(at[own], held)
            offset = np.arange(len(text_at)) - np.repeat(np.cumsum(held) - held, held)
            posting = np.repeat(self.first[key[own]], held) + offset
            item, place = self.posting_item[posting], self.posting_place[posting]
            yield item, np.floor_divide(text_at - place, 2 * self.budgets[item] + 1), text_at, place

    def _candidates(self, codes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``(item, band start, first, last text position)`` that reach the bound."""
        at, key = self._hits(codes)
        kept = self._crowded(at)
        at, key = at[kept], key[kept]
        if not len(at):
            return
        few = list(self._pairs(at, key)) if self.count[key].sum() <= _PAIR_BLOCK else None
        for shift in (0, 1):  # a band is two half bands; every hit counts in two bands
            # counts per slot are never below counts per cell
            slots = np.zeros(1 << _SLOT_BITS, dtype=np.int64)
            for item, half, _, _ in few or self._pairs(at, key):
                slots += np.bincount(self._cell_slot(item, half - shift), minlength=len(slots))
            held = []
            for item, half, text_at, place in few or self._pairs(at, key):
                kept = slots[self._cell_slot(item, half - shift)] >= self.bounds[item]
                held.append((item[kept], half[kept] - shift, text_at[kept], place[kept]))
            yield from self._dense(*map(np.concatenate, zip(*held, strict=True)))

    @staticmethod
    def _cell_slot(item: np.ndarray, band: np.ndarray) -> np.ndarray:
        mixed = item.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + band.astype(np.uint64)
        return (mixed * _FACTOR >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _dense(
        self, item: np.ndarray, band: np.ndarray, text_at: np.ndarray, place: np.ndarray
    ) -> Iterator[tuple[int, int, int, int]]:
        if not len(item):
            return
        low = int(band.min())
        cell = item * (int(band.max()) - low + 1) + (band - low)
        order = np.argsort(cell, kind="stable")  # text positions stay ascending
        cell, item, band, text_at, place = cell[order], item[order], band[order], text_at[order], place[order]
        edge = np.flatnonzero(np.diff(cell)) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(cell)]])
        enough = ends - starts >= self.bounds[item[starts]]
        for lo, hi in zip(starts[enough].tolist(), ends[enough].tolist(), strict=True):
            number = int(item[lo])
            for first, last in self._regions(number, text_at[lo:hi], place[lo:hi]):
                yield number, int(band[lo]), first, last

    def _regions(self, number: int, text_at: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int]]:
        """First and last text position of the stretches of a band that meet the bound."""
        need, budget = int(self.bounds[number]), int(self.budgets[number])
        stretch = int(self.lengths[number]) + budget - self.q + 1
        places = np.unique(text_at)
        close = np.flatnonzero(places[need - 1 :] - places[: max(len(places) - need + 1, 0)] < stretch)
        if not len(close):
            return
        for run in np.split(close, np.flatnonzero(np.diff(close) > need) + 1):
            first, last = int(places[run[0]]), int(places[run[-1] + need - 1])
            own = (text_at >= first) & (text_at <= last)
            if len(np.unique(place[own])) < need:
                continue
            diagonal = np.sort(text_at[own] - place[own])
            # an occurrence has its hits within the budget on both sides of one diagonal
            if (diagonal[need - 1 :] - diagonal[: len(diagonal) - need + 1] <= 2 * budget).any():
                yield first, last

    def _find(self, codes: np.ndarray) -> list[Region]:
        spans: list[Region] = []
        step = max(_TEXT_BLOCK, 2 * self.reach)
        for begin in range(0, max(len(codes), 1), step):
            # blocks overlap by a whole occurrence
            block = codes[begin : begin + step + self.reach]
            done: dict[int, list[Region]] = {}
            for number, band, first, last in self._candidates(block):
                # the same hits in the overlapping band say nothing new
                if any(r.start <= first and last < r.end for r in done.get(number, ())):
                    continue
                region = self._verified(block, number, band, first, last)
                if region:
                    done.setdefault(number, []).append(region)
                    key, _ = self.items[number]
                    spans.append(Region(key, begin + region.start, begin + region.end, region.edits))
        return spans

    def _verified(self, codes: np.ndarray, number: int, band: int, first: int, last: int) -> Region | None:
        _, passage = self.items[number]
        budget, half = int(self.budgets[number]), 2 * int(self.budgets[number]) + 1
        low, high = band * half, band * half + 2 * half - 1
        start = max(0, low, first - len(passage) - budget)
        end = min(len(codes), high + len(passage) + budget, last + len(passage) + self.q + budget)
        if end <= start:
            return None
        exact = codes[start:end].tobytes().find(passage.tobytes())
        if exact >= 0 and exact % 4 == 0:
            start += exact // 4
            return Region(number, start, start + len(passage), 0)
        found = banded_alignment(passage, codes[start:end], low - start, high - start, budget)
        if found is None:
            return None
        edits, stop = found[0], start + found[1]
        return Region(number, stop - len(passage) - edits, stop, edits)

    def find_all(self, texts: list[str | None]) -> list[list[Region]]:
        """Regions of each text that hold a passage within its edit budget.

        Texts are looked at together, with so many characters that match
        nothing between them that no passage can reach from one to the next.
        Overlapping regions of one passage are one region.
        """
        out: list[list[Region]] = [[] for _ in texts]
        if not self.items:
            return out
        gap = np.full(int(self.budgets.max()) + self.q, _OUTSIDE, dtype="<u4").tobytes()
        group: list[int] = []
        parts: list[bytes] = []
        size = 0
        for i, text in enumerate(texts):
            parts += [normal(text or "").encode("utf-32-le", "surrogatepass"), gap]
            group.append(i)
            size += len(parts[-2])
            if size >= 4 * _GROUP_CHARS or i == len(texts) - 1:
                self._find_group(group, parts, out)
                group, parts, size = [], [], 0
        return out

    def _find_group(self, group: list[int], parts: list[bytes], out: list[list[Region]]) -> None:
        sizes = np.array([len(p) // 4 for p in parts], dtype=np.int64)
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[::2]
        for r in self._find(np.frombuffer(b"".join(parts), dtype="<u4")):
            # the alignment may begin or end a few characters inside the gap
            which = int(np.searchsorted(starts, r.end - 1, "right")) - 1
            own, size = int(starts[which]), int(sizes[2 * which])
            out[group[which]].append(Region(r.item, max(r.start - own, 0), min(r.end - own, size), r.edits))
        for i in group:
            out[i] = _merged(out[i])

    def find(self, text: str | None) -> list[Region]:
        return self.find_all([text])[0]


def _merged(regions: list[Region]) -> list[Region]:
    out: list[Region] = []
    for r in sorted(regions, key=lambda r: (r.item is None, r.item or 0, r.start)):
        if out and out[-1].item == r.item and r.start < out[-1].end:
            last = out.pop()
            r = Region(r.item, last.start, max(last.end, r.end), min(last.edits, r.edits))
        out.append(r)
    return out


def benchmark_passages(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", q: int = Q
) -> DataFrame:
    """``(id, text, bucket)`` of the different passages of all items with ``q`` characters."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = passages_of(item) if len(item := normal(text)) >= q else []
                columns = [pa.array([key] * len(parts), pa.int64()), pa.array(parts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text"])

    rows = id_and_text(benchmark, id_col, text_col).mapInArrow(cut, "id long, text string").distinct()
    return rows.withColumn("bucket", F.pmod(F.xxhash64("id", "text"), F.lit(_BUCKETS)))


def _chunks(benchmark: DataFrame, q: int) -> Iterator[list[tuple[int | None, str]]]:
    """The passages in lists of at most ``CHUNK_CHARS`` characters, at least one list.

    A list is what one pass broadcasts. Passages are short and different, so a
    bucket holds an even part of them: one alone is longer than a list only
    beyond 65,536 lists.
    """
    passages = stage(benchmark_passages(benchmark, q=q), "passages")
    sizes = passages.groupBy("bucket").agg(F.sum(F.length("text")).alias("n")).orderBy("bucket").collect()
    ends, total = [], 0
    for row in sizes:  # at most one row per bucket
        if total and total + row["n"] > CHUNK_CHARS:
            ends.append(row["bucket"])
            total = 0
        total += row["n"]
    for low, high in zip([0, *ends], [*ends, _BUCKETS], strict=True):
        own = passages.where((F.col("bucket") >= low) & (F.col("bucket") < high))
        yield [(r["id"], r["text"]) for r in own.orderBy("id", "text").collect()]


_INDEXES: dict[tuple, Passages] = {}


def _index(items: list[tuple[int | None, str]], q: int, rate: float) -> Passages:
    key = (hash(tuple(items)), len(items), q, rate)
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Passages(items, q, rate)
    return _INDEXES[key]


_REGIONS = "regions array<struct<item_id:long,start:long,end:long,edits:int>>"
_REGION_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
)


def _region_column(found: list[list[Region]]) -> pa.Array:
    rows = [[{"item_id": r.item, "start": r.start, "end": r.end, "edits": r.edits} for r in g] for g in found]
    return pa.array(rows, _REGION_TYPE)


def _search(rows: DataFrame, items: list[tuple[int | None, str]], q: int, rate: float) -> DataFrame:
    """``rows`` with the regions of the given passages in place of ``text``, the last column."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    keys = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared.value, q, rate)
        for batch in text_slices(batches, "text"):
            found = _region_column(index.find_all(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*map(batch.column, keys), found], [*keys, "regions"])

    return rows.mapInArrow(run, ", ".join([*(f"{k} long" for k in keys), _REGIONS]))


def _join_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            _merged([Region(r["item_id"], r["start"], r["end"], r["edits"]) for r in regions or ()])
            for regions in batch.column("regions").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column("id"), _region_column(found)], ["id", "regions"])


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    q: int = Q,
    rate: float = EDIT_RATE,
) -> DataFrame:
    """``(id, regions)`` per row of ``docs``; no regions for a clean text.

    ``start`` and ``end`` bound the region in the lower-cased text with single
    spaces. Overlapping regions of one item are one region, with the edits of
    the passage that has fewest. A NULL or empty text has none. Items that are
    NULL or shorter than ``q`` characters are not looked for; an item with a
    NULL id is reported as NULL. Repeated rows are judged alike. Only the id
    and text columns are read; empty tables give no rows, an empty benchmark
    no regions.
    """
    rows = id_and_text(docs, id_col, text_col)
    chunks = _chunks(benchmark, q)
    items, more = next(chunks), next(chunks, None)
    if more is None:
        return _search(rows, items, q, rate)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    folder = scratch_path(docs.sparkSession, "regions")
    for number, chunk in enumerate(chain([items, more], chunks)):
        found = _search(rows.select("row", "text"), chunk, q, rate).where("size(regions) > 0")
        stage(found, "regions", f"{folder}/chunk={number}")
    by_row = docs.sparkSession.read.parquet(folder).groupBy("row")
    found = by_row.agg(F.flatten(F.collect_list("regions")).alias("regions"))
    whole = rows.select("row", "id").join(found, "row", "left").select("id", "regions")
    return whole.mapInArrow(_join_regions, f"id long, {_REGIONS}")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", q: int = Q, rate: float = EDIT_RATE
) -> DataFrame:
    """The rows of ``docs`` in whose text no passage is found; columns stay."""
    chunks = _chunks(benchmark, q)
    items = next(chunks)
    for more in chunks:
        docs = stage(_without(docs, items, text_col, q, rate), "unseen")
        items = more
    return _without(docs, items, text_col, q, rate)


def _without(
    docs: DataFrame, items: list[tuple[int | None, str]], text_col: str, q: int, rate: float
) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared.value, q, rate)
        for batch in text_slices(batches, at):
            found = index.find_all(batch.column(at).to_pylist())
            yield batch.filter(pa.array([not regions for regions in found], pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
