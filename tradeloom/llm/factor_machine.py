"""Quality of texts by a factorisation machine.

A text is a sparse vector: hashed words, bins of structure statistics (shares
of letters, digits, symbols and repeated words or lines, lengths) and bins of
its recorded length as metadata. Besides a weight, every feature has a short
vector, and two features interact by the product of theirs::

    y = w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The bracket is the sum over all pairs, in time linear in the features.

The machine is fitted on at most ``max_rows`` labelled texts, those whose ids
hash lowest; every text is scored whole. The model has a fixed size and goes
to the tasks as a broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import release_memory, text_key, text_slices, word_blocks

WORD_BITS = 14
RANK = 8
MAX_ROWS = 8_000
EPOCHS = 8
LEAST_STEPS = 600  # small samples are gone through more often
BATCH = 64
RATE = 0.05
WEIGHT_DECAY = 1e-5
ACCEPT = 0.3
_KNOWN_WORDS = 300_000

# Byte classes: 0 white space, 1 lower case, 2 upper case, 3 digit, 4 sentence
# mark, 5 other ASCII symbol, 6 control, 7 part of a character beyond ASCII.
_CLASS = np.full(256, 7, dtype=np.uint8)
_CLASS[:128] = 6
_CLASS[33:127] = 5
for _chars, _kind in ((b" \t\n\r\x0b\x0c", 0), (b".,;:?'\"()-", 4)):
    _CLASS[list(_chars)] = _kind
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3

STATISTICS = (
    "white lower upper digit mark symbol control beyond shouts words word_length distinct repeats "
    "lines repeated_lines longest_word symbol_words recorded_length length_gap"
).split()
_BINS = 24
WORDS = 1 << WORD_BITS
_FIRST_SIZE = WORDS + _BINS * len(STATISTICS)
FEATURES = _FIRST_SIZE + len(STATISTICS)


def _share_bin(share: float) -> int:
    return min(int(np.log2(1 + 1000 * max(share, 0.0))), _BINS - 1)


def _size_bin(size: float) -> int:
    return min(int(np.log2(1 + max(size, 0.0))), _BINS - 1)


def statistics(data: bytes, words: list[bytes], distinct: int, recorded: int | None) -> list[int]:
    """Bins of the structure statistics and the metadata, in STATISTICS order."""
    classes = np.bincount(_CLASS[np.frombuffer(data, dtype=np.uint8)], minlength=8)
    size, count = max(len(data), 1), max(len(words), 1)
    lines = data.split(b"\n")
    length = recorded if recorded is not None else len(data)
    return [
        *(_share_bin(c / size) for c in classes.tolist()),
        _share_bin(data.count(b"!!") / count),
        _size_bin(len(words)),
        min(int(2 * (len(data) / count)), _BINS - 1),
        min(int(20 * distinct / count), _BINS - 1),
        _share_bin(sum(map(eq, words, words[1:])) / count),
        _size_bin(len(lines)),
        _share_bin(1 - len(set(lines)) / len(lines)),
        _size_bin(max(map(len, words), default=0)),
        _share_bin(sum(1 for w in words if _CLASS[w[-1]] == 5) / count),
        _size_bin(length),
        _size_bin(abs(len(data) - length)),
    ]


class Features:
    """Feature ids and values of texts; remembers the buckets of frequent words."""

    def __init__(self) -> None:
        self.buckets: dict[bytes, int] = {}

    def _bucket(self, words: set[bytes]) -> np.ndarray:
        known = self.buckets
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = zlib.crc32(word) & (WORDS - 1)
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def of(self, text: str | None, recorded: int | None) -> tuple[np.ndarray, np.ndarray]:
        data = (text or "").encode("utf-8", "replace")
        words = [w for block in word_blocks(data) for w in block]
        distinct = set(words)
        hashed = np.unique(self._bucket(distinct))
        bins = statistics(data, words, len(distinct), recorded)
        # a statistic is its bin, and a size that speaks for bins not seen in training
        place, sizes = np.arange(len(bins)), np.array(bins)
        ids = np.concatenate([hashed, WORDS + place * _BINS + sizes, _FIRST_SIZE + place])
        values = np.ones(len(ids), dtype=np.float32)
        values[: len(hashed)] = 1 / np.sqrt(max(len(hashed), 1))
        values[-len(bins) :] = sizes / (_BINS / 2)
        return ids.astype(np.int32), values


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # (FEATURES,)
    vectors: np.ndarray  # (FEATURES, RANK)

    def raw(self, ids: np.ndarray, values: np.ndarray) -> float:
        scaled = self.vectors[ids] * values[:, None]
        pairs = (scaled.sum(axis=0) ** 2).sum() - (scaled**2).sum()
        return float(self.bias + self.weights[ids] @ values + 0.5 * pairs)

    def score(self, ids: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(ids, values), -30, 30))))


def untrained(bias: float = 0.0) -> Machine:
    return Machine(bias, np.zeros(FEATURES, np.float32), np.zeros((FEATURES, RANK), np.float32))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7
) -> Machine:
    """Logistic loss, one adaptive step per batch. One class only: its share."""
    positive = float(labels.sum())
    if not len(rows) or positive in (0.0, float(len(rows))):
        share = (positive + 0.5) / (len(rows) + 1.0)
        return untrained(float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    machine = untrained(float(np.log(positive / (len(rows) - positive))))
    machine.vectors[:] = rng.normal(0, 0.05, machine.vectors.shape)
    seen_w = np.full(FEATURES, 1e-6, np.float32)
    seen_v = np.full(machine.vectors.shape, 1e-6, np.float32)
    for _ in range(max(epochs, -(-LEAST_STEPS * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            ids = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            sizes = np.array([len(rows[i][0]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(chosen)), sizes)
            scaled = machine.vectors[ids] * values[:, None]
            sums = np.add.reduceat(scaled, starts, axis=0)
            squares = np.add.reduceat(scaled**2, starts, axis=0)
            linear = np.add.reduceat(machine.weights[ids] * values, starts)
            raw = machine.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(chosen)
            own = error[owner] * values
            used, place = np.unique(ids, return_inverse=True)
            grad_w = np.bincount(place, own, len(used)) + WEIGHT_DECAY * machine.weights[used]
            pull = own[:, None] * (sums[owner] - scaled)
            grad_v = np.stack([np.bincount(place, pull[:, f], len(used)) for f in range(RANK)], axis=1)
            grad_v += WEIGHT_DECAY * machine.vectors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            machine.weights[used] -= RATE * grad_w / np.sqrt(seen_w[used])
            machine.vectors[used] -= RATE * grad_v / np.sqrt(seen_v[used])
            machine.bias -= RATE * float(error.sum())
    return machine


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: one id in five by its checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _inputs(docs: DataFrame, id_col: str, text_col: str, length_col: str | None) -> DataFrame:
    recorded = docs[length_col].cast("long") if length_col else F.lit(None).cast("long")
    return docs.select(
        docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"), recorded.alias("recorded")
    )


def _rows_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views into its memory."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        flat, ends = chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())
        out += np.split(flat, ends[:-1]) if len(ends) else []
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Machine:
    """Fit on at most ``max_rows`` labelled texts that are not held out.

    Rows with a NULL id or label teach nothing. A repeated id counts once per
    row, within the bound. Without any label every score is one half.
    """
    known = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").where(~is_held_out(F.col("id")))
    chosen = known.orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    rows = _inputs(docs, id_col, text_col, length_col).join(F.broadcast(chosen), "id")  # at most max_rows
    rows = rows.withColumn("key", text_key(F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            texts, lengths = batch.column("text").to_pylist(), batch.column("recorded").to_pylist()
            found = [features.of(t, n) for t, n in zip(texts, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("key"),
                    batch.column("label"),
                    pa.array([f[0] for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.list_(pa.float32())),
                ],
                ["id", "key", "label", "ids", "values"],
            )

    vectors = rows.mapInArrow(run, "id long, key long, label int, ids array<int>, values array<float>")
    sample = vectors.orderBy(F.xxhash64("id"), "id", "key", "label").limit(max_rows).toArrow()
    pairs = list(zip(_rows_of(sample.column("ids")), _rows_of(sample.column("values")), strict=True))
    return fit(pairs, np.array(sample.column("label").to_pylist(), dtype=np.float64))


def score(
    docs: DataFrame,
    machine: Machine,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """``(id, score)`` per row of ``docs``: how likely the text is good, 0 to 1.

    NULL and empty texts are scored by their statistics. Repeated rows get the
    same score; an empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), shared.value
        for batch in batches:
            texts, lengths = batch.column("text").to_pylist(), batch.column("recorded").to_pylist()
            scores = [model.score(*features.of(t, n)) for t, n in zip(texts, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    return _inputs(docs, id_col, text_col, length_col).mapInArrow(run, "id long, score double")


def keep_good(
    docs: DataFrame,
    machine: Machine,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    accept: float = ACCEPT,
) -> DataFrame:
    """The rows of ``docs`` with a score of ``accept`` or more; columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    text_at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), shared.value
        for batch in text_slices(batches, text_at):
            texts = batch.column(text_at).to_pylist()
            lengths = batch.column(length_at).to_pylist() if length_at is not None else [None] * len(texts)
            good = [model.score(*features.of(t, n)) >= accept for t, n in zip(texts, lengths, strict=True)]
            yield batch.filter(pa.array(good, pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
