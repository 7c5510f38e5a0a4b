"""Log-bilinear language model, trained with noise-contrastive estimation.

The model predicts the next symbol from the two before it: their vectors, each
through the matrix of its place, add up to a context vector, whose product with
a symbol's vector plus the symbol's bias is the score. Symbols are the most
frequent words, the end of a text, and classes of all other words by their last
bytes; a word of a class has the share of the class's smoothed counts.

* Counting: words of all training texts, counted in tasks, then summed by word.
* Training: every task walks through its texts with minibatches that share
  their noise symbols, so scores and gradients are matrix products. The models
  of the tasks are averaged by their tokens, level by level. A first round over
  a sixteenth of the texts gives all tasks of the second, over all texts, one
  start.
* Scoring: as scores add up over the two places, the normaliser of all pairs of
  symbols is one product of two matrices. Probabilities are exact and sum to one.

Counts of frequent words go to every task, a bounded number; the rarer words
of a text are joined with their counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import id_and_text, stage, text_slices, word_blocks

HEAD = 1 << 18  # words whose counts every task knows
WORDS = 2048  # symbols that are one word, the end included
CLASSES = 256
SUFFIX = 3
WIDTH = 24
BATCH = 2048
NOISE = 64
RATE = 0.05
FEW_TOKENS = 1 << 20  # a task with fewer goes through them several times
MOST_EPOCHS = 5
FIRST_SHARE = 16
PSEUDO = 0.1  # added to every count
SEED = 11
_MOST_COUNTED = 1 << 18
_MOST_TOKENS = 1 << 19
_FAN = 64
END = 0
END_WORD = b""  # no word is empty


def is_held_out(doc_id: Column) -> Column:
    """One id in ten by its checksum; a NULL id has none and is trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _lowered(text: str) -> bytes:
    """A-Z lower-cased, everything else as it is."""
    return text.encode("utf-8", "replace").lower()


def _class_of(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % CLASSES


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts; the empty word is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def table() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in text_slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                for words in word_blocks(_lowered(text)):
                    seen.update(words)
                seen[END_WORD] += 1
            if len(seen) > _MOST_COUNTED:
                yield table()
                seen.clear()
        if seen:
            yield table()

    counted = rows.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task knows of the training texts.

    ``place`` numbers the frequent words by falling count, those of one level of
    counts all or none; per number ``symbol``
    and ``counts``; ``mass`` is the smoothed count of every class.
    """

    tokens: int
    types: int
    place: dict[bytes, int]
    symbol: np.ndarray
    counts: np.ndarray
    mass: np.ndarray
    noise: np.ndarray  # probability of every symbol

    @property
    def size(self) -> int:
        return len(self.noise)


def _least_count(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, up to a few percent of the count."""
    level = F.floor(F.log2("n") * 16).alias("level")
    levels = counts.groupBy(level).agg(F.count("*").alias("words"), F.min("n").alias("least")).toArrow()
    least, words = 1 << 62, 0
    for row in sorted(levels.to_pylist(), key=lambda r: -r["level"]):  # a row per level
        words += row["words"]
        if words > most:
            break
        least = row["least"]
    return least


def vocabulary(counts: DataFrame, head: int = HEAD, words: int = WORDS) -> Vocabulary:
    tokens, types = counts.agg(F.sum("n"), F.count("*")).first()
    suffix = F.substring("word", -SUFFIX, SUFFIX)
    classes = counts.where(F.length("word") > 0).groupBy((F.crc32(suffix) % CLASSES).alias("class"))
    per_class = classes.agg(F.sum("n").alias("n"), F.count("*").alias("types")).toArrow()  # a row per class
    totals = np.zeros((2, CLASSES))
    totals[:, per_class["class"].to_numpy()] = per_class["n"].to_numpy(), per_class["types"].to_numpy()
    found = counts.where(F.col("n") >= _least_count(counts, head)).toArrow()  # head words at most
    found = sorted(zip(found["n"].to_pylist(), found["word"].to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
    listed, numbers = [w for _, w in found], np.array([n for n, _ in found], np.int64)
    if END_WORD not in listed:  # the end has a number in any case
        ends = counts.where(F.length("word") == 0).first()
        listed, numbers = [*listed, END_WORD], np.append(numbers, ends["n"] if ends else 0)
    place = {w: i for i, w in enumerate(listed)}
    own = [w for w in listed[:words] if w != END_WORD][: words - 1]
    symbols = {END_WORD: END} | {w: i for i, w in enumerate(own, 1)}
    for word in own:
        n = numbers[place[word]]
        totals[:, _class_of(word)] -= n, 1
    symbol = np.array([symbols.get(w, -1) for w in listed], np.int32)
    rest = np.flatnonzero(symbol < 0)
    symbol[rest] = [len(symbols) + _class_of(listed[i]) for i in rest]
    amounts = np.concatenate([[numbers[place[END_WORD]]], [numbers[place[w]] for w in own], totals[0]]) + 1.0
    mass = totals[0] + PSEUDO * totals[1] + PSEUDO  # one word that was never seen has a share
    return Vocabulary(tokens or 0, types, place, symbol, numbers, mass, amounts / amounts.sum())


class Block(NamedTuple):
    """Tokens in a row: the text's place in its batch, the number (-1: not frequent),
    the symbol and the symbols before it; where rare words are, and which."""

    owner: np.ndarray
    number: np.ndarray
    symbol: np.ndarray
    one: np.ndarray
    two: np.ndarray
    unknown: np.ndarray
    rare: list[bytes]


class Reader:
    """Numbers and symbols of the words of many texts, a bounded number at a time."""

    def __init__(self, known: Vocabulary) -> None:
        self.known = known
        self.first_class = known.size - CLASSES

    def blocks(self, texts: list[str]) -> Iterator[Block]:
        words: list[bytes] = []
        owners: list[tuple[int, int]] = []
        before = (END, END)
        for at, text in enumerate(texts):
            for block in word_blocks(_lowered(text)):
                words += block
                owners.append((at, len(block)))
                if len(words) >= _MOST_TOKENS:
                    out = self._block(words, owners, before)
                    before = int(out.symbol[-1]), int(out.one[-1])
                    yield out
                    words, owners = [], []
            words.append(END_WORD)
            owners.append((at, 1))
        if words:
            yield self._block(words, owners, before)

    def _block(self, words: list[bytes], owners: list[tuple[int, int]], before: tuple[int, int]) -> Block:
        known = self.known
        number = np.fromiter(map(known.place.get, words, repeat(-1)), np.int32, len(words))
        owner = np.repeat([o for o, _ in owners], [n for _, n in owners])
        unknown = np.flatnonzero(number < 0)
        symbol = known.symbol[number]
        rare = [words[i] for i in unknown.tolist()]
        symbol[unknown] = [self.first_class + _class_of(w) for w in rare]
        one = np.concatenate([[before[0]], symbol[:-1]])
        two = np.concatenate([[before[1], before[0]], symbol[:-2]])[: len(symbol)]
        two[one == END] = END  # nothing comes before a text's first word
        return Block(owner, number, symbol, one, two, unknown, rare)


@dataclass
class Model:
    """Vectors of context and predicted symbols, place matrices and biases."""

    context: np.ndarray
    target: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, noise: np.ndarray) -> Model:
        rng, size = np.random.default_rng(SEED), len(noise)
        vectors = [rng.normal(0, 0.3, (size, WIDTH)).astype(np.float32) for _ in range(2)]
        eye = np.eye(WIDTH, dtype=np.float32)
        return cls(vectors[0], vectors[1] * 0.3, eye.copy(), eye * 0.5, np.log(noise).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray, size: int) -> Model:
        shapes = [(size, WIDTH), (size, WIDTH), (WIDTH, WIDTH), (WIDTH, WIDTH), (size,)]
        out, at = [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            out.append(flat[at : at + n].reshape(shape).astype(np.float32))
            at += n
        return cls(*out)

    def normalisers(self) -> np.ndarray:
        """Log of the sum over all symbols for every pair (two before, one before)."""
        near = (self.context @ self.near) @ self.target.T
        far = (self.context @ self.far) @ self.target.T + self.bias
        top_near, top_far = near.max(axis=1), far.max(axis=1)
        sums = np.exp(far - top_far[:, None]) @ np.exp(near - top_near[:, None]).T
        return np.log(np.maximum(sums, 1e-37)) + top_far[:, None] + top_near[None, :]


class Trainer:
    """Noise-contrastive steps with adaptive rates; the noise of a batch is shared."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int) -> None:
        self.model, self.rng = model, np.random.default_rng(seed)
        self.cumulative = np.cumsum(noise)
        self.offset = (np.log(noise) + np.log(NOISE)).astype(np.float32)
        self.seen = [np.full(p.shape, 1e-3, np.float32) for p in model.parts()]

    def step(self, symbol: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m = self.model
        at_one, at_two = m.context[one], m.context[two]
        hidden = at_one @ m.near + at_two @ m.far
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(m.bias) - 1)
        wanted = m.target[symbol]
        good = np.einsum("ij,ij->i", hidden, wanted) + m.bias[symbol] - self.offset[symbol]
        bad = hidden @ m.target[drawn].T + (m.bias[drawn] - self.offset[drawn])
        pull = _sigmoid(-good)
        push = _sigmoid(bad)
        back = pull[:, None] * wanted - push @ m.target[drawn]
        scale = np.float32(1 / len(symbol) ** 0.5)
        target = _summed(symbol, pull[:, None] * hidden, len(m.bias))
        np.subtract.at(target, drawn, push.T @ hidden)
        bias = np.bincount(symbol, pull, len(m.bias)) - np.bincount(drawn, push.sum(axis=0), len(m.bias))
        context = _summed(one, back @ m.near.T, len(m.bias)) + _summed(two, back @ m.far.T, len(m.bias))
        grads = [context, target, at_one.T @ back, at_two.T @ back, bias.astype(np.float32)]
        for part, seen, grad in zip(m.parts(), self.seen, grads, strict=True):
            grad = grad * scale
            seen += grad * grad
            part += RATE * grad / np.sqrt(seen)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -30, 30)))


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values of equal rows."""
    out = np.zeros((size, values.shape[1]), np.float32)
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out[ordered[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


_MODEL = "tokens double, model binary"


def _row_of(tokens: float, flat: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([tokens], pa.float64()), pa.array([flat.astype(np.float32).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["tokens", "model"])


def _trained(rows: DataFrame, known, start: Model) -> DataFrame:
    """``(tokens, model)`` per task."""
    given = rows.sparkSession.sparkContext.broadcast(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, noise = Reader(known.value), known.value.noise
        model = Model(*[p.copy() for p in given.value.parts()])
        trainer = Trainer(model, noise, SEED)
        tokens, few = 0, []

        def learn(columns: list[np.ndarray]) -> None:
            for at in range(0, len(columns[0]), BATCH):
                trainer.step(*(c[at : at + BATCH] for c in columns))

        for batch in text_slices(batches, "text"):
            blocks = [(b.symbol, b.one, b.two) for b in reader.blocks(batch.column("text").to_pylist())]
            if blocks:
                columns = [np.concatenate(c) for c in zip(*blocks, strict=True)]
                learn(columns)
                tokens += len(columns[0])
                few = [*few, columns] if tokens < FEW_TOKENS else []
        if few:
            columns = [np.concatenate(c) for c in zip(*few, strict=True)]
            for _ in range(min(MOST_EPOCHS, FEW_TOKENS // tokens) - 1):
                order = trainer.rng.permutation(tokens)
                learn([c[order] for c in columns])
        if tokens:
            yield _row_of(float(tokens), model.flat())

    return rows.select("text").mapInArrow(run, _MODEL)


def _mean(rows: Iterator[tuple[float, bytes]]) -> tuple[float, np.ndarray | None]:
    """Tokens of all models and their mean weighted by tokens."""
    total, tokens = None, 0.0
    for weight, model in rows:
        flat = np.frombuffer(model, np.float32) * np.float64(weight)
        total = flat if total is None else total + flat
        tokens += weight
    return tokens, None if total is None else total / tokens


def _averaged(models: DataFrame, size: int, otherwise: Model) -> Model:
    """The mean of all models, taken level by level until few are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ((b.column("tokens")[i].as_py(), b.column("model")[i].as_py()) for b in batches for i in range(b.num_rows))
        tokens, flat = _mean(columns)
        if flat is not None:
            yield _row_of(tokens, flat)

    models = stage(models, "models")
    while (left := models.count()) > _FAN:
        models = stage(models.repartition(-(-left // _FAN)).mapInArrow(run, _MODEL), "models")
    _, flat = _mean((row["tokens"], row["model"]) for row in models.toLocalIterator())  # few models
    return otherwise if flat is None else Model.of(flat, size)


def train(rows: DataFrame, known: Vocabulary) -> Model:
    """Fit on all ``rows``; without any the start model is returned."""
    shared = rows.sparkSession.sparkContext.broadcast(known)
    model = Model.start(known.noise)
    for part in (rows.where(F.xxhash64("id", "text") % FIRST_SHARE == 0), rows):
        model = _averaged(_trained(part, shared, model), known.size, model)
    return model


def _scored(rows: DataFrame, known: Vocabulary, model: Model) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, base, model, rare)``: log10 sums without the
    counts of the rare words, which are listed."""
    near, far = model.context @ model.near, model.context @ model.far
    shared = rows.sparkSession.sparkContext.broadcast(
        (known, near, far, model.target, model.bias, model.normalisers())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, near, far, target, bias, normal = shared.value
        reader = Reader(known)
        smooth = np.log10(known.counts + PSEUDO)
        was_seen = known.counts > 0
        in_class = np.arange(known.size) >= known.size - CLASSES
        share = np.concatenate([np.zeros(known.size - CLASSES), np.log10(known.mass)])
        whole = np.log10(known.tokens + PSEUDO * (known.types + 1))
        for batch in text_slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            sums = np.zeros((4, len(texts)))
            rare_words: list[bytes] = []
            rare_owner: list[np.ndarray] = []
            for block in reader.blocks(texts):
                frequent = block.number >= 0
                counted = np.where(frequent, smooth[block.number], 0.0)
                chance = np.empty(len(counted))
                for at in range(0, len(chance), 1 << 16):
                    s, a, b = (c[at : at + (1 << 16)] for c in (block.symbol, block.one, block.two))
                    raw = np.einsum("ij,ij->i", near[a] + far[b], target[s]) + bias[s]
                    chance[at : at + len(s)] = (raw - normal[b, a]) / np.log(10)
                chance += np.where(in_class[block.symbol], counted - share[block.symbol], 0.0)
                per_token = (None, frequent & was_seen[block.number], counted - whole, chance)
                sums += [np.bincount(block.owner, w, len(texts)) for w in per_token]
                rare_words += block.rare
                rare_owner.append(block.owner[block.unknown])
            places = np.concatenate(rare_owner) if rare_owner else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(places, minlength=len(texts)))])
            columns = [
                batch.column("id"),
                batch.column("held_out"),
                pa.array(sums[0].astype(np.int64)),
                pa.array(sums[1].astype(np.int64)),
                pa.array(sums[2]),
                pa.array(sums[3]),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(rare_words, pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])

    return rows.select("id", "held_out", "text").mapInArrow(
        run, "id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<binary>"
    )


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, words: int = WORDS) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Learns from the rows that are not held out: a repeated row as often as it
    occurs. A NULL text is empty, and an empty text is its end alone. Texts are
    read in blocks, whatever their length. Without a training row every word
    was never seen, ``base_score`` is 0 and ``score`` that of a model before
    training. Other columns are not read. An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("held_out", is_held_out(F.col("id")))
    learned = rows.where("not held_out")
    counts = stage(word_counts(learned), "counts")
    known = vocabulary(counts, head, words)
    model = train(learned, known)
    scored = _scored(rows, known, model).withColumn("row", F.monotonically_increasing_id())
    scored = stage(scored, "scored")
    rare = scored.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    smooth = F.log10(F.coalesce("n", F.lit(0)) + F.lit(PSEUDO))
    summed = rare.groupBy("row").agg(F.sum(smooth).alias("more"), F.count("n").alias("seen"))
    found = scored.drop("rare").join(summed, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return found.select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
