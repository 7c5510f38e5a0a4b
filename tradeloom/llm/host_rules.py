"""Quality rules per document and a verdict per host, in SQL expressions only.

A document fails the base rules if it is short or repeats itself. Failures are
counted per host. Small hosts have unreliable rates, so rates are shrunk with a
beta prior whose parameters are fitted to the rates of all hosts by their mean
and variance; a host whose shrunken rate is above ``max_rate`` loses its other
documents as well.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage, words_of

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
MAX_RATE = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 10_000.0
SYMBOLS = "#*$%&|<>"
_SEPARATORS = " \t\n\x0b\x0c\r"
WINDOW = 3


def _without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: _without(line, _SEPARATORS) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def window_hash(*window: Column) -> Column:
    return F.xxhash64(*window)


def _same_neighbour(items: Column, part: Callable[[Column], Column]) -> Column:
    """The items of a sorted array whose ``part`` equals that of an item beside them."""

    def repeated(item: Column, at: Column) -> Column:
        return (part(item) == part(F.get(items, at - 1))) | (part(item) == part(F.get(items, at + 1)))

    return F.filter(items, repeated)


def word_statistics(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)``.

    Words in repeated windows are found by sorting. Every window becomes one
    number, its hash followed by its place; in sorted order windows of equal
    hash are neighbours. The hash has 64 bits less those of the place (15 for
    20,000 words), so these windows are then sorted by their words, where only
    equal windows are neighbours. The places of repeated windows, sorted, give
    the words covered: each window adds the words up to the next one, three at
    most.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(
        docs[id_col].cast("long").alias("id"),
        docs[host_col].cast("string").alias("host"),
        _without(text, _SEPARATORS).cast("long").alias("word_chars"),
        (F.char_length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        _repeated_lines(text).cast("long").alias("n_dup_lines"),
        words_of(text).alias("words"),
    )
    words = F.col("words")
    rows = rows.withColumn("bits", F.char_length(F.bin(F.size(words).cast("long"))))
    heads = F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))

    def numbered(word: Column, at: Column) -> Column:
        window = window_hash(word, *(F.get(words, at + i) for i in range(1, WINDOW)))
        return F.call_function("shiftleft", window, F.col("bits")).bitwiseOR(at.cast("long"))

    rows = rows.withColumn("keys", F.sort_array(F.transform(heads, numbered)))
    keys, bits = F.col("keys"), F.col("bits")

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def at_place(key: Column) -> Column:
        place = key.bitwiseAND(mask).cast("int")
        text = F.struct(*(F.get(words, place + i).alias(f"w{i}") for i in range(WINDOW)))
        return F.struct(text.alias("text"), place.alias("place"))

    alike = _same_neighbour(keys, lambda key: F.call_function("shiftright", key, bits))
    rows = rows.withColumn("alike", F.sort_array(F.transform(alike, at_place)))
    repeated = _same_neighbour(F.col("alike"), lambda window: window["text"])
    places = F.transform(repeated, lambda window: window["place"])
    rows = rows.select(
        "id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.sort_array(places).alias("places"),
    )
    reach = F.transform(
        "places", lambda p, at: F.least(F.coalesce(F.get("places", at + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
    )
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda total, n: total + n)
    return rows.withColumn("n_repeat_words", covered).drop("places")


def failed_base(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


@dataclass(frozen=True)
class BetaPrior:
    a: float
    b: float

    def rate(self, failures: Column, documents: Column) -> Column:
        return (failures + F.lit(self.a)) / (documents + F.lit(self.a + self.b))


def beta_prior(hosts: DataFrame) -> BetaPrior:
    """Prior with the mean and the variance of the hosts' failure rates.

    Hosts that all have one rate make the prior as strong as is allowed, no
    hosts an even one. One row reaches the driver.
    """
    rate = F.col("failures") / F.col("documents")
    mean, variance = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    if mean is None:
        return BetaPrior(LEAST_STRENGTH / 2, LEAST_STRENGTH / 2)
    strength = mean * (1 - mean) / variance - 1 if variance else MOST_STRENGTH
    strength = min(max(strength, LEAST_STRENGTH), MOST_STRENGTH)
    return BetaPrior(mean * strength, (1 - mean) * strength)


def host_rates(judged: DataFrame) -> DataFrame:
    """``(host, documents, failures, rate)`` with the shrunken rate."""
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failures")
    )
    hosts = stage(hosts, "hosts")
    return hosts.withColumn("rate", beta_prior(hosts).rate(F.col("failures"), F.col("documents")))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """One row per row of ``docs``: statistics, ``base_failed``, ``host_rate``, ``kept``.

    A NULL text has no words and fails. Rows without a host are judged as one
    host; NULL ids and repeated rows stay and count. Other columns are not
    read. An empty table gives no rows.
    """
    found = word_statistics(docs, id_col, text_col, host_col)
    found = found.withColumn("base_failed", failed_base(F.col("n_words"), F.col("n_repeat_words")))
    judged = stage(found, "judged")  # the texts are read once
    rates = stage(host_rates(judged).select(F.col("host").alias("of"), F.col("rate").alias("host_rate")), "rates")
    joined = judged.join(rates, judged["host"].eqNullSafe(rates["of"])).drop("of")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= F.lit(max_rate)))
