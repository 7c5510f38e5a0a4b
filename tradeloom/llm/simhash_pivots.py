"""Near-duplicate documents by SimHash, found through pivot distance tables.

A fixed set of reference fingerprints (the pivots) stands for the whole space.
Two fingerprints that differ in at most ``r`` bits have distances to any pivot
that differ by at most ``r``, so a pair whose pivot distances differ more is
discarded without being compared.

To reach candidates by equality instead of by comparing everything, the
distances are also taken over blocks of the bits: with ``r`` differing bits
and ``r + 2`` blocks, two blocks at least agree fully, and there the distances
to all pivots are equal. Each fingerprint is therefore filed once per pair of
blocks under its block distances. Fingerprints that share a file are paired,
pairs whose distances to some pivot differ by more than ``r`` are discarded,
and the survivors are verified by counting bits.

A file with more than ``max_file`` different fingerprints would give
quadratically many pairs. Its members are linked in another exact way: each is
listed under itself and its single-bit neighbours. Two fingerprints at
distance two or less share one of these, everything listed under one of them
is within distance two, and no list is longer than 65.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import id_and_text, stage, text_key, word_blocks
from tradeloom.llm.components import components

BITS = 64
RADIUS = 2
PIVOTS = 16
BLOCKS = RADIUS + 2
MAX_FILE = 64
SEED = 42
_COUNT_ROWS = 1 << 15


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints, spread over the space by hashing their number."""
    return [xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(count)]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _COUNT_ROWS):
        part = hashes[at : at + _COUNT_ROWS].astype("<u8", copy=False)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return ones


def simhash(text: str, size: int = 3) -> int:
    """Fingerprint of one text; zero without a word."""
    ones, total, carried = np.zeros(BITS, dtype=np.int64), 0, []
    for words in word_blocks(text.encode("utf-8", "replace").lower()):
        words = carried + words
        carried = words[-(size - 1) :] if size > 1 else []
        count = len(words) - size + 1
        if count > 0:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
            ones += _bit_counts(hashes)
            total += count
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carried), SEED) if carried else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, key, fp)`` per row; ``key`` tells texts under one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (signed(simhash(t, size)) for t in batch.column("text").to_pylist())
            fp = pa.array(np.fromiter(found, np.int64, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), fp], ["id", "key", "fp"])

    rows = id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text")))
    return rows.mapInArrow(run, "id long, key long, fp long")


def _distances(fp: Column, mask: int = (1 << BITS) - 1) -> list[Column]:
    return [
        F.bit_count(fp.bitwiseXOR(F.lit(signed(p))).bitwiseAND(F.lit(signed(mask)))).cast("byte") for p in pivots()
    ]


def _filed(prints: DataFrame) -> DataFrame:
    """One row per fingerprint and pair of blocks, with the key it is filed under."""
    width = BITS // BLOCKS
    fp = F.col("fp")
    profile = [_distances(fp, ((1 << width) - 1) << (b * width)) for b in range(BLOCKS)]
    keys = [F.xxhash64(*profile[i], *profile[j]) for i, j in combinations(range(BLOCKS), 2)]
    return prints.select("fp", F.posexplode(F.array(*keys)).alias("file", "key"))


def _pair_links(members: DataFrame) -> DataFrame:
    """Pairs of one file that no pivot separates and that verify."""
    table = members.select("file", "key", "fp", F.array(*_distances(F.col("fp"))).alias("d"))
    a, b = table.alias("a"), table.alias("b")
    near = [F.abs(F.col("a.d")[i] - F.col("b.d")[i]) <= RADIUS for i in range(PIVOTS)]
    same = (F.col("a.file") == F.col("b.file")) & (F.col("a.key") == F.col("b.key"))
    on = same & (F.col("a.fp") < F.col("b.fp"))
    for condition in near:
        on = on & condition
    on = on & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= RADIUS)
    return a.join(b, on).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _neighbour_links(prints: DataFrame) -> DataFrame:
    """Links of fingerprints that share a single-bit neighbour or are one."""
    fp = F.col("fp")
    around = [fp, *(fp.bitwiseXOR(F.lit(signed(1 << i))) for i in range(BITS))]
    listed = prints.select("fp", F.explode(F.array(*around)).alias("z"))
    lists = listed.groupBy("z").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return lists.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")


def links(prints: DataFrame, max_file: int = MAX_FILE) -> DataFrame:
    """``(a, b)`` links of different fingerprints; connects all within RADIUS."""
    filed = stage(_filed(prints), "filed")
    sizes = stage(filed.groupBy("file", "key").agg(F.count("*").alias("n")).where("n > 1"), "files")
    shared = stage(filed.join(sizes, ["file", "key"]), "shared")
    crowded = shared.where(F.col("n") > max_file).select("fp").distinct()
    pairs = _pair_links(shared.where(F.col("n") <= max_file))
    return pairs.union(_neighbour_links(crowded))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 3,
    max_file: int = MAX_FILE,
) -> DataFrame:
    """``(id, key, fp, component_id)``: one row per row of ``docs``.

    ``component_id`` is the smallest id whose fingerprint can be reached over
    links. A NULL text is an empty one; texts without words have fingerprint
    zero and link like others. Rows with a NULL id are in components as others
    are, and a component of such rows only has a NULL ``component_id``.
    Repeated rows stay. An empty table gives no rows.
    """
    rows = stage(fingerprints(docs, id_col, text_col, size), "fingerprints")
    # copies meet here first: what follows handles each fingerprint once
    prints = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "prints")
    labels = stage(components(links(prints.select("fp"), max_file)), "labels")
    linked = labels.join(prints, labels["node"] == prints["fp"]).select("fp", "label", "first")
    firsts = stage(linked.groupBy("label").agg(F.min("first").alias("lowest")), "lowest")
    reached = labels.join(firsts, "label").select(F.col("node").alias("fp"), "lowest")
    known = stage(
        prints.join(reached, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component_id")),
        "components",
    )
    return rows.join(known, "fp").select("id", "key", "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with one row of every near-duplicate group.

    The row with the smallest id stays; among rows with that id, the one with
    the smallest text key. All columns are kept.
    """
    groups = near_duplicates(docs, id_col, text_col)
    # a component without ids stands for its fingerprint
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    kept = stage(groups.groupBy(group.alias("g")).agg(first).select("first.id", "first.key"), "kept")
    keyed = docs.withColumns({"__id": docs[id_col].cast("long"), "__key": text_key(docs[text_col])})
    on = keyed["__id"].eqNullSafe(kept["id"]) & (keyed["__key"] == kept["key"])
    return keyed.join(kept, on, "left_semi").dropDuplicates(["__id", "__key"]).drop("__id", "__key")
