"""Near copies by the Jaccard similarity of their word shingles, without loss.

Two texts are near copies if their sets of lower-cased five-word shingles have
a Jaccard similarity of 0.8 or more. In any common order of the shingles such
a pair shares one among the first fifth of either set (prefix filter), so each
different set is listed under these shingles only. The lists come from one
shuffle and stream through the tasks. Pairs of one list whose sizes or places
in the order rule the similarity out are discarded (length and position
filter). Whole sets travel to the survivors only, in two rounds: first every
set meets its smallest candidate, then the pairs that this has not connected.

The order puts shingles that a sample of the texts shows often last. It decides
how long lists get, never which pairs are found. A longer list is one of texts
that are mostly made of common shingles, as large groups of copies are: there
the member with the fewest rarer shingles is compared with all others, and
then those that did not join its group with the members of other groups.

Fingerprints alone cannot do this: at a similarity of 0.8 they differ in about
ten of 64 bits, and no equality of blocks or pivot distances separates that from
chance without losing pairs. Nor can similarities do what fingerprints do: texts
that differ in what they say once and agree in what they repeat have near
fingerprints. Groups that a fingerprint search found can be given: what its links
connect is one group too, and the lists then verify only what this has not connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import id_and_text, release_memory, stage, text_key, text_slices, word_blocks
from tradeloom.llm.components import components
from tradeloom.llm.simhash_pivots import links as fingerprint_links

SIZE = 5
LIKE, OF = 4, 5  # similarity of 4/5 or more, in whole numbers
MAX_LIST = 64
SEED = 42
_BUCKETS = 1 << 20
_SAMPLE = 16


def shingles(text: str, size: int = SIZE) -> np.ndarray:
    """Different shingle hashes, sorted; a text with fewer words is one shingle."""
    found, carried = [], []
    for words in word_blocks(text.lower().encode("utf-8", "replace")):
        words = carried + words
        carried = words[len(words) - size + 1 :] if len(words) >= size else words
        parts = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
        count = max(len(words) - size + 1, 0)
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, count))
    if not sum(map(len, found)) and carried:
        found = [np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _frequencies(rows: DataFrame) -> np.ndarray:
    """How often hash buckets of shingles occur in a sample of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BUCKETS, np.int32)
        for batch in text_slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                np.add.at(counts, (shingles(text) % _BUCKETS).astype(np.int64), 1)
        (at,) = counts.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["bucket", "n"])

    sample = rows.where(F.col("key") % _SAMPLE == 0).select("text")
    found = sample.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(_BUCKETS, np.uint16)
    out[found["bucket"].to_numpy()] = np.minimum(found["n"].to_numpy(), 65535)
    return out


def prefixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, node, n, prefix)`` per row: the set's key and size, and its first shingles in the order."""
    rows = id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text")))
    often = _frequencies(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            nodes, sizes, firsts = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                n = len(found)
                order = np.lexsort((found, often[found % _BUCKETS]))
                length = n - (LIKE * n + OF - 1) // OF + 1 if n else 0
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
                sizes.append(n)
                firsts.append(found[order[:length]].view(np.int64))
            columns = [
                batch.column("id"),
                batch.column("key"),
                pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int32()),
                pa.array(firsts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "node", "n", "prefix"])
        release_memory()

    return rows.mapInArrow(run, "id long, key long, node long, n int, prefix array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            found = [shingles(t).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "all"])
        release_memory()

    return texts.select("node", "text").mapInArrow(run, "node long, all array<long>")


def _possible() -> Column:
    """Whether sizes and places of ``a`` and ``b`` in a list allow the similarity.

    Before the first shingle they share, neither has one of the other's.
    """
    na, nb = F.col("a.n"), F.col("b.n")
    left = F.least(na - F.col("a.pos"), nb - F.col("b.pos"))
    return (OF * F.least(na, nb) >= LIKE * F.greatest(na, nb)) & ((LIKE + OF) * left >= LIKE * (na + nb))


def _pairs(a: DataFrame, b: DataFrame, differ: Column) -> DataFrame:
    on = (F.col("a.shingle") == F.col("b.shingle")) & differ & _possible()
    x, y = F.col("a.node"), F.col("b.node")
    return a.alias("a").join(b.alias("b"), on).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


_LISTED = "a long, b long, shingle long, n int, pos int"


def _listed(places: DataFrame, max_list: int) -> DataFrame:
    """Possible pairs ``(a, b)`` of short lists, and the members ``(a, shingle, n, pos)`` of longer ones.

    Lists stream in order; of the one that goes on beyond a batch at most
    ``max_list`` members are held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int32)] * 2
        crowded = None  # the shingle of a long list that goes on

        def table(columns: list, crowd: bool) -> pa.RecordBatch:
            none = pa.nulls(len(columns[0]))
            a, b = pa.array(columns[0]), none.cast(pa.int64())
            if crowd:
                rest = [pa.array(c) for c in columns[1:]]
            else:
                b, rest = pa.array(columns[1]), [none.cast(k) for k in (pa.int64(), pa.int32(), pa.int32())]
            return pa.RecordBatch.from_arrays([a, b, *rest], ["a", "b", "shingle", "n", "pos"])

        def out(rows: list[np.ndarray], ends: bool) -> Iterator[pa.RecordBatch]:
            """Pairs and long lists of ``rows``; the last list is held back unless it ends here."""
            nonlocal held, crowded
            node, shingle, n, pos = rows
            starts = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]])) if len(shingle) else []
            sizes = np.diff(np.append(starts, len(shingle)))
            size = np.repeat(sizes, sizes)
            long = (size > max_list) | (shingle == crowded if crowded is not None else False)
            last = len(shingle) if ends or not len(starts) else starts[-1]
            if last < len(shingle) and long[last]:
                crowded, last = shingle[last], len(shingle)
            elif len(shingle):
                crowded = None
            held = [c[last:] for c in rows]
            if long[:last].any():
                yield table([c[:last][long[:last]] for c in rows], True)
            short = ~long[:last] & (size[:last] > 1)
            node, shingle, n, pos = (c[:last][short] for c in rows)
            found = []
            for step in range(1, max_list):
                same = np.flatnonzero(shingle[step:] == shingle[:-step])
                if not len(same):
                    break
                na, nb = n[same].astype(np.int64), n[same + step].astype(np.int64)
                left = np.minimum(na - pos[same], nb - pos[same + step])
                fit = (OF * np.minimum(na, nb) >= LIKE * np.maximum(na, nb)) & ((LIKE + OF) * left >= LIKE * (na + nb))
                a, b = node[same][fit], node[same + step][fit]
                found.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
            if found and (pairs := np.unique(np.concatenate(found, axis=1), axis=1)).size:
                yield table(list(pairs), False)

        for batch in batches:
            new = [batch.column(c).to_numpy() for c in ("node", "shingle", "n", "pos")]
            yield from out([np.concatenate(c) for c in zip(held, new, strict=True)], False)
        yield from out(held, True)
        release_memory()

    ordered = places.repartition("shingle").sortWithinPartitions("shingle", "node")
    return ordered.select("node", "shingle", "n", "pos").mapInArrow(run, _LISTED)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("all").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("all").alias("of_b"))
    common = (LIKE + OF) * F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(one, "a").join(two, "b").where(common >= LIKE * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not connected yet."""
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("with_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("with_b"))
    both = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return both.where(F.coalesce("with_a", "a") != F.coalesce("with_b", "b")).select("a", "b")


def _connected(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect whatever the near copies among ``pairs`` connect."""
    nearest = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    found = stage(_verified(nearest, sets), "links")
    rest = stage(_apart(pairs, stage(components(found), "labels")), "rest")
    return found.union(_verified(rest, sets))


def _in_groups(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of the sets that the links of fingerprints connect.

    Sets of one fingerprint are linked to the smallest of them. A group of
    several fingerprints is searched again for the links between these.
    """
    # a group without ids stands for its fingerprint
    group = F.xxhash64("component_id", F.when(F.col("component_id").isNull(), F.col("fp")))
    of = groups.select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "fp", group.alias("group")).distinct()
    on = rows["id"].eqNullSafe(of["of_id"]) & (rows["key"] == of["of_key"])
    members = stage(rows.join(of, on).select("node", "fp", "group").distinct(), "members")
    firsts = stage(members.groupBy("fp").agg(F.min("node").alias("first")), "print-firsts")
    same = members.join(firsts, "fp").where("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b"))

    prints = members.select("group", "fp").distinct()
    several = prints.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    near = fingerprint_links(stage(prints.join(several, "group", "left_semi").select("fp").distinct(), "linked-prints"))
    of_a = firsts.select(F.col("fp").alias("a"), F.col("first").alias("first_a"))
    of_b = firsts.select(F.col("fp").alias("b"), F.col("first").alias("first_b"))
    linked = near.join(of_a, "a").join(of_b, "b").where("first_a <> first_b")
    return same.union(linked.select("first_a", "first_b")).distinct()


def links(
    docs: DataFrame,
    rows: DataFrame,
    id_col: str,
    text_col: str,
    max_list: int = MAX_LIST,
    groups: DataFrame | None = None,
) -> DataFrame:
    """``(a, b)`` near copies among different sets; connects all of them, and what ``groups`` connect."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    nodes = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), first)  # copies are one
    nodes = stage(nodes, "nodes")
    places = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "shingle"))
    listed = stage(_listed(places, max_list), "listed")
    pairs = stage(listed.where("b is not null").select("a", "b").distinct(), "pairs")
    crowded = listed.where("b is null").select("shingle", F.col("a").alias("node"), "n", "pos")

    known = pairs.limit(0) if groups is None else stage(_in_groups(groups, rows), "near")
    if groups is not None:
        pairs = stage(_apart(pairs, stage(components(known), "labels")), "apart")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).union(crowded.select("node")).distinct()
    firsts = nodes.select("node", F.col("first.id").alias("of_id"), F.col("first.key").alias("of_key")).join(ends, "node")
    firsts = stage(firsts, "firsts")
    texts = id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text")))
    on = texts["id"].eqNullSafe(firsts["of_id"]) & (texts["key"] == firsts["of_key"])
    sets = stage(_sets(texts.join(firsts, on).dropDuplicates(["node"])), "sets")

    found = stage(known.union(_connected(pairs, sets)), "links")
    if crowded.isEmpty():
        return found
    leader = F.min(F.struct("pos", "node", "n")).alias("lead")
    leaders = stage(crowded.groupBy("shingle").agg(leader).select("shingle", "lead.*"), "leaders")
    stars = stage(_pairs(leaders, crowded, F.col("a.node") != F.col("b.node")), "stars")
    found = stage(found.union(_verified(stars, sets)), "links")
    labels = stage(components(found), "labels")
    group = F.coalesce("label", "node").alias("group")
    of = labels.withColumnRenamed("node", "of")
    grouped = crowded.join(of, crowded["node"] == of["of"], "left").select("shingle", "node", "n", "pos", group)
    grouped = stage(grouped, "grouped")
    leading = grouped.join(leaders.select("shingle", "node"), ["shingle", "node"]).select("shingle", F.col("group").alias("leading"))
    others = grouped.join(leading, "shingle").where("group <> leading").drop("leading")
    rest = stage(_pairs(stage(others, "others"), grouped, F.col("a.group") != F.col("b.group")), "rest")
    return found if rest.isEmpty() else found.union(_connected(rest, sets))


def one_per_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_list: int = MAX_LIST,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``docs`` with one row of every group of near copies.

    Groups are connected over near copies. The row with the smallest id stays;
    among rows with that id, the one with the smallest text key; a NULL id
    comes last. A NULL text is an empty one, and texts without words are one
    group. All columns are kept. An empty table gives no rows. ``groups``
    are those of a fingerprint search over the same rows, ``(id, key, fp,
    component_id)``: rows that its links connect are in one group too, near
    copies or not.
    """
    rows = stage(prefixes(docs, id_col, text_col), "prefixes")
    labels = stage(components(links(docs, rows, id_col, text_col, max_list, groups)), "labels").withColumnRenamed("node", "of")
    groups = rows.select("id", "key", "node").join(labels, rows["node"] == labels["of"], "left")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    kept = groups.groupBy(F.coalesce("label", "node").alias("group")).agg(first).select("first.id", "first.key")
    kept = stage(kept, "kept")
    keyed = docs.withColumns({"__id": docs[id_col].cast("long"), "__key": text_key(docs[text_col])})
    on = keyed["__id"].eqNullSafe(kept["id"]) & (keyed["__key"] == kept["key"])
    return keyed.join(kept, on, "left_semi").dropDuplicates(["__id", "__key"]).drop("__id", "__key")
