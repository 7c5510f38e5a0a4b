"""Mix sources to target weights by pivotal dependent rounding.

A source with target ``t`` and size ``s`` takes each of its documents ``t / s``
times on average. The whole part is taken for certain. The fractional parts
are rounded together: two documents meet, words are moved from one to the
other in a random direction until one of them is whole, and the other goes on
to the next meeting. Moving words, not copies, keeps the words taken constant,
so a source ends within one document of its target; the two directions are
weighed so that each document keeps its expected number of copies.

Meetings happen in parts of a source first. A part leaves one unfinished
document at most. Those meet again in parts of the next level, and so on up to
one document per source, which is drawn by its own fraction. Parts are prefixes
of a hash of the document, and their depth follows the size of the source, so
that a hot source is many parts and no task depends on how a cluster happens
to cut its data. All random numbers are hashes of the documents that meet:
reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import stage, text_key, unit_hash, word_count

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
PART_ROWS = 2048
FAN_IN = 5  # bits: 32 parts meet in one of the next level
TINY = 1e-9


def numbered(names: DataFrame, column: str) -> DataFrame:
    """Number rows from 0 in the order of ``column``, NULL last.

    Sorted ranges are numbered on their own and shifted by the rows before
    them, so no task sees all names.
    """
    ordered = names.orderBy(F.col(column).asc_nulls_last()).withColumn("__at", F.monotonically_increasing_id())
    ordered = stage(ordered, "ordered")
    part = F.shiftright("__at", 33)
    sizes = ordered.groupBy(part.alias("p")).count().orderBy("p").collect()  # one row per range
    starts, before = {}, 0
    for row in sizes:
        starts[row["p"]] = before
        before += row["count"]
    if not starts:
        return ordered.withColumn("rank", F.lit(0).cast("long")).drop("__at")
    start = F.create_map(*(F.lit(x) for pair in starts.items() for x in pair))[part]
    rank = start + F.col("__at").bitwiseAND((1 << 33) - 1)
    return ordered.withColumn("rank", rank.cast("long")).drop("__at")


def fair_shares(sources: DataFrame, total: float, most: float = MAX_COPIES) -> DataFrame:
    """Adds ``target``: ``total`` shared by ``weight``, at most ``most * size`` each.

    What a source cannot take goes to the others by weight until nobody is
    above its limit. Each round is one aggregate; one row reaches the driver.
    """
    limit = F.col("size") * F.lit(float(most))
    share, full = 0.0, -1
    while True:
        above = limit < F.col("weight") * F.lit(share)
        row = sources.agg(
            F.sum(F.when(above, limit).otherwise(0.0)).alias("kept"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(above.cast("int")).alias("full"),
        ).first()
        if not row["open"] or row["full"] == full:
            break
        full = row["full"]
        share = (total - row["kept"]) / row["open"]
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(share)).cast("double"))


@dataclass
class Unfinished:
    key: int  # for the draws; documents may share one
    size: float
    p: float  # probability of one more copy
    name: str = ""  # tells documents apart


def meet(a: Unfinished, b: Unfinished, done: list[tuple[Unfinished, int]]) -> Unfinished | None:
    """Move words between two documents until one is whole; the other stays."""
    up = min((1 - a.p) * a.size, b.p * b.size)  # words that can move to a
    down = min(a.p * a.size, (1 - b.p) * b.size)
    move = up if unit_hash(a.key, b.key) * (up + down) < down else -down
    a.p += move / a.size
    b.p -= move / b.size
    open_ones = []
    for x in (a, b):
        if TINY < x.p < 1 - TINY:
            open_ones.append(x)
        else:
            done.append((x, round(x.p)))
    return open_ones[0] if open_ones else None


def _round_part(rows: pd.DataFrame, last: bool) -> pd.DataFrame:
    """Round the documents of one part; ``extra`` of -1 marks the one left over."""
    rows = rows.sort_values(["key", "name"], kind="stable")
    done: list[tuple[Unfinished, int]] = []
    left: Unfinished | None = None
    columns = (rows[c].tolist() for c in ("key", "size", "p", "name"))
    for key, size, p, name in zip(*columns, strict=True):
        new = Unfinished(key, float(size), p, name)
        left = new if left is None else meet(left, new, done)
    out = [(x.name, x.key, extra, 0.0, 0) for x, extra in done]
    if left is not None:
        if last:
            out.append((left.name, left.key, int(unit_hash(left.key) < left.p), 0.0, 0))
        else:
            out.append((left.name, left.key, -1, left.p, int(left.size)))
    frame = pd.DataFrame(out, columns=["name", "key", "extra", "p", "size"])
    return frame.assign(rank=rows["rank"].iloc[0], depth=rows["depth"].iloc[0])


_ROUNDED = "name string, key long, extra int, p double, size long, rank long, depth int"


def _round_level(open_rows: DataFrame, level: int) -> DataFrame:
    """One level of the tree: parts are the first ``depth - FAN_IN * level`` bits."""
    bits = F.greatest(F.col("depth") - F.lit(FAN_IN * level), F.lit(0)).alias("bits")
    hashed = open_rows.withColumn("bits", bits).withColumn(
        "part",
        F.expr("if(bits = 0, 0L, shiftrightunsigned(xxhash64(key), 64 - bits))"),
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return _round_part(rows, last=int(rows["bits"].iloc[0]) == 0)

    return hashed.groupBy("rank", "part").applyInPandas(run, _ROUNDED)


def round_copies(units: DataFrame) -> DataFrame:
    """``(rank, name, extra)`` with ``extra`` 0 or 1 for every unit.

    ``units``: ``rank`` (the source), ``name`` (unique in its source), ``key``
    (for the draws, any number), ``size`` over 0, ``p`` strictly between 0 and
    1, ``depth`` (bits of the part prefix).
    """
    deepest = units.agg(F.max("depth")).first()[0]
    if deepest is None:
        return units.select("rank", "name", F.lit(0).alias("extra"))
    left, rounded = units, []
    for level in range(-(-deepest // FAN_IN) + 1):
        step = stage(_round_level(left, level), "rounded")
        rounded.append(step.where("extra >= 0").select("rank", "name", "extra"))
        left = step.where("extra < 0")
    out = rounded[0]
    for more in rounded[1:]:
        out = out.union(more)
    return out


def draw_key(doc_id: Column, key: Column, source: Column) -> Column:
    return F.xxhash64(doc_id, key, source)


def sizes_of(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(id, text_key, source, size, n)``: n equal rows of ``size`` words each."""
    rows = docs.select(
        docs[id_col].cast("long").alias("id"),
        text_key(docs[text_col]).alias("text_key"),
        docs[source_col].cast("string").alias("source"),
        word_count(docs[text_col].cast("string")).alias("size"),
    )
    return rows.groupBy("id", "text_key", "source").agg(F.max("size").alias("size"), F.count("*").alias("n"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(id, text_key, source, size, n, source_size, target, copies)``.

    One row per document; ``n`` equal rows (same id, text and source) are one
    document whose rows are all taken ``copies`` times. Sources by code point,
    NULL last, weigh ``weights`` in turn. A NULL text has no words; documents
    without words are taken once. No document is taken more than
    ``max_copies`` times. Other columns are not read. An empty table gives no
    rows; sources without words have target 0.
    """
    sized = stage(sizes_of(docs, id_col, text_col, source_col), "sizes")
    per_source = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("size"), F.count("*").alias("documents")
    )
    ranked = numbered(per_source, "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight), "sources")
    total = ranked.agg(F.sum("size")).first()[0] or 0
    shared = fair_shares(ranked, float(total), max_copies)
    depth = F.greatest(F.ceil(F.log2(F.col("documents") / F.lit(float(part_rows)))), F.lit(0)).cast("int")
    shared = stage(
        shared.select(
            F.col("source").alias("of"),
            "rank",
            F.col("size").alias("source_size"),
            "target",
            F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(1.0).alias("rate"),
            depth.alias("depth"),
        ),
        "targets",
    )
    joined = sized.join(shared, sized["source"].eqNullSafe(shared["of"])).drop("of")
    # the rate as certain copies and a chance of one more; sums of doubles can miss a whole number
    near = F.when(F.abs(F.col("rate") - F.round("rate")) < TINY, F.round("rate")).otherwise(F.col("rate"))
    certain = F.least(F.floor(near), F.lit(max_copies))
    worded = F.col("size") > 0
    rows = joined.withColumns(
        {
            "certain": F.when(worded, certain).otherwise(1).cast("int"),
            "p": F.when(worded, near - certain).otherwise(0.0),
            "key": draw_key(F.col("id"), F.col("text_key"), F.col("source")),
            "name": F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("none")), "text_key"),
        }
    )
    rows = stage(rows, "fractions")
    units = rows.where("p > 0").select("rank", "name", "key", (F.col("size") * F.col("n")).alias("size"), "p", "depth")
    extra = stage(round_copies(units), "copies")
    found = rows.join(extra, ["rank", "name"], "left")
    return found.select(
        "id",
        "text_key",
        "source",
        "size",
        "n",
        "source_size",
        "target",
        (F.col("certain") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = stage(mix(docs, id_col, text_col, source_col).select("id", "text_key", "source", "copies"), "taken")
    keyed = docs.withColumns(
        {"__id": docs[id_col].cast("long"), "__key": text_key(docs[text_col]), "__of": docs[source_col].cast("string")}
    )
    on = (
        keyed["__id"].eqNullSafe(taken["id"])
        & (keyed["__key"] == taken["text_key"])
        & keyed["__of"].eqNullSafe(taken["source"])
    )
    names = [keyed[c] for c in docs.columns]
    joined = keyed.join(taken.where("copies > 0"), on).select(*names, taken["copies"].alias("__copies"))
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.drop("__copies", "__copy")
