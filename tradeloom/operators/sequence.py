"""Number the rows of every key, also when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.config import HOT_ROWS, SEQ_ID
from tradeloom.session import stage

_ROW = "_row_no"
_RANGE = "_range"
_MOST_RANGES = 20_000
_CELLS = 131_072


def number_rows(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[str],
    out: str = SEQ_ID,
    hot_rows: int = HOT_ROWS,
    split: bool | None = None,
) -> DataFrame:
    """Add ``row_number`` per key; ``"-x"`` in ``order`` sorts ``x`` descending.

    Ascending columns put NULL first, descending ones last. Rows of keys with
    more than ``hot_rows`` rows are set apart: their keys are split into ranges
    of the sort order, each range is numbered in its own task, and the counts
    of the ranges before it are added. All other rows are numbered by one
    window. ``split`` says whether such keys exist; ``None`` looks.
    """
    keys = _cols(keys)
    terms = [(o.lstrip("-"), o.startswith("-")) for o in order]
    if split is None:
        split = has_hot_group(df, keys, hot_rows)
    window = Window.partitionBy(*keys).orderBy(*_sort(terms))
    if not split:
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    hot, cold = split_hot(df, keys, hot_rows)
    numbered = cold.withColumn(out, F.row_number().over(window).cast("bigint"))
    ranged = _number_in_ranges(hot, keys, terms, out, hot_rows)
    return numbered.unionByName(ranged)


def has_hot_group(df: DataFrame, keys: Sequence[Column | str], hot_rows: int) -> bool:
    """Whether any key has more than ``hot_rows`` rows.

    Reads only the key columns; the counts are combined before the shuffle.
    """
    keys = _cols(keys)
    names = [f"_hot_key{i}" for i in range(len(keys))]
    return not _sizes(df, keys, names).where(F.col("_size") > hot_rows).isEmpty()


def group_sizes(df: DataFrame, keys: Sequence[Column | str], hot_rows: int = 0) -> tuple[int, int]:
    """Rows of the largest key, and rows in all; reads only the key columns.

    Where no cell of the hashed keys has more than ``hot_rows`` rows, no key
    has, and the largest cell is returned in place of the largest key: tasks
    hold and send a bounded number of counts instead of all keys.
    """
    keys = _cols(keys)
    if hot_rows > 0:
        largest, total = _largest(_sizes(df, [F.pmod(F.xxhash64(*keys), F.lit(_CELLS))], ["_cell"]))
        if largest <= hot_rows:
            return largest, total
    return _largest(_sizes(df, keys, [f"_hot_key{i}" for i in range(len(keys))]))


def _largest(sizes: DataFrame) -> tuple[int, int]:
    largest, total = sizes.agg(F.max("_size"), F.sum("_size")).first()
    return largest or 0, total or 0


def split_hot(df: DataFrame, keys: Sequence[Column | str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows of keys with more than ``hot_rows`` rows, and all others."""
    keys = _cols(keys)
    names = [f"_hot_key{i}" for i in range(len(keys))]
    # Keys with so many rows are few; the planner may broadcast them.
    hot = stage(_sizes(df, keys, names).where(F.col("_size") > hot_rows), "hot-keys")
    same = F.lit(True)
    for key, name in zip(keys, names):
        same = same & key.eqNullSafe(F.col(name))
    return df.join(hot, same, "left_semi"), df.join(hot, same, "left_anti")


def _cols(items: Sequence[Column | str]) -> list[Column]:
    return [F.col(i) if isinstance(i, str) else i for i in items]


def _sort(terms: Sequence[tuple[str, bool]]) -> list[Column]:
    return [
        F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_first()
        for name, desc in terms
    ]


def _sizes(df: DataFrame, keys: Sequence[Column], names: Sequence[str]) -> DataFrame:
    return df.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(
        F.count(F.lit(1)).alias("_size")
    )


def _number_in_ranges(
    df: DataFrame,
    keys: Sequence[Column],
    terms: Sequence[tuple[str, bool]],
    out: str,
    hot_rows: int,
) -> DataFrame:
    # The row number makes the order total, so that even equal rows can fall
    # into different ranges. Both numbers are written before they are used:
    # a re-run task cannot change them.
    rows = stage(df.withColumn(_ROW, F.monotonically_increasing_id()), "rows")
    order = _sort([*terms, (_ROW, False)])
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(max(rows.count() // max(hot_rows, 1) + 1, partitions), _MOST_RANGES)
    ranged = stage(
        rows.repartitionByRange(ranges, *keys, *order).withColumn(_RANGE, F.spark_partition_id()),
        "ranges",
    )

    # Where a key goes on from an earlier range: at most one key per range
    # does, so this table has fewer rows than there are ranges, which are bounded.
    names = [f"_hot_key{i}" for i in range(len(keys))]
    earlier = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*[k.alias(n) for k, n in zip(keys, names)], F.col(_RANGE).alias("_at"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_start", F.sum("_size").over(earlier))
        .where(F.col("_start") > 0)
        .drop("_size")
    )
    own = F.row_number().over(Window.partitionBy(*keys, _RANGE).orderBy(*order))
    same = F.col(_RANGE) == F.col("_at")
    for key, name in zip(keys, names):
        same = same & key.eqNullSafe(F.col(name))
    return (
        ranged.withColumn(out, own.cast("bigint"))
        .join(F.broadcast(starts), same, "left")
        .withColumn(out, F.col(out) + F.coalesce(F.col("_start"), F.lit(0)))
        .drop(_ROW, _RANGE, "_at", "_start", *names)
    )
