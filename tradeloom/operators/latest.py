"""Keep the newest row, or the newest batch, of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def _cols(items: Sequence[Column | str]) -> list[Column]:
    return [F.col(i) if isinstance(i, str) else i for i in items]


def keep_latest(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column | str],
    ties: str = "one",
    tie_break: Sequence[Column | str] = (),
    hot: bool = True,
) -> DataFrame:
    """Rows that come first per key when ``order`` sorts descending.

    ``ties="one"`` keeps one row; ``tie_break`` columns, ascending, make the
    choice repeatable. Every task keeps one row per key before the shuffle
    (window group limit), so a hot key sends one row per task.

    ``ties="all"`` keeps all rows of the newest batch, a set without a size
    limit. As long as a key may be ``hot``, the newest order value per key is
    aggregated, with map-side combine, and the rows are filtered by a semi
    join, whose row side adaptive execution splits at a hot key. For keys
    known to be small one window does it in a single pass.

    NULL keys form a group of their own; NULL order values sort last.
    """
    keys, order = _cols(keys), _cols(order)
    if ties not in ("one", "all"):
        raise ValueError(f"ties must be 'one' or 'all', not {ties!r}")
    if ties == "one" or not hot:
        sort = [c.desc_nulls_last() for c in order]
        if ties == "one":
            sort += [c.asc_nulls_first() for c in _cols(tie_break)]
        rank = F.row_number() if ties == "one" else F.dense_rank()
        window = Window.partitionBy(*keys).orderBy(*sort)
        ranked = df.withColumn(_RANK, rank.over(window))
        return ranked.where(F.col(_RANK) == 1).drop(_RANK)
    newest = order[0] if len(order) == 1 else F.struct(*order)
    names = [f"_latest_key{i}" for i in range(len(keys))]
    latest = df.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(
        F.max(newest).alias("_latest_order")
    )
    match = newest.eqNullSafe(F.col("_latest_order"))
    for key, name in zip(keys, names):
        match = match & key.eqNullSafe(F.col(name))
    return df.join(latest, match, "left_semi")
