"""Keyed merge of a source frame into a target frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(target_keys: Sequence[str], source_keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(t) == F.col(s) for t, s in zip(target_keys, source_keys)]
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Target after the merge: matched rows updated, the others inserted.

    Keys match by plain equality, so a NULL key never matches. Every target
    row of a matched key is updated. Columns in ``exclude`` keep the target's
    value on a match and take the source's on an insert. Nothing is deleted.

    One full outer join on the complete keys: either side is shuffled once, a
    table bucketed by the keys not at all. Rows with a NULL key bypass the join
    and cannot pile up in one task.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    given = {c.lower(): f"_source{i}" for i, c in enumerate(source.columns)}
    missing = {c.lower() for c in target.columns} ^ set(given)
    if missing:
        raise ValueError(f"target and source differ in the columns {sorted(missing)}")
    new = source.where(complete).select(
        *[F.col(c).alias(given[c.lower()]) for c in source.columns], F.lit(True).alias("_in_source")
    )
    old = target.where(complete).withColumn("_in_target", F.lit(True))
    joined = old.join(new, _match(keys, [given[k.lower()] for k in keys]), "full_outer")
    held = {c.lower() for c in exclude}
    merged = []
    for name in target.columns:
        before, after = F.col(name), F.col(given[name.lower()])
        if name.lower() in held:
            value = F.when(F.col("_in_target"), before).otherwise(after)
        else:
            value = F.when(F.col("_in_source"), after).otherwise(before)
        merged.append(value.alias(name))
    return joined.select(*merged).unionByName(target.where(~complete)).unionByName(source.where(~complete))


def matched_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key some source row has."""
    names = [f"_merge_key{i}" for i in range(len(keys))]
    source_keys = source.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    return target.join(source_keys, _match(keys, names), "left_semi")


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = [f"_merge_key{i}" for i in range(len(keys))]
    return (
        source.dropna(subset=list(keys))
        .groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def duplicate_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several source rows share and that match a target row.

    Such a merge has no single result and is refused.
    """
    names = [f"_merge_key{i}" for i in range(len(keys))]
    return repeated_keys(source, keys).join(
        target.select(*keys), _match(keys, names), "left_semi"
    )
