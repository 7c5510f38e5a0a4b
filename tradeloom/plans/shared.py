"""Feeds over the same raw tables, fed by one scan of them.

The raw rows are read once with the fields of all feeds. Every raw row is
repeated for each branch, an array that some of the feeds begin with, and holds
only that array. The levels that all feeds of a branch un-nest alike are
un-nested here, then the rows are written, one folder per branch. A feed reads
its branch and goes on from there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from os.path import commonprefix

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.config import Config, Feed
from tradeloom.operators.incremental import since
from tradeloom.operators.nested import unnest
from tradeloom.session import stage
from tradeloom.sources import RawSource
from tradeloom.sources.raw import tagged_scan

BRANCH = "_branch"
# Rows of many feeds lie in the shared folder at the same time.
COMPACT = "zstd"


@dataclass(frozen=True)
class SharedRows:
    """Written raw rows of several feeds, some levels un-nested."""

    rows: DataFrame
    branches: Mapping[str, int]
    levels: Mapping[str, int]

    def of(self, feed: Feed, loaded: int | None) -> tuple[DataFrame, int]:
        """Raw rows of one feed, and how many of its levels are un-nested."""
        root = feed.unnest[0]
        own = self.rows.where(F.col(BRANCH) == self.branches[root]).drop(BRANCH)
        return since(own, loaded), self.levels[root]


def sharing(feeds: Mapping[str, Feed]) -> list[dict[str, Feed]]:
    """All feeds, those that can share a scan together, in the order given."""
    groups: dict[object, dict[str, Feed]] = {}
    for name, item in feeds.items():
        alike = (item.like, item.tz_aware, item.where_not) if item.unnest and not item.where_not else name
        groups.setdefault(alike, {})[name] = item
    return list(groups.values())


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type with the nested fields of both."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        others = {f.name.lower(): f for f in b.fields}
        fields = []
        for field in a.fields:
            other = others.pop(field.name.lower(), field)
            fields.append(T.StructField(field.name, merged_type(field.dataType, other.dataType)))
        return T.StructType([*fields, *others.values()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    if a != b:
        raise ValueError(f"one raw field is read as {a.simpleString()} and as {b.simpleString()}")
    return a


def share(
    spark: SparkSession,
    feeds: Sequence[Feed],
    sources: Sequence[RawSource],
    cfg: Config,
    loaded: int | None = None,
    prefix: str = "",
) -> SharedRows:
    """Scan the raw tables once for all ``feeds``; ``loaded`` is their lowest watermark."""
    schema = reduce(merged_type, [T.StructType.fromDDL(f.raw_ddl) for f in feeds])
    rows = tagged_scan(spark, sources, schema, cfg, feeds[0].tz_aware, loaded, prefix)
    chains: dict[str, list[tuple[str, ...]]] = {}
    for item in feeds:
        chains.setdefault(item.unnest[0], []).append(item.unnest)
    branches = {root: i for i, root in enumerate(chains)}
    alike = {root: tuple(commonprefix(found)) for root, found in chains.items()}
    rows = rows.withColumn(BRANCH, F.explode(F.array(*map(F.lit, branches.values()))))
    rows = rows.withColumns({root: F.when(F.col(BRANCH) == i, F.col(root)) for root, i in branches.items()})
    for paths in alike.values():
        for path in paths:
            rows = _one_level(rows, path)
    written = stage(rows, "shared", partition_by=[BRANCH], folders=len(branches), codec=COMPACT)
    return SharedRows(written, branches, {root: len(paths) for root, paths in alike.items()})


def _one_level(rows: DataFrame, path: str) -> DataFrame:
    """Un-nest an array and take it out of the struct that held it."""
    if "." not in path:
        return unnest(rows, path)
    outer, inner = path.split(".")
    if inner.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"two branches un-nest into {inner}")
    rows = unnest(rows, path)
    others = [f for f in rows.schema[outer].dataType.fields if f.name.lower() != inner.lower()]
    return rows.withColumn(outer, F.col(outer).dropFields(inner)) if others else rows.drop(outer)
