"""Staged catalog tables bucketed by their merge key.

A merge into such a table shuffles the new rows only: the table's files are
already dealt by the key, and the merged rows are written bucket by bucket
where the join leaves them. Every write is a new version of the table; the view
of the table's name is pointed to it when it is complete, so readers see one
version as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tradeloom.operators.merge import duplicate_matches, merge_upsert, repeated_keys
from tradeloom.session import delete_path


def _versions(spark: SparkSession, name: str) -> list[int]:
    pattern = re.compile(re.escape(name.rsplit(".", 1)[-1]) + r"__v(\d+)", re.IGNORECASE)
    database = name.rsplit(".", 1)[0] if "." in name else None
    found = (pattern.fullmatch(t.name) for t in spark.catalog.listTables(database))
    return sorted(int(m[1]) for m in found if m)


def _write(df: DataFrame, name: str, keys: Sequence[str], buckets: int, folder: str) -> None:
    spark = df.sparkSession
    table = f"{name}__v{max(_versions(spark, name), default=0) + 1}"
    writer = df.write.format("parquet").option("path", f"{folder}/{table}")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, folder: str) -> None:
    """Replace the rows of the table ``name``; its files lie below ``folder``."""
    _write(df.repartition(buckets, *keys), name, keys, buckets, folder)


def merge_bucketed(
    name: str, source: DataFrame, keys: Sequence[str], buckets: int, folder: str, exclude: Sequence[str] = ()
) -> None:
    """Merge ``source`` into the table ``name``, by the rules of ``merge_upsert``.

    Source rows that share a key and match a target row are refused.
    """
    target = source.sparkSession.table(name)
    if not repeated_keys(source, keys).isEmpty():
        clash = duplicate_matches(target, source, keys).first()
        if clash is not None:
            raise ValueError(f"several source rows match one target row: {clash.asDict()}")
    _write(merge_upsert(target, source, keys, exclude), name, keys, buckets, folder)


def prune_versions(spark: SparkSession, name: str, folder: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` versions and return their numbers."""
    old = _versions(spark, name)[: -max(keep, 1)]
    for number in old:
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{number}")
        delete_path(spark, f"{folder}/{name}__v{number}")
    return old
