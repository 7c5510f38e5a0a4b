"""Staged tables on plain Parquet: full write, day partitions, clustering, merge.

A table without days is a row of numbered snapshots, of which readers take the
newest complete one. A table with days writes only the days that change to a
new snapshot, and after them a small table that names the snapshot of every
day. Readers follow the newest complete one of these, so they see all days of a
write or none, and a write that breaks off is never seen. Old snapshots stay
for readers that have begun until they are pruned. A table has one writer at a
time.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators.checks import WriteChecks
from tradeloom.operators.latest import keep_latest
from tradeloom.operators.merge import duplicate_matches, matched_rows, merge_upsert, repeated_keys
from tradeloom.session import delete_path

DAY = "_day"
_SNAPSHOT = "snapshot="
_DAYS = "days="
_DAYS_DDL = "folder string, snapshot int"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _children(spark: SparkSession, path: str) -> list[str] | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def _numbers(spark: SparkSession, path: str, kind: str, complete: bool = True) -> list[int]:
    """Numbers of the snapshots or lists of days, ascending; of complete ones if asked."""
    found = sorted(int(n[len(kind) :]) for n in _children(spark, path) or [] if n.startswith(kind))
    return [n for n in found if not complete or "_SUCCESS" in (_children(spark, f"{path}/{kind}{n}") or [])]


def _next_number(spark: SparkSession, path: str) -> int:
    """A number that was never used, not even by a write that failed."""
    used = [*_numbers(spark, path, _SNAPSHOT, False), *_numbers(spark, path, _DAYS, False)]
    return max(used, default=0) + 1


def _days_of(spark: SparkSession, path: str, number: int) -> dict[str, int]:
    """The snapshot of every day; one row per calendar day."""
    listed = spark.read.schema(_DAYS_DDL).parquet(f"{path}/{_DAYS}{number}").collect()
    return {r["folder"]: r["snapshot"] for r in listed}


def table_paths(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold a staged table's current rows."""
    lists = _numbers(spark, path, _DAYS)
    done = _numbers(spark, path, _SNAPSHOT)
    if lists:
        days = _days_of(spark, path, lists[-1])
        if days:
            return [f"{path}/{_SNAPSHOT}{number}/{folder}" for folder, number in sorted(days.items())]
    return [f"{path}/{_SNAPSHOT}{done[-1]}" if done else path]


def target_exists(spark: SparkSession, path: str) -> bool:
    if _numbers(spark, path, _DAYS) or _numbers(spark, path, _SNAPSHOT):
        return True
    return "_SUCCESS" in (_children(spark, path) or [])


def read_target(
    spark: SparkSession, path: str, schema: T.StructType | None = None, keep_day: bool = False
) -> DataFrame:
    """The current rows of a staged table."""
    paths = table_paths(spark, path)
    reader, number = spark.read, _SNAPSHOT.rstrip("=")
    if _numbers(spark, path, _DAYS):
        reader = reader.option("basePath", path)
        if schema is not None:
            schema = T.StructType([*schema.fields, T.StructField(number, T.IntegerType())])
        df = (reader if schema is None else reader.schema(schema)).parquet(*paths).drop(number)
    else:
        df = (reader if schema is None else reader.schema(schema)).parquet(*paths)
    return df if keep_day else df.drop(DAY)


def clustered(df: DataFrame, cluster_by: Sequence[str], day: bool) -> DataFrame:
    """Bring rows that are read together into the same sorted files.

    With days, rows are rebalanced by day: adaptive execution splits a day
    that holds many rows by size and joins small ones, and the rows above the
    last shuffle are computed once. Each file is sorted by the cluster columns,
    which lets readers skip pages. Without days the table is range-partitioned;
    the row hash at the end splits a cluster value that holds many rows.
    """
    columns = [c for c in cluster_by if c.lower() != DAY]
    if day:
        return df.hint("rebalance", DAY).sortWithinPartitions(DAY, *columns)
    if not columns:
        return df
    spread = F.xxhash64(*[c for c, t in df.dtypes if "map<" not in t and "variant" not in t])
    return df.repartitionByRange(*columns, spread).sortWithinPartitions(*columns)


def _day_folder(day) -> str:
    return f"{DAY}={_NO_DAY if day is None else day.isoformat()}"


def _put_days(
    df: DataFrame, path: str, days, partition_by: str, cluster_by: Sequence[str], checks: WriteChecks | None = None
) -> None:
    """Replace ``days`` of the table at ``path``, all if None, by the rows of ``df``."""
    spark = df.sparkSession
    lists = _numbers(spark, path, _DAYS)
    if days is not None and not lists:
        raise ValueError(f"{path} has no list of days; write it with a full refresh")
    number = _next_number(spark, path)
    _writer(df, partition_by, cluster_by, checks).parquet(f"{path}/{_SNAPSHOT}{number}")
    held: dict[str, int] = {}
    if days is not None and lists:
        gone = set(map(_day_folder, days))
        held = {folder: n for folder, n in _days_of(spark, path, lists[-1]).items() if folder not in gone}
    for name in _children(spark, f"{path}/{_SNAPSHOT}{number}") or []:
        if name.startswith(f"{DAY}="):
            held[name] = number
    _list_days(spark, f"{path}/{_DAYS}{number}", held)


def _list_days(spark: SparkSession, at: str, days: dict[str, int]) -> None:
    folders = sorted(days)
    columns = [pa.array(folders, pa.string()), pa.array([days[f] for f in folders], pa.int32())]
    # from Arrow: local rows, no Python workers
    listed = spark.createDataFrame(pa.table(columns, ["folder", "snapshot"]))
    listed.coalesce(1).write.parquet(at)


def _writer(
    df: DataFrame, partition_by: str | None, cluster_by: Sequence[str], checks: WriteChecks | None = None
):
    if partition_by is not None:
        df = df.withColumn(DAY, F.to_date(partition_by))
    df = clustered(df, cluster_by, day=partition_by is not None)
    if checks is not None:
        df = checks.watch(df)
    return df.write if partition_by is None else df.write.partitionBy(DAY)


def write_full(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    snapshots: bool = False,
    checks: WriteChecks | None = None,
) -> None:
    """Replace the whole table.

    Day-partitioned tables, and others with ``snapshots``, are written to a new
    numbered folder that readers take once it is complete; the folders read
    from are never written to. ``checks`` are measured on the rows written.
    """
    if partition_by is not None:
        _put_days(df, path, None, partition_by, cluster_by, checks)
        return
    if snapshots:
        path = f"{path}/{_SNAPSHOT}{_next_number(df.sparkSession, path)}"
    writer = _writer(df, None, cluster_by, checks).mode("overwrite")
    writer.option("partitionOverwriteMode", "static").parquet(path)


def prune_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete what the newest ``keep`` states of the table do not use.

    Returns the numbers of the snapshots that are gone as a whole.
    """
    keep = max(keep, 1)
    lists = _numbers(spark, path, _DAYS)
    if not lists:
        old = _numbers(spark, path, _SNAPSHOT)[:-keep]
        for number in old:
            delete_path(spark, f"{path}/{_SNAPSHOT}{number}")
        return old
    used = {(folder, n) for number in lists[-keep:] for folder, n in _days_of(spark, path, number).items()}
    for number in lists[:-keep]:
        delete_path(spark, f"{path}/{_DAYS}{number}")
    gone = []
    for number in _numbers(spark, path, _SNAPSHOT, complete=False):
        if number >= lists[-1]:
            continue  # the newest state, or a write that goes on
        folders = [n for n in _children(spark, f"{path}/{_SNAPSHOT}{number}") or [] if n.startswith(f"{DAY}=")]
        unused = [n for n in folders if (n, number) not in used]
        if len(unused) == len(folders):
            delete_path(spark, f"{path}/{_SNAPSHOT}{number}")
            gone.append(number)
            continue
        for name in unused:
            delete_path(spark, f"{path}/{_SNAPSHOT}{number}/{name}")
    return gone


def merge_into(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    exclude: Sequence[str] = (),
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
    checks: WriteChecks | None = None,
) -> None:
    """Merge ``source``, best a written table, into the table at ``path``.

    Of a day-partitioned table only the touched days are read and replaced:
    the days of the source and, unless the partition column is a merge key,
    the days of the target rows that match, found on the key columns alone.
    Otherwise the merged table goes to a new snapshot.

    Source rows that share a key with each other and with a target row have
    no single result: ``on_duplicate="error"`` refuses them, ``"latest"`` first
    keeps the newest source row per complete key by ``latest_by``. ``checks``
    are measured where the whole table is written, not on single days.
    """
    spark = source.sparkSession
    if not target_exists(spark, path):
        write_full(source, path, partition_by, cluster_by, snapshots=partition_by is None, checks=checks)
        return
    if on_duplicate == "latest":
        complete = _all_present(keys)
        ties = [c for c in source.columns if c not in (*keys, *latest_by)]
        source = keep_latest(source.where(complete), keys, latest_by, tie_break=ties).unionByName(
            source.where(~complete)
        )
    schema = source.schema
    if partition_by is not None:
        schema = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    target = read_target(spark, path, schema, keep_day=True)
    if partition_by is not None:
        # One row per calendar day, so the lists stay small.
        days = {r[0] for r in source.select(F.to_date(partition_by)).distinct().collect()}
        if partition_by.lower() not in {k.lower() for k in keys}:
            days |= {r[0] for r in matched_rows(target, source, keys).select(DAY).distinct().collect()}
        touched = F.col(DAY).isin([d for d in days if d is not None])
        if None in days:
            touched = touched | F.col(DAY).isNull()
        target = target.where(touched)
    target = target.drop(DAY)
    if on_duplicate == "error" and not repeated_keys(source, keys).isEmpty():
        clash = duplicate_matches(target, source, keys).first()
        if clash is not None:
            raise ValueError(f"several source rows match one target row: {clash.asDict()}")
    merged = merge_upsert(target, source, keys, exclude)
    if partition_by is None:
        write_full(merged, path, partition_by, cluster_by, snapshots=True, checks=checks)
    elif days:
        _put_days(merged, path, days, partition_by, cluster_by)


def _all_present(keys: Sequence[str]):
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present
