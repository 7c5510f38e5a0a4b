import contextlib
import datetime
import os

import pytest
from pyspark.sql import functions as F


from tradeloom.operators import (
    footer_watermark,
    loaded_at,
    max_loaded,
    merge_bucketed,
    merge_into,
    merge_upsert,
    prune_versions,
    read_target,
    sink,
    target_exists,
    write_bucketed,
    write_full,
)
from tradeloom.operators.sink import DAY, prune_snapshots

D = datetime.datetime
DDL = "k string, at timestamp_ntz, v int, keep int"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


@pytest.fixture
def target(spark):
    return frame(spark, [("a", D(2024, 1, 1), 1, 1), ("b", D(2024, 1, 2), 1, 1), (None, D(2024, 1, 3), 1, 1)])


def test_upsert(spark, target, rows):
    source = frame(spark, [("a", D(2024, 1, 1), 2, 2), ("c", D(2024, 1, 4), 2, 2), (None, D(2024, 1, 3), 2, 2)])
    assert rows(merge_upsert(target, source, ["k"]), "k", "v") == [
        (None, 1), (None, 2), ("a", 2), ("b", 1), ("c", 2),
    ]
    held = merge_upsert(target, source, ["k"], exclude=["KEEP"])
    assert rows(held, "k", "v", "keep") == [
        (None, 1, 1), (None, 2, 2), ("a", 2, 1), ("b", 1, 1), ("c", 2, 2),
    ]


@pytest.mark.parametrize("exclude", [(), ("v",)])
def test_all_target_rows_of_a_key_are_updated(spark, rows, exclude):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    source = spark.createDataFrame([("a", 9), ("c", 8), (None, 7)], "k string, v int")
    got = rows(merge_upsert(target, source, ["k"], exclude))
    a = [("a", 1), ("a", 2)] if exclude else [("a", 9), ("a", 9)]
    assert got == sorted([*a, ("b", 3), (None, 4), ("c", 8), (None, 7)], key=lambda r: [(v is not None, str(v)) for v in r])


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def current(spark, path):
    return set(read_target(spark, path).inputFiles())


def test_local_merge_rewrites_only_touched_days(spark, target, rows, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(path, target, ["k", "at"], partition_by="at", cluster_by=["k"])
    before = current(spark, path)
    source = frame(spark, [("a", D(2024, 1, 1), 9, 9), ("z", D(2024, 1, 1), 9, 9)])
    merge_into(path, source, ["k", "at"], partition_by="at", cluster_by=["k"])
    kept = before & current(spark, path)
    assert len(kept) == 2 and not any("2024-01-01" in f for f in kept)
    assert rows(read_target(spark, path), "k", "v") == [(None, 1), ("a", 9), ("b", 1), ("z", 9)]


def test_a_run_that_breaks_off_loses_nothing(spark, target, rows, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    merge_into(path, target, ["k"], partition_by="at")
    source = frame(spark, [("a", D(2024, 5, 5), 7, 7), ("b", D(2024, 1, 2), 8, 8)])
    with monkeypatch.context() as broken:
        broken.setattr(sink, "_list_days", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_into(path, source, ["k"], partition_by="at")
        with pytest.raises(ZeroDivisionError):
            write_full(source, path, partition_by="at")
    assert rows(read_target(spark, path), "k", "v") == [(None, 1), ("a", 1), ("b", 1)]
    os.makedirs(f"{path}/days=3")  # a list of days without its end is not read
    merge_into(path, source, ["k"], partition_by="at")
    assert rows(read_target(spark, path), "k", "v") == [(None, 1), ("a", 7), ("b", 8)]


def test_days_without_a_list_are_not_merged_into(spark, target, tmp_path):
    path = f"{tmp_path}/t"
    target.withColumn(DAY, F.to_date("at")).write.partitionBy(DAY).parquet(path)
    with pytest.raises(ValueError, match="full refresh"):
        merge_into(path, target, ["k"], partition_by="at")
    write_full(target, path, partition_by="at")
    merge_into(path, target, ["k"], partition_by="at")
    assert read_target(spark, path).count() == 4


def test_old_days_stay_until_pruned(spark, target, rows, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(path, target, ["k"], partition_by="at")
    begun = read_target(spark, path)
    merge_into(path, frame(spark, [("a", D(2024, 1, 1), 2, 2)]), ["k"], partition_by="at")
    assert prune_snapshots(spark, path) == []  # the state before is kept
    assert rows(begun, "k", "v") == [(None, 1), ("a", 1), ("b", 1)]
    merge_into(path, frame(spark, [("b", D(2024, 1, 2), 3, 3)]), ["k"], partition_by="at")
    os.makedirs(f"{path}/snapshot=9")  # a write that goes on is left alone
    assert prune_snapshots(spark, path, keep=1) == []
    assert sorted(f.split("/")[-2] for f in files(path) if "snapshot=1/" in f) == [f"{DAY}=2024-01-03"]
    assert rows(read_target(spark, path), "k", "v") == [(None, 1), ("a", 2), ("b", 3)]
    write_full(target, path, partition_by="at")
    assert prune_snapshots(spark, path, keep=1) == [1, 2, 3, 9]
    assert rows(read_target(spark, path), "k", "v") == [(None, 1), ("a", 1), ("b", 1)]
    write_full(target.where("false"), path, partition_by="at")
    assert target_exists(spark, path) and read_target(spark, path, target.schema).count() == 0
    merge_into(path, target, ["k"], partition_by="at")
    assert read_target(spark, path).count() == 3


def test_full_refresh_replaces_all_days(spark, target, rows, tmp_path):
    path = f"{tmp_path}/t"
    write_full(target, path, partition_by="at")
    write_full(frame(spark, [("x", D(2024, 1, 2), 3, 3), ("y", None, 3, 3)]), path, partition_by="at")
    assert rows(read_target(spark, path), "k", "v") == [("x", 3), ("y", 3)]
    assert sorted(f.split("/")[-2] for f in current(spark, path)) == [
        f"{DAY}=2024-01-02", f"{DAY}=__HIVE_DEFAULT_PARTITION__"
    ]


def test_local_merge_of_a_missing_day_appends(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    lost = frame(spark, [("a", None, 1, 1)])
    merge_into(path, lost, ["k", "at"], partition_by="at")
    merge_into(path, lost, ["k", "at"], partition_by="at")
    assert rows(read_target(spark, path), "k", "at", "v") == [("a", None, 1), ("a", None, 1)]


def test_match_in_another_day_moves_the_row(spark, target, rows, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(path, target, ["k"], partition_by="at")
    before = current(spark, path)
    moved = frame(spark, [("a", D(2024, 5, 5), 7, 7)])
    merge_into(path, moved, ["k"], partition_by="at")
    stored = read_target(spark, path, keep_day=True)
    assert rows(stored, "k", "v") == [(None, 1), ("a", 7), ("b", 1)]
    assert {str(r[0]) for r in stored.select(DAY).collect()} == {"2024-01-02", "2024-01-03", "2024-05-05"}
    kept = before & current(spark, path)
    assert len(kept) == 2 and not any("2024-01-01" in f or "2024-05-05" in f for f in kept)


def test_unpartitioned_merge_keeps_snapshots_until_pruned(spark, target, rows, tmp_path):
    path = f"{tmp_path}/t"
    for v in (2, 3, 4):
        merge_into(path, frame(spark, [("a", None, v, v)]), ["k"], cluster_by=["k"])
    os.makedirs(f"{path}/snapshot=9")  # an unfinished write is not read
    assert rows(read_target(spark, path), "k", "v") == [("a", 4)]
    assert prune_snapshots(spark, path) == [1]
    merge_into(path, frame(spark, [("a", None, 5, 5)]), ["k"])
    assert rows(read_target(spark, path), "k", "v") == [("a", 5)]


def test_repeated_source_keys(spark, target, rows, tmp_path):
    path = f"{tmp_path}/t"
    merge_into(path, target, ["k"])
    fresh = frame(spark, [("n", None, 1, 1), ("n", None, 2, 2), (None, None, 1, 1), (None, None, 2, 2)])
    merge_into(path, fresh, ["k"])  # no match: both rows are inserted
    assert read_target(spark, path).count() == 7
    clash = frame(spark, [("a", None, 5, 5), ("a", None, 6, 6)])
    with pytest.raises(ValueError, match="several source rows"):
        merge_into(path, clash, ["k"])
    merge_into(path, clash, ["k"], on_duplicate="latest", latest_by=["v"])
    assert rows(read_target(spark, path).where("k = 'a'"), "v") == [(6,)]


def test_full_write_replaces_and_clusters(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not target_exists(spark, path)
    write_full(spark.range(10).selectExpr("id", "id AS c"), path)
    df = spark.range(20_000).selectExpr("id", "pmod(hash(id), 1000) AS c")
    write_full(df, path, cluster_by=["c"])
    assert target_exists(spark, path) and read_target(spark, path).count() == 20_000
    ranges = sorted(
        (r.lo, r.hi)
        for r in read_target(spark, path)
        .selectExpr("c", "_metadata.file_name AS f")
        .groupBy("f")
        .agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
        .collect()
    )
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_hot_day_is_split_into_sorted_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(0, 60_000, 1, 8).selectExpr(
        "id",
        "pmod(hash(id), 1000) AS c",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(if(id % 3 < 2, 0, id % 20)) AS at",
    )
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(conf, "100k")
    try:
        write_full(df, path, partition_by="at", cluster_by=["c"])
    finally:
        spark.conf.unset(conf)
    assert len([f for f in files(path) if "_day=2024-01-01" in f]) > 2
    for name in [f for f in files(path) if "_day=" in f][:5]:
        values = [r.c for r in spark.read.parquet(name).coalesce(1).select("c").collect()]
        assert values == sorted(values)
    assert read_target(spark, path).count() == 60_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_is_one_join(spark, rows):
    target = spark.createDataFrame([(i, None if i % 9 == 0 else i, "t") for i in range(500)], "at int, k int, v string")
    source = spark.createDataFrame([(i, None if i % 7 == 0 else 2 * i, "s") for i in range(500)], "at int, K int, v string")
    merged = merge_upsert(target, source, ["k"], exclude=["at"])
    plan = _plan(merged)
    assert plan.count("Join ") == 1 and plan.count("Exchange hashpartitioning") == 2
    new = {2 * i: i for i in range(500) if i % 7}
    want = [(i, i, "s" if i in new else "t") for i in range(500) if i % 9]
    want += [(i, None, "t") for i in range(500) if i % 9 == 0] + [(i, None, "s") for i in range(500) if i % 7 == 0]
    old = {i for i in range(500) if i % 9}
    want += [(i, k, "s") for k, i in new.items() if k not in old]
    got = [(r.at, r.k, r.v) for r in merged.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    with pytest.raises(ValueError, match="differ in the columns"):
        merge_upsert(target, source.drop("v"), ["k"])


def test_bucketed_target_is_not_shuffled(spark, rows, tmp_path):
    name, folder = "bucketed_t", str(tmp_path)
    target = spark.createDataFrame([(f"k{i}", i, "t") for i in range(300)] + [(None, 1, "t")], "k string, d int, v string")
    write_bucketed(target, name, ["k", "d"], 4, folder)
    source = spark.createDataFrame([(f"k{i}", i, "s") for i in range(200, 400)] + [(None, 1, "s")], "k string, d int, v string")
    with spark_conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = _plan(merge_upsert(spark.table(name), source, ["k", "d"]))
    assert "Bucketed: true" in plan and plan.count("Exchange ") == 1 and "Exchange hashpartitioning(_source0" in plan
    for _ in range(2):
        merge_bucketed(name, source, ["k", "d"], 4, folder, exclude=["v"])
    got = rows(spark.table(name))
    want = [(f"k{i}", i, "t") for i in range(300)] + [(f"k{i}", i, "s") for i in range(300, 400)]
    assert [r for r in got if r[0]] == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert [r[2] for r in got if r[0] is None] == ["s", "s", "t"]
    assert prune_versions(spark, name, folder, keep=1) == [1, 2] and spark.table(name).count() == 403
    clash = spark.createDataFrame([("k1", 1, "a"), ("k1", 1, "b")], "k string, d int, v string")
    with pytest.raises(ValueError, match="several source rows"):
        merge_bucketed(name, clash, ["k", "d"], 4, folder)
    spark.sql(f"DROP VIEW {name}")
    spark.sql(f"DROP TABLE {name}__v3")


@contextlib.contextmanager
def spark_conf(spark, key, value):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    yield
    spark.conf.set(key, before)


def test_watermark_from_footers(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id * 10000000 AS _batch_runtime", "id % 3 AS day", "'x' AS wide")
    rows.write.partitionBy("day").parquet(f"{tmp_path}/t")
    found = footer_watermark(spark, f"{tmp_path}/t", 1000)
    assert "PushedAggregation: [MAX(_batch_runtime)]" in _plan(found)
    assert found.first()["max_loaded"] == 999 * 10000000 - 1000 == max_loaded(spark.read.parquet(f"{tmp_path}/t"), 1000)
    spark.sql("SELECT CAST(NULL AS BIGINT) AS _batch_runtime, 1L AS day").write.mode("append").partitionBy("day").parquet(f"{tmp_path}/t")
    assert loaded_at(spark, f"{tmp_path}/t", 1000) == 999 * 10000000 - 1000  # a file without statistics
    rows.where("false").drop("day").write.parquet(f"{tmp_path}/none")
    assert footer_watermark(spark, f"{tmp_path}/none").first()["max_loaded"] == 0
