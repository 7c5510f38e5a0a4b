import datetime

from tradeloom.config import Check
from tradeloom.operators import (
    WriteChecks,
    merge_into,
    null_violations,
    read_target,
    recency_violations,
    run_checks,
    unique_violations,
    value_violations,
    write_full,
)
from tradeloom.plans import FEEDS


def test_single_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, v int")
    assert rows(unique_violations(df, ["k", "v"])) == [("a", 1, 2)]
    assert null_violations(df, "k").count() == 1
    assert rows(value_violations(df, "k", ["b"])) == [("a", 2)]  # NULL passes


def test_recency(spark):
    day = datetime.datetime
    df = spark.createDataFrame([(day(2024, 1, 1),), (day(2024, 1, 5),), (day(2030, 1, 1),)], "t timestamp_ntz")
    assert recency_violations(df, "t", 1, "2024-01-06 00:00:00").isEmpty()
    stale = recency_violations(df, "t", 1, "2024-01-06 00:00:01").collect()
    assert [r.max_timestamp for r in stale] == [day(2024, 1, 5)]
    assert recency_violations(df.limit(0), "t", 1, "2024-01-06 00:00:00").count() == 1
    assert recency_violations(df, "t", 1).count() == 1  # against the clock


def test_suite_reports_every_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "brand string, v int")
    checks = [
        Check("unique", ("brand", "v")),
        Check("not_null", ("brand",)),
        Check("accepted", ("brand",), values=("Default",)),
        Check("recent", ("missing",), days=1),
    ]
    report = {(r["check"], r.failures, r.note) for r in run_checks(df, checks).collect()}
    assert report == {
        ("unique", 1, ""),
        ("not_null", 1, ""),
        ("accepted", 2, ""),
        ("recent", None, "no column missing"),
    }
    assert run_checks(df, []).isEmpty()


def test_declared_checks():
    kinds = [c.kind for f in FEEDS.values() for c in f.checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {"unique": 20, "not_null": 26, "accepted": 19, "recent": 19}


def test_suite_measured_by_the_write(spark, rows, tmp_path):
    day = datetime.datetime
    schema = "k string, v int, at timestamp_ntz"
    data = [("a", 1, day(2024, 1, 1)), ("a", 1, day(2024, 1, 1)), (None, 2, day(2024, 1, 2)), ("b", None, None)]
    df = spark.createDataFrame(data, schema)
    suite = [
        Check("unique", ("k", "v")),
        Check("not_null", ("k",)),
        Check("accepted", ("k",), values=("b",)),
        Check("recent", ("at",), days=1),
        Check("recent", ("missing",), days=1),
    ]
    now = "2024-01-05 00:00:00"
    for by, part in ((df, "at"), (df, None), (df.limit(0), "at")):
        path = f"{tmp_path}/{part}{by is df}"
        checks = WriteChecks(suite, now)
        assert checks.measured is None
        write_full(by, path, partition_by=part, checks=checks)
        written = read_target(spark, path, df.schema)
        assert set(checks.measured) == {"_check1", "_check2", "_check3"}
        assert rows(checks.report(written), "*") == rows(run_checks(by, suite, now), "*")
        # nothing but uniqueness reads the table
        others = WriteChecks([c for c in suite if c.kind != "unique"], now)
        write_full(by, f"{path}2", partition_by=part, checks=others)
        assert "FileScan" not in others.report(written)._jdf.queryExecution().executedPlan().toString()
    only_unique = WriteChecks(suite[:1], now)
    write_full(df, f"{tmp_path}/u", checks=only_unique)
    assert rows(only_unique.report(df), "failures") == [(1,)]


def test_a_merge_measures_whole_tables_only(spark, rows, tmp_path):
    day = datetime.datetime
    schema = "k string, v int, at timestamp_ntz"
    old = spark.createDataFrame([("a", None, day(2024, 1, 1)), ("b", 1, day(2024, 1, 2))], schema)
    new = spark.createDataFrame([("c", None, day(2024, 1, 2))], schema)
    suite = [Check("not_null", ("v",))]
    for part in (None, "at"):
        path = f"{tmp_path}/{part}"
        write_full(old, path, partition_by=part, snapshots=True)
        checks = WriteChecks(suite)
        merge_into(path, new, ["k"], partition_by=part, checks=checks)
        assert (checks.measured is None) == (part == "at")
        assert rows(checks.report(read_target(spark, path)), "failures") == [(2,)]
