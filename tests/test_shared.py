"""Financial feeds from one scan beside the same feeds each on its own."""

import datetime
import json
import os
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import types as T

from tradeloom import Config
from tradeloom.demo import feed_queries
from tradeloom.operators import read_target
from tradeloom.plans import FEEDS, run_all, runner, shared
from tradeloom.plans.shared import merged_type, share, sharing
from tradeloom.session import shared_dir, stage, staged_tables
from tradeloom.sources import RawSource

T0 = 1_700_000_000_000
NAMES = [f"ListFinancialEvents{n}" for n in ("OrderFees", "OrderTaxes", "RefundTaxes", "ServiceFees")]
CHOSEN = {n: FEEDS[n] for n in NAMES}


def money(value):
    return [{"CurrencyCode": "USD", "CurrencyAmount": str(value)}]


def record(i, batch):
    """Some arrays are empty, some missing; a later batch has other amounts."""
    posted = {"PostedDate": f"2024-01-0{1 + i % 3}T10:00:00Z", "AmazonOrderId": f"o{i}", "MarketplaceName": "m"}
    taxes = [{"TaxesWithheld": [{"ChargeType": "t", "ChargeAmount": money(i + batch)}] * (i % 3)}]
    fees = [{"FeeType": f"f{k}", "FeeAmount": money(10 * i + k + batch)} for k in range(i % 4)]
    item = {"SellerSKU": f"s{i}", "QuantityShipped": "2"}
    orders = [{**posted, "ShipmentItemList": [{**item, "ItemFeeList": fees, "ItemTaxWithHeldList": taxes}, item][: i % 3]}]
    refunds = [{**posted, "ShipmentItemAdjustmentList": [{**item, "ItemTaxWithHeldList": taxes}]}]
    services = [{"FeeReason": f"r{i}", "SellerSKU": "s", "FeeList": [{"FeeType": "x", "FeeAmount": money(i)}] * (i % 2)}]
    return (
        json.dumps(orders) if i % 5 else None, json.dumps(refunds) if i % 4 else "[]", json.dumps(services),
        datetime.datetime(2024, 1, 1 + i % 3), None, "sp", "m", "mk", 1, T0 + batch, batch,
    )


DDL = (
    "ShipmentEventlist string, RefundEventlist string, ServiceFeeEventList string, RequestStartDate timestamp_ntz, RequestEndDate timestamp_ntz,"
    " sellingPartnerId string, marketplaceName string, marketplaceId string,"
    " _user_id bigint, _batch_runtime bigint, _batch_id bigint"
)


def raw(spark, batches):
    df = spark.createDataFrame([record(i, b) for i in range(12) for b in batches if (i + b) % 3], DDL)
    return [RawSource(f"c.s.{brand}_US_Hub_ListFinancialEvents", frame=df) for brand in ("Acme", "Globex")]


def test_equal_to_feeds_on_their_own(spark, rows, tmp_path, monkeypatch):
    scans = []

    def counted(real):
        return lambda *args, **named: scans.append(1) or real(*args, **named)

    monkeypatch.setattr(shared, "tagged_scan", counted(shared.tagged_scan))
    monkeypatch.setattr(runner, "tagged_scan", counted(runner.tagged_scan))
    found = {}
    for way in ("together", "alone"):
        cfg = Config(out_dir=f"{tmp_path}/{way}")
        if way == "alone":
            monkeypatch.setattr(runner, "_share", lambda *_: None)
        for batches in ([1], [1, 2]):  # a full write, then a merge
            scans.clear()
            ended = run_all(spark, CHOSEN, lambda like: raw(spark, batches), cfg)
            assert all(r.ok for r in ended) and [r.name for r in ended] == NAMES
            assert len(scans) == (1 if way == "together" else len(NAMES))
        for name in NAMES:
            found[way, name] = rows(read_target(spark, f"{tmp_path}/{way}/{name}").drop("_last_updated"))
    for name in NAMES:
        assert found["together", name] == found["alone", name] and len(found["alone", name]) > 10


def test_a_missing_field_fails_only_its_feeds(spark, tmp_path):
    def find(like):
        return [RawSource(s.name, frame=s.frame.drop("RefundEventlist")) for s in raw(spark, [1])]

    ended = {r.name: r for r in run_all(spark, CHOSEN, find, Config(out_dir=str(tmp_path)))}
    assert [n for n in NAMES if not ended[n].ok] == [NAMES[2]] and "RefundEventlist" in ended[NAMES[2]].error


def test_a_feed_reads_its_branch_only(spark):
    rows = share(spark, list(CHOSEN.values()), raw(spark, [1]), Config())
    assert rows.branches == {"ShipmentEventlist": 0, "RefundEventlist": 1, "ServiceFeeEventList": 2}
    assert rows.levels == {"ShipmentEventlist": 2, "RefundEventlist": 5, "ServiceFeeEventList": 3}
    df = runner.build(spark, CHOSEN[NAMES[0]], [], shared=rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_branch" in plan and plan.count("FileScan") == 1 and "TaxesWithheld" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_groups_and_types():
    groups = sharing(FEEDS)
    assert sorted(map(len, groups))[-2:] == [1, 9] and sum(map(len, groups)) == len(FEEDS)
    ddl = T.StructType.fromDDL
    both = merged_type(ddl("a array<struct<x:int,y:string>>"), ddl("A array<struct<Y:string,z:int>>, b int"))
    assert both == ddl("a array<struct<x:int,y:string,z:int>>, b int")
    with pytest.raises(ValueError, match="is read as int and as string"):
        merged_type(ddl("a int"), ddl("a string"))


def test_branches_are_written_without_sorting_the_rows(spark, monkeypatch):
    writers, name = [], "spark.sql.maxConcurrentOutputFileWriters"
    real = DataFrameWriter.parquet

    def parquet(self, *args, **named):
        writers.append(spark.conf.get(name, None))
        return real(self, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    before = spark.conf.get(name, None)
    share(spark, [FEEDS[n] for n in NAMES], raw(spark, [1]), Config())
    assert writers == ["3"]  # one file for each of the three arrays the feeds begin with
    assert spark.conf.get(name, None) == before


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def test_shuffle_files_end_with_their_query(spark, rows):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name, None)
    data = spark.createDataFrame([(i % 7 or None, i) for i in range(50)], "k int, v int").repartition(4, "k")
    with staged_tables(spark):
        gone = stage(data, "gone")
        kept = stage(gone.groupBy("k").agg({"v": "sum"}).toDF("k", "n"), "kept", keep=True, codec="zstd")
        for _ in range(100):  # files are removed in the background
            left = shuffle_files(spark) - before
            if not left:
                break
            time.sleep(0.1)
        assert not left
        folder = urlparse(gone.inputFiles()[0]).path.rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and spark.conf.get(name, None) == setting
    assert rows(kept) == [(None, 196)] + [(k, sum(i for i in range(50) if i % 7 == k)) for k in range(1, 7)]


def test_shared_feeds_are_written_one_after_the_other(spark):
    before = set(os.listdir(shared_dir(spark)))
    found = feed_queries.shared_feeds(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == len(feed_queries.EVENT_FEEDS)
    left = {n.split("-")[0] for n in set(os.listdir(shared_dir(spark))) - before}
    assert left == set(feed_queries.EVENT_FEEDS)  # raw rows and rates are gone
    assert {r.feed for r in found.select("feed").distinct().collect()} == set(feed_queries.EVENT_FEEDS)
