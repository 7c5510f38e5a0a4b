import datetime
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import Config
from tradeloom.config import LOOKBACK_MS, Check
from tradeloom.operators import max_loaded, read_target, since
from tradeloom.plans import FEEDS, feed, run_all, run_feed
from tradeloom.session import shared_dir
from tradeloom.sources import RawSource
from tradeloom.streaming import refresh_stream

DAY_MS = 86_400_000
T0 = 1_700_000_000_000
ORDER = feed("ListOrder")


def raw_orders(spark, data):
    """``(order, purchase, status, batch)`` rows in the raw order layout."""
    schema = T.StructType.fromDDL(ORDER.raw_ddl)
    df = spark.createDataFrame(
        data, "AmazonOrderId string, PurchaseDate timestamp_ntz, OrderStatus string, _batch_runtime bigint"
    )
    have = set(df.columns)
    fill = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}
    fill |= {"marketplaceName": F.lit("m"), "sellingPartnerId": F.lit("s")}
    return df.withColumns(fill).select(*schema.names)


def source(spark, data, name="c.s.Acme_US_Hub_ListOrder"):
    return RawSource(name, frame=raw_orders(spark, data))


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def test_watermark_edges(spark, rows):
    df = spark.createDataFrame(
        [(1, None), (2, T0), (3, T0 - LOOKBACK_MS), (4, T0 - LOOKBACK_MS - 1)], "id int, _batch_runtime bigint"
    )
    assert max_loaded(df) == T0 - LOOKBACK_MS
    assert max_loaded(df.where("id = 1")) == 0 and max_loaded(None) == 0
    assert rows(since(df, max_loaded(df)), "id") == [(2,), (3,)]
    assert since(df, None).count() == 4


def test_runs_update_insert_and_replay(spark, rows, tmp_path):
    path = f"{tmp_path}/orders"
    first = [("o1", at(1), "new", T0), ("o2", at(2), "new", T0)]
    later = [*first, ("o1", at(1), "sent", T0 + DAY_MS), ("o3", at(2, 5), "new", T0 + DAY_MS)]
    run_feed(spark, ORDER, [source(spark, first)], path)
    for _ in range(2):
        run_feed(spark, ORDER, [source(spark, later)], path)
        assert rows(read_target(spark, path), "AmazonOrderId", "OrderStatus") == [
            ("o1", "sent"), ("o2", "new"), ("o3", "new"),
        ]


def test_rows_behind_the_look_back_are_not_read(spark, rows, tmp_path):
    path = f"{tmp_path}/orders"
    run_feed(spark, ORDER, [source(spark, [("o1", at(1), "new", T0)])], path)
    late = [
        ("o2", at(1), "edge", T0 - LOOKBACK_MS),
        ("o3", at(1), "late", T0 - LOOKBACK_MS - 1),
        ("o4", at(1), "no clock", None),
    ]
    run_feed(spark, ORDER, [source(spark, late)], path)
    assert rows(read_target(spark, path), "AmazonOrderId") == [("o1",), ("o2",)]
    run_feed(spark, ORDER, [source(spark, late)], path, full_refresh=True)
    assert read_target(spark, path).count() == 3


def test_same_key_from_two_brands(spark, tmp_path):
    path = f"{tmp_path}/orders"
    data = [("o1", at(1), "new", T0)]
    both = [source(spark, data), source(spark, data, "c.s.Globex_UK_Hub_ListOrder")]
    run_feed(spark, ORDER, both, path)
    assert read_target(spark, path).count() == 2
    with pytest.raises(ValueError, match="several source rows"):
        run_feed(spark, ORDER, both, path)
    run_feed(spark, ORDER, both, path, on_duplicate="latest")


def test_empty_source_list_then_data(spark, tmp_path):
    path = f"{tmp_path}/orders"
    run_feed(spark, ORDER, [], path)
    run_feed(spark, ORDER, [source(spark, [("o1", at(1), "new", T0)])], path)
    assert read_target(spark, path).count() == 1


def test_stream_takes_each_arrival_once_and_rereads_the_window(spark, rows, tmp_path):
    root, target, log = f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/log"
    raw = f"{root}/Acme_US_Hub_ListOrder"
    arrivals = [
        [("o1", at(1), "new", T0)],
        [("o1", at(1), "old news", T0 - DAY_MS), ("o2", at(1), "new", T0 + DAY_MS)],
    ]
    for data in arrivals:
        raw_orders(spark, data).write.mode("append").parquet(raw)
        refresh_stream(spark, ORDER, root, target, log).awaitTermination()
    # A batch that arrives late must not replace a newer one.
    assert rows(read_target(spark, target), "AmazonOrderId", "OrderStatus") == [("o1", "new"), ("o2", "new")]
    refresh_stream(spark, ORDER, root, target, log).awaitTermination()
    assert read_target(spark, target).count() == 2
    # A table of another brand that lands later belongs to the same stream.
    raw_orders(spark, [("o3", at(1), "new", T0 + DAY_MS)]).write.parquet(f"{root}/Globex_UK_Hub_LISTORDER")
    raw_orders(spark, [("o4", at(1), "new", T0 + DAY_MS)]).write.parquet(f"{root}/Globex_UK_Hub_Other")
    refresh_stream(spark, ORDER, root, target, log).awaitTermination()
    assert rows(read_target(spark, target), "AmazonOrderId", "brand") == [
        ("o1", "Acme"), ("o2", "Acme"), ("o3", "Globex")
    ]


def test_run_all_skips_disabled_feeds(spark, tmp_path):
    chosen = {n: FEEDS[n] for n in ("ListOrder", "AllListingsReport", "CatalogItems")}
    cfg = Config(out_dir=str(tmp_path), enabled={"CatalogItems": False})

    def find(like):
        return [source(spark, [("o1", at(1), "new", T0)])] if like == ORDER.like else []

    ended = run_all(spark, chosen, find, cfg)
    assert [(r.name, r.ok) for r in ended] == [("ListOrder", True), ("AllListingsReport", True)]
    assert read_target(spark, f"{tmp_path}/ListOrder").count() == 1


def test_run_all_goes_on_after_a_failed_feed(spark, tmp_path):
    chosen = {n: FEEDS[n] for n in ("AllListingsReport", "ListOrder", "CatalogItems")}

    def find(like):
        if like == FEEDS["AllListingsReport"].like:
            raise RuntimeError("no such place")
        return [source(spark, [("o1", at(1), "new", T0)])] if like == ORDER.like else []

    ended = {r.name: r for r in run_all(spark, chosen, find, Config(out_dir=str(tmp_path)))}
    assert ended["AllListingsReport"].error == "RuntimeError: no such place"
    assert ended["ListOrder"].ok and ended["CatalogItems"].ok
    with pytest.raises(ValueError, match="out_dir"):
        run_all(spark, chosen, find, Config())


def test_run_all_fails_feeds_by_severity(spark, tmp_path):
    def find(like):
        return [source(spark, [("o1", at(1), "new", T0)])]

    strict = replace(ORDER, checks=(Check("accepted", ("OrderStatus",), ("old",)), Check("unique", ("AmazonOrderId",))))
    mild = replace(ORDER, checks=(Check("accepted", ("OrderStatus",), ("old",), severity="warn"),))
    cfg = Config(out_dir=str(tmp_path))
    ended = run_all(spark, {"strict": strict, "mild": mild}, find, cfg, check=True)
    assert [(r.ok, r.failed_checks) for r in ended] == [(False, ("accepted(OrderStatus)",)), (True, ())]


def test_nothing_staged_is_left(spark, tmp_path):
    before = set(os.listdir(shared_dir(spark)))
    target = f"{tmp_path}/out"
    for _ in range(2):
        run_feed(spark, ORDER, [source(spark, [("o1", at(1), "new", T0)])], target, Config(hot_rows=0))
    twice = [source(spark, [("o1", at(1), "new", T0)]), source(spark, [("o1", at(1), "new", T0)])]
    with pytest.raises(ValueError):
        run_feed(spark, ORDER, twice, target)
    assert set(os.listdir(shared_dir(spark))) == before


def test_offsets_are_found_in_any_case():
    cfg = Config(convert_timezone=True, offset_hours={"Raw.Landing.Acme_US_X": -7})
    assert cfg.offset_for("raw.landing.acme_us_x") == -7 and cfg.offset_for("raw.landing.other") == 0


def test_a_run_without_new_rows_changes_nothing(spark, tmp_path):
    for name in ("ListOrder", "AllListingsReport"):
        path = f"{tmp_path}/{name}"
        sources = [source(spark, [("o1", at(1), "new", T0)])] if name == "ListOrder" else []
        run_feed(spark, feed(name), sources, path)
        run_feed(spark, feed(name), [], path)
        rows = read_target(spark, path, T.StructType.fromDDL("brand string"))
        assert rows.count() == len(sources)
