import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import Config
from tradeloom.operators import run_checks
from tradeloom.plans import FEEDS, build, feed
from tradeloom.plans.runner import _final_stage
from tradeloom.sources import RawSource

# Business columns per feed.
WIDTHS = {
    "AllListingsReport": 42, "CatalogItems": 29, "FBAAmazonFulfilledShipmentsReport": 54,
    "FBAManageInventory": 29, "FBAManageInventoryHealthReport": 67, "FBAReturnsReport": 19,
    "FlatFileAllOrdersReportByLastUpdate": 49, "FlatFileReturnsReportByReturnDate": 40,
    "InventoryLedgerDetailedReport": 18, "ListFinancialEventsServiceFees": 14, "ListOrder": 42,
    "ListingOffersForASIN": 21, "SalesAndTrafficReportByChildASIN": 32,
}


def raw(spark, name, data, columns):
    """Raw rows of a feed; columns not given are NULL."""
    schema = T.StructType.fromDDL(feed(name).raw_ddl)
    df = spark.createDataFrame(data, columns)
    have = {c.lower() for c in df.columns}
    missing = [f for f in schema.fields if f.name.lower() not in have]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def test_layouts():
    assert len(FEEDS) == 21
    for name, item in FEEDS.items():
        assert len(item.columns) == WIDTHS.get(name, 8)
        names = [c.lower() for c in item.column_names()]
        assert len(set(names)) == len(names)
        assert {k.lower() for k in (*item.merge_keys, *item.merge_exclude, *item.cluster_by)} <= set(names)
        assert item.partition_by is None or item.partition_by.lower() in names


def test_matches_stay_in_their_day_but_for_three_feeds():
    moving = {n for n, f in FEEDS.items() if not f.partition_in_key}
    assert moving == {"AllListingsReport", "CatalogItems", "ListingOffersForASIN"}


def test_implied_stages_are_dropped():
    name = "FlatFileReturnsReportByReturnDate"
    assert len(feed(name).latest) == 2 and len(_final_stage(feed(name))) == 1
    # rows are numbered between the two stages of this feed
    assert len(_final_stage(feed("FlatFileAllOrdersReportByLastUpdate"))) == 2


@pytest.mark.parametrize("hot_rows", [10**9, 0])
def test_all_orders_are_numbered_before_the_last_stage(spark, hot_rows):
    name = "FlatFileAllOrdersReportByLastUpdate"
    day = datetime.datetime
    frame = raw(
        spark, name,
        [("o", day(2024, 1, 1), day(2024, 1, 5), 1, 1), ("o", day(2024, 1, 1), day(2024, 1, 3), 2, 2),
         ("o", day(2024, 1, 1), day(2024, 1, 3), 1, 3), ("p", day(2024, 1, 1), day(2024, 1, 3), 1, 4)],
        "amazon_order_id string, purchase_date timestamp_ntz, last_updated_date timestamp_ntz,"
        " _batch_runtime bigint, quantity bigint",
    )
    df = build(spark, feed(name), [RawSource("c.s.A_US_x", frame=frame)], Config(hot_rows=hot_rows))
    got = sorted((r.amazon_order_id, r.last_updated_date.day, r.quantity, r._seq_id) for r in df.collect())
    assert got == [("o", 5, 1, 2), ("p", 3, 4, 1)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_nested_fields_of_other_types(spark, zone):
    """Stored doubles round, stored instants become UTC wall clock."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.sql(
            "SELECT array(named_struct('PostedDate', timestamp_seconds(1704103200), 'AmazonOrderId', 'o',"
            " 'MarketplaceName', 'm', 'ShipmentItemList', array(named_struct('SellerSKU', 's', 'QuantityShipped',"
            " 1.6D, 'ItemFeeList', array(named_struct('FeeType', 'f', 'FeeAmount',"
            " array(named_struct('CurrencyCode', 'USD', 'CurrencyAmount', 2.5D)))))))) AS ShipmentEventlist,"
            " 1L AS _user_id, 5L AS _batch_runtime, 1L AS _batch_id"
        )
        row = build(spark, feed("ListFinancialEventsOrderFees"), [RawSource("c.s.A_US_x", frame=frame)]).first()
        found = row.asDict()
        posted = next(v for k, v in found.items() if k.endswith("PostedDate"))
        quantity = next(v for k, v in found.items() if k.endswith("QuantityShipped"))
        assert posted == datetime.datetime(2024, 1, 1, 10) and quantity == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_broken_json_is_an_error(spark):
    frame = spark.createDataFrame(
        [('[{"PostedDate": "2024-01-01', 1, 5, 1)],
        "ShipmentEventlist string, _user_id bigint, _batch_runtime bigint, _batch_id bigint",
    )
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        build(spark, feed("ListFinancialEventsOrderFees"), [RawSource("c.s.A_US_x", frame=frame)]).collect()


def test_keep_latest_is_per_source(spark):
    frame = raw(spark, "AllListingsReport", [("s", "l", 5)], "seller_sku string, listing_id string, _batch_runtime bigint")
    older = raw(spark, "AllListingsReport", [("s", "l", 4)], "seller_sku string, listing_id string, _batch_runtime bigint")
    df = build(
        spark, feed("AllListingsReport"),
        [RawSource("c.s.A_US_x", frame=frame), RawSource("c.s.B_UK_x", frame=older)],
    )
    assert sorted((r.brand, r.store, r._batch_runtime) for r in df.collect()) == [("A", "US", 5), ("B", "UK", 4)]


def test_channel_filter_drops_null_too(spark):
    name = "FBAAmazonFulfilledShipmentsReport"
    data = [("a", "Web"), ("b", "Non-Amazon"), ("c", None)]
    frame = raw(spark, name, data, "sku string, sales_channel string")
    df = build(spark, feed(name), [RawSource("c.s.A_US_x", frame=frame)])
    assert [r.sku for r in df.collect()] == ["a"]


def test_shift_only_where_the_offset_is_live(spark):
    cfg = Config(convert_timezone=True, offset_hours={"c.s.A_US_x": -7})
    moment = datetime.datetime(2024, 3, 10, 0, 30)
    for name, column, moved in (("ListOrder", "PurchaseDate", True), ("FBAManageInventory", "ReportstartDate", False)):
        frame = raw(spark, name, [(moment,)], f"{column} timestamp_ntz")
        for source, here in (("c.s.A_US_x", moved), ("c.s.B_US_x", False)):
            got = build(spark, feed(name), [RawSource(source, frame=frame)], cfg).first()[column]
            assert got == (moment - datetime.timedelta(hours=7) if here else moment)


def test_rate_date_is_taken_before_the_shift(spark):
    name = "FlatFileAllOrdersReportByLastUpdate"
    cfg = Config(convert_timezone=True, convert_currency=True, offset_hours={"c.s.A_US_x": -7})
    rates = spark.sql(
        "SELECT date'2024-03-10' AS date, 'EUR' AS from_currency_code, 'USD' AS to_currency_code, 2 AS value"
    )
    frame = raw(spark, name, [(datetime.datetime(2024, 3, 10, 0, 30), "USD")], "purchase_date timestamp_ntz, currency string")
    row = build(spark, feed(name), [RawSource("c.s.A_US_x", frame=frame)], cfg, rates).first()
    assert (row.purchase_date.day, row.exchange_currency_rate, row.exchange_currency_code) == (9, 2, "EUR")


def test_json_text_feeds_like_nested_arrays(spark):
    name = "ListFinancialEventsOrderFees"
    events = (
        '[{"PostedDate":"2024-01-01T00:00:00Z","AmazonOrderId":"o","MarketplaceName":"m","ShipmentItemList":'
        '[{"SellerSKU":"s","QuantityShipped":"2","ItemFeeList":[{"FeeType":"f","FeeAmount":'
        '[{"CurrencyCode":"USD","CurrencyAmount":"1.5"}]},{"FeeType":"g","FeeAmount":[]}]}]}]'
    )
    frame = spark.createDataFrame(
        [(events, 1, 5, 1), (None, 1, 5, 2)],
        "ShipmentEventlist string, _user_id bigint, _batch_runtime bigint, _batch_id bigint",
    )
    df = build(spark, feed(name), [RawSource("c.s.A_US_x", frame=frame)])
    got = {(r.ItemFeeList_FeeType, r.FeeAmount_CurrencyCode, r._seq_id) for r in df.collect()}
    assert got == {("f", "USD", 1), ("g", None, 2), (None, None, 1)}


def test_literal_na_and_null_brand_are_two_catalog_keys(spark):
    name = "CatalogItems"
    frame = spark.sql(
        "SELECT 'r' AS ReferenceASIN, array(named_struct('brand', b)) AS summaries FROM VALUES ('N/A'), (NULL) AS t(b)"
    )
    ddl = T.StructType.fromDDL(feed(name).raw_ddl)
    summary = next(f for f in ddl.fields if f.name == "summaries").dataType
    full = F.transform(
        "summaries",
        lambda s: F.struct(
            *[
                (s["brand"] if f.name == "brand" else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in summary.elementType.fields
            ]
        ),
    )
    missing = [f for f in ddl.fields if f.name not in ("ReferenceASIN", "summaries")]
    frame = frame.withColumn("summaries", full).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in missing}
    )
    df = build(spark, feed(name), [RawSource("c.s.A_US_x", frame=frame)])
    assert [r.summaries_brandName for r in df.collect()] == ["N/A", "N/A"]


@pytest.mark.parametrize("name", ["FBAReturnsReport", "ListFinancialEventsServiceFees", "AllListingsReport"])
def test_hot_and_plain_plans_agree(spark, name):
    from tradeloom.demo import raw as shapes

    sources = shapes.sources(spark, "/root/testdata/sf0.001", name)
    plain, hot = (
        build(spark, feed(name), sources, Config(hot_rows=n)).drop("_last_updated") for n in (10**9, 1)
    )
    assert plain.count() == hot.count()
    assert plain.exceptAll(hot).isEmpty()


def test_latest_row_feeds_pass_their_key_check(spark):
    from tradeloom.demo import raw as shapes

    df = build(spark, feed("ListOrder"), shapes.sources(spark, "/root/testdata/sf0.001", "ListOrder"))
    report = {(r["check"], r["columns"]): r for r in run_checks(df, feed("ListOrder"), "2001-08-01 00:00:00").collect()}
    assert report["not_null", "AmazonOrderId"].failures == 0
    assert report["accepted", "brand"].failures == df.count()
