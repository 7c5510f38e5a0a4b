"""Tasks before a window do not grow with the table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import Config
from tradeloom.demo import raw
from tradeloom.operators.sequence import group_sizes
from tradeloom.plans import build, feed, runner
from tradeloom.sources import RawSource

T0 = 1_700_000_000_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def source(spark, item, rows):
    names = {"seller_sku": "string", "listing_id": "string", "ReferenceASIN": "string"}
    frame = spark.createDataFrame(rows, "k string, _batch_runtime bigint, _batch_id bigint")
    filled = {f.name: F.col("k") for f in T.StructType.fromDDL(item.raw_ddl).fields if f.name in names}
    for f in T.StructType.fromDDL(item.raw_ddl).fields:
        if f.name not in names and f.name not in frame.columns:
            filled[f.name] = F.lit(None).cast(f.dataType)
    return [RawSource("c.s.A_US_x", frame=frame.withColumns(filled).drop("k"))]


ROWS = [(str(i % 7), T0 + i, i) for i in range(40)]


def test_rows_are_dealt_before_they_are_unnested_and_sorted(spark, monkeypatch):
    monkeypatch.setattr(runner, "_TASK_RAW_ROWS", 10, raising=False)
    item = feed("CatalogItems")
    df = build(spark, item, source(spark, item, ROWS), Config())
    assert "RoundRobinPartitioning(5)" in plan_of(df)
    assert sorted(r._batch_id for r in df.collect()) == list(range(33, 40))


def test_a_window_has_as_many_tasks_as_its_rows_need(spark, monkeypatch):
    monkeypatch.setattr(runner, "_TASK_ROWS", 1, raising=False)
    item = feed("AllListingsReport")
    df = build(spark, item, source(spark, item, ROWS), Config())
    plan = plan_of(df)
    assert "41), REPARTITION_BY_NUM" in plan
    assert plan.index("WindowGroupLimit") < plan.index("REPARTITION_BY_NUM")  # sorted after the shuffle only
    assert sorted(r._batch_id for r in df.collect()) == list(range(33, 40))


def test_nested_values_are_decoded_once(spark):
    item, decoded = feed("ListFinancialEventsRefundTaxes"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def landed(i):
        decoded.add(1)
        return '[{"PostedDate": "2024-01-01T10:00:00Z", "AmazonOrderId": "o%d", "ShipmentItemAdjustmentList": [{}, {}]}]' % i

    frame = spark.range(6).select(
        landed.asNondeterministic()("id").alias("RefundEventlist"),
        F.lit(1).cast("bigint").alias("_user_id"),
        F.lit(T0).cast("bigint").alias("_batch_runtime"),
        F.col("id").alias("_batch_id"),
    )
    df = build(spark, item, [RawSource("c.s.A_US_x", frame=frame)], Config())
    assert sorted(r._seq_id for r in df.collect()) == [1] * 6 + [2] * 6
    assert decoded.value == 6  # not again for the largest group


def keyed(spark, item, rows, given):
    frame = spark.createDataFrame(rows, "k string, _batch_runtime bigint, _batch_id bigint")
    filled = {f.name: F.lit(None).cast(f.dataType) for f in T.StructType.fromDDL(item.raw_ddl).fields}
    filled = {n: c for n, c in filled.items() if n not in frame.columns}
    frame = frame.withColumns(filled | given).drop("k")
    return [RawSource("c.s.A_US_x", frame=frame), RawSource("c.s.B_UK_x", frame=frame.where("_batch_id < 0"))]


def offers(spark, item):
    boxes = F.expr("array(named_struct('LandedPrice', array(named_struct('CurrencyCode', k, 'Amount', '1'))))")
    summary = F.array(F.struct(F.lit("2").alias("TotalOfferCount"), boxes.alias("BuyBoxPrices")))
    summary = F.from_json(F.to_json(summary), T.StructType.fromDDL(item.nested_ddl)[0].dataType)
    # every seventh key is missing: 'N/A' is the large key
    return keyed(spark, item, ROWS, {"ASIN": F.when(F.col("k") != "0", F.col("k")), "itemCondition": F.col("k"), "Summary": summary})


def test_raw_rows_move_once_to_be_chosen_and_un_nested(spark, monkeypatch):
    monkeypatch.setattr(runner, "_TASK_ROWS", 1)
    item = feed("ListingOffersForASIN")
    df = build(spark, item, offers(spark, item), Config())
    plan = plan_of(df)
    assert plan.count("Exchange ") == 1  # one shuffle serves the choice and the window after it
    assert plan.rindex("WindowGroupLimit") < plan.index("41), REPARTITION_BY_NUM")  # no sort in the scan's tasks
    assert sorted(r._batch_id for r in df.collect()) == list(range(33, 40))


def test_rows_of_a_large_key_are_chosen_apart(spark):
    item = feed("ListingOffersForASIN")
    for hot_rows in (1, 5, 1000):
        rows = build(spark, item, offers(spark, item), Config(hot_rows=hot_rows)).collect()
        assert sorted((r.ASIN, r._batch_id) for r in rows) == sorted(
            ("N/A" if i % 7 == 0 else str(i % 7), i) for i in range(33, 40)
        )


def test_returns_are_not_sorted_before_they_move(spark, monkeypatch):
    monkeypatch.setattr(runner, "_TASK_ROWS", 1)
    item = feed("FlatFileReturnsReportByReturnDate")
    df = build(spark, item, keyed(spark, item, ROWS, {"Order_ID": F.col("k")}), Config())
    plan = plan_of(df)
    assert plan.rindex("WindowGroupLimit") < plan.index("41), REPARTITION_BY_NUM")
    assert sorted(r._batch_id for r in df.collect()) == list(range(33, 40))
    hot = build(spark, item, keyed(spark, item, ROWS, {"Order_ID": F.col("k")}), Config(hot_rows=1))
    assert sorted(r._batch_id for r in hot.collect()) == list(range(33, 40))


def test_orders_move_once_for_both_windows(spark):
    item = feed("ListOrder")
    day = F.expr("timestamp_ntz '2024-01-01 10:00:00' + make_interval(0, 0, 0, int(k))")
    df = build(spark, item, keyed(spark, item, ROWS, {"PurchaseDate": day, "AmazonOrderId": F.col("k"), "marketplaceName": F.col("k")}), Config())
    assert plan_of(df).count("Exchange ") == 1
    assert sorted(r._batch_id for r in df.collect()) == list(range(33, 40))


def test_the_largest_group_is_bounded_by_cells(spark):
    rows = spark.range(100).select((F.col("id") % 7).cast("string").alias("k"))
    assert group_sizes(rows, ["k"]) == (15, 100)
    largest, total = group_sizes(rows, ["k"], 1000)
    assert 15 <= largest <= 100 and total == 100
    assert group_sizes(rows, ["k"], 14) == (15, 100)  # too large a cell: the keys are counted
    assert group_sizes(rows.where("false"), ["k"], 5) == (0, 0)


def test_elements_of_an_array_are_looked_up(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (-1,), (None,)], "k long")
    made = rows.select(raw._array(F.col("k"), {0: None, 1: 0, 2: 2, 3: 1, 4: 3}, lambda e: e + 5).alias("x"))
    assert [r.x for r in made.collect()] == [None, [], [5, 6], [5], [5, 6, 7], None, None]
    paid = rows.select(raw._money(F.col("k") > 2, F.lit("USD"), F.col("k"), "Amount").alias("x"))
    assert [r.x and r.x[0].asDict() for r in paid.collect() if r.x] == [{"CurrencyCode": "USD", "Amount": a} for a in "34"]
    assert "slice(" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_columns_of_one_table_are_made_before_the_join(spark):
    events = raw._raw_events(spark, "/root/testdata/sf0.001", feed("ListFinancialEventsOrderTaxes"))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.rindex("Join LeftOuter")
    for made in ("% 11)", "INTERVAL '01' HOUR"):
        assert plan.index(made) > joined
