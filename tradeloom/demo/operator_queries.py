"""Every operator over the test tables, each beside the SQL for the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import functions as fn
from tradeloom import operators as ops
from tradeloom.config import BATCH_ID, BATCH_RUNTIME, Check, Config
from tradeloom.demo import raw
from tradeloom.demo.feed_queries import comparable
from tradeloom.operators.incremental import watermark
from tradeloom.operators.sink import DAY
from tradeloom.plans import build, feed, run_feed
from tradeloom.session import scratch_path
from tradeloom.sources import (
    RawSource,
    consolidate,
    discover_names,
    discover_paths,
    normalize_lineage,
    stamp,
    tag_columns,
)
from tradeloom.streaming import refresh_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql.strip()
        return query

    return keep


# Inputs as SQL both engines read -------------------------------------------

ORDERS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus || '-' || CAST(b.b AS STRING) AS status,"
    " o_totalprice + b.b AS amount, o_orderdate, b.b AS b, " + raw.lineage("o_orderkey")
    + f" FROM {{orders}} JOIN {raw.BATCHES} ON b.k = o_orderkey % 3"
)
# The same batches 20 days apart: the first is older than the look-back.
SPREAD = (
    "SELECT o_orderkey, CAST(1700000000000 + CAST(b.b AS BIGINT) * 1728000000 AS BIGINT)"
    f" AS _batch_runtime FROM {{orders}} JOIN {raw.BATCHES} ON b.k = o_orderkey % 3"
)
LINES = (
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,"
    f" l_returnflag, l_shipdate, {raw.lineage('l_orderkey')}"
    f" FROM {{lineitem}} JOIN {raw.BATCHES} ON b.k = l_orderkey % 3"
)
LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice".split()
LINE_TIES = "l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_returnflag l_shipdate"
LINE_TIE_SQL = ", ".join(f"{c} NULLS FIRST" for c in LINE_TIES.split())
NAMES = (
    "SELECT 'lake.raw.Brand' || CAST(s_suppkey AS STRING) || '_N' || CAST(s_nationkey AS STRING)"
    " || '_Hub_' || CASE s_suppkey % 4 WHEN 0 THEN 'ListOrder' WHEN 1 THEN 'FBAManageInventory'"
    " WHEN 2 THEN 'FBAManageInventoryHealthReport' ELSE 'LISTORDER' END AS name FROM {supplier}"
)
PAID = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate,"
    f" {raw.CURRENCY} AS currency FROM {{lineitem}}"
)
# Orders on event days: few enough days for a day-partitioned table.
EVENT_ORDERS = (
    "SELECT ts AS PurchaseDate, ts + b.b * INTERVAL '1' DAY AS LastUpdateDate,"
    " CAST(event_id AS STRING) AS AmazonOrderId, event_type AS marketplaceName,"
    " 'SP' || CAST(event_id % 2 AS STRING) AS sellingPartnerId,"
    " event_type || '-' || CAST(b.b AS STRING) AS OrderStatus,"
    " user_id AS NumberOfItemsShipped, b.b AS b, " + raw.lineage("event_id")
    + f" FROM {{events}} JOIN {raw.BATCHES} ON b.k = event_id % 3"
)


def _duck(sql: str) -> str:
    return f"({raw.duck(sql)})"


# Sources --------------------------------------------------------------------


@_register(
    "discover_sources",
    f"""SELECT name AS tables, lower(name) AS tables_lowercase FROM {_duck(NAMES)} AS n
    WHERE lower(split_part(name, '.', 3)) LIKE '%fbamanageinventory'
    UNION ALL SELECT name, lower(name) FROM {_duck(NAMES)} AS n
    WHERE lower(split_part(name, '.', 3)) LIKE '%listorder'""",
)
def discover_sources(spark, sf_dir):
    names = raw.run_sql(spark, sf_dir, NAMES)
    return discover_names(names, "%fbamanageinventory").unionByName(
        discover_names(names, "%listorder")
    )


@_register(
    "tag_source",
    f"""SELECT name, split_part(split_part(name, '.', 3), '_', 1) AS brand,
    split_part(split_part(name, '.', 3), '_', 2) AS store, 'none' AS default_brand
    FROM {_duck(NAMES)} AS n""",
)
def tag_source(spark, sf_dir):
    brand, store = tag_columns("name", Config())
    default, _ = tag_columns("name", Config(brand_from_name=False, default_brand="none"))
    return raw.run_sql(spark, sf_dir, NAMES).select(
        "name", brand.alias("brand"), store.alias("store"), default.alias("default_brand")
    )


@_register(
    "normalize_lineage",
    f"SELECT o_orderkey, _user_id, _batch_runtime, _batch_id FROM {_duck(ORDERS)} AS o",
)
def lineage_names(spark, sf_dir):
    spelled = raw.run_sql(spark, sf_dir, ORDERS).select(
        "o_orderkey",
        F.col("_user_id").alias("_conn_user_id"),
        F.col("_batch_runtime").alias("CONN_batch_runtime"),
        F.col("_batch_id").alias("_conn_batch_id"),
    )
    return normalize_lineage(spelled, "conn")


@_register(
    "stamp_audit",
    f"SELECT o_orderkey, b, 'run-7' AS _run_id, TRUE AS stamped FROM {_duck(ORDERS)} AS o",
)
def stamp_audit(spark, sf_dir):
    stamped = stamp(raw.run_sql(spark, sf_dir, ORDERS), "run-7")
    return stamped.select("o_orderkey", "b", "_run_id", F.expr("_last_updated is not null").alias("stamped"))


@_register(
    "consolidate_union",
    f"SELECT o_orderkey, status, amount, src FROM {_duck(ORDERS)} AS o",
)
def consolidate_union(spark, sf_dir):
    orders = raw.run_sql(spark, sf_dir, ORDERS).select("o_orderkey", "status", "amount", "src")
    frames = [orders.where(F.col("src") == i) for i in (0, 1)]
    frames[1] = frames[1].select("src", "amount", "status", "o_orderkey")
    schema = orders.schema
    return consolidate(spark, [*frames, consolidate(spark, [], schema)], schema)


# Projections and filters ------------------------------------------------------


@_register(
    "project_columns",
    "SELECT o_orderkey AS order_id, o_orderstatus AS order_status FROM orders",
)
def project_columns(spark, sf_dir):
    orders = raw.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("order_status")
    )


@_register("star_except", "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders")
def star_except(spark, sf_dir):
    return ops.star_except(raw.table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderdate"])


KEYS = (
    f"SELECT l_orderkey, l_linenumber, {raw.holes('CAST(l_partkey AS STRING)', 'l_partkey', 10)}"
    " AS sku, CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS quantity"
    " FROM {lineitem}"
)


@_register(
    "default_keys",
    f"""SELECT l_orderkey, l_linenumber, COALESCE(sku, 'N/A') AS sku,
    COALESCE(quantity, 0) AS quantity FROM {_duck(KEYS)} AS k""",
)
def default_keys(spark, sf_dir):
    return raw.run_sql(spark, sf_dir, KEYS).select(
        "l_orderkey",
        "l_linenumber",
        fn.default_key("sku").alias("sku"),
        fn.default_key("quantity", 0).alias("quantity"),
    )


CHANNELS = (
    "SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL"
    " WHEN '1-URGENT' THEN 'Non-Amazon' ELSE o_orderpriority END AS sales_channel FROM {orders}"
)


@_register(
    "exclude_channel",
    f"SELECT o_orderkey, sales_channel FROM {_duck(CHANNELS)} AS c"
    " WHERE sales_channel <> 'Non-Amazon'",
)
def exclude_channel(spark, sf_dir):
    return raw.run_sql(spark, sf_dir, CHANNELS).where(F.col("sales_channel") != "Non-Amazon")


_CODES = [*fn.columns.COUNTRY, "Amazon.de"]
MARKETS = (
    "SELECT c_custkey, CASE c_custkey % 12 "
    + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(_CODES))
    + " ELSE NULL END AS market FROM {customer}"
)


@_register(
    "country_map",
    f"""SELECT c_custkey, CASE market WHEN 'Amazon.co.mx' THEN 'Mexico'
    WHEN 'Amazon.ca' THEN 'Canada' WHEN 'Amazon.co.uk' THEN 'United Kingdom'
    WHEN 'Amazon.com' THEN 'United States' WHEN 'USD' THEN 'United States'
    WHEN 'CAD' THEN 'Canada' WHEN 'INR' THEN 'India' WHEN 'UK' THEN 'United Kingdom'
    WHEN 'US' THEN 'United States' ELSE market END AS store_name
    FROM {_duck(MARKETS)} AS m""",
)
def country_map(spark, sf_dir):
    markets = raw.run_sql(spark, sf_dir, MARKETS)
    return markets.select("c_custkey", fn.country_name("market").alias("store_name"))


# Watermark ----------------------------------------------------------------------


@_register(
    "watermark_value",
    f"""SELECT 'loaded' AS target, COALESCE(max(_batch_runtime) - 2592000000, 0) AS max_loaded
    FROM {_duck(SPREAD)} AS s
    UNION ALL SELECT 'empty', COALESCE(max(_batch_runtime) - 2592000000, 0)
    FROM {_duck(SPREAD)} AS s WHERE o_orderkey < 0""",
)
def watermark_value(spark, sf_dir):
    target = raw.run_sql(spark, sf_dir, SPREAD)
    empty = target.where("o_orderkey < 0")
    return (
        watermark(target)
        .select(F.lit("loaded").alias("target"), "max_loaded")
        .unionByName(watermark(empty).select(F.lit("empty").alias("target"), "max_loaded"))
    )


@_register(
    "watermark_footers",
    f"""SELECT 'loaded' AS target, COALESCE(max(_batch_runtime) - 2592000000, 0) AS max_loaded
    FROM {_duck(SPREAD)} AS s
    UNION ALL SELECT 'empty', COALESCE(max(_batch_runtime) - 2592000000, 0)
    FROM {_duck(SPREAD)} AS s WHERE o_orderkey < 0""",
)
def watermark_footers(spark, sf_dir):
    """The watermark of written tables, without reading a column of them."""
    rows = raw.run_sql(spark, sf_dir, SPREAD)
    found = []
    for label, table in (("loaded", rows), ("empty", rows.where("o_orderkey < 0"))):
        path = scratch_path(spark, "loaded")
        table.write.parquet(path)
        # a frame of the other session cannot be put together with this one's
        value = ops.footer_watermark(spark, path).first()["max_loaded"]
        found.append(spark.range(1).select(F.lit(label).alias("target"), F.lit(value).cast("long").alias("max_loaded")))
    return found[0].unionByName(found[1])


_NULL_CLOCK = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE _batch_runtime END"
    f" AS _batch_runtime FROM ({SPREAD}) AS s"
)


@_register(
    "watermark_filter",
    f"""SELECT o_orderkey, _batch_runtime FROM {_duck(_NULL_CLOCK)} AS s
    WHERE _batch_runtime >= (SELECT max(_batch_runtime) - 2592000000
    FROM {_duck(SPREAD)} AS t)""",
)
def watermark_filter(spark, sf_dir):
    loaded = ops.max_loaded(raw.run_sql(spark, sf_dir, SPREAD))
    return ops.since(raw.run_sql(spark, sf_dir, _NULL_CLOCK), loaded)


# Exchange rates -------------------------------------------------------------------


@_register(
    "fx_join",
    f"""WITH rates AS {_duck(raw.RATES)}
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, currency,
    CAST(COALESCE(value, 1) AS DOUBLE) AS exchange_currency_rate,
    COALESCE(from_currency_code, currency) AS exchange_currency_code
    FROM {_duck(PAID)} AS p LEFT JOIN rates ON rates.date = CAST(l_shipdate AS DATE)
    AND rates.to_currency_code = currency""",
)
def fx_join(spark, sf_dir):
    rates = ops.Rates.measure(raw.rates(spark, sf_dir))
    paid = raw.run_sql(spark, sf_dir, PAID)
    joined = ops.with_exchange_rate(paid, rates, F.to_date("l_shipdate"), "currency")
    return comparable(joined.drop("l_shipdate"))


@_register("fx_join_large_rates", SQL["fx_join"])
def fx_join_large_rates(spark, sf_dir):
    """The same join with the rates treated as too large to broadcast."""
    rates = ops.Rates.measure(raw.rates(spark, sf_dir).hint("merge"))
    paid = raw.run_sql(spark, sf_dir, PAID)
    joined = ops.with_exchange_rate(paid, rates, F.to_date("l_shipdate"), "currency")
    return comparable(joined.drop("l_shipdate"))


@_register(
    "fx_disabled",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, currency, CAST(1 AS DOUBLE)
    AS exchange_currency_rate, currency AS exchange_currency_code FROM {_duck(PAID)} AS p""",
)
def fx_disabled(spark, sf_dir):
    paid = raw.run_sql(spark, sf_dir, PAID).drop("l_extendedprice")
    off = ops.with_exchange_rate(paid, None, "l_shipdate", "currency", enabled=False)
    return comparable(off.drop("l_shipdate"))


# Un-nesting ----------------------------------------------------------------------


@_register(
    "unnest_outer",
    f"""SELECT AmazonOrderId, _batch_id, OrderStatus, BuyerInfo_BuyerEmail AS email,
    BuyerInfo_BuyerName AS buyer FROM {_duck(raw.NESTED_ROWS['ListOrder'])} AS o""",
)
def unnest_outer(spark, sf_dir):
    orders = raw.raw_frame(spark, sf_dir, feed("ListOrder"))
    return ops.unnest(orders, "BuyerInfo").select(
        "AmazonOrderId",
        "_batch_id",
        "OrderStatus",
        F.col("BuyerInfo.BuyerEmail").alias("email"),
        F.col("BuyerInfo.BuyerName").alias("buyer"),
    )


_TAX = feed("ListFinancialEventsOrderTaxes")
_TAX_ROWS = raw.event_rows(
    "ShipmentEventlist", "ShipmentItemList", "TaxesWithheld_ChargeType", "ChargeAmount"
)


@_register(
    "unnest_deep",
    f"""SELECT ShipmentEventlist_AmazonOrderId AS order_id, ShipmentItemList_SellerSKU AS sku,
    TaxesWithheld_ChargeType AS charge, ChargeAmount_CurrencyCode AS code,
    ChargeAmount_CurrencyAmount AS amount FROM {_duck(_TAX_ROWS)} AS t""",
)
def unnest_deep(spark, sf_dir):
    df = raw.raw_frame(spark, sf_dir, _TAX)
    for path in _TAX.unnest:
        df = ops.unnest(df, path)
    return df.select(
        F.col("ShipmentEventlist.AmazonOrderId").alias("order_id"),
        F.col("ShipmentItemList.SellerSKU").alias("sku"),
        F.col("TaxesWithheld.ChargeType").alias("charge"),
        F.col("ChargeAmount.CurrencyCode").alias("code"),
        F.col("ChargeAmount.CurrencyAmount").cast("double").alias("amount"),
    )


@_register(
    "unnest_siblings",
    f"""SELECT asin, _batch_id, summaries_sizeName AS size,
    classificationRanks_classificationId AS class_id, displayGroupRanks_rank AS group_rank
    FROM {_duck(raw.NESTED_ROWS['CatalogItems'])} AS c""",
)
def unnest_siblings(spark, sf_dir):
    item = feed("CatalogItems")
    df = raw.raw_frame(spark, sf_dir, item)
    for path in item.unnest:
        df = ops.unnest(df, path)
    return df.select(
        "asin",
        "_batch_id",
        F.col("summaries.size").alias("size"),
        F.col("classificationRanks.classificationId").alias("class_id"),
        F.col("displayGroupRanks.rank").cast("bigint").alias("group_rank"),
    )


@_register(
    "nested_cast",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey AS STRING) AS as_text,
    l_suppkey AS as_integer, CAST(round(l_extendedprice) AS BIGINT) AS rounded,
    CAST(l_suppkey AS DOUBLE) + 0.25 AS as_numeric,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey END AS safe_integer FROM lineitem""",
)
def nested_cast(spark, sf_dir):
    item = F.struct(
        F.col("l_partkey").alias("text"),
        F.col("l_suppkey").cast("string").alias("whole"),
        F.col("l_extendedprice").alias("fraction"),
        (F.col("l_suppkey") + F.lit(0.25)).cast("string").alias("money"),
        F.when(F.col("l_linenumber") == 2, "x").otherwise(F.col("l_suppkey").cast("string")).alias("maybe"),
    )
    lines = raw.table(spark, sf_dir, "lineitem").withColumn("item", item)
    return comparable(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            fn.cast_leaf("item.text", "string").alias("as_text"),
            fn.cast_leaf("item.whole", "integer").alias("as_integer"),
            fn.cast_leaf("item.fraction", "integer", "double").alias("rounded"),
            fn.cast_leaf("item.money", "numeric").alias("as_numeric"),
            fn.cast_leaf("item.maybe", "integer", safe=True).alias("safe_integer"),
        )
    )


# JSON ------------------------------------------------------------------------------


@_register(
    "json_extract",
    """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, props->>'$.k' AS k_text,
    CAST(props->>'$.k' AS DOUBLE) AS k_numeric, props->>'$.none' AS missing FROM events""",
)
def json_extract(spark, sf_dir):
    events = raw.table(spark, sf_dir, "events").withColumn("v", fn.parse_json_text("props"))
    return comparable(
        events.select(
            "event_id",
            fn.json_field("v", "k", "integer").alias("k"),
            fn.json_field("v", "k").alias("k_text"),
            fn.json_field("v", "k", "numeric").alias("k_numeric"),
            fn.json_field("v", "none").alias("missing"),
        )
    )


_BROKEN = (
    "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'k:' || CAST(event_id AS STRING)"
    " WHEN event_id % 10 = 1 THEN NULL ELSE props END AS props FROM {events}"
)


@_register(
    "json_parse",
    f"""SELECT event_id, COALESCE(json_valid(props), FALSE) AS parsed,
    CASE WHEN json_valid(props) THEN CAST(props->>'$.k' AS BIGINT) END AS k
    FROM {_duck(_BROKEN)} AS e""",
)
def json_parse(spark, sf_dir):
    events = raw.run_sql(spark, sf_dir, _BROKEN)
    parsed = events.withColumn("v", fn.parse_json_text("props", safe=True))
    return parsed.select(
        "event_id", F.col("v").isNotNull().alias("parsed"), fn.json_field("v", "k", "integer").alias("k")
    )


_ELEMENT = (
    "'{{\"sku\":\"' || CAST(l_partkey AS STRING) || '-@\",\"qty\":'"
    " || CAST(CAST(l_quantity AS BIGINT) + @ AS STRING) || '}}'"
)
JSON_LINES = (
    "SELECT l_orderkey, l_linenumber, l_suppkey, CASE l_linenumber % 4 WHEN 0 THEN NULL"
    f" WHEN 1 THEN '[]' WHEN 2 THEN '[' || {_ELEMENT.replace('@', '0')} || ']'"
    f" ELSE '[' || {_ELEMENT.replace('@', '0')} || ',' || {_ELEMENT.replace('@', '1')} || ']' END"
    " AS items FROM {lineitem}"
)
_JSON_FLAT = """SELECT l_orderkey, l_linenumber, l_suppkey, e.e AS pos,
    CASE WHEN e.e IS NULL THEN NULL ELSE CAST(l_partkey AS STRING) || '-' || CAST(e.e AS STRING)
    END AS sku, CASE WHEN e.e IS NULL THEN NULL ELSE CAST(l_quantity AS BIGINT) + e.e END AS qty
    FROM lineitem JOIN (VALUES (0, NULL), (1, NULL), (2, 0), (3, 0), (3, 1)) AS e(k, e)
    ON e.k = l_linenumber % 4"""


def _json_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "pos",
        fn.json_field("value", "sku").alias("sku"),
        fn.json_field("value", "qty", "integer").alias("qty"),
    )


@_register("json_flatten_inner", f"{_JSON_FLAT} WHERE e.e IS NOT NULL")
def json_flatten_inner(spark, sf_dir):
    return _json_rows(ops.unnest_json(raw.run_sql(spark, sf_dir, JSON_LINES), "items"))


@_register("json_flatten_outer", _JSON_FLAT)
def json_flatten_outer(spark, sf_dir):
    lines = raw.run_sql(spark, sf_dir, JSON_LINES)
    return _json_rows(ops.unnest_json(lines, "items", outer=True))


# Keep-latest and sequence numbers ----------------------------------------------------


def _lines(spark, sf_dir) -> DataFrame:
    return raw.run_sql(spark, sf_dir, LINES)


_KEPT = ", ".join([*LINE_COLUMNS, BATCH_RUNTIME])


@_register(
    "keep_latest_row",
    f"""SELECT {_KEPT} FROM {_duck(LINES)} AS l QUALIFY row_number() OVER
    (PARTITION BY l_orderkey ORDER BY _batch_runtime DESC NULLS LAST, {LINE_TIE_SQL}) = 1""",
)
def keep_latest_row(spark, sf_dir):
    kept = ops.keep_latest(
        _lines(spark, sf_dir), ["l_orderkey"], [BATCH_RUNTIME], tie_break=LINE_TIES.split()
    )
    return kept.select(*LINE_COLUMNS, BATCH_RUNTIME)


_BATCH_SQL = f"""SELECT {_KEPT} FROM {_duck(LINES)} AS l QUALIFY dense_rank() OVER
    (PARTITION BY l_suppkey % 5, l_returnflag, src ORDER BY _batch_runtime DESC NULLS LAST) = 1"""


def _latest_batch(spark, sf_dir, hot: bool) -> DataFrame:
    keys = [F.col("l_suppkey") % 5, "l_returnflag", "src"]
    kept = ops.keep_latest(_lines(spark, sf_dir), keys, [BATCH_RUNTIME], "all", hot=hot)
    return kept.select(*LINE_COLUMNS, BATCH_RUNTIME)


@_register("keep_latest_batch", _BATCH_SQL)
def keep_latest_batch(spark, sf_dir):
    """Fifteen keys for all rows: every one is hot."""
    return _latest_batch(spark, sf_dir, hot=True)


_SMALL_BATCH_SQL = f"""SELECT {_KEPT} FROM {_duck(LINES)} AS l QUALIFY dense_rank() OVER
    (PARTITION BY l_orderkey, l_returnflag ORDER BY _batch_runtime DESC NULLS LAST) = 1"""


@_register("keep_latest_batch_small_keys", _SMALL_BATCH_SQL)
def keep_latest_batch_small_keys(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    keys = ["l_orderkey", "l_returnflag"]
    hot = ops.has_hot_group(lines, keys, Config().hot_rows)
    kept = ops.keep_latest(lines, keys, [BATCH_RUNTIME], "all", hot=hot)
    return kept.select(*LINE_COLUMNS, BATCH_RUNTIME)


@_register(
    "keep_latest_stacked_rr",
    f"""SELECT {_KEPT}, l_shipdate FROM (SELECT * FROM {_duck(LINES)} AS l
    QUALIFY row_number() OVER (PARTITION BY l_shipdate, l_suppkey ORDER BY
    _batch_runtime DESC NULLS LAST, l_orderkey NULLS FIRST, {LINE_TIE_SQL}) = 1) AS f
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC NULLS LAST,
    _batch_runtime DESC NULLS LAST, l_orderkey NULLS FIRST, {LINE_TIE_SQL}) = 1""",
)
def keep_latest_stacked_rr(spark, sf_dir):
    ties = ["l_orderkey", *LINE_TIES.split()]
    first = ops.keep_latest(
        _lines(spark, sf_dir), ["l_shipdate", "l_suppkey"], [BATCH_RUNTIME], tie_break=ties
    )
    last = ops.keep_latest(first, ["l_suppkey"], ["l_shipdate", BATCH_RUNTIME], tie_break=ties)
    return last.select(*LINE_COLUMNS, BATCH_RUNTIME, "l_shipdate")


@_register(
    "keep_latest_stacked_dr",
    f"""SELECT {_KEPT} FROM (SELECT * FROM {_duck(LINES)} AS l
    QUALIFY dense_rank() OVER (PARTITION BY l_orderkey, l_returnflag
    ORDER BY _batch_runtime DESC NULLS LAST) = 1) AS f
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY _batch_runtime DESC NULLS LAST,
    l_suppkey DESC NULLS LAST, {LINE_TIE_SQL}) = 1""",
)
def keep_latest_stacked_dr(spark, sf_dir):
    newest = ops.keep_latest(
        _lines(spark, sf_dir), ["l_orderkey", "l_returnflag"], [BATCH_RUNTIME], "all"
    )
    last = ops.keep_latest(
        newest, ["l_orderkey"], [BATCH_RUNTIME, "l_suppkey"], tie_break=LINE_TIES.split()
    )
    return last.select(*LINE_COLUMNS, BATCH_RUNTIME)


@_register(
    "window_expression_keys",
    f"""SELECT {_KEPT} FROM {_duck(LINES)} AS l QUALIFY row_number() OVER
    (PARTITION BY CAST(l_shipdate AS DATE), l_suppkey ORDER BY _batch_runtime DESC NULLS LAST,
    _batch_id DESC NULLS LAST, l_orderkey NULLS FIRST, {LINE_TIE_SQL}) = 1""",
)
def window_expression_keys(spark, sf_dir):
    """Day of a timestamp, a struct field and a constant as keys."""
    lines = _lines(spark, sf_dir).withColumn("s", F.struct("l_suppkey"))
    keys = [F.to_date("l_shipdate"), F.col("s.l_suppkey"), F.lit("Acme")]
    kept = ops.keep_latest(
        lines, keys, [BATCH_RUNTIME, BATCH_ID], tie_break=["l_orderkey", *LINE_TIES.split()]
    )
    return kept.select(*LINE_COLUMNS, BATCH_RUNTIME)


_SEQ = ", ".join(LINE_COLUMNS)
_SEQ_ORDER = ["l_quantity", *[c for c in LINE_TIES.split() if c != "l_quantity"], BATCH_RUNTIME]
_SEQ_SQL = ", ".join(f"{c} NULLS FIRST" for c in _SEQ_ORDER)


@_register(
    "seq_id_per_source",
    f"""SELECT {_SEQ}, src, _batch_runtime, row_number() OVER (PARTITION BY l_partkey, src
    ORDER BY _batch_runtime NULLS FIRST, l_orderkey NULLS FIRST, {_SEQ_SQL}) AS _seq_id
    FROM {_duck(LINES)} AS l""",
)
def seq_id_per_source(spark, sf_dir):
    order = list(dict.fromkeys([BATCH_RUNTIME, "l_orderkey", *_SEQ_ORDER]))
    numbered = ops.number_rows(_lines(spark, sf_dir), ["l_partkey", "src"], order)
    return numbered.select(*LINE_COLUMNS, "src", BATCH_RUNTIME, "_seq_id")


@_register(
    "seq_id_global",
    f"""SELECT {_SEQ}, _batch_runtime, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY _batch_runtime NULLS FIRST, {_SEQ_SQL}) AS _seq_id FROM {_duck(LINES)} AS l""",
)
def seq_id_global(spark, sf_dir):
    order = list(dict.fromkeys([BATCH_RUNTIME, *_SEQ_ORDER]))
    numbered = ops.number_rows(_lines(spark, sf_dir), ["l_orderkey"], order)
    return numbered.select(*LINE_COLUMNS, BATCH_RUNTIME, "_seq_id")


@_register(
    "seq_id_hot_groups",
    f"""SELECT {_SEQ}, l_returnflag, _batch_runtime, row_number() OVER (PARTITION BY l_returnflag
    ORDER BY l_shipdate DESC NULLS LAST, l_orderkey NULLS FIRST, {_SEQ_SQL}) AS _seq_id
    FROM {_duck(LINES)} AS l""",
)
def seq_id_hot_groups(spark, sf_dir):
    """Three keys for all rows, each numbered in about a dozen ranges."""
    lines = _lines(spark, sf_dir)
    limit = max(raw.table(spark, sf_dir, "lineitem").count() // 16, 64)
    order = ["-l_shipdate", "l_orderkey", *[c for c in _SEQ_ORDER if c != "l_shipdate"]]
    numbered = ops.number_rows(lines, ["l_returnflag"], order, hot_rows=limit)
    return numbered.select(*LINE_COLUMNS, "l_returnflag", BATCH_RUNTIME, "_seq_id")


# Timestamps ---------------------------------------------------------------------------


@_register(
    "tz_text_zones",
    """SELECT o_orderkey, o_orderdate + INTERVAL '10' HOUR + CASE o_orderkey % 5
    WHEN 0 THEN INTERVAL '0' HOUR WHEN 1 THEN INTERVAL '-9' HOUR WHEN 2 THEN INTERVAL '3' HOUR
    WHEN 3 THEN INTERVAL '0' HOUR ELSE INTERVAL '-4' HOUR END AS at FROM orders""",
)
def tz_text_zones(spark, sf_dir):
    """Wall clock times with region names and offsets after them, some padded."""
    zone = F.element_at(
        F.array(*map(F.lit, ("", " Asia/Tokyo", "-03:00", "Z", " +0400"))), (F.col("o_orderkey") % 5 + 1).cast("int")
    )
    zone = F.when(zone == " +0400", " GMT+04:00").otherwise(zone)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.concat(F.lit("   "), day, F.lit(" 10:00:00"), zone)
    return raw.table(spark, sf_dir, "orders").select("o_orderkey", fn.as_utc(text, "string").alias("at"))


@_register(
    "tz_shift",
    """SELECT event_id, ts - INTERVAL '7' HOUR AS pacific, ts AS utc,
    ts + CAST(user_id % 5 AS INT) * INTERVAL '1' HOUR AS per_row,
    date_trunc('second', ts) - INTERVAL '7' HOUR AS from_text FROM events""",
)
def tz_shift(spark, sf_dir):
    events = raw.table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return events.select(
        "event_id",
        fn.shift_hours("ts", -7).alias("pacific"),
        fn.shift_hours("ts", 0).alias("utc"),
        fn.shift_hours("ts", (F.col("user_id") % 5).cast("int")).alias("per_row"),
        fn.shift_hours(fn.as_utc(text, "string"), -7).alias("from_text"),
    )


@_register(
    "datetime_add",
    """SELECT event_id, ts + INTERVAL '3' DAY AS days, ts - INTERVAL '90' MINUTE AS minutes,
    ts + INTERVAL '2' MONTH AS months,
    ts + CAST(user_id AS INT) * INTERVAL '1' SECOND AS seconds FROM events""",
)
def datetime_add(spark, sf_dir):
    return raw.table(spark, sf_dir, "events").select(
        "event_id",
        fn.add_interval("ts", 3, "day").alias("days"),
        fn.add_interval("ts", -90, "minute").alias("minutes"),
        fn.add_interval("ts", 2, "month").alias("months"),
        fn.add_interval("ts", F.col("user_id"), "second").alias("seconds"),
    )


@_register(
    "epoch_ms",
    f"""SELECT o_orderkey, b, TIMESTAMP '1970-01-01 00:00:00'
    + to_milliseconds(_batch_runtime) AS batch_time FROM {_duck(ORDERS)} AS o""",
)
def epoch_ms(spark, sf_dir):
    orders = raw.run_sql(spark, sf_dir, ORDERS)
    return orders.select("o_orderkey", "b", fn.from_epoch_ms(BATCH_RUNTIME).alias("batch_time"))


@_register(
    "to_date_key",
    "SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS day,"
    " CAST(CAST(ts - INTERVAL '7' HOUR AS DATE) AS STRING) AS local_day FROM events",
)
def to_date_key(spark, sf_dir):
    return comparable(
        raw.table(spark, sf_dir, "events").select(
            "event_id",
            fn.day_of("ts").alias("day"),
            fn.day_of(fn.shift_hours("ts", -7)).alias("local_day"),
        )
    )


# Sinks and merges -----------------------------------------------------------------------


# Every order is on both sides; keys that match nothing are made by moving them.
_TARGET_KEY = "CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey ELSE {} END"
_SOURCE_KEY = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 1000000000000 ELSE {} END"


def _merge_sides(spark, sf_dir, key: str = "o_orderkey"):
    orders = raw.run_sql(spark, sf_dir, ORDERS)
    columns = ["id", "o_orderkey", "status", "amount"]
    target = orders.where("b = least(o_orderkey % 3, 1)").withColumn("id", F.expr(_TARGET_KEY.format(key)))
    source = orders.where("b = o_orderkey % 3").withColumn("id", F.expr(_SOURCE_KEY.format(key)))
    return target.select(*columns), source.select(*columns)


def _merge_sql(amount: str = "s.amount", key: str = "o_orderkey") -> str:
    side = f"AS id, o_orderkey, status, amount FROM {_duck(ORDERS)} AS o WHERE b ="
    return f"""WITH t AS (SELECT {_TARGET_KEY.format(key)} {side} least(o_orderkey % 3, 1)),
    s AS (SELECT {_SOURCE_KEY.format(key)} {side} o_orderkey % 3)
    SELECT t.id, t.o_orderkey, t.status, t.amount FROM t
    WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)
    UNION ALL SELECT s.id, s.o_orderkey, s.status, {amount}
    FROM s LEFT JOIN t ON s.id = t.id"""


_NULLABLE = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END"


@_register("merge_upsert", _merge_sql())
def merge_upsert(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return ops.merge_upsert(target, source, ["id"])


@_register(
    "merge_upsert_exclude",
    _merge_sql("CASE WHEN t.id IS NULL THEN s.amount ELSE t.amount END"),
)
def merge_upsert_exclude(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return ops.merge_upsert(target, source, ["id"], exclude=["amount"])


@_register("merge_null_keys", _merge_sql(key=_NULLABLE))
def merge_null_keys(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir, _NULLABLE)
    return ops.merge_upsert(target, source, ["id"])


@_register("merge_bucketed", _merge_sql())
def merge_bucketed(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    path = scratch_path(spark, "bucketed")
    name = os.path.basename(path).replace("-", "_")
    ops.write_bucketed(target, name, ["id"], 8, path)
    ops.merge_bucketed(name, source, ["id"], 8, path)
    merged = spark.read.parquet(f"{path}/{name}__v2")
    for number in (1, 2):  # the files stay, the query leaves nothing in the catalog
        spark.sql(f"DROP TABLE {name}__v{number}")
    spark.sql(f"DROP VIEW {name}")
    return merged


_REPEATED_TARGET = "CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE -o_custkey END"
_ONE_PER_CUSTOMER = "CASE WHEN o_custkey % 2 = 0 THEN o_custkey ELSE o_custkey + 1000000000000 END"


@_register(
    "merge_repeated_target",
    f"""WITH t AS (SELECT {_REPEATED_TARGET} AS id, status, amount FROM {_duck(ORDERS)} AS o WHERE b = 0),
    s AS (SELECT {_ONE_PER_CUSTOMER} AS id, max(status) AS status, max(amount) AS amount
          FROM {_duck(ORDERS)} AS o WHERE b = 1 GROUP BY o_custkey)
    SELECT 'all' AS form, t.id, s.status, s.amount FROM t JOIN s ON t.id = s.id
    UNION ALL SELECT 'kept', t.id, s.status, t.amount FROM t JOIN s ON t.id = s.id
    UNION ALL SELECT f.form, t.id, t.status, t.amount FROM t, (VALUES ('all'), ('kept')) AS f(form)
    WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = t.id)
    UNION ALL SELECT f.form, s.id, s.status, s.amount FROM s, (VALUES ('all'), ('kept')) AS f(form)
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id)""",
)
def merge_repeated_target(spark, sf_dir):
    """Customers have several target rows; a matched key updates all of them."""
    orders = raw.run_sql(spark, sf_dir, ORDERS)
    target = orders.where("b = 0").select(F.expr(_REPEATED_TARGET).alias("id"), "status", "amount")
    source = orders.where("b = 1").groupBy(F.expr(_ONE_PER_CUSTOMER).alias("id"))
    source = source.agg(F.max("status").alias("status"), F.max("amount").alias("amount"))
    forms = {"all": (), "kept": ("amount",)}
    merged = [
        ops.merge_upsert(target, source, ["id"], kept).withColumn("form", F.lit(form))
        for form, kept in forms.items()
    ]
    return merged[0].unionByName(merged[1])


_ORDER_ROWS = f"SELECT o_orderkey, status, amount, o_orderdate FROM {_duck(ORDERS)} AS o"


@_register("full_refresh_roundtrip", _ORDER_ROWS)
def full_refresh_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "full")
    orders = raw.run_sql(spark, sf_dir, ORDERS)
    rows = orders.select("o_orderkey", "status", "amount", "o_orderdate")
    ops.write_full(rows.limit(0), path)
    ops.write_full(rows, path, cluster_by=["o_orderdate", "o_orderkey"])
    return ops.read_target(spark, path)


@_register(
    "partitioned_sink",
    "SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events",
)
def partitioned_sink(spark, sf_dir):
    path = scratch_path(spark, "days")
    ops.write_full(raw.table(spark, sf_dir, "events"), path, partition_by="ts")
    stored = ops.read_target(spark, path, keep_day=True)
    return stored.select("event_id", "user_id", F.col(DAY).cast("string").alias("day"))


@_register("clustered_sink", "SELECT event_id, user_id, event_type FROM events")
def clustered_sink(spark, sf_dir):
    path = scratch_path(spark, "clusters")
    events = raw.table(spark, sf_dir, "events")
    ops.write_full(events, path, partition_by="ts", cluster_by=["event_type", "user_id"])
    return ops.read_target(spark, path).select("event_id", "user_id", "event_type")


# Incremental runs -------------------------------------------------------------------------

_STATE = "AmazonOrderId PurchaseDate LastUpdateDate OrderStatus NumberOfItemsShipped".split()
_STATE += ["sellingPartnerId", BATCH_RUNTIME]


def _event_orders(spark, sf_dir, where: str, gap: int = 1) -> list[RawSource]:
    """The order feed's raw tables; ``gap`` days lie between two batches."""
    item = feed("ListOrder")
    schema = T.StructType.fromDDL(item.raw_ddl)
    rows = raw._fill(raw.run_sql(spark, sf_dir, EVENT_ORDERS), schema)
    clock = F.lit(1700000000000) + F.col("b").cast("bigint") * 86400000 * gap
    rows = rows.where(where).withColumn(BATCH_RUNTIME, clock)
    return [
        RawSource(name.format("ListOrder"), frame=rows.where(F.col("src") == i).select(*schema.names))
        for i, name in enumerate(raw.SOURCE_NAMES)
    ]


def _state_sql(where: str, gap: int = 1) -> str:
    clock = f"CAST(1700000000000 + CAST(b AS BIGINT) * {86400000 * gap} AS BIGINT)"
    columns = ", ".join(_STATE[:-1])
    return (
        f"SELECT {columns}, {clock} AS _batch_runtime FROM {_duck(EVENT_ORDERS)} AS e"
        f" WHERE {where}"
    )


def _load(spark, sf_dir, steps: list[str], gap: int = 1) -> str:
    path = scratch_path(spark, "orders")
    for where in steps:
        run_feed(spark, feed("ListOrder"), _event_orders(spark, sf_dir, where, gap), path)
    return path


_NEWEST = "b = CAST(AmazonOrderId AS BIGINT) % 3"


@_register("incremental_load", _state_sql(_NEWEST))
def incremental_load(spark, sf_dir):
    path = _load(spark, sf_dir, ["b <= 1", "true"])
    return ops.read_target(spark, path).select(*_STATE)


@_register("lookback_replay", _state_sql(f"{_NEWEST} AND b >= 1", 20))
def lookback_replay(spark, sf_dir):
    """Batch 0 arrives last and is 40 days behind: it is never read."""
    path = _load(spark, sf_dir, ["b >= 1", "true"], gap=20)
    return ops.read_target(spark, path).select(*_STATE)


@_register("incremental_idempotent", _state_sql(_NEWEST))
def incremental_idempotent(spark, sf_dir):
    path = _load(spark, sf_dir, ["true", "true", "true"])
    return ops.read_target(spark, path).select(*_STATE)


@_register(
    "incremental_equals_full",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM events",
)
def incremental_equals_full(spark, sf_dir):
    stepwise = ops.read_target(spark, _load(spark, sf_dir, ["b = 0", "b <= 1", "true"]))
    full = build(spark, feed("ListOrder"), _event_orders(spark, sf_dir, "true"))
    a, b = stepwise.select(*_STATE), full.select(*_STATE)
    marked = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1)))
    balance = marked.groupBy(*_STATE).agg(
        F.sum("side").alias("net"), F.count_if(F.col("side") == 1).alias("n")
    )
    return balance.agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("net") != 0).alias("n_different")
    )


@_register("multi_source_scan", _state_sql(_NEWEST))
def multi_source_scan(spark, sf_dir):
    """Raw folders of one schema are one scan, tagged from the path of each file."""
    root = scratch_path(spark, "landing")
    for source in _event_orders(spark, sf_dir, "b <= 2"):
        source.frame.write.parquet(f"{root}/{source.name.rsplit('.', 1)[1]}")
    item = feed("ListOrder")
    return build(spark, item, discover_paths(spark, root, item.like)).select(*_STATE)


@_register("stream_refresh", _state_sql(_NEWEST))
def stream_refresh(spark, sf_dir):
    """Two arrivals of raw files, each taken by one run of the stream."""
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "orders")
    checkpoint = scratch_path(spark, "stream")
    for where in ("b <= 1", "b = 2"):
        for source in _event_orders(spark, sf_dir, where):
            path = f"{root}/{source.name.rsplit('.', 1)[1]}"
            source.frame.write.mode("append").parquet(path)
        refresh_stream(spark, feed("ListOrder"), root, target, checkpoint).awaitTermination()
    return ops.read_target(spark, target).select(*_STATE)


# Data quality --------------------------------------------------------------------------------


@_register(
    "dq_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem"
    " GROUP BY ALL HAVING count(*) > 1",
)
def dq_unique(spark, sf_dir):
    return ops.unique_violations(raw.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_register(
    "dq_not_null",
    f"SELECT l_orderkey, l_linenumber, sku, quantity FROM {_duck(KEYS)} AS k WHERE sku IS NULL",
)
def dq_not_null(spark, sf_dir):
    return ops.null_violations(raw.run_sql(spark, sf_dir, KEYS), "sku")


@_register(
    "dq_accepted_values",
    f"""SELECT sales_channel AS value_field, count(*) AS n_records FROM {_duck(CHANNELS)} AS c
    WHERE sales_channel NOT IN ('Non-Amazon', '2-HIGH') GROUP BY ALL""",
)
def dq_accepted_values(spark, sf_dir):
    channels = raw.run_sql(spark, sf_dir, CHANNELS)
    return ops.value_violations(channels, "sales_channel", ["Non-Amazon", "2-HIGH"])


@_register(
    "dq_recency",
    """SELECT max(ts) AS max_timestamp FROM events WHERE ts <= TIMESTAMP '2024-02-05 00:00:00'
    HAVING max(ts) < TIMESTAMP '2024-02-05 00:00:00' - INTERVAL '3' DAY""",
)
def dq_recency(spark, sf_dir):
    return ops.recency_violations(
        raw.table(spark, sf_dir, "events"), "ts", days=3, as_of="2024-02-05 00:00:00"
    )


SUITE_SQL = """SELECT 'unique' AS "check", 'o_custkey,o_orderdate' AS columns, 'error' AS severity,
    (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate
    HAVING count(*) > 1) AS g) AS failures, '' AS note
    UNION ALL SELECT 'not_null', 'o_orderdate', 'warn',
    (SELECT count(*) FROM orders WHERE o_orderdate IS NULL), ''
    UNION ALL SELECT 'accepted', 'o_orderstatus', 'error',
    (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')), ''
    UNION ALL SELECT 'recent', 'o_orderdate', 'error',
    (SELECT CASE WHEN max(o_orderdate) < TIMESTAMP '2001-08-19 00:00:00' THEN 1 ELSE 0 END
    FROM orders WHERE o_orderdate <= TIMESTAMP '2001-08-20 00:00:00'), ''
    UNION ALL SELECT 'not_null', 'posteddate', 'error', NULL, 'no column posteddate'"""
SUITE = (
    Check("unique", ("o_custkey", "o_orderdate")),
    Check("not_null", ("o_orderdate",), severity="warn"),
    Check("accepted", ("o_orderstatus",), values=("F", "O")),
    Check("recent", ("o_orderdate",), days=1),
    Check("not_null", ("posteddate",)),
)


@_register("dq_suite", SUITE_SQL)
def dq_suite(spark, sf_dir):
    return ops.run_checks(raw.table(spark, sf_dir, "orders"), SUITE, as_of="2001-08-20 00:00:00")


@_register("dq_during_write", SUITE_SQL)
def dq_during_write(spark, sf_dir):
    """The same suite, measured while the orders are written; only uniqueness reads them again."""
    path = scratch_path(spark, "checked")
    checks = ops.WriteChecks(SUITE, as_of="2001-08-20 00:00:00")
    orders = raw.table(spark, sf_dir, "orders")
    ops.write_full(orders, path, cluster_by=["o_orderdate", "o_orderkey"], checks=checks)
    return checks.report(ops.read_target(spark, path))
