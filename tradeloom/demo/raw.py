"""Raw-shaped inputs as pure functions of the test tables.

The flat shapes are SQL that Spark and DuckDB read alike. The nested shapes are
built row by row in Spark; for them the SQL gives the flat rows that correct
outer un-nesting must produce.

Every key comes in one to three batches (``key % 3``) and lives in one of two
raw tables (``key % 2``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.config import Feed
from tradeloom.plans import feed
from tradeloom.sources import RawSource

SOURCE_NAMES = ("lake.raw.Acme_US_Hub_{}", "lake.raw.Globex_UK_Hub_{}")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

BATCHES = "(VALUES (0, 0), (1, 0), (1, 1), (2, 0), (2, 1), (2, 2)) AS b(k, b)"
CURRENCY = (
    "CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 11 = 1 THEN 'INR'"
    " WHEN l_suppkey % 3 = 0 THEN 'USD' WHEN l_suppkey % 3 = 1 THEN 'CAD' ELSE 'GBP' END"
)


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def holes(expr: str, key: str, every: int) -> str:
    """``expr`` with NULL at every n-th key and a literal 'N/A' beside it."""
    return (
        f"CASE WHEN {key} % {every} = 0 THEN NULL"
        f" WHEN {key} % {every} = 1 THEN 'N/A' ELSE {expr} END"
    )


def lineage(key: str) -> str:
    return (
        f"{key} % 2 AS src, CAST(7 AS BIGINT) AS _user_id,"
        " CAST(1700000000000 + b.b * 86400000 AS BIGINT) AS _batch_runtime,"
        f" CAST(b.b * 10 + {key} % 7 AS BIGINT) AS _batch_id"
    )


def _lines(columns: str) -> str:
    return (
        f"SELECT {columns}, {lineage('l_orderkey')}"
        f" FROM {{lineitem}} JOIN {BATCHES} ON b.k = l_orderkey % 3"
    )


_ORDER_ID = holes(text("l_orderkey"), "l_orderkey", 50)
_SKU = holes(text("l_partkey"), "l_partkey", 10)
_ASIN = holes("'B' || " + text("l_partkey"), "l_partkey", 15)
_QUANTITY = "CAST(l_quantity AS BIGINT) + b.b"
_AT = "l_shipdate + CAST(l_orderkey % 24 AS INT) * INTERVAL '1' HOUR"
_MARKET = "'M' || " + text("l_suppkey % 3")
_SELLER = "'SP' || " + text("l_orderkey % 2")
_PART_GROUP = "CAST(FLOOR(p_partkey / 6) AS BIGINT)"

_DAYS = "SELECT CAST(o_orderdate AS DATE) AS d FROM {orders} UNION SELECT CAST(ts AS DATE) AS d FROM {events}"
RATES = " UNION ALL ".join(
    f"SELECT d AS date, 'EUR' AS from_currency_code, '{code}' AS to_currency_code,"
    f" CAST({base} + (day(d) % 4) * 0.25 AS DECIMAL(38, 9)) AS value FROM ({_DAYS}) AS days_{code}"
    " WHERE day(d) % 5 <> 0"
    for code, base in (("USD", 1), ("CAD", 2), ("GBP", 3))
)

FLAT = {
    "AllListingsReport": (
        f"SELECT {text('CAST(FLOOR(p_partkey / 3) AS BIGINT)')} AS seller_sku,"
        f" CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE {text(_PART_GROUP)} END AS listing_id,"
        " p_name AS item_name, p_retailprice + b.b AS price,"
        " CAST(p_size AS BIGINT) AS quantity, '2023-01-01T10:30:00Z' AS open_date,"
        f" {text('p_partkey')} AS product_id, {lineage(_PART_GROUP)}"
        f" FROM {{part}} JOIN {BATCHES} ON b.k = {_PART_GROUP} % 3"
    ),
    "FBAAmazonFulfilledShipmentsReport": _lines(
        f"{_ORDER_ID} AS amazon_order_id, {_AT} AS purchase_date, l_shipdate AS reporting_date,"
        f" {_SKU} AS sku, {_QUANTITY} AS quantity_shipped, {CURRENCY} AS currency,"
        f" l_extendedprice AS item_price, {_MARKET} AS marketplaceName,"
        " CASE l_returnflag WHEN 'R' THEN 'Non-Amazon' WHEN 'A' THEN 'Amazon'"
        " ELSE CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 'Web' END END AS sales_channel"
    ),
    "FBAManageInventory": _lines(
        f"{_AT} AS ReportstartDate, {_MARKET} AS marketplaceId,"
        f" {holes(text('l_partkey % 200'), 'l_partkey', 10)} AS sku, {_ASIN} AS asin,"
        f" l_extendedprice AS your_price, {_QUANTITY} AS afn_total_quantity"
    ),
    "FBAManageInventoryHealthReport": _lines(
        f"{_AT} AS ReportRequestTime, l_shipdate AS snapshot_date, {_MARKET} AS marketplaceId,"
        f" {_SELLER} AS sellingPartnerId,"
        f" {holes(text('l_partkey % 200'), 'l_partkey', 10)} AS sku,"
        f" {holes(text('l_partkey % 100'), 'l_partkey', 15)} AS asin,"
        f" {_QUANTITY} AS available, {CURRENCY} AS currency, l_extendedprice AS your_price"
    ),
    "FBAReturnsReport": _lines(
        f"{_AT} AS return_date, {_MARKET} AS marketplaceId,"
        f" {holes(text('l_orderkey % 20'), 'l_orderkey', 10)} AS order_id,"
        f" {holes(text('l_partkey % 5'), 'l_partkey', 10)} AS sku,"
        f" {holes(text('l_partkey % 5'), 'l_partkey', 15)} AS asin,"
        f" {_QUANTITY} AS quantity, l_returnflag AS fulfillment_center_id,"
        f" l_linestatus AS status, {text('l_linenumber')} AS customer_comments"
    ),
    "FlatFileAllOrdersReportByLastUpdate": _lines(
        f"{_ORDER_ID} AS amazon_order_id, {_MARKET} AS marketplaceId,"
        f" {_AT} AS purchase_date,"
        f" l_shipdate + CAST(l_linenumber % 3 AS INT) * INTERVAL '1' DAY AS last_updated_date,"
        f" l_linestatus AS order_status, {holes(text('l_partkey % 4'), 'l_partkey', 10)} AS sku,"
        f" {holes(text('l_partkey % 4'), 'l_partkey', 15)} AS asin,"
        f" {_QUANTITY} AS quantity, {CURRENCY} AS currency, l_extendedprice AS item_price"
    ),
    "FlatFileReturnsReportByReturnDate": _lines(
        f"{_AT} AS ReportRequestTime, {_MARKET} AS marketplaceId, {_ORDER_ID} AS Order_ID,"
        " CAST(l_shipdate AS DATE) AS Return_request_date,"
        f" CASE WHEN l_linenumber = 3 THEN NULL ELSE {text('l_linenumber')} END AS Amazon_RMA_ID,"
        f" {CURRENCY} AS Currency_code, {holes(text('l_partkey % 4'), 'l_partkey', 15)} AS ASIN,"
        f" {_QUANTITY} AS Return_quantity, l_extendedprice AS Refunded_Amount"
    ),
    "InventoryLedgerDetailedReport": _lines(
        f"{_AT} AS reportstartdate, {_SELLER} AS sellingpartnerid,"
        f" {_MARKET} AS marketplaceid, {_AT} AS Date,"
        f" {holes(text('l_partkey % 50'), 'l_partkey', 15)} AS asin,"
        f" {holes(text('l_partkey % 50'), 'l_partkey', 10)} AS msku, l_linestatus AS event_type,"
        f" {holes(text('l_orderkey % 40'), 'l_orderkey', 20)} AS reference_id,"
        " CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS quantity,"
        f" l_returnflag AS disposition, {text('l_suppkey')} AS reason"
    ),
    "SalesAndTrafficReportByChildASIN": _lines(
        f"CAST(l_shipdate AS DATE) AS date, {_MARKET} AS marketplaceId,"
        f" {_SELLER} AS sellingPartnerId,"
        f" {holes(text('l_partkey % 20'), 'l_partkey', 15)} AS parentAsin,"
        f" {holes(text('l_partkey % 40'), 'l_partkey', 10)} AS childAsin,"
        f" {_QUANTITY} AS unitsOrdered, l_extendedprice AS orderedProductSales_amount,"
        f" {CURRENCY} AS orderedProductSales_currencyCode"
    ),
}

# How many elements an array of the nested shapes has: {remainder: count}; no
# count stands for a NULL array, 0 for an empty one.
_BUYERS = {0: None, 1: 0, 2: 2, 3: 1, 4: 1}
_ITEMS = {0: 0, 1: 1, 2: 2, 3: 1}
_ENTRIES = {0: None, 1: 0, 2: 2, 3: 1, 4: 3}
_SERVICES = {0: None, 1: 1, 2: 2, 3: 0}
_FEES = {0: 0, 1: 1, 2: 2}
_SUMMARIES = {0: None, 1: 1, 2: 2}
_RANKS = {0: 0, 1: 1, 2: 2, 3: 1}
_CLASSES = {0: None, 1: 2, 2: 1}
_GROUPS = {0: 0, 1: 3, 2: 1, 3: 2}
_OFFERS = {0: None, 1: 1, 2: 2}
_PRICES = {0: 0, 1: 1, 2: 2}
_LANDED = {0: None, 1: 2, 2: 1, 3: 1}
_LISTED = {0: 0, 1: 1, 2: 3}


def _elements(counts: dict[int, int | None], alias: str, element: str) -> str:
    """The outer un-nesting of such an array as a small relation."""
    rows = [
        f"({k}, {e})" for k, n in counts.items() for e in (range(n) if n else ["NULL"])
    ]
    return f"(VALUES {', '.join(rows)}) AS {alias}(k, {element})"


def _given(element: str, expr: str) -> str:
    return f"CASE WHEN {element} IS NULL THEN NULL ELSE {expr} END"


def event_rows(events: str, items: str, kind: str, amount: str) -> str:
    """Flat rows of the financial events, NULL below every missing level."""
    line = "l_orderkey"
    return (
        "SELECT "
        + ", ".join(
            [
                _given(line, "o_orderdate + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR")
                + f" AS {events}_PostedDate",
                _given(line, holes(text("o_orderkey"), "o_orderkey", 50))
                + f" AS {events}_AmazonOrderId",
                _given(line, "'M' || " + text("o_custkey % 3")) + f" AS {events}_MarketplaceName",
                _given("it.i", holes(text("l_partkey") + " || '-' || " + text("it.i"),
                                     "l_partkey", 10)) + f" AS {items}_SellerSKU",
                _given("it.i", "CAST(l_quantity AS BIGINT)") + f" AS {items}_QuantityShipped",
                _given("en.e", f"CASE WHEN l_partkey % 7 = 0 AND en.e = 1 THEN NULL"
                               f" ELSE 'T' || {text('en.e')} END") + f" AS {kind}",
                f"CASE WHEN en.e IS NULL OR (l_suppkey + en.e) % 6 = 0 THEN NULL"
                f" ELSE {CURRENCY} END AS {amount}_CurrencyCode",
                "CASE WHEN en.e IS NULL OR (l_suppkey + en.e) % 6 = 0 THEN NULL"
                " ELSE CAST(l_suppkey * 100 + en.e AS DOUBLE) + 0.25 END"
                f" AS {amount}_CurrencyAmount",
                lineage("o_orderkey"),
            ]
        )
        + " FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey"
        + f" JOIN {BATCHES} ON b.k = o_orderkey % 3"
        + f" JOIN {_elements(_ITEMS, 'it', 'i')} ON it.k = COALESCE(l_linenumber % 4, 0)"
        + f" JOIN {_elements(_ENTRIES, 'en', 'e')}"
        + " ON en.k = CASE WHEN it.i IS NULL THEN 0 ELSE l_partkey % 5 END"
    )


NESTED_ROWS = {
    "ListOrder": (
        "SELECT o_orderdate + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS PurchaseDate,"
        " o_orderdate + b.b * INTERVAL '1' DAY AS LastUpdateDate,"
        f" {holes(text('o_orderkey'), 'o_orderkey', 50)} AS AmazonOrderId,"
        f" 'M' || {text('o_custkey % 3')} AS marketplaceName,"
        f" 'SP' || {text('o_orderkey % 2')} AS sellingPartnerId,"
        f" o_orderstatus || '-' || {text('b.b')} AS OrderStatus,"
        " CAST(o_custkey % 9 AS BIGINT) AS NumberOfItemsShipped,"
        f" {_given('m.e', text('o_custkey') + ' || ' + chr(39) + '-' + chr(39) + ' || ' + text('m.e'))}"
        " AS BuyerInfo_BuyerEmail,"
        f" {_given('m.e', 'o_orderpriority')} AS BuyerInfo_BuyerName, {lineage('o_orderkey')}"
        f" FROM {{orders}} JOIN {BATCHES} ON b.k = o_orderkey % 3"
        f" JOIN {_elements(_BUYERS, 'm', 'e')} ON m.k = o_custkey % 5"
    ),
    "CatalogItems": (
        f"SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE {text(_PART_GROUP)} END"
        " AS ReferenceASIN, 'SP' || " + text(f"{_PART_GROUP} % 2") + " AS sellingPartnerId,"
        f" 'M' || {text('p_size % 2')} AS marketplaceId, {text('p_partkey')} AS asin,"
        f" {_given('sr.e', 'p_type')} AS salesRanks_marketplaceId,"
        f" {_given('cl.e', text('p_partkey') + ' || p_type')}"
        " AS classificationRanks_classificationId,"
        f" {_given('cl.e', 'CAST(p_partkey + cl.e AS BIGINT)')} AS classificationRanks_rank,"
        f" {_given('gr.e', 'p_type')} AS displayGroupRanks_title,"
        f" {_given('gr.e', 'CAST(p_size + gr.e + b.b AS BIGINT)')} AS displayGroupRanks_rank,"
        f" {_given('su.e', 'p_type')} AS summaries_marketplaceId,"
        f" {_given('su.e', holes('p_brand', 'p_partkey', 12))} AS summaries_brandName,"
        f" {_given('su.e', 'CASE WHEN p_size % 4 = 0 THEN NULL ELSE ' + text('su.e') + ' END')}"
        " AS summaries_modelNumber,"
        f" {_given('su.e', 'CAST(p_size AS BIGINT)')} AS summaries_packageQuantity,"
        f" {_given('su.e', 'p_name')} AS summaries_sizeName, {lineage(_PART_GROUP)}"
        f" FROM {{part}} JOIN {BATCHES} ON b.k = {_PART_GROUP} % 3"
        f" JOIN {_elements(_SUMMARIES, 'su', 'e')} ON su.k = p_partkey % 3"
        f" JOIN {_elements(_RANKS, 'sr', 'e')} ON sr.k = p_size % 4"
        f" JOIN {_elements(_CLASSES, 'cl', 'e')}"
        " ON cl.k = CASE WHEN sr.e IS NULL THEN 0 ELSE (p_partkey + sr.e) % 3 END"
        f" JOIN {_elements(_GROUPS, 'gr', 'e')}"
        " ON gr.k = CASE WHEN sr.e IS NULL THEN 0 ELSE (p_partkey + sr.e) % 4 END"
    ),
    "ListingOffersForASIN": (
        f"SELECT {_ASIN} AS ASIN, {_SKU} AS SKU, l_returnflag AS itemCondition,"
        f" {_SELLER} AS sellingPartnerId, l_shipdate AS RequeststartDate,"
        f" {_given('su.e', 'CAST(l_linenumber + su.e AS BIGINT)')} AS Summary_TotalOfferCount,"
        f" {_given('bb.e', 'l_linestatus')} AS BuyBoxPrices_condition,"
        f" {_given('bb.e', 'CAST(l_suppkey + bb.e AS BIGINT)')} AS BuyBoxPrices_quantityTier,"
        f" {_given('la.e', CURRENCY)} AS LandedPrice_CurrencyCode,"
        f" {_given('la.e', 'CAST(l_suppkey * 10 + la.e AS DOUBLE) + 0.5')} AS LandedPrice_Amount,"
        f" {_given('li.e', CURRENCY)} AS ListingPrice_CurrencyCode,"
        f" {_given('li.e', 'CAST(l_partkey + li.e AS DOUBLE) + 0.75')} AS ListingPrice_Amount,"
        f" {_given('su.e', 'l_shipdate + CAST(l_orderkey % 24 AS INT) * INTERVAL ' + chr(39) + '1' + chr(39) + ' HOUR')}"
        f" AS Summary_OffersAvailableTime, {lineage('l_orderkey')}"
        f" FROM {{lineitem}} JOIN {BATCHES} ON b.k = l_orderkey % 3"
        f" JOIN {_elements(_OFFERS, 'su', 'e')} ON su.k = l_linenumber % 3"
        f" JOIN {_elements(_PRICES, 'bb', 'e')}"
        " ON bb.k = CASE WHEN su.e IS NULL THEN 0 ELSE l_suppkey % 3 END"
        f" JOIN {_elements(_LANDED, 'la', 'e')}"
        " ON la.k = CASE WHEN bb.e IS NULL THEN 0 ELSE (l_suppkey + bb.e) % 4 END"
        f" JOIN {_elements(_LISTED, 'li', 'e')}"
        " ON li.k = CASE WHEN bb.e IS NULL THEN 0 ELSE (l_suppkey + bb.e) % 3 END"
    ),
    "ListFinancialEventsServiceFees": (
        f"SELECT ts AS RequestStartDate, 'SP' || {text('event_id % 2')} AS sellingPartnerId,"
        f" 'N' || {text('user_id % 2')} AS marketplaceName,"
        f" 'M' || {text('user_id % 3')} AS marketplaceId,"
        f" {_given('sv.e', 'event_type')} AS ServiceFeeEventList_FeeReason,"
        f" {_given('fe.e', chr(39) + 'F' + chr(39) + ' || ' + text('fe.e'))} AS FeeList_FeeType,"
        " CASE WHEN fe.e IS NULL OR (event_id + fe.e) % 5 = 0 THEN NULL ELSE"
        " CASE WHEN user_id % 2 = 0 THEN 'USD' ELSE 'CAD' END END AS FeeAmount_CurrencyCode,"
        " CASE WHEN fe.e IS NULL OR (event_id + fe.e) % 5 = 0 THEN NULL"
        " ELSE CAST(event_id + fe.e AS DOUBLE) + 0.5 END AS FeeAmount_CurrencyAmount,"
        f" {_given('sv.e', holes(text('user_id % 10'), 'user_id', 10))}"
        " AS ServiceFeeEventList_SellerSKU,"
        f" {_given('sv.e', 'event_type || ' + text('sv.e'))} AS ServiceFeeEventList_FeeDescription,"
        f" {lineage('event_id')}"
        f" FROM {{events}} JOIN {BATCHES} ON b.k = event_id % 3"
        f" JOIN {_elements(_SERVICES, 'sv', 'e')} ON sv.k = event_id % 4"
        f" JOIN {_elements(_FEES, 'fe', 'e')}"
        " ON fe.k = CASE WHEN sv.e IS NULL THEN 0 ELSE user_id % 3 END"
    ),
}


def duck(sql: str) -> str:
    """The SQL over plain table names."""
    return sql.format(**{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, RATES)


def marked(item: Feed) -> list[str]:
    """Text columns of a flat feed that its raw rows lack; they hold their own name."""
    if item.name not in FLAT:
        return []
    have = {n.lower() for n in re.findall(r"\bAS (\w+)", FLAT[item.name])}
    plain = (c for c in item.columns if c.kind == "plain" and c.dtype == "string" and c.default is None)
    return [c.name for c in plain if c.name.lower() not in have]


def _fill(df: DataFrame, schema: T.StructType, marks: Iterable[str] = ()) -> DataFrame:
    """Add the raw columns that the test tables cannot fill: their name or NULL."""
    have, names = {c.lower() for c in df.columns}, {m.lower() for m in marks}
    missing = {
        f.name: F.lit(f.name if f.name.lower() in names else None).cast(f.dataType)
        for f in schema.fields
        if f.name.lower() not in have
    }
    return df.withColumns(missing)


def _array(key: Column, counts: dict[int, int | None], make) -> Column:
    """Array whose length follows ``key``; ``make`` builds element number ``e``.

    The numbers of the elements are constant arrays that a row only looks up.
    """
    numbers = F.array(*[F.lit(i) for i in range(max(n or 0 for n in counts.values()))])
    sizes = [counts.get(k) for k in range(max(counts) + 1)]
    shares = F.array(*[F.slice(numbers, F.lit(1), F.lit(n).cast("int")) for n in sizes])
    return F.transform(F.get(shares, key.cast("int")), make)


def _str(col: Column) -> Column:
    return col.cast("string")


def _zulu(col: Column) -> Column:
    return F.concat(F.replace(_str(col), F.lit(" "), F.lit("T")), F.lit("Z"))


def _money(present: Column, code: Column, amount: Column, amount_name: str) -> Column:
    money = F.array(F.struct(code.alias("CurrencyCode"), _str(amount).alias(amount_name)))
    none = F.array().cast(f"array<struct<CurrencyCode:string,{amount_name}:string>>")
    return F.when(present, money).otherwise(none)


def _raw_events(spark: SparkSession, sf_dir: str, *feeds: Feed, landed=None) -> DataFrame:
    """One raw record per order line, with the nested fields of all ``feeds``.

    ``landed`` makes of an array what the raw table stores, once for all batches.
    """
    c = F.col
    # What an order or a line gives alone is made before the join, once and not for every element.
    orders = run_sql(
        spark,
        sf_dir,
        f"SELECT o_orderkey, o_custkey, {holes(text('o_orderkey'), 'o_orderkey', 50)} AS oid,"
        " o_orderdate + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS posted FROM {orders}",
    ).withColumn("posted", _zulu(c("posted")))
    lines = run_sql(spark, sf_dir, f"SELECT *, {CURRENCY} AS ccy FROM {{lineitem}}")
    base = orders.join(lines, c("l_orderkey") == c("o_orderkey"), "left")
    base = base.withColumn("qty", c("l_quantity").cast("bigint"))

    def entries(item: Feed) -> Column:
        # The last three of the un-nest chain: entry, amount and what is above.
        amount = item.unnest[-1].split(".")[1]
        chain = [p.split(".")[1] for p in item.unnest[2:-1]]
        kind = next(x.path.split(".")[1] for x in item.columns if x.path.startswith(chain[-1] + "."))

        def entry(e: Column) -> Column:
            money = _money(
                (c("l_suppkey") + e) % 6 != 0,
                c("ccy"),
                (c("l_suppkey") * 100 + e).cast("double") + 0.25,
                "CurrencyAmount",
            )
            name = F.when((c("l_partkey") % 7 == 0) & (e == 1), None).otherwise(
                F.concat(F.lit("T"), _str(e))
            )
            made = F.struct(name.alias(kind), money.alias(amount))
            for level in reversed(chain[1:]):
                made = F.struct(F.array(made).alias(level))
            return made

        return _array(c("l_partkey") % 5, _ENTRIES, entry).alias(chain[0])

    def event(members: Sequence[Feed]) -> Column:
        def line_item(i: Column) -> Column:
            sku = (
                F.when(c("l_partkey") % 10 == 0, None)
                .when(c("l_partkey") % 10 == 1, "N/A")
                .otherwise(F.concat(_str(c("l_partkey")), F.lit("-"), _str(i)))
            )
            return F.struct(
                sku.alias("SellerSKU"), _str(c("qty")).alias("QuantityShipped"), *map(entries, members)
            )

        return F.struct(
            c("posted").alias("PostedDate"),
            c("oid").alias("AmazonOrderId"),
            F.concat(F.lit("M"), _str(c("o_custkey") % 3)).alias("MarketplaceName"),
            _array(c("l_linenumber") % 4, _ITEMS, line_item).alias(members[0].unnest[1].split(".")[1]),
        )

    sides: dict[str, list[Feed]] = {}
    for item in feeds:
        sides.setdefault(item.unnest[0], []).append(item)
    given = c("l_orderkey").isNotNull()
    nested = base.select(
        "o_orderkey", *[F.when(given, F.array(event(members))).alias(events) for events, members in sides.items()]
    )
    if landed:
        nested = nested.withColumns({events: landed(events) for events in sides})
    return spark.sql(
        f"SELECT nested.*, {lineage('o_orderkey')} FROM {{nested}} AS nested"
        f" JOIN {BATCHES} ON b.k = o_orderkey % 3",
        nested=nested,
    )


def _raw_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_sql(
        spark,
        sf_dir,
        f"SELECT *, ts AS RequestStartDate, 'SP' || {text('event_id % 2')} AS sellingPartnerId,"
        f" 'N' || {text('user_id % 2')} AS marketplaceName,"
        f" 'M' || {text('user_id % 3')} AS marketplaceId,"
        f" {holes(text('user_id % 10'), 'user_id', 10)} AS sku, {lineage('event_id')}"
        f" FROM {{events}} JOIN {BATCHES} ON b.k = event_id % 3",
    )
    c = F.col

    def fee(f: Column) -> Column:
        code = F.when(c("user_id") % 2 == 0, "USD").otherwise("CAD")
        amount = (c("event_id") + f).cast("double") + 0.5
        money = _money((c("event_id") + f) % 5 != 0, code, amount, "CurrencyAmount")
        return F.struct(
            F.concat(F.lit("F"), _str(f)).alias("FeeType"), money.alias("FeeAmount")
        )

    def service(s: Column) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            none.alias("AmazonOrderId"),
            c("event_type").alias("FeeReason"),
            c("sku").alias("SellerSKU"),
            none.alias("FnSKU"),
            F.concat(c("event_type"), _str(s)).alias("FeeDescription"),
            none.alias("ASIN"),
            _array(c("user_id") % 3, _FEES, fee).alias("FeeList"),
        )

    return base.withColumn(
        "ServiceFeeEventList", _array(c("event_id") % 4, _SERVICES, service)
    )


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_sql(
        spark,
        sf_dir,
        "SELECT *, o_orderdate + CAST(o_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS PurchaseDate,"
        " o_orderdate + b.b * INTERVAL '1' DAY AS LastUpdateDate,"
        f" {holes(text('o_orderkey'), 'o_orderkey', 50)} AS AmazonOrderId,"
        f" 'M' || {text('o_custkey % 3')} AS marketplaceName,"
        f" 'SP' || {text('o_orderkey % 2')} AS sellingPartnerId,"
        f" o_orderstatus || '-' || {text('b.b')} AS OrderStatus,"
        f" CAST(o_custkey % 9 AS BIGINT) AS NumberOfItemsShipped, {lineage('o_orderkey')}"
        f" FROM {{orders}} JOIN {BATCHES} ON b.k = o_orderkey % 3",
    )
    none = F.lit(None).cast("string")

    def buyer(e: Column) -> Column:
        return F.struct(
            F.concat(_str(F.col("o_custkey")), F.lit("-"), _str(e)).alias("BuyerEmail"),
            F.col("o_orderpriority").alias("BuyerName"),
            none.alias("BuyerCounty"),
            none.alias("PurchaseOrderNumber"),
        )

    return base.withColumn("BuyerInfo", _array(F.col("o_custkey") % 5, _BUYERS, buyer))


def _raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_sql(
        spark,
        sf_dir,
        f"SELECT *, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE {text(_PART_GROUP)} END"
        " AS ReferenceASIN, 'SP' || " + text(f"{_PART_GROUP} % 2") + " AS sellingPartnerId,"
        f" 'M' || {text('p_size % 2')} AS marketplaceId, {text('p_partkey')} AS asin,"
        f" {holes('p_brand', 'p_partkey', 12)} AS brand_name, {lineage(_PART_GROUP)}"
        f" FROM {{part}} JOIN {BATCHES} ON b.k = {_PART_GROUP} % 3",
    )
    c = F.col
    none = F.lit(None).cast("string")

    def class_rank(e: Column) -> Column:
        return F.struct(
            F.concat(_str(c("p_partkey")), c("p_type")).alias("classificationId"),
            none.alias("title"),
            none.alias("link"),
            _str(c("p_partkey") + e).alias("rank"),
        )

    def group_rank(e: Column) -> Column:
        return F.struct(
            none.alias("websiteDisplayGroup"),
            c("p_type").alias("title"),
            none.alias("link"),
            _str(c("p_size") + e + c("b")).alias("rank"),
        )

    def sales_rank(s: Column) -> Column:
        return F.struct(
            c("p_type").alias("marketplaceId"),
            _array((c("p_partkey") + s) % 3, _CLASSES, class_rank).alias("classificationRanks"),
            _array((c("p_partkey") + s) % 4, _GROUPS, group_rank).alias("displayGroupRanks"),
        )

    def summary(e: Column) -> Column:
        return F.struct(
            c("p_type").alias("marketplaceId"),
            c("brand_name").alias("brand"),
            none.alias("color"),
            none.alias("itemClassification"),
            none.alias("itemName"),
            none.alias("manufacturer"),
            F.when(c("p_size") % 4 == 0, None).otherwise(_str(e)).alias("modelNumber"),
            _str(c("p_size")).alias("packageQuantity"),
            none.alias("partNumber"),
            c("p_name").alias("size"),
            none.alias("style"),
            none.alias("websiteDisplayGroup"),
            none.alias("websiteDisplayGroupName"),
        )

    return base.withColumns(
        {
            "summaries": _array(c("p_partkey") % 3, _SUMMARIES, summary),
            "salesRanks": _array(c("p_size") % 4, _RANKS, sales_rank),
        }
    )


def _raw_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_sql(
        spark,
        sf_dir,
        f"SELECT *, {_ASIN} AS ASIN, {_SKU} AS SKU, l_returnflag AS itemCondition,"
        f" {_SELLER} AS sellingPartnerId, l_shipdate AS RequeststartDate, {CURRENCY} AS ccy,"
        " l_shipdate + CAST(l_orderkey % 24 AS INT) * INTERVAL '1' HOUR AS offered,"
        f" {lineage('l_orderkey')} FROM {{lineitem}} JOIN {BATCHES} ON b.k = l_orderkey % 3",
    )
    c = F.col
    none = F.lit(None).cast("string")

    def price(amount: Column) -> Column:
        return F.struct(c("ccy").alias("CurrencyCode"), _str(amount).alias("Amount"))

    def box(p: Column) -> Column:
        return F.struct(
            c("l_linestatus").alias("condition"),
            none.alias("offerType"),
            _str(c("l_suppkey") + p).alias("quantityTier"),
            none.alias("quantityDiscountType"),
            none.alias("sellerId"),
            _array(
                (c("l_suppkey") + p) % 4,
                _LANDED,
                lambda e: price((c("l_suppkey") * 10 + e).cast("double") + 0.5),
            ).alias("LandedPrice"),
            _array(
                (c("l_suppkey") + p) % 3,
                _LISTED,
                lambda e: price((c("l_partkey") + e).cast("double") + 0.75),
            ).alias("ListingPrice"),
        )

    def summary(e: Column) -> Column:
        return F.struct(
            _str(c("l_linenumber") + e).alias("TotalOfferCount"),
            _zulu(c("offered")).alias("OffersAvailableTime"),
            _array(c("l_suppkey") % 3, _PRICES, box).alias("BuyBoxPrices"),
        )

    return base.withColumn("Summary", _array(c("l_linenumber") % 3, _OFFERS, summary))


def raw_frame(spark: SparkSession, sf_dir: str, item: Feed, landed=None) -> DataFrame:
    """Raw rows of one feed for both sources, still with the ``src`` column.

    ``landed`` makes of an array column what the raw table stores.
    """
    if item.name in FLAT:
        df = run_sql(spark, sf_dir, FLAT[item.name])
    elif item.name == "ListOrder":
        df = _raw_orders(spark, sf_dir)
    elif item.name == "CatalogItems":
        df = _raw_catalog(spark, sf_dir)
    elif item.name == "ListingOffersForASIN":
        df = _raw_offers(spark, sf_dir)
    elif item.name == "ListFinancialEventsServiceFees":
        df = _raw_services(spark, sf_dir)
    else:
        df = _raw_events(spark, sf_dir, item, landed=landed)
    schema = T.StructType.fromDDL(item.raw_ddl)
    df = _fill(df, schema, marked(item)).select("src", *schema.names)
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({c: landed(c) for c in arrays}) if landed and arrays else df


def sources(spark: SparkSession, sf_dir: str, name: str, landed=None) -> list[RawSource]:
    """The two raw tables of a feed."""
    item = feed(name)
    raw = raw_frame(spark, sf_dir, item, landed)
    return [
        RawSource(pattern.format(name), frame=raw.where(F.col("src") == i).drop("src"))
        for i, pattern in enumerate(SOURCE_NAMES)
    ]


def event_sources(spark: SparkSession, sf_dir: str, feeds: Sequence[Feed]) -> list[RawSource]:
    """The two raw tables of financial events, with the fields of all ``feeds``."""
    raw = _raw_events(spark, sf_dir, *feeds)
    return [
        RawSource(pattern.format("ListFinancialEvents"), frame=raw.where(F.col("src") == i).drop("src"))
        for i, pattern in enumerate(SOURCE_NAMES)
    ]
