"""Every feed over the test tables, with the SQL that states the same result."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import LINEAGE, SEQ_ID, Config
from tradeloom.demo import raw
from tradeloom.operators.fx import Rates
from tradeloom.plans import FEEDS, build, feed
from tradeloom.plans import finance as fin
from tradeloom.plans.shared import COMPACT, share
from tradeloom.session import stage, staged_tables


@dataclass(frozen=True)
class FeedCase:
    """Filled output columns of a feed and the parts of its check SQL."""

    filled: dict[str, str]  # output column -> SQL over the flat raw rows
    keys: str
    rank: str = "row_number()"
    lead: str = "_batch_runtime DESC NULLS LAST, _batch_id DESC NULLS LAST"
    where: str = "TRUE"
    first_keys: str = ""
    seq_keys: str = ""
    seq_order: str = ""
    fx_day: str = ""  # SQL over the flat raw rows
    fx_code: str = ""
    extra: dict[str, str] = field(default_factory=dict)
    rows: str = ""  # flat SQL when not found by name


def _same(names: str) -> dict[str, str]:
    return {n: n for n in names.split()}


def _na(names: str) -> dict[str, str]:
    return {n: f"COALESCE({n}, 'N/A')" for n in names.split()}


def _local(names: str) -> dict[str, str]:
    """Source 1 is shifted by seven hours."""
    return {n: f"{n} - CAST(src AS INT) * INTERVAL '7' HOUR" for n in names.split()}


def _finance(item, default: bool = True) -> FeedCase:
    names = [c.name for c in item.columns]
    posted, order_id, market, sku, quantity, kind, code, amount = names
    events, items = posted.rsplit("_", 1)[0], sku.rsplit("_", 1)[0]
    texts = {n: f"COALESCE({n}, 'N/A')" if default else n for n in (order_id, market, sku, kind)}
    filled = {posted: posted, quantity: quantity, code: code, amount: amount, **texts}
    group = f"CAST({posted} AS DATE), {market}, {order_id}"
    return FeedCase(
        {n: filled[n] for n in names},
        keys=f"{group}, {kind}",
        rank="dense_rank()",
        lead="_batch_runtime DESC NULLS LAST",
        seq_keys=group,
        seq_order=(
            f"_batch_runtime NULLS FIRST, {kind} NULLS FIRST, {quantity} NULLS FIRST,"
            f" {posted} NULLS FIRST, {order_id} NULLS FIRST, {market} NULLS FIRST,"
            f" {sku} NULLS FIRST, {code} NULLS FIRST, {amount} NULLS FIRST,"
            " _batch_id NULLS FIRST, src"
        ),
        fx_day=posted,
        fx_code=code,
        rows=raw.event_rows(events, items, kind, amount.rsplit("_", 1)[0]),
    )


CASES: dict[str, FeedCase] = {
    "AllListingsReport": FeedCase(
        {
            **_same("item_name listing_id seller_sku price quantity"),
            "open_date": "TIMESTAMP '2023-01-01 10:30:00'",
            "product_id": "product_id",
        },
        keys="seller_sku, listing_id",
        rank="dense_rank()",
        lead="_batch_runtime DESC NULLS LAST",
    ),
    "CatalogItems": FeedCase(
        {
            **_na("ReferenceASIN"),
            **_same("sellingPartnerId marketplaceId asin salesRanks_marketplaceId"),
            **_same("classificationRanks_classificationId classificationRanks_rank"),
            **_same("displayGroupRanks_title displayGroupRanks_rank summaries_marketplaceId"),
            **_na("summaries_brandName summaries_modelNumber"),
            **_same("summaries_packageQuantity summaries_sizeName"),
        },
        keys="raw_brand, ReferenceASIN, raw_model, summaries_marketplaceId",
        extra={"raw_brand": "summaries_brandName", "raw_model": "summaries_modelNumber"},
    ),
    "FBAAmazonFulfilledShipmentsReport": FeedCase(
        {
            "marketplaceName": "marketplaceName",
            **_na("amazon_order_id"),
            **_local("purchase_date reporting_date"),
            **_na("sku"),
            **_same("quantity_shipped currency item_price sales_channel"),
        },
        keys="purchase_date, sku, amazon_order_id, marketplaceName",
        where="sales_channel <> 'Non-Amazon'",
        seq_keys="purchase_date, sku, amazon_order_id, src",
        seq_order=(
            "_batch_runtime NULLS FIRST, quantity_shipped NULLS FIRST,"
            " marketplaceName NULLS FIRST"
        ),
        fx_day="purchase_date",
        fx_code="currency",
    ),
    "FBAManageInventory": FeedCase(
        {
            **_same("ReportstartDate marketplaceId"),
            **_na("sku"),
            **_same("asin your_price afn_total_quantity"),
        },
        keys="CAST(ReportstartDate AS DATE), sku, marketplaceId",
        rank="dense_rank()",
        lead="_batch_runtime DESC NULLS LAST",
    ),
    "FBAManageInventoryHealthReport": FeedCase(
        {
            **_same("ReportRequestTime sellingPartnerId marketplaceId"),
            "snapshot_date": "CAST(snapshot_date AS DATE)",
            **_na("sku asin"),
            **_same("available currency your_price"),
        },
        keys="snapshot_date, asin, sku, marketplaceId",
        rank="dense_rank()",
        lead="_batch_runtime DESC NULLS LAST",
        fx_day="ReportRequestTime",
        fx_code="currency",
    ),
    "FBAReturnsReport": FeedCase(
        {
            "marketplaceId": "marketplaceId",
            "return_date": "CAST(return_date AS DATE)",
            **_na("order_id sku asin fnsku"),
            "quantity": "quantity",
            **_na("fulfillment_center_id"),
            "status": "status",
            **_na("license_plate_number"),
            "customer_comments": "customer_comments",
        },
        keys=(
            "return_date, asin, sku, order_id, fnsku, license_plate_number,"
            " fulfillment_center_id, marketplaceId"
        ),
        rank="dense_rank()",
        lead="_batch_runtime DESC NULLS LAST",
        seq_keys=(
            "return_date, asin, sku, order_id, fnsku, license_plate_number,"
            " fulfillment_center_id, src"
        ),
        seq_order=(
            "_batch_runtime DESC NULLS LAST, marketplaceId NULLS FIRST, quantity NULLS FIRST,"
            " status NULLS FIRST, customer_comments NULLS FIRST, _batch_id NULLS FIRST"
        ),
    ),
    "FlatFileAllOrdersReportByLastUpdate": FeedCase(
        {
            "marketplaceId": "marketplaceId",
            **_na("amazon_order_id"),
            **_local("purchase_date last_updated_date"),
            "order_status": "order_status",
            **_na("sku asin"),
            **_same("quantity currency item_price"),
        },
        keys="purchase_date, amazon_order_id, asin, sku",
        lead="last_updated_date DESC NULLS LAST, _batch_runtime DESC NULLS LAST,"
        " _batch_id DESC NULLS LAST",
        first_keys="last_updated_date, purchase_date, amazon_order_id, asin, sku",
        seq_keys="purchase_date, amazon_order_id, asin, sku, src",
        seq_order=(
            "_batch_runtime DESC NULLS LAST, quantity DESC NULLS LAST, marketplaceId NULLS FIRST,"
            " last_updated_date NULLS FIRST, order_status NULLS FIRST, currency NULLS FIRST,"
            " item_price NULLS FIRST, _batch_id NULLS FIRST"
        ),
        fx_day="purchase_date",
        fx_code="currency",
    ),
    "FlatFileReturnsReportByReturnDate": FeedCase(
        {
            **_same("ReportRequestTime marketplaceId"),
            **_na("Order_ID"),
            **_same("Return_request_date Amazon_RMA_ID Currency_code"),
            **_na("ASIN"),
            **_same("Return_quantity Refunded_Amount"),
        },
        keys="Return_request_date, Order_ID, ASIN",
        lead="_batch_runtime DESC NULLS LAST, Amazon_RMA_ID DESC NULLS LAST,"
        " _batch_id DESC NULLS LAST",
        fx_day="ReportRequestTime",
        fx_code="Currency_code",
    ),
    "InventoryLedgerDetailedReport": FeedCase(
        {
            **_local("reportstartdate"),
            **_same("sellingpartnerid marketplaceid"),
            "Date": 'CAST("Date" AS DATE)',
            **_na("asin msku event_type reference_id"),
            "quantity": "COALESCE(quantity, 0)",
            **_na("disposition"),
            "reason": "reason",
        },
        keys='"Date", asin, msku, event_type, reference_id, quantity, disposition, marketplaceid',
    ),
    "ListFinancialEventsOrderFees": _finance(fin.ORDER_FEES, default=False),
    "ListFinancialEventsOrderPromotions": _finance(fin.ORDER_PROMOTIONS),
    "ListFinancialEventsOrderRevenue": _finance(fin.ORDER_REVENUE),
    "ListFinancialEventsOrderTaxes": _finance(fin.ORDER_TAXES),
    "ListFinancialEventsRefundFees": _finance(fin.REFUND_FEES),
    "ListFinancialEventsRefundPromotions": _finance(fin.REFUND_PROMOTIONS),
    "ListFinancialEventsRefundRevenue": _finance(fin.REFUND_REVENUE),
    "ListFinancialEventsRefundTaxes": _finance(fin.REFUND_TAXES),
    "ListFinancialEventsServiceFees": FeedCase(
        {
            **_same("RequestStartDate sellingPartnerId marketplaceName marketplaceId"),
            **_na("ServiceFeeEventList_FeeReason FeeList_FeeType"),
            **_same("FeeAmount_CurrencyCode FeeAmount_CurrencyAmount"),
            **_na("ServiceFeeEventList_SellerSKU"),
            "ServiceFeeEventList_FeeDescription": "ServiceFeeEventList_FeeDescription",
        },
        keys=(
            "CAST(RequestStartDate AS DATE), marketplaceId, ServiceFeeEventList_FeeReason,"
            " FeeList_FeeType, ServiceFeeEventList_SellerSKU, ServiceFeeEventList_FeeDescription"
        ),
        rank="dense_rank()",
        lead="_batch_runtime DESC NULLS LAST",
        seq_keys=(
            "CAST(RequestStartDate AS DATE), marketplaceName, ServiceFeeEventList_FeeReason,"
            " FeeList_FeeType, ServiceFeeEventList_SellerSKU, ServiceFeeEventList_FeeDescription"
        ),
        seq_order=(
            "_batch_runtime NULLS FIRST, _batch_id NULLS FIRST, RequestStartDate NULLS FIRST,"
            " sellingPartnerId NULLS FIRST, marketplaceId NULLS FIRST,"
            " FeeAmount_CurrencyCode NULLS FIRST, FeeAmount_CurrencyAmount NULLS FIRST, src"
        ),
        fx_day="RequestStartDate",
        fx_code="FeeAmount_CurrencyCode",
    ),
    "ListOrder": FeedCase(
        {
            **_same("sellingPartnerId marketplaceName"),
            **_na("AmazonOrderId"),
            **_local("PurchaseDate LastUpdateDate"),
            **_same("OrderStatus NumberOfItemsShipped BuyerInfo_BuyerEmail BuyerInfo_BuyerName"),
        },
        keys="CAST(PurchaseDate AS DATE), AmazonOrderId, marketplaceName",
    ),
    "ListingOffersForASIN": FeedCase(
        {
            "RequeststartDate": "RequeststartDate",
            **_na("ASIN SKU"),
            **_same("itemCondition sellingPartnerId Summary_TotalOfferCount"),
            **_same("BuyBoxPrices_condition BuyBoxPrices_quantityTier"),
            **_same("LandedPrice_CurrencyCode LandedPrice_Amount"),
            **_same("ListingPrice_CurrencyCode ListingPrice_Amount Summary_OffersAvailableTime"),
        },
        keys="ASIN, itemCondition",
    ),
    "SalesAndTrafficReportByChildASIN": FeedCase(
        {
            **_same("sellingPartnerId marketplaceId"),
            "date": '"date"',
            **_na("parentAsin childAsin"),
            **_same("unitsOrdered orderedProductSales_amount orderedProductSales_currencyCode"),
        },
        keys='"date", parentAsin, childAsin, marketplaceId',
        fx_day='"date"',
        fx_code="orderedProductSales_currencyCode",
    ),
}

# Raw columns a flat shape leaves out although the check SQL defaults them.
_ABSENT = {"FBAReturnsReport": ("fnsku", "license_plate_number")}
_DATES = ("snapshot_date", "return_date", "Return_request_date", "Date", "date")


def config(name: str) -> Config:
    offsets = {raw.SOURCE_NAMES[1].format(name): -7}
    return Config(convert_currency=True, convert_timezone=True, offset_hours=offsets)


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, which any client reads alike."""
    as_is = {"date": "string", "decimal(38,9)": "double"}
    return df.select(
        *[F.col(c).cast(as_is[t]).alias(c) if t in as_is else F.col(c) for c, t in df.dtypes]
    )


def output_columns(name: str) -> list[str]:
    case = CASES[name]
    marks = [n for n in raw.marked(feed(name)) if n not in case.filled]
    columns = ["brand", "store", *case.filled, *marks]
    if case.fx_day:
        columns += ["exchange_currency_rate", "exchange_currency_code"]
    columns += LINEAGE
    return [*columns, SEQ_ID] if case.seq_keys else columns


def feed_query(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        item = feed(name)
        rates = raw.rates(spark, sf_dir) if item.fx else None
        df = build(spark, item, raw.sources(spark, sf_dir, name), config(name), rates)
        return comparable(df.select(*output_columns(name)))

    return run


# Feeds whose nested columns also come as semi-structured values.
VARIANT_FEEDS = ("ListFinancialEventsOrderFees", "CatalogItems")


def variant_feed_query(name: str):
    """The feed from raw tables whose arrays are VARIANT columns."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        item = feed(name)
        landed = raw.sources(spark, sf_dir, name, lambda c: F.parse_json(F.to_json(c)))
        rates = raw.rates(spark, sf_dir) if item.fx else None
        df = build(spark, item, landed, config(name), rates)
        return comparable(df.select(*output_columns(name)))

    return run


# Feeds of one layout cut out of the same records, which are scanned once for all of them.
EVENT_FEEDS = [n for n, item in FEEDS.items() if item.like == fin.LIKE and len(item.columns) == 8]


def _shared_columns() -> list[str]:
    """Names of the common layout in the place of each feed's own."""
    names = "posted order_id market sku quantity kind code amount".split()
    rates = ["exchange_currency_rate", "exchange_currency_code"]
    return ["brand", "store", *names, *rates, *LINEAGE, SEQ_ID]


def shared_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all financial-event feeds, from one scan of their raw tables.

    Each feed is written before the next begins: rows that wait in shuffle files
    take several times the space of the written ones, and those of one feed only
    are there at a time.
    """
    feeds = [feed(name) for name in EVENT_FEEDS]
    cfg = config(EVENT_FEEDS[0])
    out = []
    with staged_tables(spark):
        shared = share(spark, feeds, raw.event_sources(spark, sf_dir, feeds), cfg)
        rates = Rates.measure(raw.rates(spark, sf_dir))
        for name, item in zip(EVENT_FEEDS, feeds, strict=True):
            rows = build(spark, item, [], cfg, rates, shared=shared)
            rows = comparable(rows.select(*output_columns(name))).toDF(*_shared_columns())
            out.append(stage(rows.withColumn("feed", F.lit(name)), item.name, keep=True, codec=COMPACT))
    return reduce(DataFrame.unionByName, out)


def shared_feeds_sql() -> str:
    names = _shared_columns()
    at = names.index(LINEAGE[0])
    columns = ", ".join([*names[: at - 2], *names[at:], *names[at - 2 : at]])  # as the feeds' SQL has them
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feed, * FROM ({feed_sql(name)}) AS f({columns})" for name in EVENT_FEEDS
    )


def feed_sql(name: str, batches: str = "TRUE") -> str:
    case = CASES[name]
    rows = raw.duck(case.rows or raw.FLAT.get(name) or raw.NESTED_ROWS[name])
    if name in _ABSENT:
        nulls = ", ".join(f"CAST(NULL AS STRING) AS {c}" for c in _ABSENT[name])
        rows = f"SELECT *, {nulls} FROM ({rows}) AS f"
    defined = {**case.filled, **case.extra}
    if case.fx_day:
        defined["fx_day"] = f"CAST({case.fx_day} AS DATE)"
    select = ", ".join(f'raw.{e} AS "{n}"' if e == n else f'{e} AS "{n}"' for n, e in defined.items())
    ties = ", ".join(f'"{n}" NULLS FIRST' for n in case.filled)
    order = case.lead if case.rank == "dense_rank()" else f"{case.lead}, {ties}"
    numbered, newest_of = "", "tagged"
    if case.first_keys:
        # numbered after one keep-latest stage and before the last
        numbered = (
            f" first AS (SELECT * FROM tagged QUALIFY row_number() OVER (PARTITION BY"
            f" {case.first_keys}, src ORDER BY _batch_runtime DESC NULLS LAST,"
            f" _batch_id DESC NULLS LAST, {ties}) = 1),"
            f" numbered AS (SELECT *, row_number() OVER (PARTITION BY {case.seq_keys}"
            f" ORDER BY {case.seq_order}) AS {SEQ_ID} FROM first),"
        )
        newest_of = "numbered"
    sql = (
        f"WITH raw AS ({rows}), tagged AS (SELECT src,"
        " CASE src WHEN 0 THEN 'Acme' ELSE 'Globex' END AS brand,"
        " CASE src WHEN 0 THEN 'US' ELSE 'UK' END AS store,"
        f" {select}, {', '.join(LINEAGE)} FROM raw WHERE ({case.where}) AND ({batches})),"
        f"{numbered} latest AS (SELECT * FROM {newest_of} QUALIFY {case.rank}"
        f" OVER (PARTITION BY {case.keys}, src ORDER BY {order}) = 1)"
    )
    columns = [
        f'CAST(latest."{n}" AS STRING) AS "{n}"' if n in _DATES else f'latest."{n}"'
        for n in ("brand", "store", *case.filled, *LINEAGE)
    ]
    columns += [f"'{n}' AS \"{n}\"" for n in raw.marked(feed(name)) if n not in case.filled]
    joins = ""
    if case.first_keys:
        columns.append(f"latest.{SEQ_ID}")
    elif case.seq_keys:
        columns.append(
            f"row_number() OVER (PARTITION BY {case.seq_keys} ORDER BY {case.seq_order})"
            f" AS {SEQ_ID}"
        )
    if case.fx_day:
        sql += f", rates AS ({raw.duck(raw.RATES)})"
        columns += [
            "CAST(COALESCE(rates.value, 1) AS DOUBLE) AS exchange_currency_rate",
            f"COALESCE(rates.from_currency_code, {case.fx_code}) AS exchange_currency_code",
        ]
        joins = (
            f" LEFT JOIN rates ON rates.date = latest.fx_day"
            f" AND rates.to_currency_code = {case.fx_code}"
        )
    return f"{sql} SELECT {', '.join(columns)} FROM latest{joins}"


def key_of(name: str) -> str:
    """Query key: the feed's name in snake case behind ``pl_``."""
    out = ""
    for i, ch in enumerate(name):
        starts = ch.isupper() and i and (
            name[i - 1].islower() or (i + 1 < len(name) and name[i + 1].islower())
        )
        out += ("_" if starts else "") + ch.lower()
    return f"pl_{out}"
