"""The nine feeds cut out of one nested financial-event record."""

from __future__ import annotations

from dataclasses import dataclass

from tradeloom.config import BATCH_ID, BATCH_RUNTIME, SEQ_ID, Feed, Fx, Latest, Sequence
from tradeloom.plans.columns import checks, leaf_stamp, leaves, plain, stamps

# Fixed values throughout this file: field names, keys and name patterns are
# the staged tables' public layout.

LIKE = "%listfinancialevents"
MONEY = "array<struct<CurrencyCode:string,CurrencyAmount:string>>"


@dataclass(frozen=True)
class _Event:
    """Order or refund side of the record."""

    word: str
    events: str
    items: str


_ORDER = _Event("Order", "ShipmentEventlist", "ShipmentItemList")
_REFUND = _Event("Refund", "RefundEventlist", "ShipmentItemAdjustmentList")


def _event_feed(
    event: _Event,
    what: str,
    lists: tuple[str, ...],
    type_field: str,
    amount: str,
    item_prefix: str,
    default: str | None = "N/A",
) -> Feed:
    """``lists`` leads from the item to the entry that has type and amount."""
    entry = lists[-1]
    nested = f"array<struct<{type_field}:string,{amount}:{MONEY}>>"
    for outer, inner in zip(reversed(lists[:-1]), reversed(lists[1:])):
        nested = f"array<struct<{inner}:{nested}>>"
    posted = f"{event.events}_PostedDate"
    market = f"{event.events}_MarketplaceName"
    order_id = f"{event.events}_AmazonOrderId"
    kind = f"{entry}_{type_field}"
    quantity = f"{item_prefix}_QuantityShipped"
    chain = [event.events, event.items, *lists, amount]
    merge_keys = (posted, market, order_id, kind, SEQ_ID)
    return Feed(
        name=f"ListFinancialEvents{event.word}{what}",
        like=LIKE,
        unnest=(chain[0], *(f"{a}.{b}" for a, b in zip(chain, chain[1:]))),
        nested_ddl=(
            f"{event.events} array<struct<PostedDate:string,AmazonOrderId:string,"
            f"MarketplaceName:string,{event.items}:array<struct<SellerSKU:string,"
            f"QuantityShipped:string,{lists[0]}:{nested}>>>>"
        ),
        columns=(
            *leaf_stamp(event.events, "PostedDate"),
            *leaves(event.events, "AmazonOrderId MarketplaceName", default=default),
            *leaves(event.items, "SellerSKU", item_prefix, default),
            *leaves(event.items, "QuantityShipped:integer", item_prefix),
            *leaves(entry, type_field, default=default),
            *leaves(amount, "CurrencyCode CurrencyAmount:numeric"),
        ),
        latest=(Latest((f"day({posted})", market, order_id, kind), ties="all"),),
        sequence=Sequence(
            (f"day({posted})", market, order_id), (BATCH_RUNTIME, kind, quantity)
        ),
        fx=Fx(posted, f"{amount}_CurrencyCode"),
        merge_keys=merge_keys,
        partition_by=posted,
        cluster_by=(posted, market, order_id),
        checks=checks(" ".join(merge_keys), posted),
    )


_TAXES = ("ItemTaxWithHeldList", "TaxesWithheld")

ORDER_FEES = _event_feed(
    _ORDER, "Fees", ("ItemFeeList",), "FeeType", "FeeAmount", "ShipmentItemlist", default=None
)
ORDER_PROMOTIONS = _event_feed(
    _ORDER,
    "Promotions",
    ("PromotionList",),
    "PromotionType",
    "PromotionAmount",
    "ShipmentItemlist",
)
ORDER_REVENUE = _event_feed(
    _ORDER, "Revenue", ("ItemChargeList",), "ChargeType", "ChargeAmount", "ShipmentItemList"
)
ORDER_TAXES = _event_feed(
    _ORDER, "Taxes", _TAXES, "ChargeType", "ChargeAmount", "ShipmentItemList"
)
REFUND_FEES = _event_feed(
    _REFUND, "Fees", ("ItemFeeAdjustmentList",), "FeeType", "FeeAmount", _REFUND.items
)
REFUND_PROMOTIONS = _event_feed(
    _REFUND, "Promotions", ("PromotionList",), "PromotionType", "PromotionAmount", _REFUND.items
)
REFUND_REVENUE = _event_feed(
    _REFUND, "Revenue", ("ItemChargeAdjustmentList",), "ChargeType", "ChargeAmount", _REFUND.items
)
REFUND_TAXES = _event_feed(_REFUND, "Taxes", _TAXES, "ChargeType", "ChargeAmount", _REFUND.items)

_SERVICE_KEY = (
    "ServiceFeeEventList_FeeReason",
    "FeeList_FeeType",
    "ServiceFeeEventList_SellerSKU",
    "ServiceFeeEventList_FeeDescription",
)

SERVICE_FEES = Feed(
    name="ListFinancialEventsServiceFees",
    like=LIKE,
    unnest=("ServiceFeeEventList", "ServiceFeeEventList.FeeList", "FeeList.FeeAmount"),
    nested_ddl=(
        "ServiceFeeEventList array<struct<AmazonOrderId:string,FeeReason:string,"
        "SellerSKU:string,FnSKU:string,FeeDescription:string,ASIN:string,"
        f"FeeList:array<struct<FeeType:string,FeeAmount:{MONEY}>>>>"
    ),
    columns=(
        *stamps("RequestStartDate RequestEndDate"),
        *plain("sellingPartnerId marketplaceName marketplaceId"),
        *leaves("ServiceFeeEventList", "AmazonOrderId FeeReason", default="N/A"),
        *leaves("FeeList", "FeeType", default="N/A"),
        *leaves("FeeAmount", "CurrencyCode CurrencyAmount:numeric"),
        *leaves("ServiceFeeEventList", "SellerSKU FnSKU", default="N/A"),
        *leaves("ServiceFeeEventList", "FeeDescription ASIN"),
    ),
    latest=(Latest(("day(RequestStartDate)", "marketplaceId", *_SERVICE_KEY), ties="all"),),
    sequence=Sequence(
        ("day(RequestStartDate)", "marketplaceName", *_SERVICE_KEY), (BATCH_RUNTIME, BATCH_ID)
    ),
    fx=Fx("RequestStartDate", "FeeAmount_CurrencyCode"),
    merge_keys=("RequestStartDate", "marketplaceId", *_SERVICE_KEY, SEQ_ID),
    partition_by="RequestStartDate",
    cluster_by=("RequestStartDate", "marketplaceName", "sellingPartnerId"),
    # The declared check names a column the table lacks; the suite reports that.
    checks=checks(not_null="posteddate"),
)
