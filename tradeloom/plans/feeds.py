"""All feeds by name."""

from __future__ import annotations

from tradeloom.config import Feed
from tradeloom.plans import finance, listings, reports

FEEDS: dict[str, Feed] = {
    f.name: f
    for f in (
        reports.ALL_LISTINGS,
        listings.CATALOG_ITEMS,
        reports.FULFILLED_SHIPMENTS,
        reports.MANAGE_INVENTORY,
        reports.INVENTORY_HEALTH,
        reports.FBA_RETURNS,
        reports.ALL_ORDERS,
        reports.MERCHANT_RETURNS,
        reports.INVENTORY_LEDGER,
        finance.ORDER_FEES,
        finance.ORDER_PROMOTIONS,
        finance.ORDER_REVENUE,
        finance.ORDER_TAXES,
        finance.REFUND_FEES,
        finance.REFUND_PROMOTIONS,
        finance.REFUND_REVENUE,
        finance.REFUND_TAXES,
        finance.SERVICE_FEES,
        listings.LIST_ORDER,
        listings.LISTING_OFFERS,
        reports.SALES_AND_TRAFFIC,
    )
}


def feed(name: str) -> Feed:
    """Look a feed up by name, ignoring case."""
    return {n.lower(): f for n, f in FEEDS.items()}[name.lower()]
