"""Orders, catalog items and listing offers: records with a few nested arrays."""

from __future__ import annotations

from tradeloom.config import BATCH_ID, BATCH_RUNTIME, Feed, Latest
from tradeloom.plans.columns import checks, keys, leaf_stamp, leaves, plain, stamps

# Fixed values throughout this file: column names, keys and name patterns are
# the staged tables' public layout.

LIST_ORDER = Feed(
    name="ListOrder",
    like="%listorder",
    tz_aware=True,
    unnest=("BuyerInfo",),
    nested_ddl=(
        "BuyerInfo array<struct<BuyerEmail:string,BuyerName:string,"
        "BuyerCounty:string,PurchaseOrderNumber:string>>"
    ),
    columns=(
        *stamps("RequestStartDate RequestEndDate"),
        *plain("sellingPartnerId marketplaceName"),
        *keys("AmazonOrderId"),
        *plain("SellerOrderId"),
        *stamps("PurchaseDate LastUpdateDate"),
        *plain(
            """OrderStatus FulfillmentChannel SalesChannel OrderChannel ShipServiceLevel
            NumberOfItemsShipped:bigint NumberOfItemsUnshipped:bigint PaymentMethod
            PaymentMethodDetails MarketplaceId ShipmentServiceLevelCategory
            EasyShipShipmentStatus CbaDisplayableShippingLabel OrderType EarliestShipDate
            LatestShipDate EarliestDeliveryDate LatestDeliveryDate IsBusinessOrder IsPrime
            IsPremiumOrder IsGlobalExpressEnabled ReplacedOrderId IsReplacementOrder
            PromiseResponseDueDate IsEstimatedShipDateSet IsSoldByAB BuyerInvoicePreference
            IsISPU SellerDisplayName"""
        ),
        *leaves("BuyerInfo", "BuyerEmail BuyerName BuyerCounty PurchaseOrderNumber"),
    ),
    latest=(Latest(("day(PurchaseDate)", "AmazonOrderId", "marketplaceName")),),
    merge_keys=("PurchaseDate", "AmazonOrderId", "marketplaceName", "sellingPartnerId"),
    partition_by="PurchaseDate",
    cluster_by=("LastUpdateDate", "PurchaseDate", "AmazonOrderId"),
    checks=checks("PurchaseDate AmazonOrderId marketplaceName", "PurchaseDate", "AmazonOrderId"),
)

CATALOG_ITEMS = Feed(
    name="CatalogItems",
    like="%catalogitems",
    unnest=(
        "summaries",
        "salesRanks",
        "salesRanks.classificationRanks",
        "salesRanks.displayGroupRanks",
    ),
    nested_ddl=(
        "summaries array<struct<marketplaceId:string,brand:string,color:string,"
        "itemClassification:string,itemName:string,manufacturer:string,modelNumber:string,"
        "packageQuantity:string,partNumber:string,size:string,style:string,"
        "websiteDisplayGroup:string,websiteDisplayGroupName:string>>, "
        "salesRanks array<struct<marketplaceId:string,"
        "classificationRanks:array<struct<classificationId:string,title:string,"
        "link:string,rank:string>>,"
        "displayGroupRanks:array<struct<websiteDisplayGroup:string,title:string,"
        "link:string,rank:string>>>>"
    ),
    columns=(
        *stamps("RequeststartDate RequestendDate"),
        *keys("ReferenceASIN"),
        *plain("sellingPartnerId marketplaceName marketplaceId asin"),
        *leaves("salesRanks", "marketplaceId"),
        *leaves("classificationRanks", "classificationId title link rank:integer"),
        *leaves("displayGroupRanks", "websiteDisplayGroup title link rank:integer"),
        *leaves("summaries", "marketplaceId"),
        *leaves("summaries", "brand>brandName", default="N/A"),
        *leaves("summaries", "color>colorName itemClassification itemName manufacturer"),
        *leaves("summaries", "modelNumber", default="N/A"),
        *leaves("summaries", "packageQuantity:integer partNumber size>sizeName style>styleName"),
        *leaves("summaries", "websiteDisplayGroup websiteDisplayGroupName"),
    ),
    latest=(
        Latest(
            (
                "summaries.brand",
                "ReferenceASIN",
                "summaries.modelNumber",
                "summaries.marketplaceId",
            ),
            order=(BATCH_RUNTIME, BATCH_ID),
        ),
    ),
    merge_keys=(
        "summaries_brandName",
        "ReferenceASIN",
        "summaries_modelNumber",
        "marketplaceId",
        "sellingPartnerId",
    ),
    partition_by="RequeststartDate",
    cluster_by=("RequeststartDate", "summaries_brandName", "ReferenceASIN"),
    checks=checks(
        "summaries_brandName ReferenceASIN summaries_modelNumber marketplaceId sellingPartnerId",
        "RequeststartDate",
        brand=False,
    ),
)

LISTING_OFFERS = Feed(
    name="ListingOffersForASIN",
    like="%listingoffersforasin",
    unnest=(
        "Summary",
        "Summary.BuyBoxPrices",
        "BuyBoxPrices.LandedPrice",
        "BuyBoxPrices.ListingPrice",
    ),
    nested_ddl=(
        "Summary array<struct<TotalOfferCount:string,OffersAvailableTime:string,"
        "BuyBoxPrices:array<struct<condition:string,offerType:string,quantityTier:string,"
        "quantityDiscountType:string,sellerId:string,"
        "LandedPrice:array<struct<CurrencyCode:string,Amount:string>>,"
        "ListingPrice:array<struct<CurrencyCode:string,Amount:string>>>>>>"
    ),
    columns=(
        *stamps("RequeststartDate RequestendDate"),
        *plain("ReferenceSKU"),
        *keys("ASIN SKU"),
        *plain("itemCondition customerType status marketplaceId sellingPartnerId"),
        *leaves("Summary", "TotalOfferCount:integer"),
        *leaves(
            "BuyBoxPrices", "condition offerType quantityTier:integer quantityDiscountType"
        ),
        *leaves("LandedPrice", "CurrencyCode Amount:numeric"),
        *leaves("ListingPrice", "CurrencyCode Amount:numeric"),
        *leaves("BuyBoxPrices", "sellerId"),
        *leaf_stamp("Summary", "OffersAvailableTime"),
    ),
    latest=(Latest(("ASIN", "itemCondition")),),
    merge_keys=("ASIN", "itemCondition", "sellingPartnerId"),
    partition_by="RequeststartDate",
    cluster_by=("RequeststartDate", "ASIN", "itemCondition"),
    checks=checks("ASIN itemCondition", "RequeststartDate"),
)
