"""The nine flat reports."""

from __future__ import annotations

from tradeloom.config import BATCH_RUNTIME, SEQ_ID, Feed, Fx, Latest, Sequence
from tradeloom.plans.columns import REPORT_HEAD, checks, dates, keys, plain, stamps, zeros

# Fixed values throughout this file: column names, keys and name patterns are
# the staged tables' public layout.

ALL_LISTINGS = Feed(
    name="AllListingsReport",
    like="%alllistingsreport",
    columns=(
        *REPORT_HEAD,
        *plain("item_name item_description listing_id seller_sku price:double quantity:bigint"),
        *stamps("open_date"),
        *plain(
            """image_url item_is_marketplace product_id_type zshop_shipping_fee item_note
            item_condition zshop_category1 zshop_browse_path zshop_storefront_feature
            asin1 asin2 asin3 will_ship_internationally expedited_shipping zshop_boldface
            product_id bid_for_featured_placement add_delete pending_quantity:bigint
            fulfillment_channel optional_payment_type_exclusion merchant_shipping_group status
            maximum_retail_price:double scheduled_delivery_sku_set standard_price_point
            ProductTaxCode minimum_seller_allowed_price:double
            maximum_seller_allowed_price:double"""
        ),
    ),
    latest=(Latest(("seller_sku", "listing_id"), ties="all"),),
    merge_keys=("seller_sku", "listing_id"),
    cluster_by=("ReportstartDate", "seller_sku"),
    checks=checks("seller_sku listing_id", not_null="seller_sku", brand=False),
)

FULFILLED_SHIPMENTS = Feed(
    name="FBAAmazonFulfilledShipmentsReport",
    like="%fulfilledshipments%",
    tz_aware=True,
    columns=(
        *REPORT_HEAD,
        *keys("amazon_order_id"),
        *plain("merchant_order_id shipment_id shipment_item_id"),
        *plain("amazon_order_item_id merchant_order_item_id"),
        *stamps("purchase_date payments_date shipment_date reporting_date"),
        *plain("buyer_email buyer_name buyer_phone_number"),
        *keys("sku"),
        *plain("product_name quantity_shipped:bigint currency"),
        *plain("item_price item_tax shipping_price shipping_tax", "double"),
        *plain("gift_wrap_price gift_wrap_tax", "double"),
        *plain(
            """ship_service_level recipient_name ship_address_1 ship_address_2 ship_address_3
            ship_city ship_state ship_postal_code ship_country ship_phone_number
            bill_address_1 bill_address_2 bill_address_3 bill_city bill_state
            bill_postal_code bill_country item_promotion_discount:double
            ship_promotion_discount:double carrier tracking_number estimated_arrival_date
            fulfillment_center_id fulfillment_channel sales_channel"""
        ),
    ),
    where_not=(("sales_channel", "Non-Amazon"),),
    latest=(Latest(("purchase_date", "sku", "amazon_order_id", "marketplaceName")),),
    sequence=Sequence(
        ("purchase_date", "sku", "amazon_order_id"),
        (BATCH_RUNTIME, "quantity_shipped"),
        per_source=True,
    ),
    fx=Fx("purchase_date", "currency", raw=True),
    merge_keys=("purchase_date", "sku", "amazon_order_id", "marketplaceName", SEQ_ID),
    partition_by="purchase_date",
    cluster_by=("reporting_date", "purchase_date", "sku", "amazon_order_id"),
    checks=checks(
        "purchase_date sku amazon_order_id marketplaceName _seq_id", "purchase_date", days=3
    ),
)

MANAGE_INVENTORY = Feed(
    name="FBAManageInventory",
    like="%fbamanageinventory",
    columns=(
        *REPORT_HEAD,
        *keys("sku"),
        *plain("fnsku asin product_name condition your_price:double"),
        *plain("mfn_listing_exists mfn_fulfillable_quantity:bigint afn_listing_exists"),
        *plain(
            """afn_warehouse_quantity afn_fulfillable_quantity afn_fulfillable_quantity_local
            afn_fulfillable_quantity_remote afn_unsellable_quantity afn_reserved_quantity
            afn_total_quantity""",
            "bigint",
        ),
        *plain("per_unit_volume", "double"),
        *plain(
            """afn_inbound_working_quantity afn_inbound_shipped_quantity
            afn_inbound_receiving_quantity afn_researching_quantity
            afn_reserved_future_supply afn_future_supply_buyable""",
            "bigint",
        ),
    ),
    latest=(Latest(("day(ReportstartDate)", "sku", "marketplaceId"), ties="all"),),
    merge_keys=("ReportstartDate", "sku", "marketplaceId"),
    partition_by="ReportstartDate",
    cluster_by=("ReportstartDate", "sku"),
    checks=checks("ReportstartDate sku marketplaceId", "ReportstartDate", "sku"),
)

INVENTORY_HEALTH = Feed(
    name="FBAManageInventoryHealthReport",
    like="%fbamanageinventoryhealthreport",
    columns=(
        *REPORT_HEAD,
        *dates("snapshot_date"),
        *keys("sku"),
        *plain("fnsku"),
        *keys("asin"),
        *plain("product_name condition available:bigint pending_removal_quantity:bigint"),
        *plain(
            """inv_age_0_to_90_days inv_age_91_to_180_days inv_age_181_to_270_days
            inv_age_271_to_365_days inv_age_365_plus_days""",
            "bigint",
        ),
        *plain("currency"),
        *plain(
            """qty_to_be_charged_ltsf_6_mo projected_ltsf_6_mo qty_to_be_charged_ltsf_12_mo
            estimated_ltsf_next_charge""",
            "double",
        ),
        *plain("units_shipped_t7 units_shipped_t30 units_shipped_t60 units_shipped_t90", "bigint"),
        *plain("alert"),
        *plain(
            "your_price sales_price lowest_price_new_plus_shipping lowest_price_used", "double"
        ),
        *plain(
            """recommended_action healthy_inventory_level:bigint
            recommended_sales_price:double recommended_sale_duration_days:bigint
            recommended_removal_quantity:bigint
            estimated_cost_savings_of_recommended_actions:double sell_through:double
            item_volume:double volume_unit_measurement storage_type storage_volume:double
            marketplace product_group sales_rank:bigint days_of_supply:bigint
            estimated_excess_quantity:bigint weeks_of_cover_t30:double
            weeks_of_cover_t90:double featuredoffer_price:double
            sales_shipped_last_7_days:double sales_shipped_last_30_days:double
            sales_shipped_last_60_days:double sales_shipped_last_90_days:double
            inv_age_0_to_30_days:bigint inv_age_31_to_60_days:bigint
            inv_age_61_to_90_days:bigint inv_age_181_to_330_days:bigint
            inv_age_331_to_365_days:bigint estimated_storage_cost_next_month:double
            inbound_quantity:bigint inbound_working:bigint inbound_shipped:bigint
            inbound_received:bigint no_sale_last_6_months"""
        ),
    ),
    latest=(Latest(("snapshot_date", "asin", "sku", "marketplaceId"), ties="all"),),
    fx=Fx("ReportRequestTime", "currency", raw=True),
    merge_keys=("snapshot_date", "asin", "sku", "marketplaceId", "sellingPartnerId"),
    partition_by="snapshot_date",
    cluster_by=("snapshot_date", "asin", "sku"),
    checks=checks("snapshot_date asin sku marketplaceId", "snapshot_date", "sku"),
)

FBA_RETURNS = Feed(
    name="FBAReturnsReport",
    like="%fbareturnsreport",
    columns=(
        *REPORT_HEAD,
        *dates("return_date"),
        *keys("order_id sku asin fnsku"),
        *plain("product_name quantity:bigint"),
        *keys("fulfillment_center_id"),
        *plain("detailed_disposition reason status"),
        *keys("license_plate_number"),
        *plain("customer_comments"),
    ),
    latest=(
        Latest(
            (
                "day(return_date)", "asin", "sku", "order_id", "fnsku",
                "license_plate_number", "fulfillment_center_id", "marketplaceId",
            ),
            ties="all",
        ),
    ),
    sequence=Sequence(
        (
            "day(return_date)", "asin", "sku", "order_id", "fnsku",
            "license_plate_number", "fulfillment_center_id",
        ),
        ("-" + BATCH_RUNTIME,),
        per_source=True,
    ),
    merge_keys=(
        "return_date", "asin", "sku", "order_id", "fnsku",
        "license_plate_number", "fulfillment_center_id", SEQ_ID, "marketplaceId",
    ),
    partition_by="return_date",
    cluster_by=("ReportstartDate", "return_date", "asin", "sku"),
    checks=checks(
        "return_date asin sku order_id fnsku license_plate_number fulfillment_center_id"
        " _seq_id marketplaceId",
        "return_date",
    ),
)

ALL_ORDERS = Feed(
    name="FlatFileAllOrdersReportByLastUpdate",
    like="%flatfileallordersreportbylastupdate",
    tz_aware=True,
    columns=(
        *REPORT_HEAD,
        *keys("amazon_order_id"),
        *plain("merchant_order_id"),
        *stamps("purchase_date last_updated_date"),
        *plain(
            """order_status fulfillment_channel sales_channel order_channel url
            ship_service_level product_name"""
        ),
        *keys("sku asin"),
        *plain("item_status quantity:bigint currency"),
        *plain("item_price item_tax shipping_price shipping_tax", "double"),
        *plain("gift_wrap_price gift_wrap_tax", "double"),
        *plain("item_promotion_discount ship_promotion_discount", "double"),
        *plain(
            """address_type ship_city ship_state ship_postal_code ship_country promotion_ids
            item_extensions_data is_business_order purchase_order_number price_designation
            buyer_company_name customized_url customized_page is_replacement_order
            original_order_id licensee_name license_number license_state
            license_expiration_date"""
        ),
    ),
    latest=(
        Latest(("last_updated_date", "purchase_date", "amazon_order_id", "asin", "sku")),
        Latest(
            ("purchase_date", "amazon_order_id", "asin", "sku"),
            order=("last_updated_date", BATCH_RUNTIME),
        ),
    ),
    sequence=Sequence(
        ("purchase_date", "amazon_order_id", "asin", "sku"),
        ("-" + BATCH_RUNTIME, "-quantity"),
        per_source=True,
        before_last=True,
    ),
    fx=Fx("purchase_date", "currency", raw=True),
    merge_keys=("purchase_date", "amazon_order_id", "asin", "sku", SEQ_ID),
    merge_exclude=(
        "quantity", "currency", "item_price", "item_tax", "shipping_price",
        "shipping_tax", "gift_wrap_price", "gift_wrap_tax",
        "item_promotion_discount", "ship_promotion_discount",
    ),
    partition_by="purchase_date",
    cluster_by=("last_updated_date", "purchase_date", "asin", "amazon_order_id"),
    checks=checks("purchase_date amazon_order_id asin sku _seq_id", "purchase_date"),
)

MERCHANT_RETURNS = Feed(
    name="FlatFileReturnsReportByReturnDate",
    like="%flatfilereturnsreportbyreturndate",
    columns=(
        *REPORT_HEAD,
        *keys("Order_ID"),
        *plain(
            """Order_date:date Return_request_date:date Return_request_status Amazon_RMA_ID
            Merchant_RMA_ID Seller_RMA_ID Label_type Label_cost:double Currency_code
            Return_carrier Tracking_ID Label_to_be_paid_by A_to_z_claim Is_prime"""
        ),
        *keys("ASIN"),
        *plain(
            """Merchant_SKU Item_Name Return_quantity:bigint Return_Reason In_policy
            Return_type Resolution Invoice_number Return_delivery_date Order_Amount:double
            Order_quantity:bigint SafeT_action_reason SafeT_claim_id SafeT_claim_state
            SafeT_claim_creation_time SafeT_claim_reimbursement_amount:double
            Refunded_Amount:double Category"""
        ),
    ),
    latest=(
        Latest(("Return_request_date", "Order_ID", "ASIN", "marketplaceId"), ties="all"),
        Latest(
            ("Return_request_date", "Order_ID", "ASIN"), order=(BATCH_RUNTIME, "Amazon_RMA_ID")
        ),
    ),
    fx=Fx("ReportRequestTime", "Currency_code", raw=True),
    merge_keys=("Return_request_date", "Order_ID", "ASIN", "marketplaceId"),
    partition_by="Return_request_date",
    cluster_by=("ReportstartDate", "Return_request_date", "ASIN", "Order_ID"),
    checks=checks("Return_request_date Order_ID ASIN marketplaceId", "Return_request_date"),
)

INVENTORY_LEDGER = Feed(
    name="InventoryLedgerDetailedReport",
    like="%ledgerdetail%",
    tz_aware=True,
    columns=(
        *stamps("reportstartdate reportenddate reportrequesttime"),
        *plain("sellingpartnerid marketplacename marketplaceid"),
        *dates("Date"),
        *plain("fnsku"),
        *keys("asin msku"),
        *plain("title"),
        *keys("event_type reference_id"),
        *zeros("quantity"),
        *keys("fulfillment_center disposition"),
        *plain("reason country"),
    ),
    latest=(
        Latest(
            (
                "Date", "asin", "msku", "fulfillment_center", "event_type",
                "reference_id", "quantity", "disposition", "marketplaceid",
            )
        ),
    ),
    merge_keys=(
        "Date", "asin", "fulfillment_center", "msku", "event_type", "reference_id",
        "quantity", "disposition", "marketplaceid", "sellingpartnerid",
    ),
    partition_by="Date",
    cluster_by=("Date", "asin", "msku"),
    checks=checks(
        "Date asin fulfillment_center msku event_type reference_id quantity disposition"
        " marketplaceid",
        "Date",
        "msku fulfillment_center",
    ),
)

SALES_AND_TRAFFIC = Feed(
    name="SalesAndTrafficReportByChildASIN",
    like="%salesandtrafficreportbychildasin%",
    columns=(
        *REPORT_HEAD,
        *plain("date", "date"),
        *keys("parentAsin childAsin"),
        *plain("unitsOrdered unitsOrderedB2B", "bigint"),
        *plain("orderedProductSales_amount:double orderedProductSales_currencyCode"),
        *plain("orderedProductSalesB2B_amount:double orderedProductSalesB2B_currencyCode"),
        *plain("totalOrderItems totalOrderItemsB2B", "bigint"),
        *plain("browserSessions mobileAppSessions sessions", "bigint"),
        *plain(
            "browserSessionPercentage mobileAppSessionPercentage sessionPercentage", "double"
        ),
        *plain("browserPageViews mobileAppPageViews pageViews", "bigint"),
        *plain(
            """browserPageViewsPercentage mobileAppPageViewsPercentage pageViewsPercentage
            buyBoxPercentage unitSessionPercentage unitSessionPercentageB2B""",
            "double",
        ),
    ),
    latest=(Latest(("date", "parentAsin", "childAsin", "marketplaceId")),),
    fx=Fx("date", "orderedProductSales_currencyCode"),
    merge_keys=("date", "parentAsin", "childAsin", "marketplaceId", "sellingPartnerId"),
    partition_by="date",
    cluster_by=("ReportstartDate", "date", "parentAsin", "childAsin"),
    # The declared key names a column the report lacks; the suite reports that.
    checks=checks("date parentAsin childAsin sku marketplaceId", "date"),
)
