"""What each landed table contributes to the star, as data.

A :class:`Feed` names a landed table, how its product reference is resolved, and
the SQL expression of every conformed column that isn't already there under its
own name. ``Conformer.conform`` runs any feed; adding a system is adding feeds.
Expressions may use ``{name}`` for a value of the config.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Lookup:
    """How a feed's rows find their product.

    ``ref`` is the feed's reference; ``by`` one of the conformer's code maps,
    looked up by ``code``. ``kind``: ``code`` keeps all rows, ``text`` compares
    normalised text, ``must`` drops rows without a match, ``missing`` keeps only
    those. ``unknown`` names the config's label for rows without a match (None:
    null), ``row`` the column that tells rows apart when references are blank."""
    ref: str
    by: str
    code: str
    key: str = "sku"
    kind: str = "code"
    unknown: str | None = None
    row: str | None = None


@dataclass(frozen=True)
class Feed:
    table: str
    columns: dict[str, str] = field(default_factory=dict)
    lookup: Lookup | None = None
    # further landed tables or maps of the conformer: (table, shared column, inner or left)
    joins: tuple[tuple[str, str, str], ...] = ()


# Landed tables whose rows have a bound: only these are broadcast.
BOUNDED_TABLES = frozenset({"hd_categories"})

_ISO_DAY = "cast(date_format(try_to_timestamp({0}), 'yyyyMMdd') as int)"
_TEXT_DAY = "cast(date_format(try_to_date({0}, '{{text_date_format}}'), 'yyyyMMdd') as int)"

FEEDS: dict[str, Feed] = {
    "products": Feed("products", {"is_retailer_only": "false"}, joins=(("suppliers", "supplier_key", "left"), ("product_codes", "sku", "left"))),
    "retailer_only_products": Feed(
        "rt_products", lookup=Lookup("LOCAL_CODE", "local_map", "local_code", kind="missing"),
        columns={"sku": "concat('{retailer_only_prefix}', substring(LOCAL_CODE, {retailer_code_digits_from}))",
                 "product_name": "initcap(ITEM_DESC)", "list_price": "UNIT_PRICE", "local_code": "LOCAL_CODE",
                 "category": "'{only_category}'", "subcategory": "'{only_subcategory}'", "brand": "'{only_brand}'",
                 "abc_class": "'{only_class}'", "supplier_name": "'{only_supplier}'", "is_retailer_only": "true"}),
    "locations": Feed("locations", {"source": "'{source_erp}'"}),
    "stores": Feed("rt_stores", {
        "location_id": "STORE_CODE", "location_name": "initcap(STORE_NAME)", "region": "initcap(REGION)",
        "location_type": "'{store_type}'", "country": "'{store_country}'", "source": "'{source_retailer}'"}),
    "erp_sales": Feed("erp_sales_lines", {
        "qty": "qty_sold", "gross_amount": "round(qty_sold * unit_price, 2)", "net_amount": "round(qty_sold * unit_price, 2)",
        "source": "'{source_erp}'"}),
    "marketplace_sales": Feed(
        "mp_orders", joins=(("mp_settlements", "orderId", "inner"),),
        lookup=Lookup("listingId", "listing_map", "listing_id", unknown="unmapped_label", row="orderId"),
        columns={"date_key": _ISO_DAY.format("orderDate"), "gross_amount": "grossAmount", "net_amount": "payoutAmount",
                 "location_id": "'{marketplace_location_id}'", "channel": "'{channel_marketplace}'", "source": "'{source_marketplace}'"}),
    "retailer_sales": Feed(
        "rt_sales", lookup=Lookup("ITEM_DESC", "description_map", "desc", row="SALE_ID"),
        columns={"date_key": _TEXT_DAY.format("SALE_DATE"), "location_id": "STORE_CODE", "qty": "QTY", "gross_amount": "TOTAL_AMT",
                 "net_amount": "TOTAL_AMT", "channel": "'{channel_retailer}'", "source": "'{source_retailer}'"}),
    "daily_inventory": Feed("erp_inventory", {"grain": "'daily'", "source": "'{source_erp}'"}),
    "weekly_inventory": Feed(
        "rt_stock_counts", lookup=Lookup("LOCAL_CODE", "local_full", "LOCAL_CODE", key="c_sku", kind="must"),
        columns={"date_key": _TEXT_DAY.format("COUNT_DATE"), "location_id": "STORE_CODE", "on_hand_qty": "QTY_ON_HAND",
                 "is_stockout": "if(QTY_ON_HAND <= {near_zero_count}, 1, 0)", "grain": "'weekly'", "source": "'{source_retailer}'"}),
    "fact_service": Feed(
        "svc_work_orders", lookup=Lookup("ItemCode", "item_map", "itm_code", unknown="unresolved_label", row="WorkOrderId"),
        columns={"work_order_id": "WorkOrderId", "date_key": _ISO_DAY.format("OpenedAt"), "work_type": "WorkType",
                 "status": "Status", "labor_hours": "LaborHours"}),
    "fact_service_parts": Feed(
        "svc_parts_usage", lookup=Lookup("ItemCode", "item_map", "itm_code", unknown="unresolved_label", row="UsageId"),
        columns={"usage_id": "UsageId", "date_key": _ISO_DAY.format("UsedAt"), "qty_used": "QtyUsed"}),
    "fact_helpdesk": Feed(
        "hd_tickets", joins=(("hd_categories", "categoryId", "left"),),
        lookup=Lookup("productText", "name_map", "product_name", kind="text", unknown="unresolved_label", row="ticketId"),
        columns={"ticket_id": "ticketId", "date_key": _ISO_DAY.format("createdAt"), "category": "categoryName",
                 "is_complaint": "categoryId = {complaint_category_id}", "is_open": "status = '{open_status}'"}),
}
