"""Answers computed straight on the landed tables (no star).

They serve as an independent cross-check of the star answers and as the
documented contrast cases (exact text match, uncleaned crosswalk, row-level
average denominators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.config import DEFAULT, StarConfig
from confluo.functions.text import lacks_all, not_blank
from confluo.plans.answers import star_join
from confluo.plans.metrics import Count, Registry, SemiAdditive, Sum, query, ratio
from confluo.plans.star import Star
from confluo.sources.binding import Landed


def _xref_clean(L: Landed, cfg: StarConfig) -> DataFrame:
    return L.xref.where(lacks_all("notes", cfg.drop_status_words))


def line_amount(L: Landed) -> DataFrame:
    """ERP line amount = qty x unit price, rounded to cents."""
    return L.erp_sales_lines.select(
        "sales_line_id",
        F.round(F.col("qty_sold") * F.col("unit_price"), 2).cast("decimal(18,2)").alias("gross_amount"))


def top_products(L: Landed, n: int = 5) -> DataFrame:
    """Top-n ERP products by line revenue (ties broken by SKU)."""
    rev = (L.erp_sales_lines.groupBy("sku")
           .agg(F.sum(F.col("qty_sold") * F.col("unit_price")).cast("decimal(38,2)").alias("revenue")))
    return (rev.join(L.products.select("sku", "product_name"), "sku")
            .orderBy(F.col("revenue").desc(), F.col("sku").asc()).limit(n)
            .select("sku", "product_name", "revenue"))


def net_by_month(L: Landed) -> DataFrame:
    """Marketplace settlements by settlement month: net, gross, effective fee rate."""
    s = L.mp_settlements.withColumn("month", F.substring("settlementDate", 1, 7))
    g = s.groupBy("month").agg(F.sum("payoutAmount").cast("decimal(38,2)").alias("net_revenue"),
                               F.sum("grossAmount").cast("decimal(38,2)").alias("gross_revenue"))
    return g.withColumn("effective_fee_rate", F.lit(1.0) - F.try_divide(
        F.col("net_revenue").cast("double"), F.col("gross_revenue").cast("double")))


def net_marketplace(L: Landed) -> DataFrame:
    """Orders joined to settlements (inner: unsettled orders drop out)."""
    return (L.mp_orders.join(L.mp_settlements.select("orderId", "payoutAmount"), "orderId")
            .select("orderId", F.col("grossAmount").alias("gross_amount"),
                    F.col("payoutAmount").alias("net_amount")))


def _unmapped_gross(orders: DataFrame, listing_ids: DataFrame) -> DataFrame:
    ids = listing_ids.select(F.col("listing_id").alias("__id"))
    un = orders.join(ids, F.col("listingId") == F.col("__id"), "left_anti")
    total = orders.agg(F.sum("grossAmount")).scalar()
    return un.agg(F.sum("grossAmount").cast("decimal(38,2)").alias("unmapped_gross"),
                  F.count(F.lit(1)).alias("unmapped_orders"),
                  F.try_divide(F.sum("grossAmount").cast("double") * F.lit(100.0),
                               total.cast("double")).alias("pct_of_gross"))


def unmapped_gross(L: Landed, cfg: StarConfig = DEFAULT) -> DataFrame:
    """Marketplace gross on listings the *cleaned* crosswalk cannot map."""
    x = _xref_clean(L, cfg).where(not_blank("listing_id")).select("listing_id")
    return _unmapped_gross(L.mp_orders, x)


def unmapped_gross_uncleaned(L: Landed) -> DataFrame:
    """Same, against the raw crosswalk (status words ignored): the contrast."""
    return _unmapped_gross(L.mp_orders, L.xref.where(not_blank("listing_id")).select("listing_id"))


def tickets_exact(L: Landed) -> DataFrame:
    """Tickets per product by *exact* text equality (no trim/upper): the
    under-count the normalised resolution fixes."""
    p = L.products.select(F.col("product_name").alias("__name"), "sku")
    # blank text names no product and may be a hot key; each text is counted before the join
    named = L.hd_tickets.where(not_blank("productText")).groupBy("productText").agg(F.count(F.lit(1)).alias("n"))
    return (named.join(p, F.col("productText") == F.col("__name"))
            .groupBy("sku").agg(F.sum("n").alias("tickets")))


def parts_attach_raw(L: Landed, category: str, cfg: StarConfig = DEFAULT) -> DataFrame:
    """Parts per 100 units for one category on raw tables: the category's SKUs
    pushed onto parts usage through the item-code crosswalk (two semi joins)."""
    skus = L.products.where(F.col("category") == category).select("sku")
    items = (_xref_clean(L, cfg).where(not_blank("itm_code"))
             .join(skus, "sku", "left_semi").select(F.col("itm_code").alias("ItemCode")))
    parts = L.svc_parts_usage.join(items, "ItemCode", "left_semi").agg(F.sum("QtyUsed")).scalar()
    units = L.erp_sales_lines.join(skus, "sku", "left_semi").agg(F.sum("qty_sold")).scalar()
    return L.spark.range(1).select(
        parts.alias("parts"), units.alias("units"),
        F.try_divide(parts.cast("double") * F.lit(100.0), units.cast("double")).alias("parts_per_100"))


def sell_through_naive(L: Landed, since_key: int) -> DataFrame:
    """Units over the *row-level* average on-hand (the wrong denominator:
    it averages single snapshot rows instead of daily network totals)."""
    dc_units = L.erp_sales_lines.where(F.col("date_key") >= since_key).agg(F.sum("qty_sold")).scalar()
    dc_oh = L.erp_inventory.where(F.col("date_key") >= since_key).agg(F.avg("on_hand_qty")).scalar()
    return L.spark.range(1).select(
        F.lit("ERP").alias("network"), dc_units.alias("units_sold"),
        dc_oh.alias("avg_row_on_hand"),
        F.try_divide(dc_units.cast("double"), dc_oh).alias("naive_sell_through"))


RAW_RELATIONSHIPS: tuple[tuple[str, str, str, str], ...] = (
    ("erp_sales_lines", "sku", "products", "sku"),
    ("erp_inventory", "sku", "products", "sku"),
    ("erp_sales_lines", "location_id", "locations", "location_id"),
    ("erp_inventory", "location_id", "locations", "location_id"),
)


def raw_star(L: Landed) -> Star:
    """The landed ERP tables as a star of their own: the four relationships that
    the raw tables support, and no others (other systems' codes don't match).
    Supplier names come with the products, joined there, not with each sale."""
    p = (L.products.select("sku", "product_name", "category", "abc_class", "supplier_key")
         .join(L.suppliers.select("supplier_key", "supplier_name"), "supplier_key", "left").drop("supplier_key"))
    loc = L.locations.select("location_id", "location_name", "location_type")
    return Star({"erp_sales_lines": L.erp_sales_lines, "erp_inventory": L.erp_inventory, "products": p, "locations": loc},
                relationships=RAW_RELATIONSHIPS, bounded=frozenset({"locations"}), unknown=())


def raw_registry() -> Registry:
    """Measures over the raw star's own columns."""
    return Registry([
        Sum("units", "erp_sales_lines", "qty_sold"),
        Count("lines", "erp_sales_lines"),
        Count("counts", "erp_inventory"),
        Sum("stockouts", "erp_inventory", "is_stockout"),
        SemiAdditive("avg_on_hand", "erp_inventory", "on_hand_qty"),
        ratio("stockout_share", "stockouts", "counts"),
        ratio("sell_through", "units", "avg_on_hand"),
    ])


def raw_star_join(L: Landed) -> DataFrame:
    """ERP lines with product, supplier and location attributes."""
    return star_join(raw_star(L), "erp_sales_lines")


def raw_inventory_join(L: Landed) -> DataFrame:
    """ERP stock counts with product, supplier and location attributes."""
    return star_join(raw_star(L), "erp_inventory")


def raw_by_category(L: Landed) -> DataFrame:
    """Sales and stock by product category, each over its own raw relationship, in one drill-across query."""
    return query(raw_star(L), raw_registry(), ["units", "lines", "avg_on_hand", "stockout_share", "sell_through"], by=["products.category"])


def raw_by_place(L: Landed) -> DataFrame:
    """The same by type of place."""
    return query(raw_star(L), raw_registry(), ["units", "counts", "stockouts", "avg_on_hand"], by=["locations.location_type"])
