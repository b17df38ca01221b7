"""The report measures and answers on the landed tables, beside the star's.

Differences to the star are those of the raw reports: marketplace money by settlement date, tickets by exact product name,
on-hand averaged over rows, ERP units only. ``channel_parity`` sets the one answer that must agree, net revenue by
channel, side by side with the star's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.config import DEFAULT, StarConfig
from confluo.functions.dates import date_key, iso_date_key, parse_text_date
from confluo.functions.text import normalise, not_blank
from confluo.plans.answers import latest_snapshot
from confluo.plans.legacy import _xref_clean
from confluo.sources.binding import Landed

TOTAL = "decimal(38,2)"


def _line() -> Column:
    return F.round(F.col("qty_sold") * F.col("unit_price"), 2)


def _rate(a: Column, b: Column, times: float = 1.0) -> Column:
    return F.try_divide(a.cast("double") * F.lit(times), b.cast("double"))


def month_total(L: Landed, month_key: int) -> DataFrame:
    """One month's money of the three systems, each by its own date: ERP line, settlement, store sale."""
    erp = L.erp_sales_lines.where(F.expr("date_key div 100") == month_key).agg(F.sum(_line())).scalar()
    text = f"{month_key // 100}-{month_key % 100:02d}"
    market = L.mp_settlements.where(F.substring("settlementDate", 1, 7) == text).agg(F.sum("payoutAmount")).scalar()
    store = L.rt_sales.where(F.substring("SALE_DATE", 4, 7) == f"{month_key % 100:02d}/{month_key // 100}").agg(F.sum("TOTAL_AMT")).scalar()
    cols = {"erp": erp, "marketplace": market, "retailer": store}
    out = L.spark.range(1).select(*[F.coalesce(v, F.lit(0)).cast(TOTAL).alias(k) for k, v in cols.items()])
    return out.withColumn("total", (F.col("erp") + F.col("marketplace") + F.col("retailer")).cast(TOTAL))


def stockout_rate_raw(L: Landed) -> DataFrame:
    """Share of the ERP's daily rows in stockout, all dates."""
    return L.erp_inventory.agg(F.count_if(F.col("is_stockout") == 1).alias("stockouts"), F.count(F.lit(1)).alias("counts")).withColumn(
        "rate", _rate(F.col("stockouts"), F.col("counts")))


def after_sale_by_product(L: Landed, cfg: StarConfig = DEFAULT) -> DataFrame:
    """Per product with ERP units: those units, tickets and open complaints by exact name, tickets per 1,000 units.

    Each side is added up by its own key first, so the joins see a row for each product and name."""
    units = L.erp_sales_lines.groupBy("sku").agg(F.sum("qty_sold").alias("units"))
    complaint = (F.col("categoryId") == cfg.complaint_category_id) & (F.col("status") == cfg.open_status)
    named = (L.hd_tickets.where(not_blank("productText")).groupBy("productText")
             .agg(F.count(F.lit(1)).alias("tickets"), F.count_if(complaint).alias("open_complaints")))
    products = L.products.select("sku", "product_name").join(units, "sku")
    out = products.join(named, F.col("product_name") == F.col("productText"), "left").fillna(0, ["tickets", "open_complaints"])
    return out.select("sku", "units", "tickets", "open_complaints", _rate(F.col("tickets"), F.col("units"), 1000.0).alias("per_1k"))


def after_sale_by_category(L: Landed, cfg: StarConfig = DEFAULT) -> DataFrame:
    """Per category: complaints by exact name plus parts fitted, per 1,000 ERP units."""
    products = L.products.select("sku", "product_name", "category")
    units = L.erp_sales_lines.groupBy("sku").agg(F.sum("qty_sold").alias("v")).join(products, "sku").groupBy("category").agg(F.sum("v").alias("units"))
    named = L.hd_tickets.where(F.col("categoryId") == cfg.complaint_category_id).groupBy("productText").agg(F.count(F.lit(1)).alias("v"))
    complaints = named.join(products, F.col("productText") == F.col("product_name")).groupBy("category").agg(F.sum("v").alias("complaints"))
    items = _xref_clean(L, cfg).where(not_blank("itm_code")).groupBy(F.col("itm_code").alias("ItemCode")).agg(F.min("sku").alias("sku"))
    parts = (L.svc_parts_usage.groupBy("ItemCode").agg(F.sum("QtyUsed").alias("v")).join(items, "ItemCode")
             .join(products, "sku").groupBy("category").agg(F.sum("v").alias("parts")))
    out = units.join(complaints, "category", "left").join(parts, "category", "left").fillna(0, ["complaints", "parts"])
    return out.withColumn("per_1k", _rate(F.col("complaints") + F.col("parts"), F.col("units"), 1000.0))


def sell_through_by_product(L: Landed) -> DataFrame:
    """Per product: ERP units over the mean of its daily rows, and the plain average of its category."""
    units = L.erp_sales_lines.groupBy("sku").agg(F.sum("qty_sold").alias("units"))
    stock = L.erp_inventory.groupBy("sku").agg(F.avg("on_hand_qty").alias("mean_row"))
    own = L.products.select("sku", "category").join(units, "sku").join(stock, "sku").withColumn("ratio", _rate(F.col("units"), F.col("mean_row")))
    whole = F.floor(F.col("ratio") * 1e12 + 0.5).cast("decimal(38,0)")
    peers = own.groupBy("category").agg((F.sum(whole).cast("double") / F.count("ratio") / 1e12).alias("category_average"))
    return own.join(peers, "category").select("sku", "category", "ratio", "category_average")


def store_network(L: Landed, since_key: int, cfg: StarConfig = DEFAULT) -> DataFrame:
    """The store network since a day: units, money, mean of the count rows, and units over that mean."""
    since = L.rt_sales.where(date_key(parse_text_date("SALE_DATE", cfg.text_date_format)) >= since_key).agg(
        F.sum("QTY").alias("units"), F.sum("TOTAL_AMT").cast(TOTAL).alias("amount"))
    mean = L.rt_stock_counts.agg(F.avg("QTY_ON_HAND")).scalar()
    return since.withColumn("mean_row", mean).withColumn("ratio", _rate(F.col("units"), F.col("mean_row")))


def a_class_at_risk_raw(L: Landed, cfg: StarConfig = DEFAULT) -> DataFrame:
    """A-class products with open complaints (by normalised name) whose latest ERP count of some place is at or below
    its safety stock. Complaints are counted by text before names are matched, and stock only of the products left."""
    named = L.products.where(F.col("abc_class") == "A").select("sku", "product_name")
    complaint = (F.col("categoryId") == cfg.complaint_category_id) & (F.col("status") == cfg.open_status)
    texts = L.hd_tickets.where(complaint & not_blank("productText")).select(normalise("productText").alias("name")).distinct()
    asked = named.join(texts, normalise("product_name") == F.col("name"), "left_semi")
    latest = latest_snapshot(L.erp_inventory.join(asked.select("sku"), "sku", "left_semi"))
    return asked.join(latest.where(F.col("on_hand_qty") <= F.col("safety_stock")).select("sku"), "sku", "left_semi")


def sell_through_networks_raw(L: Landed, since_key: int, cfg: StarConfig = DEFAULT) -> DataFrame:
    """Units since a day over the mean of the network's own daily (ERP) or weekly (stores) totals."""
    day = lambda c: date_key(parse_text_date(c, cfg.text_date_format))
    networks = [("ERP", L.erp_sales_lines.select("date_key", F.col("qty_sold").alias("n")), L.erp_inventory.select("date_key", F.col("on_hand_qty").alias("n"))),
                ("STORES", L.rt_sales.select(day("SALE_DATE").alias("date_key"), F.col("QTY").alias("n")), L.rt_stock_counts.select(day("COUNT_DATE").alias("date_key"), F.col("QTY_ON_HAND").alias("n")))]
    out = None
    for name, sold, held in networks:
        totals = held.where(F.col("date_key") >= since_key).groupBy("date_key").agg(F.sum("n").alias("n")).agg(F.avg("n")).scalar()
        row = sold.where(F.col("date_key") >= since_key).agg(F.sum("n").alias("units")).select(F.lit(name).alias("network"), "units", totals.alias("mean_total"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("ratio", _rate(F.col("units"), F.col("mean_total")))


def revenue_by_channel_raw(L: Landed, keys: tuple[int, int], cfg: StarConfig = DEFAULT) -> DataFrame:
    """Net revenue by channel in a range of days, straight from the three systems (settled orders by order date)."""
    settled = L.mp_orders.join(L.mp_settlements.select("orderId", "payoutAmount"), "orderId")
    parts = [L.erp_sales_lines.select("date_key", "channel", _line().alias("net")),
             settled.select(iso_date_key("orderDate").alias("date_key"), F.lit(cfg.channel_marketplace).alias("channel"), F.col("payoutAmount").alias("net")),
             L.rt_sales.select(date_key(parse_text_date("SALE_DATE", cfg.text_date_format)).alias("date_key"), F.lit(cfg.channel_retailer).alias("channel"), F.col("TOTAL_AMT").alias("net"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.where(F.col("date_key").between(*keys)).groupBy("channel").agg(F.sum("net").cast(TOTAL).alias("revenue_net"))


def channel_parity(star_answer: DataFrame, L: Landed, keys: tuple[int, int]) -> DataFrame:
    """Per channel the star's net revenue, the raw one, and whether they agree."""
    star = star_answer.select("channel", F.col("revenue_net").alias("star_net"))
    raw = revenue_by_channel_raw(L, keys).select("channel", F.col("revenue_net").alias("raw_net"))
    return star.join(raw, "channel", "full").withColumn("agrees", F.col("star_net").eqNullSafe(F.col("raw_net")))


def risk_parity(star_answer: DataFrame, L: Landed) -> DataFrame:
    """Products at risk by the star, by the raw tables, or both; the star also sees the stores' weekly counts."""
    star, raw = star_answer.select("sku", F.lit(True).alias("in_star")), a_class_at_risk_raw(L).select("sku", F.lit(True).alias("in_raw"))
    both = star.join(raw, "sku", "full").fillna(False, ["in_star", "in_raw"])
    return both.withColumn("agrees", F.col("in_star") == F.col("in_raw"))
