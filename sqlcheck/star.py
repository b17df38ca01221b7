"""DuckDB SQL for the conformed star (oracle side), over the binding CTEs."""

from __future__ import annotations


def initcap(x: str) -> str:
    """Spark initcap for space-separated words, spelled out for DuckDB."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def iso_key(x: str) -> str:
    return f"CAST(strftime(TRY_CAST({x} AS TIMESTAMP), '%Y%m%d') AS INTEGER)"


def text_key(x: str) -> str:
    return f"CAST(strftime(try_strptime({x}, '%d/%m/%Y'), '%Y%m%d') AS INTEGER)"


EVENT_DATE = "DATE '2000-01-01'"

STAR_CTES: dict[str, str] = {
    "xref_clean": """
  SELECT * FROM xref
  WHERE coalesce(notes, '') NOT LIKE '%retired%' AND coalesce(notes, '') NOT LIKE '%CONFLICT%'""",
    "local_map": """
  SELECT local_code, sku FROM xref_clean WHERE local_code IS NOT NULL AND local_code <> ''""",
    "item_map": """
  SELECT itm_code, sku FROM xref_clean WHERE itm_code IS NOT NULL AND itm_code <> ''""",
    "listing_map": """
  SELECT listing_id, sku FROM xref_clean WHERE listing_id IS NOT NULL AND listing_id <> ''""",
    "local_full": """
  SELECT r.LOCAL_CODE, r.ITEM_DESC, coalesce(m.sku, 'RTX-' || substr(r.LOCAL_CODE, 5)) AS c_sku
  FROM rt_products r LEFT JOIN local_map m ON r.LOCAL_CODE = m.local_code""",
    "sales_dates": f"""
  SELECT date_key AS k FROM erp_sales_lines
  UNION ALL SELECT {iso_key('orderDate')} FROM mp_orders
  UNION ALL SELECT {text_key('SALE_DATE')} FROM rt_sales""",
    "cal_window": """
  SELECT CAST(strptime(CAST(min(k) AS VARCHAR), '%Y%m%d') AS DATE) AS lo,
         CAST(strptime(CAST(max(k) AS VARCHAR), '%Y%m%d') AS DATE) AS hi
  FROM sales_dates""",
    "dim_date": f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(strftime(d, '%Y%m') AS INTEGER) AS month_key, CAST(day(d) AS INTEGER) AS day,
         dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
         CAST(year(d) AS INTEGER) AS fiscal_year,
         'FY' || CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS fiscal_quarter,
         d >= {EVENT_DATE} AS is_post_event
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM cal_window)""",
    "dim_product": f"""
  SELECT p.sku, p.product_name, p.category, p.subcategory, p.brand, p.abc_class,
         p.standard_unit_cost, p.list_price, s.supplier_name, c.itm_code, c.local_code,
         c.listing_id, false AS is_retailer_only
  FROM products p
  LEFT JOIN suppliers s ON p.supplier_key = s.supplier_key
  LEFT JOIN (SELECT sku, max(itm_code) AS itm_code, max(local_code) AS local_code,
                    max(listing_id) AS listing_id
             FROM xref_clean GROUP BY sku) c ON p.sku = c.sku
  UNION ALL
  SELECT 'RTX-' || substr(r.LOCAL_CODE, 5), {initcap('r.ITEM_DESC')}, 'House Label',
         'Local Range', 'House', 'C', CAST(NULL AS DECIMAL(18,2)), r.UNIT_PRICE,
         'Direct to Store', NULL, r.LOCAL_CODE, NULL, true
  FROM rt_products r
  WHERE NOT EXISTS (SELECT 1 FROM local_map m WHERE m.local_code = r.LOCAL_CODE)
  UNION ALL
  SELECT sku, product_name, 'Unknown', 'Unknown', 'Unknown', 'C', CAST(NULL AS DECIMAL(18,2)),
         CAST(NULL AS DECIMAL(18,2)), NULL, NULL, NULL, NULL, false
  FROM (VALUES ('UNMAPPED', 'Marketplace listing without a product'),
               ('UNRESOLVED', 'Product reference not resolved')) u(sku, product_name)""",
    "dim_location": f"""
  SELECT location_id, location_name, region, location_type, country, 'ERP' AS source FROM locations
  UNION ALL
  SELECT STORE_CODE, {initcap('STORE_NAME')}, {initcap('REGION')}, 'Retail Store',
         'Store Network', 'RETAILER' FROM rt_stores
  UNION ALL
  SELECT 'LOC-MP', 'Online Marketplace', 'Online', 'Marketplace', 'Global', 'MARKETPLACE'""",
    "dim_channel": """
  SELECT channel FROM (VALUES ('Online'), ('Retail'), ('Wholesale'), ('Marketplace'),
                              ('Acquired Store')) c(channel)""",
    "fact_sales": f"""
  SELECT 'ERP' AS source, date_key, sku, location_id, channel, qty_sold AS qty,
         CAST(round(qty_sold * unit_price, 2) AS DECIMAL(18,2)) AS gross_amount,
         CAST(round(qty_sold * unit_price, 2) AS DECIMAL(18,2)) AS net_amount
  FROM erp_sales_lines
  UNION ALL
  SELECT 'MARKETPLACE', {iso_key('o.orderDate')}, coalesce(m.sku, 'UNMAPPED'), 'LOC-MP',
         'Marketplace', o.qty, o.grossAmount, s.payoutAmount
  FROM mp_orders o
  JOIN mp_settlements s ON o.orderId = s.orderId
  LEFT JOIN listing_map m ON o.listingId = m.listing_id
  UNION ALL
  SELECT 'RETAILER', {text_key('r.SALE_DATE')}, lf.c_sku, r.STORE_CODE, 'Acquired Store',
         r.QTY, r.TOTAL_AMT, r.TOTAL_AMT
  FROM rt_sales r LEFT JOIN local_full lf ON r.ITEM_DESC = lf.ITEM_DESC""",
    "fact_inventory": f"""
  SELECT date_key, sku, location_id, on_hand_qty, safety_stock, is_stockout,
         'daily' AS grain, 'ERP' AS source
  FROM erp_inventory
  UNION ALL
  SELECT {text_key('c.COUNT_DATE')}, lf.c_sku, c.STORE_CODE, c.QTY_ON_HAND, CAST(NULL AS BIGINT),
         CASE WHEN c.QTY_ON_HAND <= 0 THEN 1 ELSE 0 END, 'weekly', 'RETAILER'
  FROM rt_stock_counts c JOIN local_full lf ON c.LOCAL_CODE = lf.LOCAL_CODE""",
    "fact_service": f"""
  SELECT w.WorkOrderId AS work_order_id, {iso_key('w.OpenedAt')} AS date_key,
         coalesce(m.sku, 'UNRESOLVED') AS sku, w.WorkType AS work_type, w.Status AS status,
         w.LaborHours AS labor_hours
  FROM svc_work_orders w LEFT JOIN item_map m ON w.ItemCode = m.itm_code""",
    "fact_service_parts": f"""
  SELECT u.UsageId AS usage_id, {iso_key('u.UsedAt')} AS date_key,
         coalesce(m.sku, 'UNRESOLVED') AS sku, u.QtyUsed AS qty_used
  FROM svc_parts_usage u LEFT JOIN item_map m ON u.ItemCode = m.itm_code""",
    "fact_helpdesk": f"""
  SELECT t.ticketId AS ticket_id, {iso_key('t.createdAt')} AS date_key,
         coalesce(p.sku, 'UNRESOLVED') AS sku, c.categoryName AS category,
         t.categoryId = 1 AS is_complaint, t.status = 'open' AS is_open, t.priority
  FROM hd_tickets t
  LEFT JOIN (SELECT upper(trim(product_name)) AS norm, sku FROM products) p
         ON upper(trim(coalesce(t.productText, ''))) = p.norm
  LEFT JOIN hd_categories c ON t.categoryId = c.categoryId""",
}

STAR_TABLES = ("dim_date", "dim_product", "dim_location", "dim_channel", "fact_sales",
               "fact_inventory", "fact_service", "fact_service_parts", "fact_helpdesk")
