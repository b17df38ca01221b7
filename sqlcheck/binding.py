"""DuckDB SQL for the landed-system bindings (oracle side).

Written independently from ``confluo.sources.binding``: the two must agree
row for row; ``tests/test_binding_parity.py`` checks that they do.
"""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S'"

BINDING_CTES: dict[str, str] = {
    "products": """
  SELECT p_partkey AS product_key,
         printf('SKU-%06d', p_partkey) AS sku,
         p_name || ' ' || CAST(p_partkey AS VARCHAR) AS product_name,
         p_type AS category,
         p_type || ' / size ' || CAST(p_size AS VARCHAR) AS subcategory,
         p_brand AS brand,
         CASE WHEN p_size <= 12 THEN 'A' WHEN p_size <= 25 THEN 'B' ELSE 'C' END AS abc_class,
         CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS standard_unit_cost,
         CAST(p_retailprice AS DECIMAL(18,2)) AS list_price,
         p_partkey % (SELECT count(*) FROM supplier) AS supplier_key
  FROM part""",
    "suppliers": """
  SELECT s_suppkey AS supplier_key, printf('SUP-%05d', s_suppkey) AS supplier_id,
         s_name AS supplier_name, n_name AS supplier_country
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "locations": """
  SELECT n_nationkey AS location_key, printf('LOC-%02d', n_nationkey) AS location_id,
         n_name AS location_name, r_name AS region,
         CASE WHEN n_nationkey < 10 THEN 'Distribution Center' ELSE 'Consignment' END AS location_type,
         n_name AS country,
         CASE WHEN n_nationkey >= 10 THEN 'Y' ELSE 'N' END AS is_consignment
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey < 15""",
    "erp_sales_lines": """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sales_line_id,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
         printf('SKU-%06d', l_partkey) AS sku,
         printf('LOC-%02d', l_suppkey % 15) AS location_id,
         CASE WHEN l_orderkey % 5 <= 1 THEN 'Online' WHEN l_orderkey % 5 = 2 THEN 'Retail'
              ELSE 'Wholesale' END AS channel,
         CAST(l_quantity * 2 AS BIGINT) AS qty_sold,
         CAST(floor(l_extendedprice * 100 / (l_quantity * 2)) / 100 AS DECIMAL(18,2)) AS unit_price
  FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R'""",
    "inv_snapshots": """
  SELECT p_partkey, p_size, l.loc, d.day,
         DATE '1999-12-18' + CAST(d.day - 1 AS INTEGER) AS snap_date,
         CAST((p_partkey * 7 + l.loc * 13 + d.day * 5) % 97 AS BIGINT) AS on_hand
  FROM part CROSS JOIN range(0, 25) AS l(loc) CROSS JOIN range(1, 29) AS d(day)""",
    "erp_inventory": """
  SELECT CAST(strftime(snap_date, '%Y%m%d') AS INTEGER) AS date_key,
         printf('SKU-%06d', p_partkey) AS sku, printf('LOC-%02d', loc) AS location_id,
         on_hand AS on_hand_qty, CAST(p_size % 20 AS BIGINT) AS safety_stock,
         CASE WHEN on_hand = 0 THEN 1 ELSE 0 END AS is_stockout
  FROM inv_snapshots WHERE loc < 15""",
    "svc_work_orders": f"""
  SELECT 'WO-' || CAST(event_id AS VARCHAR) AS WorkOrderId,
         strftime(ts - INTERVAL 24 YEAR, {ISO}) AS OpenedAt,
         strftime(ts - INTERVAL 24 YEAR + INTERVAL 1 DAY, {ISO}) AS ClosedAt,
         printf('ITM-%06d', TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS ItemCode,
         'TECH-' || CAST(user_id AS VARCHAR) AS TechnicianId,
         CASE event_id % 3 WHEN 0 THEN 'Repair' WHEN 1 THEN 'Install' ELSE 'Inspection' END AS WorkType,
         CASE WHEN event_id % 5 = 0 THEN 'Open' ELSE 'Closed' END AS Status,
         CAST(event_id % 40 AS DOUBLE) AS LaborHours
  FROM events WHERE event_type = 'signup'""",
    "svc_parts_usage": f"""
  SELECT 'U-' || CAST(event_id AS VARCHAR) AS UsageId,
         'WO-' || CAST(event_id AS VARCHAR) AS WorkOrderId,
         printf('ITM-%06d', TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) * 10) AS ItemCode,
         CAST(event_id % 3 + 1 AS BIGINT) AS QtyUsed,
         strftime(ts - INTERVAL 24 YEAR, {ISO}) AS UsedAt
  FROM events WHERE event_type = 'purchase'""",
    "hd_tickets": f"""
  SELECT 'T-' || CAST(e.event_id AS VARCHAR) AS ticketId,
         strftime(e.ts - INTERVAL 24 YEAR, {ISO}) AS createdAt,
         CASE WHEN (e.event_id // 6) % 4 = 0 THEN NULL
              ELSE strftime(e.ts - INTERVAL 24 YEAR + INTERVAL 2 DAY, {ISO}) END AS closedAt,
         CASE WHEN p.p_partkey IS NULL THEN NULL
              WHEN (e.event_id // 24) % 25 = 0 THEN ''
              WHEN (e.event_id // 24) % 25 <= 2 THEN p.p_name || CAST(p.p_partkey AS VARCHAR)
              WHEN (e.event_id // 24) % 25 = 3 THEN p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR)
              WHEN (e.event_id // 24) % 25 = 4 THEN ' ' || p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR) || '  '
              ELSE '  ' || upper(p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR)) || ' ' END AS productText,
         CAST(e.event_id % 6 + 1 AS BIGINT) AS categoryId,
         CASE e.event_id % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS priority,
         CASE WHEN (e.event_id // 6) % 4 = 0 THEN 'open' ELSE 'closed' END AS status,
         CASE WHEN e.event_id % 2 = 0 THEN 'email' ELSE 'phone' END AS channel
  FROM events e LEFT JOIN part p ON e.user_id = p.p_partkey""",
    "hd_categories": """
  SELECT CAST(categoryId AS BIGINT) AS categoryId, categoryName
  FROM (VALUES (1, 'Product complaint'), (2, 'Delivery'), (3, 'Billing'), (4, 'Returns'),
               (5, 'How-to'), (6, 'Other')) AS c(categoryId, categoryName)""",
    "mp_listings": """
  SELECT printf('ML-%06d', p_partkey) AS listingId, printf('SKU-%06d', p_partkey) AS sellerSku,
         upper(p_name) AS title, CAST(p_retailprice AS DECIMAL(18,2)) AS listPrice,
         CASE WHEN p_partkey % 10 = 9 THEN 'stale' ELSE 'active' END AS status
  FROM part
  UNION ALL
  SELECT printf('ML-D%06d', p_partkey), printf('SKU-%06d', p_partkey), upper(p_name),
         CAST(p_retailprice AS DECIMAL(18,2)), 'active'
  FROM part WHERE p_partkey % 50 = 0""",
    "mp_orders": """
  SELECT 'MP-' || CAST(o_orderkey AS VARCHAR) AS orderId,
         strftime(o_orderdate, '%Y-%m-%d') AS orderDate,
         CASE WHEN o_orderkey % 40 = 0
              THEN printf('ML-D%06d', o_orderkey % n.cnt - (o_orderkey % n.cnt) % 50)
              ELSE printf('ML-%06d', o_orderkey % n.cnt) END AS listingId,
         CAST(o_orderkey % 5 + 1 AS BIGINT) AS qty,
         CAST(o_totalprice AS DECIMAL(18,2)) AS grossAmount
  FROM orders CROSS JOIN (SELECT count(*) AS cnt FROM part) n""",
    "mp_settlements": """
  SELECT 'ST-' || CAST(o_orderkey AS VARCHAR) AS settlementId,
         'MP-' || CAST(o_orderkey AS VARCHAR) AS orderId,
         strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 + 3 AS INTEGER), '%Y-%m-%d') AS settlementDate,
         g AS grossAmount, c AS commissionFee,
         CAST(g - c - py AS DECIMAL(18,2)) AS fulfillmentFee, py AS payoutAmount
  FROM (SELECT o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS g,
               CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.10 AS DECIMAL(2,2)), 2) AS DECIMAL(18,2)) AS c,
               CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.86 AS DECIMAL(2,2)), 2) AS DECIMAL(18,2)) AS py
        FROM orders WHERE o_orderkey % 101 <> 0) s""",
    "rt_products": """
  SELECT printf('RTL-%06d', p_partkey) AS LOCAL_CODE, printf('ITEM %06d', p_partkey) AS ITEM_DESC,
         p_type AS CATEGORY, CAST(p_retailprice AS DECIMAL(18,2)) AS UNIT_PRICE
  FROM part WHERE p_partkey % 2 = 0""",
    "rt_stores": """
  SELECT printf('STR-%02d', n_nationkey) AS STORE_CODE, 'STORE ' || n_name AS STORE_NAME,
         r_name AS REGION, CAST(10000 + n_nationkey * 500 AS BIGINT) AS SQFT
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey >= 15""",
    "rt_sales": """
  SELECT 'RS-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS SALE_ID,
         strftime(l_shipdate, '%d/%m/%Y') AS SALE_DATE,
         printf('STR-%02d', l_suppkey % 10 + 15) AS STORE_CODE,
         printf('ITEM %06d', l_partkey) AS ITEM_DESC,
         CAST(l_quantity AS BIGINT) AS QTY,
         CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(18,2)) AS UNIT_PRICE,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS TOTAL_AMT
  FROM lineitem WHERE l_returnflag = 'R'""",
    "rt_stock_counts": """
  SELECT strftime(snap_date, '%d/%m/%Y') AS COUNT_DATE, printf('STR-%02d', loc) AS STORE_CODE,
         printf('RTL-%06d', p_partkey) AS LOCAL_CODE, on_hand AS QTY_ON_HAND
  FROM inv_snapshots WHERE loc >= 15 AND day % 7 = 1""",
    "xref": """
  SELECT printf('SKU-%06d', p_partkey) AS sku, printf('ITM-%06d', p_partkey) AS itm_code,
         CASE WHEN p_partkey % 2 = 0 AND p_partkey % 33 <> 0 THEN printf('RTL-%06d', p_partkey)
              ELSE '' END AS local_code,
         CASE WHEN p_partkey % 10 <> 9 THEN printf('ML-%06d', p_partkey) END AS listing_id,
         CASE WHEN p_partkey % 97 = 0 THEN 'retired SKU'
              WHEN p_partkey % 33 = 0 THEN 'TODO: confirm local code' END AS notes
  FROM part
  UNION ALL
  SELECT printf('SKU-%06d', p_partkey), NULL, NULL, printf('ML-D%06d', p_partkey),
         'CONFLICT: duplicate listing'
  FROM part WHERE p_partkey % 50 = 0""",
}

LANDED_TABLES = ("products", "suppliers", "locations", "erp_sales_lines", "erp_inventory",
                 "svc_work_orders", "svc_parts_usage", "hd_tickets", "hd_categories",
                 "mp_listings", "mp_orders", "mp_settlements", "rt_products", "rt_stores",
                 "rt_sales", "rt_stock_counts", "xref")
