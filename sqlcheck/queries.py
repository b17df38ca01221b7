"""Oracle SQL (DuckDB) for each registered query key.

Written by hand from the question each key answers; the only shared pieces
are the binding and star CTEs (themselves checked table by table).
"""

from __future__ import annotations

from sqlcheck.catalog import COLUMNS, METRICS, STAR_COLUMNS
from sqlcheck.compose import with_ctes
from sqlcheck.raw import RAW
from sqlcheck.star import STAR_CTES, initcap, iso_key, text_key

UNK = "('UNMAPPED', 'UNRESOLVED')"
NETWORKS = "('Distribution Center', 'Retail Store')"


def Q(body: str, **extra: str) -> str:
    return with_ctes(body, STAR_CTES, extra)


def _m(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


def _b(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _ratio(a: str, b: str, scale: str | None = None) -> str:
    r = f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"
    return f"({r} * {scale})" if scale else r


def _covers(sources: str, basis: str, lo: str | int | None = None, hi: str | int | None = None) -> str:
    """The columns that tell what an answer covers."""
    ends = [(lo, "min", "from"), (hi, "max", "to")]
    period = [f"CAST({f'(SELECT {f}(date_key) FROM dim_date)' if x is None else x} AS INTEGER) AS period_{n}" for x, f, n in ends]
    return ", ".join([*period, f"'{sources}' AS sources", f"'{basis}' AS basis"])


def _lost(*facts: str) -> str:
    rows = " UNION ALL ".join(f"SELECT sku FROM {f}" for f in facts)
    return f"(SELECT CAST(count(*) FILTER (WHERE sku IN {UNK}) AS DOUBLE) / count(*) FROM ({rows})) AS unresolved_share"


_ST_CHECK = "CASE WHEN sell_through < 0.05 THEN 'near zero' WHEN sell_through >= 10 THEN 'too large' WHEN sell_through IS NOT NULL THEN 'ok' END AS sell_through_check"
_ALL = "ERP, MARKETPLACE, RETAILER"

STAR_TABLE_LIST = ("dim_date", "dim_product", "dim_location", "dim_channel", "fact_sales",
                   "fact_inventory", "fact_service", "fact_service_parts", "fact_helpdesk")

# per (sku, category[, abc_class]) units, average on-hand and sell-through,
# unknown members excluded; used by the benchmark answers
_ST = f"""
  SELECT sku, category, abc_class, CAST(sum(units) AS BIGINT) AS units_sold, max(avg_oh) AS avg_on_hand
  FROM (
    SELECT f.sku, p.category, p.abc_class, f.qty AS units, CAST(NULL AS DOUBLE) AS avg_oh
    FROM fact_sales f LEFT JOIN dim_product p ON f.sku = p.sku
    WHERE f.sku NOT IN {UNK}
    UNION ALL
    SELECT sku, category, abc_class, NULL, avg(s)
    FROM (SELECT f.sku, p.category, p.abc_class, f.date_key, sum(f.on_hand_qty) AS s
          FROM fact_inventory f LEFT JOIN dim_product p ON f.sku = p.sku
          WHERE f.sku NOT IN {UNK} GROUP BY 1, 2, 3, 4)
    GROUP BY 1, 2, 3)
  GROUP BY sku, category, abc_class"""
_ST2 = """
  SELECT sku, category, abc_class, CAST(units_sold AS DOUBLE) / NULLIF(avg_on_hand, 0) AS sell_through FROM st"""
_BENCH = """
  SELECT category, sum(CAST(floor(sell_through * 1e12 + 0.5) AS HUGEINT)) AS s, count(sell_through) AS n
  FROM st2 GROUP BY category"""
_BENCH_ROWS = """
  SELECT s.sku, s.category, s.abc_class, s.sell_through, CAST(b.s AS DOUBLE) / b.n / 1e12 AS category_avg_sell_through,
         CAST(floor(s.sell_through * 1e12 + 0.5) AS HUGEINT) * b.n < b.s AS below
  FROM st2 s LEFT JOIN bench b ON s.category IS NOT DISTINCT FROM b.category
  WHERE s.sell_through IS NOT NULL OR b.n > 0"""


_RAW_RISK = """
  SELECT sku, product_name FROM products
  WHERE abc_class = 'A'
    AND upper(trim(product_name)) IN (SELECT upper(trim(productText)) FROM hd_tickets WHERE categoryId = 1 AND status = 'open' AND trim(coalesce(productText, '')) <> '')
    AND sku IN (SELECT sku FROM (SELECT *, row_number() OVER (PARTITION BY sku, location_id ORDER BY date_key DESC) AS rn FROM erp_inventory)
                WHERE rn = 1 AND on_hand_qty <= safety_stock)"""


def _semi_by(dim_join: str, group: str, where: str = "TRUE") -> str:
    """avg over dates of the per-(group, date) on-hand sums."""
    return f"""
  SELECT g, avg(s) AS avg_on_hand
  FROM (SELECT {group} AS g, f.date_key, sum(f.on_hand_qty) AS s
        FROM fact_inventory f {dim_join} WHERE {where} GROUP BY 1, 2)
  GROUP BY 1"""


ORACLE: dict[str, str] = {
    # ------------------------------------------------------------- sources
    "land_csv": Q("SELECT * FROM rt_sales"),
    "star_roundtrip": Q(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_written, count(*) AS rows_read FROM {t}"
        for t in STAR_TABLE_LIST)),
    "column_catalog": COLUMNS,
    "star_catalog": STAR_COLUMNS,
    "metric_catalog": METRICS,
    # --------------------------------------------------------- conformance
    "date_dim": Q("SELECT * FROM dim_date"),
    "conform_product": Q("SELECT * FROM dim_product"),
    "conform_location": Q("SELECT * FROM dim_location"),
    "unified_sales": Q("SELECT * FROM fact_sales"),
    "unified_inventory": Q("SELECT * FROM fact_inventory"),
    "helpdesk_flags": Q("SELECT * FROM fact_helpdesk"),
    "unknown_members": Q(f"SELECT sku, product_name, category FROM dim_product WHERE sku IN {UNK}"),
    "mapping_check": Q(" UNION ALL ".join(f"""
SELECT '{code}' AS map, CAST(coalesce(sum(n), 0) AS BIGINT) AS pairs, count(*) AS codes,
       count(*) FILTER (WHERE k > 1) AS duplicated
FROM (SELECT {code}, count(*) AS n, count(DISTINCT sku) AS k FROM xref_clean
      WHERE trim(coalesce({code}, '')) <> '' GROUP BY 1)""" for code in ("local_code", "itm_code", "listing_id"))),
    "crosswalk_clean": Q("SELECT sku, itm_code, local_code, listing_id FROM xref_clean"),
    "local_only_products": Q(f"""
SELECT r.LOCAL_CODE, {initcap('r.ITEM_DESC')} AS product_name, r.UNIT_PRICE AS list_price,
       'RTX-' || substr(r.LOCAL_CODE, 5) AS sku
FROM rt_products r
WHERE NOT EXISTS (SELECT 1 FROM local_map m WHERE m.local_code = r.LOCAL_CODE)"""),
    "local_fallback_key": Q("SELECT LOCAL_CODE, c_sku FROM local_full"),
    "resolve_listing": Q("""
SELECT o.orderId, o.listingId, coalesce(m.sku, 'UNMAPPED') AS sku
FROM mp_orders o LEFT JOIN listing_map m ON o.listingId = m.listing_id"""),
    "resolve_item": Q("""
SELECT 'work_order' AS record_type, work_order_id AS record_id, sku FROM fact_service
UNION ALL SELECT 'part_usage', usage_id, sku FROM fact_service_parts"""),
    "resolve_description": Q("""
SELECT r.SALE_ID, r.ITEM_DESC, lf.c_sku AS sku
FROM rt_sales r LEFT JOIN local_full lf ON r.ITEM_DESC = lf.ITEM_DESC"""),
    "resolve_text": Q("""
SELECT f.ticket_id, f.sku, t.productText AS product_text
FROM fact_helpdesk f JOIN hd_tickets t ON f.ticket_id = t.ticketId"""),
    "parse_text_date": Q(f"""
SELECT SALE_ID, SALE_DATE, CAST(try_strptime(SALE_DATE, '%d/%m/%Y') AS DATE) AS sale_date,
       {text_key('SALE_DATE')} AS date_key
FROM rt_sales"""),
    "date_key": Q(f"""
SELECT ticketId, createdAt, CAST(TRY_CAST(createdAt AS TIMESTAMP) AS DATE) AS created_date,
       {iso_key('createdAt')} AS date_key
FROM hd_tickets"""),
    "line_amount": Q("""
SELECT sales_line_id, CAST(round(qty_sold * unit_price, 2) AS DECIMAL(18,2)) AS gross_amount
FROM erp_sales_lines"""),
    "net_marketplace": Q("""
SELECT o.orderId, o.grossAmount AS gross_amount, s.payoutAmount AS net_amount
FROM mp_orders o JOIN mp_settlements s ON o.orderId = s.orderId"""),
    "star_join": Q("""
SELECT f.*, d.date, d.year, d.quarter, d.month, d.month_name, d.month_key, d.day, d.day_of_week,
       d.is_weekend, d.fiscal_year, d.fiscal_quarter, d.is_post_event,
       p.product_name, p.category, p.subcategory, p.brand, p.abc_class, p.standard_unit_cost,
       p.list_price, p.supplier_name, p.itm_code, p.local_code, p.listing_id, p.is_retailer_only,
       l.location_name, l.region, l.location_type, l.country
FROM fact_sales f
LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_product p ON f.sku = p.sku
LEFT JOIN dim_location l ON f.location_id = l.location_id
LEFT JOIN dim_channel c ON f.channel = c.channel"""),
    "raw_star_join": Q("""
SELECT e.*, p.product_name, p.category, p.abc_class, s.supplier_name, l.location_name, l.location_type
FROM erp_sales_lines e
LEFT JOIN products p ON e.sku = p.sku
LEFT JOIN suppliers s ON p.supplier_key = s.supplier_key
LEFT JOIN locations l ON e.location_id = l.location_id"""),
    "raw_inventory_join": Q("""
SELECT e.*, p.product_name, p.category, p.abc_class, s.supplier_name, l.location_name, l.location_type
FROM erp_inventory e
LEFT JOIN products p ON e.sku = p.sku
LEFT JOIN suppliers s ON p.supplier_key = s.supplier_key
LEFT JOIN locations l ON e.location_id = l.location_id"""),
    "raw_by_category": Q(f"""
SELECT coalesce(a.category, i.category) AS category, {_b('a.units')} AS units, a.lines, i.avg_on_hand,
       {_ratio('i.so', 'i.n')} AS stockout_share, {_ratio('a.units', 'i.avg_on_hand')} AS sell_through
FROM (SELECT category, sum(qty_sold) AS units, count(*) AS lines FROM erp_sales_lines LEFT JOIN products USING (sku) GROUP BY 1) a
FULL JOIN (SELECT category, avg(s) AS avg_on_hand, sum(so) AS so, sum(n) AS n
           FROM (SELECT category, date_key, sum(on_hand_qty) AS s, sum(is_stockout) AS so, count(*) AS n
                 FROM erp_inventory LEFT JOIN products USING (sku) GROUP BY 1, 2) GROUP BY 1) i ON a.category IS NOT DISTINCT FROM i.category"""),
    "raw_by_place": Q(f"""
SELECT coalesce(a.location_type, i.location_type) AS location_type, {_b('a.units')} AS units, {_b('i.n')} AS counts, {_b('i.so')} AS stockouts, i.avg_on_hand
FROM (SELECT location_type, sum(qty_sold) AS units FROM erp_sales_lines LEFT JOIN locations USING (location_id) GROUP BY 1) a
FULL JOIN (SELECT location_type, avg(s) AS avg_on_hand, sum(so) AS so, sum(n) AS n
           FROM (SELECT location_type, date_key, sum(on_hand_qty) AS s, sum(is_stockout) AS so, count(*) AS n
                 FROM erp_inventory LEFT JOIN locations USING (location_id) GROUP BY 1, 2) GROUP BY 1) i ON a.location_type IS NOT DISTINCT FROM i.location_type"""),
    "a_class_at_risk_raw": Q("SELECT sku, product_name FROM raw_risk", raw_risk=_RAW_RISK),
    "sell_through_networks_raw": Q("""
SELECT *, CAST(units AS DOUBLE) / NULLIF(mean_total, 0) AS ratio FROM (
  SELECT 'ERP' AS network, (SELECT CAST(sum(qty_sold) AS BIGINT) FROM erp_sales_lines WHERE date_key >= 20000101) AS units,
         (SELECT avg(s) FROM (SELECT sum(on_hand_qty) AS s FROM erp_inventory WHERE date_key >= 20000101 GROUP BY date_key)) AS mean_total
  UNION ALL
  SELECT 'STORES', (SELECT CAST(sum(QTY) AS BIGINT) FROM rt_sales WHERE strptime(SALE_DATE, '%d/%m/%Y') >= DATE '2000-01-01'),
         (SELECT avg(s) FROM (SELECT sum(QTY_ON_HAND) AS s FROM rt_stock_counts WHERE strptime(COUNT_DATE, '%d/%m/%Y') >= DATE '2000-01-01' GROUP BY COUNT_DATE)))"""),
    "risk_parity": Q("""
SELECT sku, in_star, in_raw, in_star = in_raw AS agrees FROM (
  SELECT coalesce(s.sku, r.sku) AS sku, s.sku IS NOT NULL AS in_star, r.sku IS NOT NULL AS in_raw
  FROM star_risk s FULL JOIN raw_risk r ON s.sku = r.sku)""", raw_risk=_RAW_RISK, star_risk="""
  SELECT sku FROM dim_product
  WHERE abc_class = 'A' AND sku IN (SELECT sku FROM fact_helpdesk WHERE is_complaint AND is_open)
    AND sku IN (SELECT sku FROM (SELECT *, row_number() OVER (PARTITION BY sku, location_id, grain ORDER BY date_key DESC) AS rn FROM fact_inventory)
                WHERE rn = 1 AND on_hand_qty <= CASE WHEN grain = 'daily' THEN safety_stock ELSE 0 END)"""),
    # ------------------------------------------------------------- answers
    "filter_period": Q(f"""
SELECT f.source, {_m('sum(f.net_amount)')} AS revenue_net, {_b('sum(f.qty)')} AS units_sold
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
WHERE f.date_key BETWEEN 19980101 AND 19980630
  AND d.date >= DATE '1998-04-01' AND d.date < DATE '1998-07-01'
GROUP BY f.source"""),
    "filter_dim": Q(f"""
SELECT f.channel, {_m('sum(f.net_amount)')} AS revenue_net, {_b('sum(f.qty)')} AS units_sold
FROM fact_sales f
JOIN dim_date d ON f.date_key = d.date_key
JOIN dim_product p ON f.sku = p.sku
JOIN dim_location l ON f.location_id = l.location_id
WHERE d.year = 1999 AND p.abc_class = 'A' AND l.location_type IN {NETWORKS}
GROUP BY f.channel"""),
    "revenue_by_channel": Q(f"""
SELECT channel, {_m('sum(net_amount)')} AS revenue_net, {_m('sum(gross_amount)')} AS revenue_gross,
       {_b('sum(qty)')} AS units_sold, {_covers(_ALL, 'gross, net', 19980101, 19980331)}
FROM fact_sales WHERE date_key BETWEEN 19980101 AND 19980331 GROUP BY channel"""),
    "revenue_by_source": Q(f"""
SELECT source, {_m('sum(net_amount)')} AS revenue_net, {_m('sum(gross_amount)')} AS revenue_gross,
       {_b('sum(qty)')} AS units_sold
FROM fact_sales GROUP BY source"""),
    "company_sales_total": Q(f"""
SELECT *, {_covers(_ALL, 'net', 19980501, 19980531)} FROM (
  SELECT {_m("sum(f.net_amount) FILTER (WHERE f.source = 'ERP')")} AS erp_revenue,
         {_m("sum(f.net_amount) FILTER (WHERE f.source = 'MARKETPLACE')")} AS marketplace_net_revenue,
         {_m("sum(f.net_amount) FILTER (WHERE f.source = 'RETAILER')")} AS retailer_revenue,
         {_m('sum(f.net_amount)')} AS revenue_net
  FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key WHERE d.month_key = 199805)
WHERE revenue_net IS NOT NULL"""),
    "net_by_month": Q(f"""
SELECT substr(settlementDate, 1, 7) AS month, {_m('sum(payoutAmount)')} AS net_revenue,
       {_m('sum(grossAmount)')} AS gross_revenue,
       1.0 - {_ratio('sum(payoutAmount)', 'sum(grossAmount)')} AS effective_fee_rate
FROM mp_settlements GROUP BY 1"""),
    "top_products": Q(f"""
SELECT e.sku, p.product_name, {_m('sum(e.qty_sold * e.unit_price)')} AS revenue
FROM erp_sales_lines e JOIN products p ON e.sku = p.sku
GROUP BY e.sku, p.product_name ORDER BY revenue DESC, e.sku LIMIT 5"""),
    "sales_on_day": Q(f"""
SELECT '03/02/1998' AS sale_day,
       (SELECT {_m('sum(TOTAL_AMT)')} FROM rt_sales WHERE SALE_DATE = '03/02/1998') AS amount_text_match,
       (SELECT {_m('sum(net_amount)')} FROM fact_sales
        WHERE source = 'RETAILER' AND date_key = 19980203) AS amount_conformed,
       'dd/MM/yyyy' AS day_read_as, {_covers('RETAILER', 'net', 19980203, 19980203)}"""),
    "revenue_since_event": Q(f"""
SELECT *, {_covers('RETAILER', 'net', 20000101)} FROM (SELECT {_m("sum(net_amount) FILTER (WHERE source = 'RETAILER')")} AS retailer_revenue
               FROM fact_sales WHERE date_key >= 20000101)
WHERE retailer_revenue IS NOT NULL"""),
    "stockout_rate": Q(f"""
SELECT *, {_covers('ERP', 'quantity', 20000101, 20000131)} FROM (
  SELECT {_ratio("sum(f.is_stockout) FILTER (WHERE f.grain = 'daily')", "sum(1) FILTER (WHERE f.grain = 'daily')")} AS stockout_rate,
         {_b("sum(f.is_stockout) FILTER (WHERE f.grain = 'daily')")} AS stockout_rows,
         {_b("sum(1) FILTER (WHERE f.grain = 'daily')")} AS snapshot_rows
  FROM fact_inventory f JOIN dim_date d ON f.date_key = d.date_key WHERE d.month_key = 200001)
WHERE snapshot_rows IS NOT NULL OR stockout_rows IS NOT NULL"""),
    "avg_on_hand": Q("""
SELECT g AS location_type, avg_on_hand FROM inv_avg WHERE avg_on_hand IS NOT NULL""",
                     inv_avg=_semi_by("LEFT JOIN dim_location l ON f.location_id = l.location_id", "l.location_type")),
    "sell_through_by_network": Q(f"""
SELECT coalesce(u.g, i.g) AS location_type, {_b('u.units')} AS units_sold, i.avg_on_hand,
       {_ratio('u.units', 'i.avg_on_hand')} AS sell_through, {_ST_CHECK}, {_covers('ERP, RETAILER', 'quantity', 20000101)}
FROM u FULL JOIN inv_avg i ON u.g IS NOT DISTINCT FROM i.g""",
        u=f"""
  SELECT l.location_type AS g, sum(f.qty) AS units
  FROM fact_sales f JOIN dim_location l ON f.location_id = l.location_id
  WHERE f.date_key >= 20000101 AND l.location_type IN {NETWORKS} GROUP BY 1""",
        inv_avg=_semi_by("JOIN dim_location l ON f.location_id = l.location_id", "l.location_type",
                      f"f.date_key >= 20000101 AND l.location_type IN {NETWORKS}")),
    "sell_through_naive": Q(f"""
SELECT 'ERP' AS network, {_b('u')} AS units_sold, a AS avg_row_on_hand, {_ratio('u', 'a')} AS naive_sell_through
FROM (SELECT (SELECT sum(qty_sold) FROM erp_sales_lines WHERE date_key >= 20000101) AS u,
             (SELECT avg(on_hand_qty) FROM erp_inventory WHERE date_key >= 20000101) AS a)"""),
    "latest_snapshot": Q("""
SELECT sku, location_id, date_key, on_hand_qty, safety_stock
FROM (SELECT *, row_number() OVER (PARTITION BY sku, location_id ORDER BY date_key DESC) AS rn
      FROM erp_inventory)
WHERE rn = 1"""),
    "stockout_risk_sku": Q(f"""
SELECT sku, {_b('sum(on_hand_qty)')} AS on_hand_qty, {_b('sum(safety_stock)')} AS safety_stock,
       CASE WHEN sum(on_hand_qty) <= sum(safety_stock) THEN 1 ELSE 0 END AS at_risk
FROM erp_inventory WHERE date_key = (SELECT max(date_key) FROM erp_inventory)
GROUP BY sku"""),
    "a_class_at_risk": Q(f"""
SELECT p.sku, p.product_name, oc.open_complaints, r.as_of, {_covers('ERP, HELPDESK, RETAILER', 'quantity')}
FROM dim_product p
JOIN (SELECT sku, count(*) AS open_complaints FROM fact_helpdesk
      WHERE is_complaint AND is_open GROUP BY sku) oc ON p.sku = oc.sku
JOIN (SELECT sku, max(date_key) AS as_of
      FROM (SELECT sku, on_hand_qty, safety_stock, date_key,
                   grain, row_number() OVER (PARTITION BY sku, location_id, grain
                                             ORDER BY date_key DESC) AS rn
            FROM fact_inventory)
      WHERE rn = 1 AND on_hand_qty <= CASE WHEN grain = 'daily' THEN safety_stock ELSE 0 END GROUP BY sku) r ON p.sku = r.sku
WHERE p.abc_class = 'A'"""),
    "tickets_by_product": Q(f"SELECT sku, {_b('sum(1)')} AS tickets FROM fact_helpdesk GROUP BY sku"),
    "tickets_exact": Q("""
SELECT p.sku, count(*) AS tickets
FROM hd_tickets t JOIN products p ON t.productText = p.product_name GROUP BY p.sku"""),
    "tickets_per_1k": Q(f"""
SELECT coalesce(t.sku, u.sku) AS sku, t.tickets, u.units AS units_sold,
       {_ratio('t.tickets', 'u.units', '1000.0')} AS tickets_per_1k, {_lost('fact_helpdesk')},
       {_covers('ERP, HELPDESK, MARKETPLACE, RETAILER', 'quantity')}
FROM t FULL JOIN u ON t.sku = u.sku
WHERE u.units >= 1000 AND t.tickets IS NOT NULL""",
        t=f"SELECT sku, {_b('sum(1)')} AS tickets FROM fact_helpdesk WHERE sku NOT IN {UNK} GROUP BY sku",
        u=f"SELECT sku, {_b('sum(qty)')} AS units FROM fact_sales WHERE sku NOT IN {UNK} GROUP BY sku"),
    "parts_attach": Q(f"""
SELECT *, {_lost('fact_service_parts')}, {_covers('ERP, FIELD SERVICE, MARKETPLACE, RETAILER', 'quantity')} FROM (
  SELECT {_b('pa.v')} AS service_parts_used, {_b('un.v')} AS units_sold,
         {_ratio('pa.v', 'un.v', '100.0')} AS parts_per_100
  FROM (SELECT sum(f.qty_used) AS v FROM fact_service_parts f JOIN dim_product p ON f.sku = p.sku
        WHERE p.category = 'SMALL') pa,
       (SELECT sum(f.qty) AS v FROM fact_sales f JOIN dim_product p ON f.sku = p.sku
        WHERE p.category = 'SMALL') un)
WHERE service_parts_used IS NOT NULL OR units_sold IS NOT NULL"""),
    "parts_attach_raw": Q(f"""
SELECT {_b('parts')} AS parts, {_b('units')} AS units,
       CAST(parts AS DOUBLE) * 100.0 / NULLIF(CAST(units AS DOUBLE), 0) AS parts_per_100
FROM (SELECT
  (SELECT sum(QtyUsed) FROM svc_parts_usage WHERE ItemCode IN (
      SELECT itm_code FROM xref_clean WHERE itm_code IS NOT NULL AND itm_code <> ''
        AND sku IN (SELECT sku FROM products WHERE category = 'SMALL'))) AS parts,
  (SELECT sum(qty_sold) FROM erp_sales_lines
    WHERE sku IN (SELECT sku FROM products WHERE category = 'SMALL')) AS units)"""),
    "after_sale_rate": Q(f"""
SELECT category, complaints, service_parts_used, units_sold,
       CASE WHEN complaints IS NULL AND service_parts_used IS NULL THEN NULL
            ELSE CAST(coalesce(complaints, 0) + coalesce(service_parts_used, 0) AS DOUBLE)
                 / NULLIF(CAST(units_sold AS DOUBLE), 0) * 1000.0 END AS after_sale_per_1k,
       {_lost('fact_helpdesk', 'fact_service_parts')}, {_covers('ERP, FIELD SERVICE, HELPDESK, MARKETPLACE, RETAILER', 'quantity')}
FROM (
  SELECT category, {_b('sum(c)')} AS complaints, {_b('sum(pu)')} AS service_parts_used,
         {_b('sum(u)')} AS units_sold
  FROM (SELECT p.category, CASE WHEN f.is_complaint THEN 1 END AS c, CAST(NULL AS BIGINT) AS pu,
               CAST(NULL AS BIGINT) AS u
        FROM fact_helpdesk f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL
        SELECT p.category, NULL, f.qty_used, NULL
        FROM fact_service_parts f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL
        SELECT p.category, NULL, NULL, f.qty
        FROM fact_sales f LEFT JOIN dim_product p ON f.sku = p.sku)
  GROUP BY category)
WHERE complaints IS NOT NULL OR service_parts_used IS NOT NULL OR units_sold IS NOT NULL"""),
    "category_benchmark": Q("SELECT sku, category, sell_through, category_avg_sell_through FROM rows_",
                            st=_ST, st2=_ST2, bench=_BENCH, rows_=_BENCH_ROWS),
    "overstocked_products": Q(f"""
SELECT sku, category, sell_through, category_avg_sell_through, {_ST_CHECK}, {_covers(_ALL, 'quantity')} FROM rows_
WHERE below
ORDER BY sell_through ASC, sku ASC LIMIT 5""", st=_ST, st2=_ST2, bench=_BENCH, rows_=_BENCH_ROWS),
    "overstock_by_class": Q("""
SELECT abc_class, count(*) FILTER (WHERE below) AS below_benchmark,
       count(*) AS products
FROM rows_ WHERE sell_through IS NOT NULL GROUP BY abc_class""",
                            st=_ST, st2=_ST2, bench=_BENCH, rows_=_BENCH_ROWS),
    "drill_across": Q(f"""
SELECT coalesce(a.category, i.g) AS category, a.revenue_net, a.tickets, a.service_parts_used,
       i.avg_on_hand
FROM a FULL JOIN inv_avg i ON a.category IS NOT DISTINCT FROM i.g
WHERE a.revenue_net IS NOT NULL OR a.tickets IS NOT NULL OR a.service_parts_used IS NOT NULL
   OR i.avg_on_hand IS NOT NULL""",
        a=f"""
  SELECT category, {_m('sum(n)')} AS revenue_net, {_b('sum(t)')} AS tickets,
         {_b('sum(pu)')} AS service_parts_used
  FROM (SELECT p.category, f.net_amount AS n, CAST(NULL AS BIGINT) AS t, CAST(NULL AS BIGINT) AS pu
        FROM fact_sales f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL SELECT p.category, NULL, 1, NULL
        FROM fact_helpdesk f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL SELECT p.category, NULL, NULL, f.qty_used
        FROM fact_service_parts f LEFT JOIN dim_product p ON f.sku = p.sku)
  GROUP BY category""",
        inv_avg=_semi_by("LEFT JOIN dim_product p ON f.sku = p.sku", "p.category")),
    "ratio_metrics": Q(f"""
SELECT * FROM (
  SELECT coalesce(a.category, i.g) AS category,
         {_ratio('a.tickets', 'a.units', '1000.0')} AS tickets_per_1k,
         {_ratio('a.parts', 'a.units', '100.0')} AS parts_per_100,
         {_ratio('a.units', 'i.avg_on_hand')} AS sell_through,
         {_ratio('a.so', 'a.snap')} AS stockout_rate
  FROM a FULL JOIN inv_avg i ON a.category IS NOT DISTINCT FROM i.g)
WHERE tickets_per_1k IS NOT NULL OR parts_per_100 IS NOT NULL OR sell_through IS NOT NULL
   OR stockout_rate IS NOT NULL""",
        a="""
  SELECT category, sum(t) AS tickets, sum(u) AS units, sum(pu) AS parts, sum(so) AS so, sum(sn) AS snap
  FROM (SELECT p.category, 1 AS t, CAST(NULL AS BIGINT) AS u, CAST(NULL AS BIGINT) AS pu,
               CAST(NULL AS BIGINT) AS so, CAST(NULL AS BIGINT) AS sn
        FROM fact_helpdesk f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL SELECT p.category, NULL, f.qty, NULL, NULL, NULL
        FROM fact_sales f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL SELECT p.category, NULL, NULL, f.qty_used, NULL, NULL
        FROM fact_service_parts f LEFT JOIN dim_product p ON f.sku = p.sku
        UNION ALL SELECT p.category, NULL, NULL, NULL,
               CASE WHEN f.grain = 'daily' THEN f.is_stockout END,
               CASE WHEN f.grain = 'daily' THEN 1 END
        FROM fact_inventory f LEFT JOIN dim_product p ON f.sku = p.sku)
  GROUP BY category""",
        inv_avg=_semi_by("LEFT JOIN dim_product p ON f.sku = p.sku", "p.category")),
    "attributable_share": Q(f"""
SELECT *, {_covers(_ALL, 'net')} FROM (
  SELECT {_m('sum(net_amount)')} AS revenue_net,
         {_m(f'sum(net_amount) FILTER (WHERE sku IN {UNK})')} AS unattributable_revenue,
         CAST(sum(net_amount) - coalesce(sum(net_amount) FILTER (WHERE sku IN {UNK}), 0) AS DOUBLE)
           / NULLIF(CAST(sum(net_amount) AS DOUBLE), 0) AS attributable_share
  FROM fact_sales)
WHERE revenue_net IS NOT NULL OR unattributable_revenue IS NOT NULL"""),
    "unmapped_gross": Q(f"""
SELECT {_m('sum(o.grossAmount)')} AS unmapped_gross, count(*) AS unmapped_orders,
       CAST(sum(o.grossAmount) AS DOUBLE) * 100.0
         / NULLIF(CAST((SELECT sum(grossAmount) FROM mp_orders) AS DOUBLE), 0) AS pct_of_gross
FROM mp_orders o
WHERE NOT EXISTS (SELECT 1 FROM listing_map m WHERE m.listing_id = o.listingId)"""),
    "unmapped_gross_uncleaned": Q(f"""
SELECT {_m('sum(o.grossAmount)')} AS unmapped_gross, count(*) AS unmapped_orders,
       CAST(sum(o.grossAmount) AS DOUBLE) * 100.0
         / NULLIF(CAST((SELECT sum(grossAmount) FROM mp_orders) AS DOUBLE), 0) AS pct_of_gross
FROM mp_orders o
WHERE NOT EXISTS (SELECT 1 FROM xref x WHERE x.listing_id IS NOT NULL AND x.listing_id <> ''
                  AND x.listing_id = o.listingId)"""),
    # ------------------------------------------------------------- quality
    "row_count_check": Q("""
SELECT table_name, rows, expected_rows, rows = expected_rows AS ok FROM (
  SELECT 'dim_date' AS table_name, (SELECT count(*) FROM dim_date) AS rows,
         (SELECT CAST(datediff('day', lo, hi) + 1 AS BIGINT) FROM cal_window) AS expected_rows
  UNION ALL SELECT 'dim_product', (SELECT count(*) FROM dim_product),
         (SELECT count(*) FROM products)
         + (SELECT count(*) FROM rt_products r
            WHERE NOT EXISTS (SELECT 1 FROM local_map m WHERE m.local_code = r.LOCAL_CODE)) + 2
  UNION ALL SELECT 'dim_location', (SELECT count(*) FROM dim_location),
         (SELECT count(*) FROM locations) + (SELECT count(*) FROM rt_stores) + 1
  UNION ALL SELECT 'dim_channel', (SELECT count(*) FROM dim_channel), 5
  UNION ALL SELECT 'fact_sales', (SELECT count(*) FROM fact_sales),
         (SELECT count(*) FROM erp_sales_lines)
         + (SELECT count(*) FROM mp_orders WHERE orderId IN (SELECT orderId FROM mp_settlements))
         + (SELECT count(*) FROM rt_sales)
  UNION ALL SELECT 'fact_inventory', (SELECT count(*) FROM fact_inventory),
         (SELECT count(*) FROM erp_inventory)
         + (SELECT count(*) FROM rt_stock_counts WHERE LOCAL_CODE IN (SELECT LOCAL_CODE FROM local_full))
  UNION ALL SELECT 'fact_service', (SELECT count(*) FROM fact_service), (SELECT count(*) FROM svc_work_orders)
  UNION ALL SELECT 'fact_service_parts', (SELECT count(*) FROM fact_service_parts),
         (SELECT count(*) FROM svc_parts_usage)
  UNION ALL SELECT 'fact_helpdesk', (SELECT count(*) FROM fact_helpdesk), (SELECT count(*) FROM hd_tickets))"""),
    "coverage_report": Q(" UNION ALL ".join(
        f"""SELECT '{subject}' AS subject, count(*) FILTER (WHERE {unk}) AS unknown_rows,
       count(*) AS total_rows,
       CAST(count(*) FILTER (WHERE {unk}) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) AS unknown_share
FROM {table} WHERE {where}"""
        for subject, table, where, unk in (
            ("marketplace_sales", "fact_sales", "source = 'MARKETPLACE'", "sku = 'UNMAPPED'"),
            ("retailer_sales", "fact_sales", "source = 'RETAILER'", "sku IS NULL"),
            ("helpdesk_tickets", "fact_helpdesk", "TRUE", "sku = 'UNRESOLVED'"),
            ("work_orders", "fact_service", "TRUE", "sku = 'UNRESOLVED'"),
            ("parts_usage", "fact_service_parts", "TRUE", "sku = 'UNRESOLVED'")))),
    "parity_check": Q("""
SELECT coalesce(r.source, s.source) AS source, r.gross AS raw_total, s.gross AS star_total,
       CAST(coalesce(s.gross, 0) - coalesce(r.gross, 0) AS DECIMAL(38,2)) AS difference,
       coalesce(s.gross, 0) - coalesce(r.gross, 0) = 0 AS ok
FROM raw_totals r FULL JOIN star_totals s ON r.source = s.source""",
        raw_totals="""
  SELECT 'ERP' AS source, CAST(sum(round(qty_sold * unit_price, 2)) AS DECIMAL(38,2)) AS gross FROM erp_sales_lines
  UNION ALL SELECT 'MARKETPLACE', CAST(sum(grossAmount) AS DECIMAL(38,2)) FROM mp_orders
            WHERE orderId IN (SELECT orderId FROM mp_settlements)
  UNION ALL SELECT 'RETAILER', CAST(sum(TOTAL_AMT) AS DECIMAL(38,2)) FROM rt_sales""",
        star_totals="""
  SELECT source, CAST(sum(gross_amount) AS DECIMAL(38,2)) AS gross FROM fact_sales GROUP BY source"""),
}

ORACLE |= RAW
