"""DuckDB SQL of the catalogs: inferred landed columns, the star's columns, the metrics with their display."""

from __future__ import annotations

from sqlcheck.binding import LANDED_TABLES
from sqlcheck.compose import with_ctes
from sqlcheck.star import STAR_CTES, STAR_TABLES

_KEY = r"(^|_)(key|id|sku|code)$"
# camelCase names part at capitals, UPPER_SNAKE and snake_case at underscores
_NAME = "lower(CASE WHEN n = upper(n) OR contains(n, '_') THEN n ELSE regexp_replace(n, '([A-Z])', '_\\1', 'g') END)"

_CLASSES = [
    ("int", r"v = '0' OR (regexp_full_match(v, '-?[1-9][0-9]{0,18}') AND TRY_CAST(v AS INTEGER) IS NOT NULL)"),
    ("long", r"regexp_full_match(v, '-?[1-9][0-9]{0,18}') AND TRY_CAST(v AS BIGINT) IS NOT NULL"),
    ("decimal", r"regexp_full_match(v, '-?(0|[1-9][0-9]*)\.[0-9]+') AND len(replace(replace(v, '-', ''), '.', '')) <= 38"),
    ("date", r"regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(v, '%Y-%m-%d') IS NOT NULL"),
    ("time", r"regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}') AND try_strptime(v, '%Y-%m-%dT%H:%M:%S') IS NOT NULL"),
    ("both", r"regexp_full_match(v, '[0-9]{2}/[0-9]{2}/[0-9]{4}') AND try_strptime(v, '%d/%m/%Y') IS NOT NULL AND try_strptime(v, '%m/%d/%Y') IS NOT NULL"),
    ("dayfirst", r"regexp_full_match(v, '[0-9]{2}/[0-9]{2}/[0-9]{4}') AND try_strptime(v, '%d/%m/%Y') IS NOT NULL"),
    ("monthfirst", r"regexp_full_match(v, '[0-9]{2}/[0-9]{2}/[0-9]{4}') AND try_strptime(v, '%m/%d/%Y') IS NOT NULL"),
    ("double", r"regexp_full_match(v, '-?[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]+')"),
    ("bool", "v IN ('true', 'false')"),
]
_CASE = "CASE WHEN v IS NULL OR trim(v) = '' THEN NULL " + " ".join(f"WHEN {test} THEN '{name}'" for name, test in _CLASSES) + " ELSE 'text' END"


def _only(*names: str) -> str:
    return "len(list_filter(seen, lambda x: x NOT IN (" + ", ".join(f"'{n}'" for n in names) + "))) = 0"


_NUMBERS = ("int", "long", "decimal")
_TYPE = f"""CASE WHEN len(seen) = 0 THEN 'string' WHEN {_only('int')} THEN 'int' WHEN {_only('int', 'long')} THEN 'bigint'
  WHEN {_only(*_NUMBERS)} AND a + b <= 38 THEN printf('decimal(%d,%d)', a + b, b) WHEN {_only(*_NUMBERS, 'double')} THEN 'double'
  WHEN {_only('bool')} THEN 'boolean' WHEN {_only('date')} THEN 'date' WHEN {_only('date', 'time')} THEN 'timestamp'
  WHEN {_only('both', 'dayfirst')} OR {_only('both', 'monthfirst')} THEN 'date' ELSE 'string' END"""
_FORMAT = f"""CASE WHEN len(seen) = 0 THEN NULL WHEN {_only('date')} THEN 'yyyy-MM-dd' WHEN {_only('date', 'time')} THEN 'yyyy-MM-dd''T''HH:mm:ss'
  WHEN {_only('both', 'dayfirst')} THEN 'dd/MM/yyyy' WHEN {_only('both', 'monthfirst')} THEN 'MM/dd/yyyy' END"""


def _values(tables: tuple[str, ...]) -> str:
    one = "SELECT '{0}' AS t, n, v FROM (SELECT COLUMNS(*)::VARCHAR FROM {0}) UNPIVOT INCLUDE NULLS (v FOR n IN (COLUMNS(*)))"
    return " UNION ALL ".join(one.format(t) for t in tables)


COLUMNS = with_ctes(f"""
SELECT t AS table_name, n AS column_name, {_TYPE} AS inferred_type, {_FORMAT} AS date_format,
       CASE WHEN regexp_matches({_TYPE}, '^(int|bigint|double|decimal)') AND NOT is_key THEN 'sum' ELSE 'none' END AS default_agg,
       is_key AS hidden, rows, non_null, blank
FROM (SELECT *, regexp_matches({_NAME}, '{_KEY}') AS is_key FROM columns_)""", {
    "values_": _values(LANDED_TABLES),
    "classed": f"SELECT t, n, v, {_CASE} AS c, replace(v, '-', '') AS number FROM values_",
    "columns_": f"""
  SELECT t, n, coalesce(list(DISTINCT c) FILTER (WHERE c IS NOT NULL), []) AS seen, count(*) AS rows, count(v) AS non_null,
         count(*) FILTER (WHERE v IS NOT NULL AND trim(v) = '') AS blank,
         coalesce(max(len(split_part(number, '.', 1))) FILTER (WHERE c IN {_NUMBERS}), 0) AS a,
         coalesce(max(len(split_part(number, '.', 2))) FILTER (WHERE c IN {_NUMBERS}), 0) AS b
  FROM classed GROUP BY t, n"""})


# the star's columns: Spark's type names from DuckDB's
_SPARK = "CASE t WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(t) END"
#: What the conformed columns mean.
_MEANING = {
    "date_key": "Day of the row as yyyymmdd.", "sku": "Product of the row; a label where none was found.", "location_id": "Place of the row.",
    "channel": "Way the sale came about.", "source": "System the row came from.", "qty": "Units of the row.", "gross_amount": "Price paid.",
    "net_amount": "Price paid less marketplace fees.", "on_hand_qty": "Units counted.", "safety_stock": "Units that should never be undercut.",
    "is_stockout": "1 if none were left.", "grain": "Whether a count is daily or weekly.", "product_name": "Name of the product.",
    "category": "Group of products or of tickets.", "abc_class": "Importance of the product.", "list_price": "Price on the list.",
    "supplier_name": "Who delivers it.", "is_retailer_only": "True for products that only the stores carry.", "location_type": "Kind of place.",
    "is_complaint": "True for tickets of the complaint category.", "is_open": "True while nobody has closed the ticket.", "labor_hours": "Hours worked.",
    "qty_used": "Parts fitted.", "month_key": "Month as yyyymm.",
}


def _star_columns() -> str:
    one = """
  SELECT '{0}' AS table_name, n, t, rows, non_null FROM
    (SELECT n, any_value(v) AS t FROM (SELECT typeof(COLUMNS(*)) FROM {0}) UNPIVOT (v FOR n IN (COLUMNS(*))) GROUP BY n)
    JOIN (SELECT n, count(*) AS rows, count(v) AS non_null FROM (SELECT COLUMNS(*)::VARCHAR FROM {0}) UNPIVOT INCLUDE NULLS (v FOR n IN (COLUMNS(*))) GROUP BY n) USING (n)"""
    return " UNION ALL ".join(one.format(t) for t in STAR_TABLES)


_MEANINGS = ", ".join(f"('{k}', '{v}')" for k, v in _MEANING.items())
STAR_COLUMNS = with_ctes(f"""
SELECT table_name, n AS column_name, {_SPARK} AS data_type,
       CASE WHEN regexp_matches(n, '(_key|_id|sku|code)$') OR n IN ('year', 'quarter', 'month', 'day', 'fiscal_year') THEN 'none'
            WHEN regexp_matches(t, '^(BIGINT|INTEGER|DOUBLE|DECIMAL)') THEN 'sum' ELSE 'none' END AS default_agg,
       d AS description, ends_with(n, '_key') AS hidden, rows, non_null
FROM star_columns LEFT JOIN (VALUES {_MEANINGS}) m(c, d) ON c = n""", STAR_CTES, {"star_columns": _star_columns()})

_UNKNOWN = "('UNMAPPED', 'UNRESOLVED')"
#: metric: (kind, pattern, description, value)
_METRICS = {
    "revenue_gross": ("sum", "#,##0", "What buyers paid, before any fee is taken off.", "(SELECT sum(gross_amount) FROM fact_sales)"),
    "revenue_net": ("sum", "#,##0", "What reaches us: gross amounts, and for the marketplace its payouts.", "(SELECT sum(net_amount) FROM fact_sales)"),
    "units_sold": ("sum", "#,##0", "Quantity over all sales rows.", "(SELECT sum(qty) FROM fact_sales)"),
    "erp_revenue": ("sum", "#,##0", "Part of revenue_net booked through the ERP.", "(SELECT sum(net_amount) FROM fact_sales WHERE source = 'ERP')"),
    "marketplace_net_revenue": ("sum", "#,##0", "Part of revenue_net paid out by the marketplace.", "(SELECT sum(net_amount) FROM fact_sales WHERE source = 'MARKETPLACE')"),
    "marketplace_gross_revenue": ("sum", "#,##0", "Order value on the marketplace, commission and fulfilment included.", "(SELECT sum(gross_amount) FROM fact_sales WHERE source = 'MARKETPLACE')"),
    "retailer_revenue": ("sum", "#,##0", "Part of revenue_net from the store network.", "(SELECT sum(net_amount) FROM fact_sales WHERE source = 'RETAILER')"),
    "stockout_rows": ("sum", "#,##0", "How many daily counts found an empty shelf.", "(SELECT sum(is_stockout) FROM fact_inventory WHERE grain = 'daily')"),
    "snapshot_rows": ("count", "#,##0", "How many daily counts there are.", "(SELECT count(*) FROM fact_inventory WHERE grain = 'daily')"),
    "stockout_rate": ("formula", "0.0%", "stockout_rows over snapshot_rows.", "(SELECT sum(is_stockout) / count(*)::DOUBLE FROM fact_inventory WHERE grain = 'daily')"),
    "avg_on_hand": ("semi_additive", "#,##0", "Stock added up over places for each day, then averaged over the days that have counts.", "(SELECT avg(s) FROM (SELECT sum(on_hand_qty) AS s FROM fact_inventory GROUP BY date_key))"),
    "sell_through": ("formula", "0.00", "units_sold over avg_on_hand.", "(SELECT sum(qty)::DOUBLE FROM fact_sales) / (SELECT avg(s) FROM (SELECT sum(on_hand_qty) AS s FROM fact_inventory GROUP BY date_key))"),
    "tickets": ("count", "#,##0", "Number of helpdesk contacts.", "(SELECT count(*) FROM fact_helpdesk)"),
    "open_complaints": ("count", "#,##0", "Complaints that nobody has closed.", "(SELECT count(*) FROM fact_helpdesk WHERE is_complaint AND is_open)"),
    "tickets_per_1k": ("formula", "0.0", "tickets over units_sold, times 1,000.", "(SELECT count(*)::DOUBLE FROM fact_helpdesk) / (SELECT sum(qty) FROM fact_sales) * 1000"),
    "service_parts_used": ("sum", "#,##0", "Quantity of parts that field service fitted.", "(SELECT sum(qty_used) FROM fact_service_parts)"),
    "parts_per_100": ("formula", "0.0", "service_parts_used over units_sold, times 100.", "(SELECT sum(qty_used)::DOUBLE FROM fact_service_parts) / (SELECT sum(qty) FROM fact_sales) * 100"),
    "unattributable_revenue": ("sum", "#,##0", "Part of revenue_net on the unknown members.", f"(SELECT sum(net_amount) FROM fact_sales WHERE sku IN {_UNKNOWN})"),
    "attributable_share": ("formula", "0.0%", "One minus unattributable_revenue over revenue_net.", f"(SELECT (sum(net_amount) - coalesce(sum(net_amount) FILTER (WHERE sku IN {_UNKNOWN}), 0))::DOUBLE / sum(net_amount)::DOUBLE FROM fact_sales)"),
    "complaints": ("count", "#,##0", "Contacts filed under the complaint category.", "(SELECT count(*) FROM fact_helpdesk WHERE is_complaint)"),
    "after_sale_per_1k": ("formula", "0.0", "complaints and service_parts_used together over units_sold, times 1,000.", "((SELECT count(*) FROM fact_helpdesk WHERE is_complaint) + (SELECT sum(qty_used) FROM fact_service_parts))::DOUBLE / (SELECT sum(qty) FROM fact_sales) * 1000"),
    "category_avg_sell_through": ("peer_average", "0.00", "Plain average of sell_through over a category's products, whatever product filters are set.", "NULL"),
}
_SHOWN = {
    "#,##0": "format('{{:,}}', round(x)::BIGINT)",
    "0.0%": "printf('%.1f%%', round(x * 100, 1))",
    "0.00": "printf('%.2f', round(x, 2))",
    "0.0": "printf('%.1f', round(x, 1))",
}
METRICS = with_ctes(" UNION ALL ".join(
    f"SELECT '{name}' AS metric, '{kind}' AS kind, '{pattern}' AS format, '{text.replace(chr(39), chr(39) * 2)}' AS description, CAST(v AS DOUBLE) AS value, "
    f"{_SHOWN[pattern].replace('{{', '{').replace('}}', '}')} AS display FROM (SELECT v, CAST(v AS DECIMAL(38,10)) AS x FROM (SELECT {value} AS v))"
    for name, (kind, pattern, text, value) in _METRICS.items()), STAR_CTES)
