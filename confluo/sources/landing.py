"""Landing: CSV in with an explicit schema (never inferred), and the landed
type check that day-first text dates stayed text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NULL = "\\N"
S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DecimalType(18, 2)

# Declared landed types of the columns that the conformance relies on, all 17 tables.
EXPECTED_TYPES: dict[str, dict[str, T.DataType]] = {
    "products": {"product_key": L, "sku": S, "product_name": S, "category": S, "abc_class": S, "standard_unit_cost": D,
                 "list_price": D, "supplier_key": L},
    "suppliers": {"supplier_key": L, "supplier_id": S, "supplier_name": S, "supplier_country": S},
    "locations": {"location_key": L, "location_id": S, "location_name": S, "region": S, "location_type": S},
    "svc_work_orders": {"WorkOrderId": S, "OpenedAt": S, "ItemCode": S, "Status": S, "LaborHours": T.DoubleType()},
    "svc_parts_usage": {"UsageId": S, "WorkOrderId": S, "ItemCode": S, "QtyUsed": L, "UsedAt": S},
    "hd_categories": {"categoryId": L, "categoryName": S},
    "mp_listings": {"listingId": S, "sellerSku": S, "title": S, "listPrice": D, "status": S},
    "rt_products": {"LOCAL_CODE": S, "ITEM_DESC": S, "CATEGORY": S, "UNIT_PRICE": D},
    "rt_stores": {"STORE_CODE": S, "STORE_NAME": S, "REGION": S, "SQFT": L},
    "erp_sales_lines": {"date_key": I, "sku": S, "location_id": S, "qty_sold": L, "unit_price": D},
    "erp_inventory": {"date_key": I, "sku": S, "location_id": S, "on_hand_qty": L, "safety_stock": L},
    "mp_orders": {"orderId": S, "orderDate": S, "listingId": S, "qty": L, "grossAmount": D},
    "mp_settlements": {"orderId": S, "settlementDate": S, "grossAmount": D, "payoutAmount": D},
    "rt_sales": {"SALE_ID": S, "SALE_DATE": S, "ITEM_DESC": S, "QTY": L, "TOTAL_AMT": D},
    "rt_stock_counts": {"COUNT_DATE": S, "STORE_CODE": S, "LOCAL_CODE": S, "QTY_ON_HAND": L},
    "hd_tickets": {"ticketId": S, "createdAt": S, "productText": S, "categoryId": L},
    "xref": {"sku": S, "itm_code": S, "local_code": S, "listing_id": S, "notes": S},
}

# day-first text date columns that must stay strings and parse with the format
TEXT_DATE_COLUMNS: dict[str, tuple[str, str]] = {
    "rt_sales": ("SALE_DATE", "dd/MM/yyyy"),
    "rt_stock_counts": ("COUNT_DATE", "dd/MM/yyyy"),
}


def write_csv(df: DataFrame, path: str) -> str:
    """Blank text is written quoted, null as \\N: they stay apart. The text of large tables is many times their Parquet, so it
    lies there as gzip; a task reads a file, which holds what a task wrote."""
    df.write.mode("overwrite").option("header", True).option("nullValue", NULL).option("compression", "gzip").csv(path)
    return path


def read_landed(spark, path: str) -> DataFrame:
    """The landed CSV as it lies there: every column text."""
    return spark.read.option("header", True).option("nullValue", NULL).csv(path)


def read_csv(spark, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema: text dates stay strings; a row that
    does not fit the schema fails the read (FAILFAST) instead of turning null."""
    return (spark.read.option("header", True).option("mode", "FAILFAST").option("nullValue", NULL)
            .schema(schema).csv(path))


def land_csv(df: DataFrame, base: str, name: str) -> DataFrame:
    """Round trip of one landed table through CSV in a shared folder."""
    path = write_csv(df, f"{base.rstrip('/')}/{name}")
    return read_csv(df.sparkSession, path, df.schema)
