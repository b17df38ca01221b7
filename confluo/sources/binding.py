"""Bind the driver's parquet tables to the five landed business systems.

The library conforms *landed* tables: an ERP (snake_case), a field-service
system (PascalCase), a helpdesk (camelCase, free-text product references), a
marketplace (own listing ids, gross vs net) and an acquired retailer
(UPPER_SNAKE, day-first text dates, own product codes), plus a crosswalk.
Here every landed table is a lazy DataFrame derived row-by-row from the
TPC-H-like tables, so its size grows with them.  The rules are ours; they
plant the same traps the conformance has to handle (blank codes, status
words, duplicate listings, stale listings, unmatched descriptions,
misspelled free text, mixed inventory grain, orders without settlement).

Design notes for scale:
* every binding is a narrow projection/filter of one scan (no shuffles),
  except the helpdesk text (events x part on the key, one shuffle join) and
  the one-row part count used through a scalar subquery;
* codes are built with ``format_string('%06d')`` which never truncates;
* every row of ``part``, ``supplier``, ``lineitem`` and ``orders`` belongs to a
  system: line items flagged ``R`` are the retailer's, all others (a null flag
  included) the ERP's; all orders are the marketplace's.  Events are assigned
  by type: every event is a helpdesk ticket, signups are also work orders and
  purchases are also parts usages;
* inventory snapshots are generated with ``inline`` per product row (a
  generator, not a cross join), so they grow linearly with ``part``; products
  are dealt to tasks first, since their file is small where the snapshots are
  many, and codes and dates are made once for each product, place and day.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from confluo.operators.dimensions import literal_rows

MONEY = T.DecimalType(18, 2)

# Inventory window of the bound systems: daily snapshots from here on, for so
# many days (parameters of Landed; every product and every location is counted).
INVENTORY_START = "1999-12-18"
INVENTORY_DAYS = 28
# One task generates the snapshots of so many products, whatever the number of products.
PARTS_PER_TASK = 4000
# The ERP books single units; a line item's quantity is in pairs.
UNITS_PER_LINE_QTY = 2
# Event timestamps are moved back this many years so that all facts share
# one calendar with orders and line items.
EVENT_SHIFT_YEARS = 24

# The raw day behind each system's dates, and the years they were moved back by.
RAW_DAYS = {"lineitem": ("l_shipdate", 0), "orders": ("o_orderdate", 0), "events": ("ts", EVENT_SHIFT_YEARS)}

# fixed values: helpdesk categories (id, name)
HELPDESK_CATEGORIES = [
    (1, "Product complaint"),
    (2, "Delivery"),
    (3, "Billing"),
    (4, "Returns"),
    (5, "How-to"),
    (6, "Other"),
]


def _code(pattern: str, key: Column | str) -> Column:
    """Zero-padded code; null key gives null (format_string would print 'null')."""
    c = F.col(key) if isinstance(key, str) else key
    return F.when(c.isNotNull(), F.format_string(pattern, c))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _shifted(ts: str) -> Column:
    return F.col(ts) - F.expr(f"INTERVAL {EVENT_SHIFT_YEARS} YEARS")


def _cents_price(amount: Column, qty: Column) -> Column:
    """Unit price in whole cents: floor(amount*100/qty)/100 as DECIMAL(18,2)."""
    return (F.floor(amount * 100 / qty) / 100).cast(MONEY)


def _years_on(day: dt.date, years: int) -> dt.date:
    return dt.date(day.year + years, day.month, min(day.day, 28) if years and day.month == 2 else day.day)


class Landed:
    """Lazy landed tables of the five systems, bound to ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str,
                 inventory_start: str = INVENTORY_START, inventory_days: int = INVENTORY_DAYS,
                 days: tuple[int | None, int | None] = (None, None)):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.inventory_start = inventory_start
        self.inventory_days = inventory_days
        self.days = tuple(None if d is None else dt.date(d // 10000, d // 100 % 100, d % 100) for d in days)

    def whole(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        """A table's rows; of some days only if ``days`` says so. The landed dates
        ascend with the raw ones, so a bound on them is one on the raw column,
        which the scan can use (a day more on both sides covers moved leap days)."""
        df = self.whole(name)
        if name not in RAW_DAYS or self.days == (None, None):
            return df
        column, years = RAW_DAYS[name]
        kind = df.schema[column].dataType
        lo, hi = self.days
        if lo is not None:
            day = _years_on(lo, years) - dt.timedelta(days=1 if years else 0)
            df = df.where(F.col(column) >= F.lit(day.isoformat()).cast(kind))
        if hi is not None:
            day = _years_on(hi, years) + dt.timedelta(days=2 if years else 1)
            df = df.where(F.col(column) < F.lit(day.isoformat()).cast(kind))
        return df

    def between(self, lo: int | None, hi: int | None) -> Landed:
        """The same systems with what happened from day ``lo`` to day ``hi`` (yyyymmdd); tables without days stay whole."""
        some = Landed(self.spark, self.sf_dir, self.inventory_start, self.inventory_days, (lo, hi))
        some.snapshot_tasks = self.snapshot_tasks
        return some

    @cached_property
    def sales_days(self) -> DataFrame:
        """First and last sales day (lo, hi) by raw table: every line item and order is a sale, so no table is read twice."""
        parts = [self.whole(t).agg(F.min(c).cast("date").alias("lo"), F.max(c).cast("date").alias("hi")) for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"))]
        return parts[0].unionByName(parts[1])

    # ------------------------------------------------------------------ ERP
    @cached_property
    def products(self) -> DataFrame:
        k = F.col("p_partkey")
        n_suppliers = self.raw("supplier").agg(F.count(F.lit(1))).scalar()   # scalar subquery
        return self.raw("part").select(
            k.alias("product_key"),
            _code("SKU-%06d", k).alias("sku"),
            F.concat_ws(" ", "p_name", k.cast("string")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.col("p_type"), F.lit(" / size "), F.col("p_size").cast("string")).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.when(F.col("p_size") <= 12, "A").when(F.col("p_size") <= 25, "B")
             .otherwise("C").alias("abc_class"),
            F.round(F.col("p_retailprice").cast(MONEY) * F.lit(0.6).cast("decimal(2,1)"), 2)
             .cast(MONEY).alias("standard_unit_cost"),
            F.col("p_retailprice").cast(MONEY).alias("list_price"),
            (k % n_suppliers).alias("supplier_key"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        # nation is a fixed 25-row table at every scale: broadcast is bounded
        nation = F.broadcast(self.raw("nation").select("n_nationkey", "n_name"))
        return (self.raw("supplier")
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
                .select(F.col("s_suppkey").alias("supplier_key"),
                        _code("SUP-%05d", "s_suppkey").alias("supplier_id"),
                        F.col("s_name").alias("supplier_name"),
                        F.col("n_name").alias("supplier_country")))

    def _nations(self) -> DataFrame:
        region = F.broadcast(self.raw("region"))
        return self.raw("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")

    @cached_property
    def locations(self) -> DataFrame:
        k = F.col("n_nationkey")
        return (self._nations().where(k < 15)
                .select(k.alias("location_key"),
                        _code("LOC-%02d", k).alias("location_id"),
                        F.col("n_name").alias("location_name"),
                        F.col("r_name").alias("region"),
                        F.when(k < 10, "Distribution Center").otherwise("Consignment").alias("location_type"),
                        F.col("n_name").alias("country"),
                        F.when(k >= 10, "Y").otherwise("N").alias("is_consignment")))

    @cached_property
    def erp_sales_lines(self) -> DataFrame:
        li = self.raw("lineitem").where(~F.col("l_returnflag").eqNullSafe("R"))
        units = F.col("l_quantity") * UNITS_PER_LINE_QTY
        ch = F.col("l_orderkey") % 5
        return li.select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
             .alias("sales_line_id"),
            F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("date_key"),
            _code("SKU-%06d", "l_partkey").alias("sku"),
            _code("LOC-%02d", F.col("l_suppkey") % 15).alias("location_id"),
            F.when(ch <= 1, "Online").when(ch == 2, "Retail").otherwise("Wholesale").alias("channel"),
            units.cast("bigint").alias("qty_sold"),
            _cents_price(F.col("l_extendedprice"), units).alias("unit_price"),
        )

    @cached_property
    def snapshot_tasks(self) -> int:
        """How many tasks generate snapshots (the parts are counted from their files' footers)."""
        return self.whole("part").count() // PARTS_PER_TASK + 1

    def _snapshots(self, code: str, place: str, first_loc: int, last_loc: int, every: int) -> DataFrame:
        """All products x locations first..last x each ``every``-th day, by inline, with their codes."""
        start, (lo, hi) = dt.date.fromisoformat(self.inventory_start), self.days
        days = [d for d in range(1, self.inventory_days + 1, every)
                if (lo is None or start + dt.timedelta(d - 1) >= lo) and (hi is None or start + dt.timedelta(d - 1) <= hi)]
        part = self.raw("part") if days else self.raw("part").where("false")
        dates = [(d, start + dt.timedelta(d - 1)) for d in days or [1]]
        locs = F.array(*[F.struct(F.lit(n).alias("loc"), F.lit(place % n).alias("place")) for n in range(first_loc, last_loc + 1)])
        when = F.array(*[F.struct(F.lit(d).alias("day"), F.lit(int(f"{x:%Y%m%d}")).alias("date_key"), F.lit(f"{x:%d/%m/%Y}").alias("date_text")) for d, x in dates])
        g = (part.select("p_partkey", "p_size").repartition(self.snapshot_tasks)
             .select("p_partkey", (F.col("p_size") % 20).cast("bigint").alias("safety_stock"), _code(code, "p_partkey").alias("code"))
             .select("*", F.inline(locs)).select("*", F.inline(when)))
        return g.select(
            "code", "place", "date_key", "date_text", "safety_stock",
            ((F.col("p_partkey") * 7 + F.col("loc") * 13 + F.col("day") * 5) % 97).cast("bigint").alias("on_hand"))

    @cached_property
    def erp_inventory(self) -> DataFrame:
        s = self._snapshots("SKU-%06d", "LOC-%02d", 0, 14, 1)
        return s.select(
            "date_key",
            F.col("code").alias("sku"),
            F.col("place").alias("location_id"),
            F.col("on_hand").alias("on_hand_qty"),
            "safety_stock",
            F.when(F.col("on_hand") == 0, 1).otherwise(0).alias("is_stockout"),
        )

    # -------------------------------------------------------------- service
    def _events_k(self) -> Column:
        return F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)")

    @cached_property
    def svc_work_orders(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "signup")
        eid = F.col("event_id")
        opened = _shifted("ts")
        return e.select(
            F.concat(F.lit("WO-"), eid.cast("string")).alias("WorkOrderId"),
            _iso(opened).alias("OpenedAt"),
            _iso(opened + F.expr("INTERVAL 1 DAYS")).alias("ClosedAt"),
            _code("ITM-%06d", self._events_k()).alias("ItemCode"),
            F.concat(F.lit("TECH-"), F.col("user_id").cast("string")).alias("TechnicianId"),
            F.when(eid % 3 == 0, "Repair").when(eid % 3 == 1, "Install").otherwise("Inspection").alias("WorkType"),
            F.when(eid % 5 == 0, "Open").otherwise("Closed").alias("Status"),
            (eid % 40).cast("double").alias("LaborHours"),
        )

    @cached_property
    def svc_parts_usage(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "purchase")
        eid = F.col("event_id")
        return e.select(
            F.concat(F.lit("U-"), eid.cast("string")).alias("UsageId"),
            F.concat(F.lit("WO-"), eid.cast("string")).alias("WorkOrderId"),
            _code("ITM-%06d", self._events_k() * 10).alias("ItemCode"),
            (eid % 3 + 1).cast("bigint").alias("QtyUsed"),
            _iso(_shifted("ts")).alias("UsedAt"),
        )

    # ------------------------------------------------------------- helpdesk
    @cached_property
    def hd_tickets(self) -> DataFrame:
        e = self.raw("events").select("event_id", "ts", "user_id")
        p = self.raw("part").select("p_partkey", "p_name")
        j = e.join(p.hint("merge"), F.col("user_id") == F.col("p_partkey"), "left")   # all parts never go through the driver
        eid = F.col("event_id")
        name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
        # the text's kind depends on neither the category (id % 6) nor the status
        kind = F.floor(eid / 24) % 25
        is_open = F.floor(eid / 6) % 4 == 0
        text = (F.when(kind == 0, F.lit(""))
                 .when(kind.isin(1, 2), F.concat(F.col("p_name"), F.col("p_partkey").cast("string")))
                 .when(kind == 3, name)
                 .when(kind == 4, F.concat(F.lit(" "), name, F.lit("  ")))
                 .otherwise(F.concat(F.lit("  "), F.upper(name), F.lit(" "))))
        created = _shifted("ts")
        return j.select(
            F.concat(F.lit("T-"), eid.cast("string")).alias("ticketId"),
            _iso(created).alias("createdAt"),
            F.when(is_open, F.lit(None).cast("string"))
             .otherwise(_iso(created + F.expr("INTERVAL 2 DAYS"))).alias("closedAt"),
            F.when(F.col("p_partkey").isNull(), F.lit(None).cast("string")).otherwise(text).alias("productText"),
            (eid % 6 + 1).cast("bigint").alias("categoryId"),
            F.when(eid % 3 == 0, "High").when(eid % 3 == 1, "Medium").otherwise("Low").alias("priority"),
            F.when(is_open, "open").otherwise("closed").alias("status"),
            F.when(eid % 2 == 0, "email").otherwise("phone").alias("channel"),
        )

    @cached_property
    def hd_categories(self) -> DataFrame:
        return literal_rows(self.spark, HELPDESK_CATEGORIES, "categoryId bigint, categoryName string")

    # ---------------------------------------------------------- marketplace
    @cached_property
    def mp_listings(self) -> DataFrame:
        p = self.raw("part")
        k = F.col("p_partkey")
        primary = p.select(
            _code("ML-%06d", k).alias("listingId"),
            _code("SKU-%06d", k).alias("sellerSku"),
            F.upper(F.col("p_name")).alias("title"),
            F.col("p_retailprice").cast(MONEY).alias("listPrice"),
            F.when(k % 10 == 9, "stale").otherwise("active").alias("status"))
        dup = p.where(k % 50 == 0).select(
            _code("ML-D%06d", k).alias("listingId"),
            _code("SKU-%06d", k).alias("sellerSku"),
            F.upper(F.col("p_name")).alias("title"),
            F.col("p_retailprice").cast(MONEY).alias("listPrice"),
            F.lit("active").alias("status"))
        return primary.unionByName(dup)

    @cached_property
    def mp_orders(self) -> DataFrame:
        n_parts = self.raw("part").agg(F.count(F.lit(1))).scalar()   # scalar subquery
        o = self.raw("orders")
        key = F.col("o_orderkey")
        k = key % n_parts
        return o.select(
            F.concat(F.lit("MP-"), key.cast("string")).alias("orderId"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("orderDate"),
            F.when(key % 40 == 0, F.format_string("ML-D%06d", k - k % 50))
             .otherwise(F.format_string("ML-%06d", k)).alias("listingId"),
            (key % 5 + 1).cast("bigint").alias("qty"),
            F.col("o_totalprice").cast(MONEY).alias("grossAmount"),
        )

    @cached_property
    def mp_settlements(self) -> DataFrame:
        o = self.raw("orders").where(F.col("o_orderkey") % 101 != 0)
        key = F.col("o_orderkey")
        gross = F.col("o_totalprice").cast(MONEY)
        commission = F.round(gross * F.lit(0.10).cast("decimal(2,2)"), 2).cast(MONEY)
        payout = F.round(gross * F.lit(0.86).cast("decimal(2,2)"), 2).cast(MONEY)
        return o.select(
            F.concat(F.lit("ST-"), key.cast("string")).alias("settlementId"),
            F.concat(F.lit("MP-"), key.cast("string")).alias("orderId"),
            F.date_format(F.date_add(F.col("o_orderdate").cast("date"), (key % 20 + 3).cast("int")),
                          "yyyy-MM-dd").alias("settlementDate"),
            gross.alias("grossAmount"),
            commission.alias("commissionFee"),
            (gross - commission - payout).cast(MONEY).alias("fulfillmentFee"),
            payout.alias("payoutAmount"),
        )

    # ------------------------------------------------------ acquired retailer
    @cached_property
    def rt_products(self) -> DataFrame:
        p = self.raw("part").where(F.col("p_partkey") % 2 == 0)
        return p.select(
            _code("RTL-%06d", "p_partkey").alias("LOCAL_CODE"),
            _code("ITEM %06d", "p_partkey").alias("ITEM_DESC"),
            F.col("p_type").alias("CATEGORY"),
            F.col("p_retailprice").cast(MONEY).alias("UNIT_PRICE"))

    @cached_property
    def rt_stores(self) -> DataFrame:
        k = F.col("n_nationkey")
        return (self._nations().where(k >= 15)
                .select(_code("STR-%02d", k).alias("STORE_CODE"),
                        F.concat(F.lit("STORE "), F.col("n_name")).alias("STORE_NAME"),
                        F.col("r_name").alias("REGION"),
                        (F.lit(10000) + k * 500).cast("bigint").alias("SQFT")))

    @cached_property
    def rt_sales(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        return li.select(
            F.concat_ws("-", F.lit("RS"), F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("SALE_ID"),
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("SALE_DATE"),
            _code("STR-%02d", F.col("l_suppkey") % 10 + 15).alias("STORE_CODE"),
            _code("ITEM %06d", "l_partkey").alias("ITEM_DESC"),
            F.col("l_quantity").cast("bigint").alias("QTY"),
            _cents_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("UNIT_PRICE"),
            F.col("l_extendedprice").cast(MONEY).alias("TOTAL_AMT"),
        )

    @cached_property
    def rt_stock_counts(self) -> DataFrame:
        s = self._snapshots("RTL-%06d", "STR-%02d", 15, 24, 7)
        return s.select(
            F.col("date_text").alias("COUNT_DATE"),
            F.col("place").alias("STORE_CODE"),
            F.col("code").alias("LOCAL_CODE"),
            F.col("on_hand").alias("QTY_ON_HAND"))

    # ------------------------------------------------------------ crosswalk
    @cached_property
    def xref(self) -> DataFrame:
        p = self.raw("part")
        k = F.col("p_partkey")
        base = p.select(
            _code("SKU-%06d", k).alias("sku"),
            _code("ITM-%06d", k).alias("itm_code"),
            F.when((k % 2 == 0) & (k % 33 != 0), F.format_string("RTL-%06d", k))
             .otherwise(F.lit("")).alias("local_code"),
            F.when(k % 10 != 9, F.format_string("ML-%06d", k)).alias("listing_id"),
            F.when(k % 97 == 0, F.lit("retired SKU"))
             .when(k % 33 == 0, F.lit("TODO: confirm local code")).alias("notes"))
        conflict = p.where(k % 50 == 0).select(
            _code("SKU-%06d", k).alias("sku"),
            F.lit(None).cast("string").alias("itm_code"),
            F.lit(None).cast("string").alias("local_code"),
            F.format_string("ML-D%06d", k).alias("listing_id"),
            F.lit("CONFLICT: duplicate listing").alias("notes"))
        return base.unionByName(conflict)

    # ------------------------------------------------------------- registry
    TABLES = ("products", "suppliers", "locations", "erp_sales_lines", "erp_inventory",
              "svc_work_orders", "svc_parts_usage", "hd_tickets", "hd_categories",
              "mp_listings", "mp_orders", "mp_settlements", "rt_products", "rt_stores",
              "rt_sales", "rt_stock_counts", "xref")

    def table(self, name: str) -> DataFrame:
        if name not in self.TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def register_views(self) -> None:
        for name in self.TABLES:
            self.table(name).createOrReplaceTempView(name)
