"""Conform the landed systems into one star: 4 dimensions + 5 facts.

Everything stays lazy: :class:`Conformer` exposes each conformed table as a
DataFrame; callers choose to query it directly, or to write it with
:func:`write_star` (facts partitioned by month) and read it back with
:func:`read_star`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from confluo.config import DEFAULT, StarConfig
from confluo.operators import crosswalk as xw
from confluo.operators.dimensions import date_dim, literal_rows, union_dim, unknown_members
from confluo.operators.facts import SourceMap, unify
from confluo.plans.feeds import BOUNDED_TABLES, FEEDS
from confluo.sources.binding import Landed

MONEY = T.DecimalType(18, 2)

SALES_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("date_key", T.IntegerType()),
    T.StructField("sku", T.StringType()), T.StructField("location_id", T.StringType()),
    T.StructField("channel", T.StringType()), T.StructField("qty", T.LongType()),
    T.StructField("gross_amount", MONEY), T.StructField("net_amount", MONEY)])

INVENTORY_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()), T.StructField("sku", T.StringType()),
    T.StructField("location_id", T.StringType()), T.StructField("on_hand_qty", T.LongType()),
    T.StructField("safety_stock", T.LongType()), T.StructField("is_stockout", T.IntegerType()),
    T.StructField("grain", T.StringType()), T.StructField("source", T.StringType())])

SERVICE_SCHEMA = T.StructType([
    T.StructField("work_order_id", T.StringType()), T.StructField("date_key", T.IntegerType()),
    T.StructField("sku", T.StringType()), T.StructField("work_type", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("labor_hours", T.DoubleType())])

PARTS_SCHEMA = T.StructType([
    T.StructField("usage_id", T.StringType()), T.StructField("date_key", T.IntegerType()),
    T.StructField("sku", T.StringType()), T.StructField("qty_used", T.LongType())])

HELPDESK_SCHEMA = T.StructType([
    T.StructField("ticket_id", T.StringType()), T.StructField("date_key", T.IntegerType()),
    T.StructField("sku", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("is_complaint", T.BooleanType()), T.StructField("is_open", T.BooleanType()),
    T.StructField("priority", T.StringType())])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("sku", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("subcategory", T.StringType()),
    T.StructField("brand", T.StringType()), T.StructField("abc_class", T.StringType()),
    T.StructField("standard_unit_cost", MONEY), T.StructField("list_price", MONEY),
    T.StructField("supplier_name", T.StringType()), T.StructField("itm_code", T.StringType()),
    T.StructField("local_code", T.StringType()), T.StructField("listing_id", T.StringType()),
    T.StructField("is_retailer_only", T.BooleanType())])

LOCATION_SCHEMA = T.StructType([
    T.StructField("location_id", T.StringType()), T.StructField("location_name", T.StringType()),
    T.StructField("region", T.StringType()), T.StructField("location_type", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("source", T.StringType())])

# fact -> (fk column, dimension, dimension key): the star's relationships
RELATIONSHIPS: tuple[tuple[str, str, str, str], ...] = (
    ("fact_sales", "date_key", "dim_date", "date_key"),
    ("fact_sales", "sku", "dim_product", "sku"),
    ("fact_sales", "location_id", "dim_location", "location_id"),
    ("fact_sales", "channel", "dim_channel", "channel"),
    ("fact_inventory", "date_key", "dim_date", "date_key"),
    ("fact_inventory", "sku", "dim_product", "sku"),
    ("fact_inventory", "location_id", "dim_location", "location_id"),
    ("fact_service", "date_key", "dim_date", "date_key"),
    ("fact_service", "sku", "dim_product", "sku"),
    ("fact_service_parts", "date_key", "dim_date", "date_key"),
    ("fact_service_parts", "sku", "dim_product", "sku"),
    ("fact_helpdesk", "date_key", "dim_date", "date_key"),
    ("fact_helpdesk", "sku", "dim_product", "sku"),
)

# Dimensions whose row count has a proven bound independent of data volume
# (calendar days of the window, business locations, channel list).  Only these
# are ever broadcast by hint; the product dimension grows with the catalogue.
BOUNDED_DIMS = frozenset({"dim_date", "dim_location", "dim_channel"})

# Facts of snapshots: a written star knows, for each, the months that hold the
# latest snapshot of some key, and reads no others for the latest ones.
SNAPSHOTS = {"fact_inventory": ("sku", "location_id", "grain")}

DIMENSIONS = ("dim_date", "dim_product", "dim_location", "dim_channel")
FACTS = ("fact_sales", "fact_inventory", "fact_service", "fact_service_parts", "fact_helpdesk")


@dataclass
class Star:
    """Conformed tables plus the relationship graph used by the metric compiler.

    ``periods`` gives a fact's rows of some days where the star isn't written yet
    (a superset is fine: filters still apply); ``months`` the months a written
    star holds latest snapshots in."""
    tables: dict[str, DataFrame]
    relationships: tuple[tuple[str, str, str, str], ...] = RELATIONSHIPS
    bounded: frozenset = BOUNDED_DIMS
    config: StarConfig = field(default_factory=lambda: DEFAULT)
    unknown: tuple[str, ...] | None = None
    periods: Callable[[str, int | None, int | None], DataFrame] | None = None
    months: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self):
        self.unknown = self.config.unknown_labels if self.unknown is None else self.unknown

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def edges(self, fact: str) -> list[tuple[str, str, str]]:
        return [(fk, dim, dk) for f, fk, dim, dk in self.relationships if f == fact]

    def between(self, fact: str, lo: int | None, hi: int | None) -> DataFrame:
        """The fact, as far as cheaply possible only its rows from day ``lo`` to day ``hi``."""
        return self[fact] if self.periods is None or (lo is None and hi is None) else self.periods(fact, lo, hi)

    def newest(self, fact: str) -> DataFrame:
        """The fact; of a written one only the months that hold some key's latest row (one small row for each month is read)."""
        if fact not in self.months:
            return self[fact]
        return self[fact].where(F.col("month_key").isin(sorted(r["month_key"] for r in self.months[fact].collect())))


class Conformer:
    """Builds each conformed table lazily from :class:`Landed` tables."""

    def __init__(self, landed: Landed, config: StarConfig = DEFAULT, watch: Callable[[str], Observation] | None = None):
        """``watch`` names an observation for each feed; it counts the feed's rows while they are written."""
        self.landed = landed
        self.cfg = config
        self.spark = landed.spark
        self.watch = watch
        self._periods: dict[tuple, Conformer] = {}

    # ------------------------------------------------------- crosswalk maps
    @cached_property
    def xref_clean(self) -> DataFrame:
        return xw.clean(self.landed.xref, "notes", self.cfg.drop_status_words)

    @cached_property
    def local_map(self) -> DataFrame:
        return xw.mapping(self.xref_clean, "local_code")

    @cached_property
    def item_map(self) -> DataFrame:
        return xw.mapping(self.xref_clean, "itm_code")

    @cached_property
    def listing_map(self) -> DataFrame:
        return xw.mapping(self.xref_clean, "listing_id")

    @cached_property
    def local_full(self) -> DataFrame:
        """Retailer products with their conformed key (mapped or fallback)."""
        return xw.with_fallback(
            self.landed.rt_products.select("LOCAL_CODE", "ITEM_DESC"), self.local_map,
            "LOCAL_CODE", "local_code", self.cfg.retailer_only_prefix,
            self.cfg.retailer_code_digits_from)

    # ------------------------------------------------------------ dimensions
    def date_window(self):
        """(start, end) of the calendar: config, else min/max sale date of all sources."""
        if self.cfg.window_start and self.cfg.window_end:
            return self.cfg.window_start, self.cfg.window_end
        bounds = self.landed.sales_days.agg(F.struct(F.min("lo").alias("lo"), F.max("hi").alias("hi"))).scalar()
        start = self.cfg.window_start or bounds.getField("lo")
        end = self.cfg.window_end or bounds.getField("hi")
        return start, end

    @cached_property
    def dim_date(self) -> DataFrame:
        start, end = self.date_window()
        return date_dim(self.spark, start, end, self.cfg.event_date)

    @cached_property
    def product_codes(self) -> DataFrame:
        return xw.code_rollup(self.xref_clean, "sku", ["itm_code", "local_code", "listing_id"])

    @cached_property
    def erp_products(self) -> DataFrame:
        return self.conform("products", PRODUCT_SCHEMA)

    @cached_property
    def retailer_only_products(self) -> DataFrame:
        return self.conform("retailer_only_products", PRODUCT_SCHEMA)

    @cached_property
    def unknown_products(self) -> DataFrame:
        c = self.cfg
        return unknown_members(self.spark, [
            (c.unmapped_label, "Marketplace listing without a product"),
            (c.unresolved_label, "Product reference not resolved")],
            c.unknown_category, PRODUCT_SCHEMA)

    @cached_property
    def dim_product(self) -> DataFrame:
        return union_dim([self.erp_products, self.retailer_only_products, self.unknown_products])

    @cached_property
    def dim_location(self) -> DataFrame:
        own = [self.conform(feed, LOCATION_SCHEMA) for feed in ("locations", "stores")]
        market = tuple(self.cfg.marketplace_location[f] for f in LOCATION_SCHEMA.fieldNames())
        return union_dim([*own, literal_rows(self.spark, [market], LOCATION_SCHEMA)])

    @cached_property
    def dim_channel(self) -> DataFrame:
        return literal_rows(self.spark, [(ch,) for ch in self.cfg.channels], "channel string")

    # ----------------------------------------------------------------- feeds
    @cached_property
    def description_map(self) -> DataFrame:
        return self.local_full.select(F.col("ITEM_DESC").alias("desc"), F.col("c_sku").alias("sku"))

    @cached_property
    def name_map(self) -> DataFrame:
        return self.landed.products.select("product_name", "sku")

    def resolved(self, feed: str, rows: DataFrame | None = None) -> DataFrame:
        """The feed's landed rows (or ``rows`` of that shape, as from a stream)
        with their further tables and their product in ``sku``."""
        f = FEEDS[feed]
        df = self.landed.table(f.table) if rows is None else rows
        for table, on, how in f.joins:
            other = self.landed.table(table) if table in self.landed.TABLES else getattr(self, table)
            other = other.select(on, *[c for c in other.columns if c not in df.columns])
            df = df.join(F.broadcast(other) if table in BOUNDED_TABLES else other.hint("merge"), on, how)
        look = f.lookup
        if look is None or look.kind not in ("must", "missing"):
            df = self._watched(feed, df)   # from here on no row may get lost or doubled
        if look is None:
            return df
        known = getattr(self, look.by)
        if look.kind == "missing":
            return self._watched(feed, xw.unmapped(df, known, look.ref, look.code))
        unknown = getattr(self.cfg, look.unknown) if look.unknown else None
        find = xw.resolve_text if look.kind == "text" else xw.resolve
        args = (known, look.code) if look.kind == "text" else (look.ref, look.code)
        if look.kind == "text":
            return find(df, look.ref, *args, key_col=look.key, unknown=unknown, row_id=look.row)
        out = find(df, known, *args, key_col=look.key, unknown=unknown, row_id=look.row)
        return self._watched(feed, out.where(F.col("sku").isNotNull())) if look.kind == "must" else out

    def _watched(self, feed: str, df: DataFrame) -> DataFrame:
        return df if self.watch is None or df.isStreaming else df.observe(self.watch(feed), F.count(F.lit(1)).alias("rows"))

    def conform(self, feed: str, schema: T.StructType, rows: DataFrame | None = None) -> DataFrame:
        """A feed's rows in the conformed shape: its expressions, else columns of
        the same name, else typed nulls."""
        df, values = self.resolved(feed, rows), vars(self.cfg)
        given = {t: F.expr(e.format(**values)) for t, e in FEEDS[feed].columns.items()}
        same = {c: F.col(c) for c in df.columns if c in schema.fieldNames() and c not in given}
        return unify([SourceMap(df, same | given)], schema)

    def _facts(self, schema: T.StructType, *feeds: str) -> DataFrame:
        return union_dim([self.conform(f, schema) for f in feeds])

    @cached_property
    def marketplace_sales(self) -> DataFrame:
        """Settled orders only (an order without a settlement isn't revenue), with their product."""
        return self.resolved("marketplace_sales")

    @cached_property
    def retailer_sales(self) -> DataFrame:
        return self.resolved("retailer_sales")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._facts(SALES_SCHEMA, "erp_sales", "marketplace_sales", "retailer_sales")

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return self._facts(INVENTORY_SCHEMA, "daily_inventory", "weekly_inventory")

    @cached_property
    def fact_service(self) -> DataFrame:
        return self._facts(SERVICE_SCHEMA, "fact_service")

    @cached_property
    def fact_service_parts(self) -> DataFrame:
        return self._facts(PARTS_SCHEMA, "fact_service_parts")

    @cached_property
    def fact_helpdesk(self) -> DataFrame:
        return self._facts(HELPDESK_SCHEMA, "fact_helpdesk")

    # -------------------------------------------------------------- the star
    def between(self, table: str, lo: int | None, hi: int | None) -> DataFrame:
        """A table from landed rows of these days alone: the bound goes to the raw date columns, down to the scan."""
        if (lo, hi) not in self._periods:
            self._periods[lo, hi] = Conformer(self.landed.between(lo, hi), self.cfg)
        return getattr(self._periods[lo, hi], table)

    def star(self) -> Star:
        return Star({n: getattr(self, n) for n in DIMENSIONS + FACTS}, config=self.cfg, periods=self.between)


def build_star(landed: Landed, config: StarConfig = DEFAULT) -> Star:
    return Conformer(landed, config).star()


# ------------------------------------------------------------------- sinks
def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month_key", F.expr("date_key div 100").cast("int"))


def latest_months(fact: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The months (``month_key``) that hold some key's latest rows, from a written fact's key columns alone."""
    return fact.groupBy(*keys).agg(F.max("month_key").alias("month_key")).select("month_key").distinct().coalesce(1)


def _write_table(name: str, df: DataFrame, target: str, mode: str) -> None:
    if name.startswith("fact_") and "date_key" in df.columns:
        (_by_month(df).hint("rebalance", "month_key")
           .write.mode(mode).option("partitionOverwriteMode", "static")
           .partitionBy("month_key").parquet(target))
        if name in SNAPSHOTS:
            spark = df.sparkSession
            latest_months(spark.read.parquet(target), SNAPSHOTS[name]).write.mode(mode).parquet(f"{target}__months")
    else:
        df.write.mode(mode).parquet(target)


def in_parallel(jobs: dict[str, Callable[[], None]], parallel: int = 4) -> None:
    """Independent Spark jobs, submitted from ``parallel`` driver threads so that small ones leave no executors idle."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(job) for job in jobs.values()]:
            f.result()   # re-raise the first failure


def write_star(star: Star, path: str, mode: str = "overwrite", parallel: int = 4) -> dict[str, str]:
    """Write every table as parquet under ``path``; facts are partitioned by
    month (``month_key``) with a rebalance so AQE splits hot months into
    several files instead of one giant task.  Readers of ``path`` see the tables
    change one by one; ``StarCatalog`` publishes a star as a whole."""
    targets = {name: f"{path.rstrip('/')}/{name}" for name in star.tables}
    in_parallel({n: lambda n=n, df=df: _write_table(n, df, targets[n], mode) for n, df in star.tables.items()}, parallel)
    return targets


def read_star(spark, path: str, config: StarConfig = DEFAULT) -> Star:
    tables, months = {}, {}
    for name in DIMENSIONS + FACTS:
        # month_key stays: the metric compiler derives months from date filters,
        # so a period question opens only the folders of its months
        tables[name] = spark.read.parquet(f"{path.rstrip('/')}/{name}")
    for name in SNAPSHOTS:
        try:
            months[name] = spark.read.schema("month_key int").parquet(f"{path.rstrip('/')}/{name}__months")
        except AnalysisException:   # written without
            pass
    return Star(tables, config=config, months=months)


def materialize_star(spark, star: Star, path: str | None = None) -> Star:
    """Write the star once into the cluster's shared folder and return the
    re-read star: queries then start from the written tables, so a lost
    executor recomputes from parquet, not from the whole conformance lineage."""
    from confluo.session import ensure_checkpoint_dir
    import uuid
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/confluo-star-{uuid.uuid4().hex[:12]}"
    write_star(star, path)
    return read_star(spark, path, star.config)
