"""Every registered query: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables under ``sf_dir`` through the landed-system
bindings, so its work grows with them.  Parameters come from
:data:`confluo.plans.answers.P`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.config import DEFAULT
from confluo.functions.dates import date_key as to_key
from confluo.functions.dates import parse_iso_timestamp, parse_text_date
from confluo.operators import crosswalk as xw
from confluo.operators import quality as q
from confluo.operators.inference import inferred_columns
from confluo.plans import answers as A
from confluo.plans import legacy as raw
from confluo.plans import raw_twins as twins
from confluo.plans.governed import governed, metric_card
from confluo.plans.managed import StarCatalog
from confluo.plans.report import StarReport
from confluo.plans.star import FACTS, Conformer, in_parallel
from confluo.session import case_sensitive, ensure_checkpoint_dir
from confluo.sources.binding import Landed
from confluo.sources.landing import EXPECTED_TYPES, TEXT_DATE_COLUMNS, land_csv, read_landed, write_csv

P = A.P


def _ctx(spark: SparkSession, sf_dir: str):
    L = Landed(spark, sf_dir)
    c = Conformer(L, DEFAULT)
    return L, c, c.star(), governed(DEFAULT)


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/confluo-{what}-{uuid.uuid4().hex[:12]}"


def _q(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(*_ctx(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


# ---------------------------------------------------------------- sources
def q_land_csv(spark, sf_dir):
    L = Landed(spark, sf_dir)
    return land_csv(L.rt_sales, _scratch(spark, "landed"), "rt_sales")


def _landed(L: Landed, base: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The tables landed as CSV, several at a time, and read back as text."""
    in_parallel({n: lambda n=n: write_csv(L.table(n), f"{base}/{n}") for n in names})
    return {n: read_landed(L.spark, f"{base}/{n}") for n in names}


def q_landed_schema_check(spark, sf_dir):
    """All tables land as CSV; what lies there is checked, and a misfit fails the job."""
    L, base = Landed(spark, sf_dir), _scratch(spark, "landed")
    return q.require_landed(q.landed_schema_check(_landed(L, base, EXPECTED_TYPES), EXPECTED_TYPES, TEXT_DATE_COLUMNS))


def q_column_catalog(spark, sf_dir):
    """All tables land as CSV; types come from all rows of the text that lies there."""
    L, base = Landed(spark, sf_dir), _scratch(spark, "landed")
    return inferred_columns(_landed(L, base, L.TABLES))


def q_star_catalog(spark, sf_dir):
    _, _, star, _ = _ctx(spark, sf_dir)
    return q.column_catalog(star.tables)


def q_star_roundtrip(spark, sf_dir):
    """The star published as managed tables of a database of its own, read back, and dropped."""
    name = f"confluo_{uuid.uuid4().hex[:12]}"
    catalog = StarCatalog(spark, name, _scratch(spark, "catalog"))
    try:
        version, report = catalog.publish(Landed(spark, sf_dir))
        counts = catalog.roundtrip(version, report)
        return spark.createDataFrame(counts.collect(), counts.schema)   # nine rows
    finally:
        catalog.drop()


# ------------------------------------------------------------ conformance
def q_parse_text_date(spark, sf_dir):
    """``SALE_DATE`` as landed beside ``sale_date`` as parsed: file sinks take both only where names tell capitals apart."""
    L = Landed(case_sensitive(spark), sf_dir)
    day = parse_text_date("SALE_DATE")
    return L.rt_sales.select("SALE_ID", "SALE_DATE", day.alias("sale_date"), to_key(day).alias("date_key"))


def _table(name):
    def f(L, c, star, R):
        return getattr(c, name)
    f.__name__ = name
    return _q(f)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "land_csv": q_land_csv,
    "landed_schema_check": q_landed_schema_check,
    "column_catalog": q_column_catalog,
    "star_catalog": q_star_catalog,
    "star_roundtrip": q_star_roundtrip,
    "metric_catalog": _q(lambda L, c, star, R: metric_card(star, R)),
    "date_dim": _table("dim_date"),
    "conform_product": _table("dim_product"),
    "conform_location": _table("dim_location"),
    "unified_sales": _table("fact_sales"),
    "unified_inventory": _table("fact_inventory"),
    "helpdesk_flags": _table("fact_helpdesk"),
    "unknown_members": _q(lambda L, c, star, R: star["dim_product"]
                          .where(F.col("sku").isin(*DEFAULT.unknown_labels))
                          .select("sku", "product_name", "category")),
    "month_total_raw": _q(lambda L, c, star, R: twins.month_total(L, P.month_key)),
    "stockout_rate_raw": _q(lambda L, c, star, R: twins.stockout_rate_raw(L)),
    "after_sale_by_product_raw": _q(lambda L, c, star, R: twins.after_sale_by_product(L)),
    "after_sale_by_category_raw": _q(lambda L, c, star, R: twins.after_sale_by_category(L)),
    "sell_through_by_product_raw": _q(lambda L, c, star, R: twins.sell_through_by_product(L)),
    "store_network_raw": _q(lambda L, c, star, R: twins.store_network(L, P.since_key)),
    "channel_parity": _q(lambda L, c, star, R: twins.channel_parity(A.revenue_by_channel(star, R), L, P.quarter)),
    "mapping_check": _q(lambda L, c, star, R: xw.mapping_check({
        "local_code": c.local_map, "itm_code": c.item_map, "listing_id": c.listing_map})),
    "crosswalk_clean": _q(lambda L, c, star, R: c.xref_clean.select("sku", "itm_code", "local_code", "listing_id")),
    "local_only_products": _q(lambda L, c, star, R: c.retailer_only_products.select(
        F.col("local_code").alias("LOCAL_CODE"), "product_name", "list_price", "sku")),
    "local_fallback_key": _q(lambda L, c, star, R: c.local_full.select("LOCAL_CODE", "c_sku")),
    "resolve_listing": _q(lambda L, c, star, R: A_resolve_listing(L, c)),
    "resolve_item": _q(lambda L, c, star, R: A_resolve_item(c)),
    "resolve_description": _q(lambda L, c, star, R: c.retailer_sales.select("SALE_ID", "ITEM_DESC", "sku")),
    "resolve_text": _q(lambda L, c, star, R: c.resolved("fact_helpdesk").select(
        F.col("ticketId").alias("ticket_id"), "sku", F.col("productText").alias("product_text"))),
    "parse_text_date": q_parse_text_date,
    "date_key": _q(lambda L, c, star, R: L.hd_tickets.select(
        "ticketId", "createdAt", parse_iso_timestamp("createdAt").cast("date").alias("created_date"),
        to_key(parse_iso_timestamp("createdAt")).alias("date_key"))),
    "line_amount": _q(lambda L, c, star, R: raw.line_amount(L)),
    "net_marketplace": _q(lambda L, c, star, R: raw.net_marketplace(L)),
    "star_join": _q(lambda L, c, star, R: A.star_join(star)),
    "raw_star_join": _q(lambda L, c, star, R: raw.raw_star_join(L)),
    "raw_inventory_join": _q(lambda L, c, star, R: raw.raw_inventory_join(L)),
    "raw_by_category": _q(lambda L, c, star, R: raw.raw_by_category(L)),
    "raw_by_place": _q(lambda L, c, star, R: raw.raw_by_place(L)),
    "a_class_at_risk_raw": _q(lambda L, c, star, R: twins.a_class_at_risk_raw(L)),
    "sell_through_networks_raw": _q(lambda L, c, star, R: twins.sell_through_networks_raw(L, P.since_key)),
    "risk_parity": _q(lambda L, c, star, R: twins.risk_parity(A.a_class_at_risk(star), L)),
    # ------------------------------------------------------------- answers
    "filter_period": _q(lambda L, c, star, R: A.filter_period(star, R)),
    "filter_dim": _q(lambda L, c, star, R: A.filter_dim(star, R)),
    "revenue_by_channel": _q(lambda L, c, star, R: A.revenue_by_channel(star, R)),
    "revenue_by_source": _q(lambda L, c, star, R: A.revenue_by_source(star, R)),
    "company_sales_total": _q(lambda L, c, star, R: A.company_sales_total(star, R)),
    "net_by_month": _q(lambda L, c, star, R: raw.net_by_month(L)),
    "top_products": _q(lambda L, c, star, R: raw.top_products(L, P.top_n)),
    "sales_on_day": _q(lambda L, c, star, R: A.sales_on_day(star, R, L)),
    "revenue_since_event": _q(lambda L, c, star, R: A.revenue_since_event(star, R)),
    "stockout_rate": _q(lambda L, c, star, R: A.stockout_rate(star, R)),
    "avg_on_hand": _q(lambda L, c, star, R: A.avg_on_hand(star, R)),
    "sell_through_by_network": _q(lambda L, c, star, R: A.sell_through_by_network(star, R)),
    "sell_through_naive": _q(lambda L, c, star, R: raw.sell_through_naive(L, P.since_key)),
    "latest_snapshot": _q(lambda L, c, star, R: A.latest_snapshot(L.erp_inventory)),
    "stockout_risk_sku": _q(lambda L, c, star, R: A.stockout_risk_sku(L.erp_inventory)),
    "a_class_at_risk": _q(lambda L, c, star, R: A.a_class_at_risk(star)),
    "tickets_by_product": _q(lambda L, c, star, R: A.tickets_by_product(star, R)),
    "tickets_exact": _q(lambda L, c, star, R: raw.tickets_exact(L)),
    "tickets_per_1k": _q(lambda L, c, star, R: A.tickets_per_1k(star, R)),
    "parts_attach": _q(lambda L, c, star, R: A.parts_attach(star, R)),
    "parts_attach_raw": _q(lambda L, c, star, R: raw.parts_attach_raw(L, P.parts_category)),
    "after_sale_rate": _q(lambda L, c, star, R: A.after_sale_rate(star, R)),
    "category_benchmark": _q(lambda L, c, star, R: A.category_benchmark(star, R)),
    "overstocked_products": _q(lambda L, c, star, R: A.overstocked_products(star, R)),
    "overstock_by_class": _q(lambda L, c, star, R: A.overstock_by_class(star, R)),
    "drill_across": _q(lambda L, c, star, R: A.drill_across(star, R)),
    "ratio_metrics": _q(lambda L, c, star, R: A.ratio_metrics(star, R)),
    "attributable_share": _q(lambda L, c, star, R: A.attributable_share(star, R)),
    "unmapped_gross": _q(lambda L, c, star, R: raw.unmapped_gross(L)),
    "unmapped_gross_uncleaned": _q(lambda L, c, star, R: raw.unmapped_gross_uncleaned(L)),
    # ------------------------------------------------------------- quality
    "row_count_check": _q(lambda L, c, star, R: StarReport(L).run().row_counts()),
    "coverage_report": _q(lambda L, c, star, R: StarReport(L).run(tables=tuple(t for t in FACTS if t != "fact_inventory")).coverage()),
    "parity_check": _q(lambda L, c, star, R: parity_check(L, star)),
}


def A_resolve_listing(L, c):
    from confluo.operators import crosswalk as xw
    r = xw.resolve(L.mp_orders.select("orderId", "listingId"), c.listing_map, "listingId", "listing_id",
                   unknown=DEFAULT.unmapped_label, row_id="orderId")
    return r.select("orderId", "listingId", "sku")


def A_resolve_item(c):
    w = c.fact_service.select(F.lit("work_order").alias("record_type"),
                              F.col("work_order_id").alias("record_id"), "sku")
    p = c.fact_service_parts.select(F.lit("part_usage").alias("record_type"),
                                    F.col("usage_id").alias("record_id"), "sku")
    return w.unionByName(p)


def parity_check(L: Landed, star) -> DataFrame:
    cfg = DEFAULT
    erp = L.erp_sales_lines.agg(F.sum(F.round(F.col("qty_sold") * F.col("unit_price"), 2)).alias("gross"))
    mp = L.mp_orders.join(L.mp_settlements.select("orderId"), "orderId", "left_semi").agg(
        F.sum("grossAmount").alias("gross"))
    rt = L.rt_sales.agg(F.sum("TOTAL_AMT").alias("gross"))
    raw_totals = (erp.select(F.lit(cfg.source_erp).alias("source"), F.col("gross").cast("decimal(38,2)").alias("gross"))
                  .unionByName(mp.select(F.lit(cfg.source_marketplace).alias("source"),
                                         F.col("gross").cast("decimal(38,2)").alias("gross")))
                  .unionByName(rt.select(F.lit(cfg.source_retailer).alias("source"),
                                         F.col("gross").cast("decimal(38,2)").alias("gross"))))
    star_totals = star["fact_sales"].groupBy("source").agg(
        F.sum("gross_amount").cast("decimal(38,2)").alias("gross"))
    return q.parity(raw_totals, star_totals, "source", "gross")
