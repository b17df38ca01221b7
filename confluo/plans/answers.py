"""Parameterised business answers on the governed star.

Each answer is one metric query (or a short DataFrame plan where the
question is a set operation). The twelve business answers say what they cover:
period, sources and basis, beside per-unit ratios the share of references that
name no known product, and beside sell-through whether it is plausible.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.plans.metrics import BELOW, AtLeast, Between, HalfOpen, NotIn, Registry, period_columns, query, small
from confluo.config import DEFAULT
from confluo.plans.star import Star


@dataclass(frozen=True)
class Params:
    """Parameters of the registered answers (one place, no constants in plans)."""
    quarter: tuple[int, int] = (19980101, 19980331)
    month_key: int = 199805
    stockout_month_key: int = 200001
    parts_category: str = "SMALL"
    sales_day_text: str = "03/02/1998"
    since_key: int = 20000101
    min_units: int = DEFAULT.min_units_for_rate
    top_n: int = DEFAULT.top_n
    period_keys: tuple[int, int] = (19980101, 19980630)
    period_dates: tuple[str, str] = ("1998-04-01", "1998-07-01")
    networks: tuple[str, ...] = ("Distribution Center", "Retail Store")
    filter_year: int = 1999
    filter_class: str = "A"


P = Params()


def _unknowns(star: Star) -> tuple:
    return tuple(star.config.unknown_labels)


# ------------------------------------------------------------- revenue
def revenue_by_channel(star: Star, R: Registry, quarter=P.quarter) -> DataFrame:
    return query(star, R, ["revenue_net", "revenue_gross", "units_sold"], by=["channel"],
                 where={"date_key": Between(*quarter)}, order=[("revenue_net", "desc"), ("channel", "asc")], scope=True)


def revenue_by_source(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["revenue_net", "revenue_gross", "units_sold"], by=["source"],
                 order=[("revenue_net", "desc")])


def company_sales_total(star: Star, R: Registry, month_key=P.month_key) -> DataFrame:
    """All sources, net basis, one calendar month of the date dimension."""
    return query(star, R, ["erp_revenue", "marketplace_net_revenue", "retailer_revenue", "revenue_net"],
                 where={"dim_date.month_key": month_key}, scope=True)


def filter_period(star: Star, R: Registry, keys=P.period_keys, dates=P.period_dates) -> DataFrame:
    """Inclusive integer-key range AND a half-open range on real dates."""
    lo, hi = (_dt.date.fromisoformat(d) for d in dates)
    return query(star, R, ["revenue_net", "units_sold"], by=["source"],
                 where=[("date_key", Between(*keys)), ("dim_date.date", HalfOpen(lo, hi))])


def filter_dim(star: Star, R: Registry) -> DataFrame:
    """Filters on three different dimensions' attributes."""
    return query(star, R, ["revenue_net", "units_sold"], by=["channel"],
                 where={"dim_date.year": P.filter_year, "dim_product.abc_class": P.filter_class,
                        "dim_location.location_type": list(P.networks)})


def attributable_share(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["revenue_net", "unattributable_revenue", "attributable_share"], scope=True)


def revenue_since_event(star: Star, R: Registry, since_key=P.since_key) -> DataFrame:
    return query(star, R, ["retailer_revenue"], where={"date_key": AtLeast(since_key)}, scope=True)


def sales_on_day(star: Star, R: Registry, landed, day_text=P.sales_day_text) -> DataFrame:
    """Retailer sales on one day: literal text equality on the landed text
    dates, and the same day through the conformed date key (both must agree)."""
    d = _dt.datetime.strptime(day_text, "%d/%m/%Y").date()
    text = landed.rt_sales.where(F.col("SALE_DATE") == day_text).agg(
        F.sum("TOTAL_AMT").cast("decimal(38,2)")).scalar()
    key = int(d.strftime("%Y%m%d"))
    conformed = star.between("fact_sales", key, key).where(
        (F.col("source") == star.config.source_retailer) & (F.col("date_key") == key)
    ).agg(F.sum("net_amount").cast("decimal(38,2)")).scalar()
    return landed.spark.range(1).select(
        F.lit(day_text).alias("sale_day"), text.alias("amount_text_match"), conformed.alias("amount_conformed"),
        F.lit(star.config.text_date_format).alias("day_read_as"), F.lit(star.config.source_retailer).alias("sources"), F.lit("net").alias("basis"),
    ).withColumns(period_columns(star, key, key))


# ------------------------------------------------------------ inventory
def stockout_rate(star: Star, R: Registry, month_key=P.stockout_month_key) -> DataFrame:
    return query(star, R, ["stockout_rate", "stockout_rows", "snapshot_rows"],
                 where={"dim_date.month_key": month_key}, scope=True)


def avg_on_hand(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["avg_on_hand"], by=["dim_location.location_type"])


def sell_through_by_network(star: Star, R: Registry, since_key=P.since_key,
                            networks=P.networks) -> DataFrame:
    """Each network's units over its own average on-hand (mean over its own
    snapshot dates), marketplace and consignment left out."""
    return query(star, R, ["units_sold", "avg_on_hand", "sell_through"],
                 by=["dim_location.location_type"],
                 where={"date_key": AtLeast(since_key), "dim_location.location_type": list(networks)}, scope=True)


def latest_snapshot(inventory: DataFrame, keys=("sku", "location_id"), order_col="date_key",
                    value_cols=("on_hand_qty", "safety_stock")) -> DataFrame:
    """Newest row per key.  ``max_by`` is an ordinary aggregate: it combines
    map-side, so a key holding a third of all rows never lands whole in one
    task (a row_number window would sort the whole key in one task).  One for each
    value, of numbers: it is aggregated by hash (a struct would be by sort), and as
    all see the same rows in the same order, all take the same one."""
    return inventory.groupBy(*keys).agg(F.max(order_col).alias(order_col), *[F.max_by(c, order_col).alias(c) for c in value_cols])


def stockout_risk_sku(inventory_daily: DataFrame) -> DataFrame:
    """At the globally latest snapshot date: on-hand and safety summed over
    locations per SKU, at risk when on-hand <= safety."""
    last = inventory_daily.agg(F.max("date_key")).scalar()
    return (inventory_daily.where(F.col("date_key") == last)
            .groupBy("sku").agg(F.sum("on_hand_qty").alias("on_hand_qty"),
                                F.sum("safety_stock").alias("safety_stock"))
            .withColumn("at_risk", F.when(F.col("on_hand_qty") <= F.col("safety_stock"), 1).otherwise(0)))


def a_class_at_risk(star: Star) -> DataFrame:
    """A-class products that have open complaints AND are at stockout risk
    (latest daily snapshot of some location at or below safety stock, or latest
    weekly count of some store at or below the near-zero bound); ``as_of`` is the
    newest such snapshot.

    The products in question come first; only their snapshots are aggregated, and
    on a written star only months that hold some place's latest one are read."""
    p = star["dim_product"].where(F.col("abc_class") == "A").select("sku", "product_name")
    oc = (star["fact_helpdesk"].where(F.col("is_complaint") & F.col("is_open"))
          .groupBy("sku").agg(F.count(F.lit(1)).alias("open_complaints")))
    asked = p.join(oc, "sku")
    latest = latest_snapshot(star.newest("fact_inventory").join(asked.select("sku"), "sku", "left_semi"), keys=("sku", "location_id", "grain"))
    at_risk = F.when(F.col("grain") == "daily", F.col("on_hand_qty") <= F.col("safety_stock")).otherwise(
        F.col("on_hand_qty") <= star.config.near_zero_count)
    risk = latest.where(at_risk).groupBy("sku").agg(F.max("date_key").alias("as_of"))
    used = sorted({x for f in ("fact_helpdesk", "fact_inventory") for x in star.config.fact_sources[f]})
    return asked.join(risk, "sku").withColumns(period_columns(star) | {"sources": F.lit(", ".join(used)), "basis": F.lit("quantity")})


# -------------------------------------------------------------- service
def tickets_by_product(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["tickets"], by=["sku"])


def tickets_per_1k(star: Star, R: Registry, min_units=P.min_units) -> DataFrame:
    """Per product, unknown members excluded, only products with enough units."""
    return query(star, R, ["tickets", "units_sold", "tickets_per_1k"], by=["sku"],
                 where={"sku": NotIn(_unknowns(star))},
                 having=(F.col("units_sold") >= min_units) & F.col("tickets").isNotNull(),
                 order=[("tickets_per_1k", "desc"), ("sku", "asc")], scope=True)


def parts_attach(star: Star, R: Registry, category=P.parts_category) -> DataFrame:
    return query(star, R, ["service_parts_used", "units_sold", "parts_per_100"],
                 where={"dim_product.category": category}, scope=True)


def after_sale_rate(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["complaints", "service_parts_used", "units_sold", "after_sale_per_1k"],
                 by=["dim_product.category"], scope=True)


# ---------------------------------------------------------- benchmarks
def category_benchmark(star: Star, R: Registry, below: bool = False, scope: bool = False) -> DataFrame:
    return query(star, R, ["sell_through", "category_avg_sell_through"],
                 by=["dim_product.sku", "dim_product.category"],
                 where={"sku": NotIn(_unknowns(star))}, below=below, scope=scope)


def overstocked_products(star: Star, R: Registry, top_n=P.top_n) -> DataFrame:
    """Products selling through slower than their category; ranked by their own
    ratio (slowest first), not by the gap; benchmark shown beside each."""
    b = category_benchmark(star, R, below=True, scope=True)
    flag = "category_avg_sell_through" + BELOW
    return (b.where(F.col(flag)).drop(flag)
            .orderBy(F.col("sell_through").asc(), F.col("sku").asc()).limit(top_n))


def overstock_by_class(star: Star, R: Registry) -> DataFrame:
    b = query(star, R, ["sell_through", "category_avg_sell_through"],
              by=["dim_product.sku", "dim_product.category", "dim_product.abc_class"],
              where={"sku": NotIn(_unknowns(star))}, below=True)
    below = F.col("category_avg_sell_through" + BELOW)
    return (b.where(F.col("sell_through").isNotNull())
            .groupBy("abc_class").agg(F.count_if(below).alias("below_benchmark"),
                                      F.count(F.lit(1)).alias("products")))


# --------------------------------------------------------- drill-across
def drill_across(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["revenue_net", "tickets", "service_parts_used", "avg_on_hand"],
                 by=["dim_product.category"])


def ratio_metrics(star: Star, R: Registry) -> DataFrame:
    return query(star, R, ["tickets_per_1k", "parts_per_100", "sell_through", "stockout_rate"],
                 by=["dim_product.category"])


def star_join(star: Star, fact: str = "fact_sales", colocated: bool = False) -> DataFrame:
    """Fact rows with the attributes of every related dimension (left joins:
    the row count is unchanged).  Bounded dimensions are broadcast; others are
    joined by merge, so that they never go through the driver.  Rows without a key and the rows of the unknown
    members, which may be a third of all, get a key of their own that matches
    nothing, so they spread over all partitions; the unknown members' attributes
    (two rows) come by broadcast.

    ``colocated`` is for a star published in buckets of the key: the rows of known
    keys are joined bucket by bucket where they lie, without a shuffle, and the
    others, read apart, only take the broadcast rows.  A real key that holds a
    large share of all rows is one bucket then; leave it off for such data."""
    out = star[fact]
    row = F.xxhash64(*[F.col(c) for c in out.columns]).cast("string")
    columns, edges = list(out.columns), []
    for fk, dim, dk in star.edges(fact):
        own = [c for c in star[dim].columns if c not in columns and c != dk]
        edges.append((fk, dim, dk, own))
        columns += own
    for fk, dim, dk, own in sorted(edges, key=lambda e: e[1] in star.bounded):   # what is shuffled goes without bounded attributes
        d = star[dim].select(dk, *own).withColumnRenamed(dk, f"__{dim}_key")
        key = F.col(f"__{dim}_key")
        if dim in star.bounded:
            out = out.join(F.broadcast(d) if small(d) else d, F.col(fk) == key, "left").drop(key)
            continue
        unknown = list(star.unknown)
        hot = F.col(fk).isNull() | F.col(fk).isin(unknown) if unknown else F.col(fk).isNull()
        named = d.where(key.isin(unknown)) if unknown else d.limit(0)
        known = d.where(~key.isin(unknown)) if unknown else d
        attributes = [c for c in d.columns if c != f"__{dim}_key"]
        if colocated:
            near = out.where(~hot).join(known, F.col(fk) == key, "left")
            out = near.unionByName(out.where(hot).join(F.broadcast(named), F.col(fk) == key, "left")).drop(key)
            continue
        # a row's own key is made where it is needed, so that it isn't shuffled with every row
        out = out.join(known.hint("merge"), F.when(hot, F.concat(F.lit("\u0000"), row)).otherwise(F.col(fk)) == key, "left").drop(key)
        if unknown:
            few = F.broadcast(named.select(key, *[F.col(c).alias(f"__u_{c}") for c in attributes]))
            out = out.join(few, F.col(fk) == key, "left").drop(key)
            out = out.withColumns({c: F.coalesce(c, f"__u_{c}") for c in attributes}).drop(*[f"__u_{c}" for c in attributes])
    return out.select(*columns)
