"""The governed metric registry: the named measures over the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from confluo.config import DEFAULT, StarConfig
from confluo.functions.formats import display
from confluo.plans.metrics import (Count, Formula, PeerAverage, Registry, SemiAdditive, Sum,
                                   blank_add, ratio, safe_ratio)

# metric name -> (display format, description); formats follow the usual
# spreadsheet patterns: '#,##0' integer money/units, '0.0%' share, '0.00' ratio
FORMATS = {
    "revenue_gross": ("#,##0", "What buyers paid, before any fee is taken off."),
    "revenue_net": ("#,##0", "What reaches us: gross amounts, and for the marketplace its payouts."),
    "units_sold": ("#,##0", "Quantity over all sales rows."),
    "erp_revenue": ("#,##0", "Part of revenue_net booked through the ERP."),
    "marketplace_net_revenue": ("#,##0", "Part of revenue_net paid out by the marketplace."),
    "marketplace_gross_revenue": ("#,##0", "Order value on the marketplace, commission and fulfilment included."),
    "retailer_revenue": ("#,##0", "Part of revenue_net from the store network."),
    "stockout_rows": ("#,##0", "How many daily counts found an empty shelf."),
    "snapshot_rows": ("#,##0", "How many daily counts there are."),
    "stockout_rate": ("0.0%", "stockout_rows over snapshot_rows."),
    "avg_on_hand": ("#,##0", "Stock added up over places for each day, then averaged over the days that have counts."),
    "sell_through": ("0.00", "units_sold over avg_on_hand."),
    "tickets": ("#,##0", "Number of helpdesk contacts."),
    "open_complaints": ("#,##0", "Complaints that nobody has closed."),
    "tickets_per_1k": ("0.0", "tickets over units_sold, times 1,000."),
    "service_parts_used": ("#,##0", "Quantity of parts that field service fitted."),
    "parts_per_100": ("0.0", "service_parts_used over units_sold, times 100."),
    "unattributable_revenue": ("#,##0", "Part of revenue_net on the unknown members."),
    "attributable_share": ("0.0%", "One minus unattributable_revenue over revenue_net."),
    "complaints": ("#,##0", "Contacts filed under the complaint category."),
    "after_sale_per_1k": ("0.0", "complaints and service_parts_used together over units_sold, times 1,000."),
    "category_avg_sell_through": ("0.00", "Plain average of sell_through over a category's products, whatever product filters are set."),
}


def governed(cfg: StarConfig = DEFAULT) -> Registry:
    S, I, H, P = "fact_sales", "fact_inventory", "fact_helpdesk", "fact_service_parts"
    daily = {"grain": "daily"}
    return Registry([
        Sum("revenue_gross", S, "gross_amount"),
        Sum("revenue_net", S, "net_amount"),
        Sum("units_sold", S, "qty"),
        Sum("erp_revenue", S, "net_amount", {"source": cfg.source_erp}),
        Sum("marketplace_net_revenue", S, "net_amount", {"source": cfg.source_marketplace}),
        Sum("marketplace_gross_revenue", S, "gross_amount", {"source": cfg.source_marketplace}),
        Sum("retailer_revenue", S, "net_amount", {"source": cfg.source_retailer}),
        Sum("stockout_rows", I, "is_stockout", daily),
        Count("snapshot_rows", I, daily),
        ratio("stockout_rate", "stockout_rows", "snapshot_rows"),
        SemiAdditive("avg_on_hand", I, "on_hand_qty", over="date_key"),
        ratio("sell_through", "units_sold", "avg_on_hand", plausible=cfg.plausible_sell_through),
        Count("tickets", H),
        Count("open_complaints", H, {"is_complaint": True, "is_open": True}),
        ratio("tickets_per_1k", "tickets", "units_sold", 1000, references=("tickets",)),
        Sum("service_parts_used", P, "qty_used"),
        ratio("parts_per_100", "service_parts_used", "units_sold", 100, references=("service_parts_used",)),
        Sum("unattributable_revenue", S, "net_amount", {"dim_product.sku": list(cfg.unknown_labels)}),
        Formula("attributable_share", ("revenue_net", "unattributable_revenue"),
                lambda n, u: safe_ratio(n - F.coalesce(u, F.lit(0)), n)),
        Count("complaints", H, {"is_complaint": True}),
        Formula("after_sale_per_1k", ("complaints", "service_parts_used", "units_sold"),
                lambda c, p, u: safe_ratio(blank_add(c, p), u, 1000), references=("complaints", "service_parts_used")),
        PeerAverage("category_avg_sell_through", "sell_through", member="dim_product.sku",
                    peer="dim_product.category", exclude=tuple(cfg.unknown_labels)),
    ])


def metric_catalog(spark, registry: Registry):
    """One row per governed metric: kind, definition, display format, description.
    (Metadata only; a small literal relation built from the registry.)"""
    from confluo.plans.metrics import Count as _C, Formula as _F, PeerAverage as _P, SemiAdditive as _S, Sum as _Su
    rows = []
    for name, m in registry.metrics.items():
        if isinstance(m, _Su):
            kind, d = "sum", f"sum({m.fact}.{m.column})" + (f" where {dict(m.where)}" if m.where else "")
        elif isinstance(m, _C):
            kind, d = "count", f"count({m.fact})" + (f" where {dict(m.where)}" if m.where else "")
        elif isinstance(m, _S):
            kind, d = "semi_additive", f"avg over {m.over} of sum({m.fact}.{m.column})"
        elif isinstance(m, _P):
            kind, d = "peer_average", f"avg of {m.base} per {m.member} within {m.peer}, excluding {list(m.exclude)}"
        elif isinstance(m, _F):
            kind, d = "formula", f"f({', '.join(m.deps)})"
        else:
            kind, d = type(m).__name__, ""
        fmt, desc = FORMATS.get(name, (None, None))
        rows.append((name, kind, d, fmt, desc))
    return spark.createDataFrame(rows, "metric string, kind string, definition string, format string, description string")


def metric_card(star, registry: Registry):
    """Every governed metric evaluated over the whole star in ONE drill-across
    query, unpivoted to (metric, kind, format, description, value, display)."""
    from confluo.plans.metrics import query
    names = [n for n, m in registry.metrics.items()]
    wide = query(star, registry, names)
    shown = lambda n: display(F.col(n), FORMATS[n][0]) if n in FORMATS else F.col(n).cast("string")
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"), shown(n).alias("display")) for n in names])).alias("m"))
    cat = metric_catalog(star["fact_sales"].sparkSession, registry).select("metric", "kind", "format", "description")
    return long.select("m.metric", "m.value", "m.display").join(F.broadcast(cat), "metric")
