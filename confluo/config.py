"""Business parameters of a star build.

Nothing in the operators hard-codes a date, a status word or a label: they
all come from a :class:`StarConfig`, so the same code conforms any set of
landed systems.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class StarConfig:
    # ---- fixed values: they carry the reference behaviour ------------------
    # crosswalk rows whose status text contains any of these words are dropped
    # before any mapping is derived ("primary listing wins" for duplicates)
    drop_status_words: tuple[str, ...] = ("retired", "CONFLICT")
    # explicit unknown members of the product dimension
    unmapped_label: str = "UNMAPPED"
    unresolved_label: str = "UNRESOLVED"
    # helpdesk category id that means "product complaint", and the open status
    complaint_category_id: int = 1
    open_status: str = "open"
    # text-date formats of the landed systems (day first)
    text_date_format: str = "dd/MM/yyyy"
    # ---- our own naming for the bound systems --------------------------------
    source_erp: str = "ERP"
    source_marketplace: str = "MARKETPLACE"
    source_retailer: str = "RETAILER"
    channel_marketplace: str = "Marketplace"
    channel_retailer: str = "Acquired Store"
    marketplace_location_id: str = "LOC-MP"
    retailer_only_prefix: str = "RTX-"
    # 1-based position where the numeric part of a retailer code starts
    retailer_code_digits_from: int = 5
    # products that only the retailer carries, and its stores
    only_category: str = "House Label"
    only_subcategory: str = "Local Range"
    only_brand: str = "House"
    only_class: str = "C"
    only_supplier: str = "Direct to Store"
    store_type: str = "Retail Store"
    store_country: str = "Store Network"
    # ---- business parameters ------------------------------------------------
    event_date: _dt.date = _dt.date(2000, 1, 1)
    # inclusive date window of the date dimension; None = derive from the facts
    window_start: _dt.date | None = None
    window_end: _dt.date | None = None
    min_units_for_rate: int = 1000
    near_zero_count: int = 0
    top_n: int = 5
    channels: tuple[str, ...] = ("Online", "Retail", "Wholesale", "Marketplace", "Acquired Store")
    unknown_category: str = "Unknown"
    # what an answer names as its sources and basis: the systems behind each fact,
    # behind each inventory grain, those that a place belongs to, and money columns
    fact_sources: dict = field(default_factory=lambda: {
        "fact_sales": ("ERP", "MARKETPLACE", "RETAILER"), "fact_inventory": ("ERP", "RETAILER"),
        "fact_service": ("FIELD SERVICE",), "fact_service_parts": ("FIELD SERVICE",), "fact_helpdesk": ("HELPDESK",)})
    grain_sources: dict = field(default_factory=lambda: {"daily": "ERP", "weekly": "RETAILER"})
    place_sources: tuple[str, ...] = ("ERP", "MARKETPLACE", "RETAILER")
    bases: dict = field(default_factory=lambda: {"net_amount": "net", "gross_amount": "gross"})
    # units over average on-hand outside of this range point to a wrong denominator
    plausible_sell_through: tuple[float, float] = (0.05, 10.0)
    marketplace_location: dict = field(default_factory=lambda: {
        "location_id": "LOC-MP", "location_name": "Online Marketplace",
        "region": "Online", "location_type": "Marketplace", "country": "Global",
        "source": "MARKETPLACE"})

    @property
    def unknown_labels(self) -> tuple[str, str]:
        return (self.unmapped_label, self.unresolved_label)


DEFAULT = StarConfig()
