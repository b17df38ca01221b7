"""Row counts and coverage of a star, taken by its writes themselves.

Spark's ``observe`` attaches aggregates to a plan; they are computed while the rows stream to the sink, so no table is read
a second time to be counted. Each feed is observed where its rows enter the star (for feeds that keep only some landed rows,
after that rule) and each table where it is written: rows that a lookup or union loses or doubles in between show as
a difference. A stage that is run again after a lost executor may be counted twice by Spark; a difference is therefore a
reason to count the table, not proof.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from confluo.plans.star import DIMENSIONS, FACTS, Conformer, in_parallel
from confluo.sources.binding import Landed

#: The feeds of each table; further rows are the config's literal members.
FEEDS_OF = {
    "dim_product": ("products", "retailer_only_products"),
    "dim_location": ("locations", "stores"),
    "fact_sales": ("erp_sales", "marketplace_sales", "retailer_sales"),
    "fact_inventory": ("daily_inventory", "weekly_inventory"),
    "fact_service": ("fact_service",),
    "fact_service_parts": ("fact_service_parts",),
    "fact_helpdesk": ("fact_helpdesk",),
}


def to_nowhere(name: str, df: DataFrame) -> None:
    """Computes a table whole and keeps nothing."""
    df.write.format("noop").mode("overwrite").save()


class StarReport:
    def __init__(self, landed: Landed, config=None):
        self.spark = landed.spark
        self.feeds: dict[str, Observation] = {}
        self.tables: dict[str, Observation] = {}
        self.conformer = Conformer(landed, *([config] if config else []), watch=self._feed)
        self.cfg = self.conformer.cfg

    def _feed(self, name: str) -> Observation:
        self.feeds[name] = Observation(f"feed-{name}-{uuid.uuid4().hex[:8]}")
        return self.feeds[name]

    def subjects(self, table: str) -> dict[str, tuple[Column, Column]]:
        """(which rows, which of them name no known product) of the coverage subjects in a table."""
        cfg, sku, every = self.cfg, F.col("sku"), F.lit(True)
        if table == "fact_sales":
            return {"marketplace_sales": (F.col("source") == cfg.source_marketplace, sku == cfg.unmapped_label),
                    "retailer_sales": (F.col("source") == cfg.source_retailer, sku.isNull())}
        lost = sku == cfg.unresolved_label
        name = {"fact_helpdesk": "helpdesk_tickets", "fact_service": "work_orders", "fact_service_parts": "parts_usage"}.get(table)
        return {name: (every, lost)} if name else {}

    def observed(self, table: str, df: DataFrame) -> DataFrame:
        self.tables[table] = Observation(f"table-{table}-{uuid.uuid4().hex[:8]}")
        what = [F.count(F.lit(1)).alias("rows")]
        if table == "dim_date":
            what.append((F.datediff(F.max("date"), F.min("date")) + 1).cast("bigint").alias("days"))
        for name, (own, lost) in self.subjects(table).items():
            what += [F.count_if(own).alias(f"{name}_total"), F.count_if(own & lost).alias(f"{name}_unknown")]
        return df.observe(self.tables[table], *what)

    def run(self, sink: Callable[[str, DataFrame], None] = to_nowhere, tables: tuple[str, ...] = DIMENSIONS + FACTS, parallel: int = 4) -> StarReport:
        """Writes the tables, each once."""
        frames = {n: self.observed(n, getattr(self.conformer, n)) for n in tables}
        in_parallel({n: lambda n=n, df=df: sink(n, df) for n, df in frames.items()}, parallel)
        return self

    def rows(self, table: str) -> int:
        return self.tables[table].get["rows"]

    def expected(self, table: str) -> int:
        if table == "dim_date":
            return self.tables[table].get["days"] or 0
        literal = {"dim_product": len(self.cfg.unknown_labels), "dim_location": 1, "dim_channel": len(self.cfg.channels)}
        return sum(self.feeds[f].get["rows"] for f in FEEDS_OF.get(table, ())) + literal.get(table, 0)

    def row_counts(self) -> DataFrame:
        """Per table: rows written, rows its feeds brought, and whether they agree."""
        rows = [(t, self.rows(t), self.expected(t)) for t in self.tables]
        out = self.spark.createDataFrame(rows, "table_name string, rows bigint, expected_rows bigint")
        return out.withColumn("ok", F.col("rows") == F.col("expected_rows"))

    def coverage(self) -> DataFrame:
        """Per subject: rows without a known product, all rows, and their share."""
        rows = [(name, self.tables[t].get[f"{name}_unknown"], self.tables[t].get[f"{name}_total"]) for t in self.tables for name in self.subjects(t)]
        out = self.spark.createDataFrame(rows, "subject string, unknown_rows bigint, total_rows bigint")
        return out.withColumn("unknown_share", F.try_divide(F.col("unknown_rows").cast("double"), F.col("total_rows").cast("double")))
