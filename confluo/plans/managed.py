"""A star as managed tables, published as a whole.

Every publication writes its own nine tables, ``<name>_v<number>``, into one database; the database's property
``star.current`` then names the version in one step. A reader takes the property once and reads that version's
tables, so it never sees tables of two stars, or half of one, however long the writer takes. A writer that dies leaves
tables no reader looks at. Two writers: the one that finds another version published since it began fails.

Old versions stay for readers that began with them until ``vacuum``. Rows are counted by the writes (``StarReport``); a
version whose rows differ from what its feeds brought isn't published.

Facts are partitioned by month. With ``buckets`` facts and the product dimension are also bucketed by product, so
that ``star_join(..., colocated=True)`` joins them where they lie.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.config import DEFAULT, StarConfig
from confluo.plans.report import StarReport
from confluo.plans.star import DIMENSIONS, FACTS, SNAPSHOTS, Star, _by_month, latest_months
from confluo.sources.binding import Landed

POINTER = "star.current"


class StarCatalog:
    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        """``location``: where a new database's tables lie; the warehouse if not given."""
        self.spark, self.database = spark, database
        at = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")

    def _name(self, table: str, version: int) -> str:
        return f"`{self.database}`.`{table}_v{version}`"

    def current(self) -> int | None:
        """The published version."""
        rows = self.spark.sql(f"DESCRIBE DATABASE EXTENDED `{self.database}`").collect()
        found = re.search(rf"\({re.escape(POINTER)},\s*(\d+)\)", " ".join(str(r[1]) for r in rows if r[0] == "Properties"))
        return int(found[1]) if found else None

    def versions(self) -> list[int]:
        """All versions that have tables, whole or not."""
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN `{self.database}`").collect()]
        return sorted({int(m[1]) for n in names if (m := re.search(r"_v(\d+)$", n))})

    def _save(self, table: str, df: DataFrame, version: int, buckets: int | None) -> None:
        dated = table.startswith("fact_")
        bucketed = buckets and "sku" in df.columns
        if dated:
            df = _by_month(df)
        if bucketed:
            df = df.repartition(buckets, "sku")   # a task for each bucket
        elif dated:
            df = df.hint("rebalance", "month_key")
        writer = df.write.mode("errorifexists").format("parquet")
        if dated:
            writer = writer.partitionBy("month_key")
        if bucketed:
            writer = writer.bucketBy(buckets, "sku").sortBy("sku")
        writer.saveAsTable(self._name(table, version))
        if table in SNAPSHOTS:
            latest_months(self.spark.table(self._name(table, version)), SNAPSHOTS[table]).write.saveAsTable(self._name(f"{table}__months", version))

    def write(self, landed: Landed, config: StarConfig = DEFAULT, buckets: int | None = None, parallel: int = 4) -> tuple[int, StarReport]:
        """Writes a new version, which nobody sees yet."""
        version = max(self.versions(), default=0) + 1
        report = StarReport(landed, config)
        report.run(lambda table, df: self._save(table, df, version, buckets), parallel=parallel)
        return version, report

    def publish(self, landed: Landed, config: StarConfig = DEFAULT, buckets: int | None = None, parallel: int = 4) -> tuple[int, StarReport]:
        """Writes a new version, checks its counts and makes it the current one."""
        base = self.current()
        version, report = self.write(landed, config, buckets, parallel)
        bad = [t for t in report.tables if report.rows(t) != report.expected(t) and self.spark.table(self._name(t, version)).count() != report.expected(t)]
        if bad:
            raise ValueError(f"version {version} isn't published: {', '.join(bad)} differ from their feeds")
        self.swap(base, version)
        return version, report

    def swap(self, base: int | None, version: int) -> None:
        """Makes ``version`` current if ``base`` still is."""
        if self.current() != base:
            raise RuntimeError(f"version {self.current()} was published meanwhile; {version} began from {base}")
        self.spark.sql(f"ALTER DATABASE `{self.database}` SET DBPROPERTIES ('{POINTER}' = '{version}')")

    def open(self, version: int | None = None, config: StarConfig = DEFAULT) -> Star:
        """The star of a version, the current one if not given."""
        version = self.current() if version is None else version
        if version is None:
            raise LookupError(f"nothing is published in {self.database}")
        tables = {t: self.spark.table(self._name(t, version)) for t in DIMENSIONS + FACTS}
        return Star(tables, config=config, months={t: self.spark.table(self._name(f"{t}__months", version)) for t in SNAPSHOTS})

    def roundtrip(self, version: int, report: StarReport) -> DataFrame:
        """Per table: rows the write counted, and rows read back."""
        star, out = self.open(version), None
        for t in report.tables:
            part = star[t].agg(F.count(F.lit(1)).alias("rows_read")).select(F.lit(t).alias("table_name"), F.lit(report.rows(t)).cast("bigint").alias("rows_written"), "rows_read")
            out = part if out is None else out.unionByName(part)
        return out

    def vacuum(self, keep: int = 2) -> list[int]:
        """Drops all but the current version and the newest ``keep`` - 1 before it; unfinished newer ones too."""
        current = self.current()
        older = [v for v in self.versions() if current is None or v < current]
        stay = {current, *older[len(older) - keep + 1 :]} if keep > 1 else {current}
        gone = [v for v in self.versions() if v not in stay]
        for v in gone:
            for t in [*DIMENSIONS, *FACTS, *(f"{t}__months" for t in SNAPSHOTS)]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(t, v)}")
        return gone

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
