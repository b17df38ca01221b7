"""A published star is seen whole or not at all; its layout saves reads and shuffles."""

from __future__ import annotations

import contextlib
import io
import re
import uuid

import pytest
from pyspark.sql import functions as F

from confluo.plans import answers as A
from confluo.plans.governed import governed
from confluo.plans.managed import StarCatalog
from confluo.plans.report import StarReport
from confluo.plans.star import DIMENSIONS, FACTS, Conformer, build_star, latest_months, read_star, write_star
from confluo.sources.binding import Landed
from confluo.streaming import start_append


def explained(df) -> str:
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain("formatted")
    return plan.getvalue()


@pytest.fixture(scope="module")
def landed(spark, sf_small):
    return Landed(spark, sf_small)


@pytest.fixture(scope="module")
def catalog(spark, landed, tmp_path_factory):
    c = StarCatalog(spark, f"star_{uuid.uuid4().hex[:8]}", str(tmp_path_factory.mktemp("db")))
    assert c.current() is None
    with pytest.raises(LookupError):
        c.open()
    c.publish(landed, buckets=4)
    yield c
    c.drop()


def test_a_reader_sees_one_star_while_another_is_written(spark, catalog, landed, sf_small):
    old = catalog.open()
    before = {t: old[t].count() for t in DIMENSIONS + FACTS}
    small = Landed(spark, sf_small, inventory_days=3)
    seen = []

    def save(table, df, *more, whole=catalog._save):
        whole(table, df, *more)
        seen.append((catalog.current(), {t: catalog.open()[t].count() for t in ("fact_inventory", "dim_product")}))

    catalog._save, base = save, catalog.current()
    try:
        version, report = catalog.write(small, parallel=1)
    finally:
        del catalog._save
    assert len(seen) == 9 and all(s == (base, {t: before[t] for t in s[1]}) for s in seen)   # after each of the nine tables
    assert catalog.current() == base and version == base + 1
    catalog.swap(base, version)
    assert catalog.current() == version and catalog.open()["fact_inventory"].count() == report.rows("fact_inventory") < before["fact_inventory"]
    assert {t: old[t].count() for t in before} == before   # who began with the old star ends with it
    with pytest.raises(RuntimeError, match="published meanwhile"):
        catalog.swap(base, version + 1)
    catalog.swap(version, base)


def test_a_star_that_loses_rows_is_not_published(spark, catalog, landed, monkeypatch):
    base = catalog.current()
    whole = Conformer.fact_service.func
    lossy = property(lambda self: whole(self).where("work_order_id NOT LIKE '%1'"))
    monkeypatch.setattr(Conformer, "fact_service", lossy)
    with pytest.raises(ValueError, match="fact_service differ"):
        catalog.publish(landed)
    assert catalog.current() == base
    gone = catalog.vacuum(keep=1)
    assert catalog.versions() == [base] and gone


def test_counts_come_from_the_writes(spark, landed):
    report = StarReport(landed).run()
    got = {r.table_name: (r.rows, r.expected_rows, r.ok) for r in report.row_counts().collect()}
    star = build_star(landed)
    assert got == {t: (n, n, True) for t in DIMENSIONS + FACTS for n in [star[t].count()]}
    assert {r.subject for r in report.coverage().collect()} == {"marketplace_sales", "retailer_sales", "helpdesk_tickets", "work_orders", "parts_usage"}


def test_latest_snapshots_read_only_their_months(spark, catalog, landed):
    star = build_star(landed)
    written = catalog.open()
    assert [r.month_key for r in written.months["fact_inventory"].collect()] == [200001]
    daily = lambda s: s.newest("fact_inventory").where("grain = 'daily'")
    plan = explained(A.latest_snapshot(daily(written)))
    assert re.search(r"PartitionFilters: \[.*month_key#\d+ = 200001", plan), plan
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(A.latest_snapshot(daily(written))) == rows(A.latest_snapshot(landed.erp_inventory))
    assert rows(A.stockout_risk_sku(daily(written))) == rows(A.stockout_risk_sku(landed.erp_inventory))
    assert rows(A.a_class_at_risk(written)) == rows(A.a_class_at_risk(star))
    old = spark.createDataFrame([("a", 199901), ("a", 199903), ("b", 199902), ("c", 199903)], "sku string, month_key int")
    assert {r.month_key for r in latest_months(old, ("sku",)).collect()} == {199902, 199903}


def test_a_star_of_files_knows_its_months_too(spark, landed, tmp_path):
    write_star(build_star(landed), str(tmp_path))
    star = read_star(spark, str(tmp_path))
    assert star.newest("fact_inventory").select("month_key").distinct().collect() == star.months["fact_inventory"].collect()
    with pytest.raises(ValueError, match="overwrites"):
        start_append(None, f"{tmp_path}/fact_sales", f"{tmp_path}/c")


def test_buckets_join_without_a_shuffle_of_the_fact(spark, catalog, landed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = catalog.open()
        joined = A.star_join(star, colocated=True)
        plan = explained(joined)
        assert "SortMergeJoin" in plan and not re.search(r"^\(\d+\) Exchange\b", plan, re.M), plan
        columns = [c for c in A.star_join(build_star(landed)).columns]
        got = joined.select(*columns)
        assert got.exceptAll(A.star_join(build_star(landed))).count() == 0 and got.count() == star["fact_sales"].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_periods_reach_the_landed_scans(spark, landed):
    star, R = build_star(landed), governed()
    for answer in (A.revenue_by_channel, A.company_sales_total, A.filter_period):
        plan = explained(answer(star, R))
        for column in ("l_shipdate", "o_orderdate"):
            assert re.search(rf"PushedFilters: \[[^\n]*GreaterThanOrEqual\({column},199", plan), (answer, column)
            assert re.search(rf"PushedFilters: \[[^\n]*LessThan\({column},199", plan), (answer, column)
    whole = build_star(landed)
    whole.periods = None
    rows = lambda df: sorted(map(str, df.collect()))
    for answer in (A.revenue_by_channel, A.company_sales_total, A.filter_period, A.stockout_rate, A.revenue_since_event):
        assert rows(answer(star, R)) == rows(answer(whole, R))


def test_moved_days_stay_within_the_bound(spark, landed):
    """Tickets are moved back by years; a bound on the moved day loses none, leap days included."""
    for fact in ("fact_helpdesk", "fact_service_parts", "fact_inventory", "fact_sales"):
        star = build_star(landed)
        for lo, hi in ((20000101, 20000105), (20000228, 20000301), (None, 19960229), (20000229, 20000229)):
            own = F.lit(True)
            own = own if lo is None else own & (F.col("date_key") >= lo)
            own = own if hi is None else own & (F.col("date_key") <= hi)
            assert star.between(fact, lo, hi).where(own).exceptAll(star[fact].where(own)).count() == 0
            assert star[fact].where(own).count() == star.between(fact, lo, hi).where(own).count()


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_filters_reach_the_facts(spark, landed, tmp_path):
    """Above the size threshold (lowered here) Spark builds Bloom filters from the filtered side for the fact's scan."""
    write_star(build_star(landed), str(tmp_path))
    star, R = read_star(spark, str(tmp_path)), governed()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    rows = lambda df: sorted(map(str, df.collect()))
    expected = [rows(A.filter_dim(star, R)), rows(A.a_class_at_risk(star))]
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for answer, want in zip((A.filter_dim(star, R), A.a_class_at_risk(star)), expected, strict=True):
            assert "might_contain" in final_plan(answer)
            assert rows(answer) == want
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_the_benchmark_computes_its_members_once(spark, landed, tmp_path):
    write_star(build_star(landed), str(tmp_path))
    plan = final_plan(A.category_benchmark(read_star(spark, str(tmp_path)), governed()))
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("fact_inventory") <= 2, plan
