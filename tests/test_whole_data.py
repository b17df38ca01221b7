"""The bindings leave no row out; duplicates, rewrites and period filters behave."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from confluo.operators import crosswalk as xw
from confluo.plans import answers as A
from confluo.plans.governed import governed
from confluo.plans.metrics import BELOW, Between, PeerAverage, Registry, Sum, query
from confluo.plans.star import Star, build_star, read_star, write_star
from confluo.sources.binding import Landed


def test_every_source_row_is_bound(spark, sf_small):
    landed = Landed(spark, sf_small)
    count = lambda name: landed.raw(name).count()
    assert landed.erp_sales_lines.count() + landed.rt_sales.count() == count("lineitem")
    assert landed.mp_orders.count() == count("orders")
    assert landed.erp_inventory.select("sku").distinct().count() == count("part")
    assert landed.products.select("supplier_key").distinct().count() == count("supplier")
    assert landed.hd_tickets.count() == count("events")
    assert Landed(spark, sf_small, inventory_days=3).erp_inventory.count() == count("part") * 15 * 3


def test_a_code_mapped_twice_doubles_nothing(spark):
    fact = spark.createDataFrame([(1, "L1", 10), (2, "L2", 20)], "id int, code string, money int")
    m = spark.createDataFrame([("L1", "S2"), ("L1", "S1"), ("L2", "S3")], "code string, sku string")
    out = xw.resolve(fact, m, "code", "code", unknown="UNMAPPED", row_id="id").orderBy("id").collect()
    assert [(r.id, r.sku, r.money) for r in out] == [(1, "S1", 10), (2, "S3", 20)]
    assert [tuple(r) for r in xw.duplicate_codes(m, "code").collect()] == [("L1", 2, "S1")]
    check = xw.mapping_check({"code": m}).first()
    assert (check.pairs, check.codes, check.duplicated) == (3, 2, 1)
    names = spark.createDataFrame([("Bolt", "S2"), ("bolt ", "S1")], "name string, sku string")
    ticket = spark.createDataFrame([(1, "BOLT")], "id int, ref string")
    assert [r.sku for r in xw.resolve_text(ticket, "ref", names, "name", row_id="id").collect()] == ["S1"]


def test_rewrite_is_complete_and_periods_prune(spark, sf_small, tmp_path):
    star = build_star(Landed(spark, sf_small))
    small = Star({"fact_sales": star["fact_sales"].where("date_key < 19960101"), "dim_date": star["dim_date"]})
    write_star(Star({"fact_sales": star["fact_sales"], "dim_date": star["dim_date"]}), str(tmp_path))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_star(small, str(tmp_path))   # whoever's session runs it
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    back = Star({n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("fact_sales", "dim_date")})
    assert back["fact_sales"].count() == small["fact_sales"].count()
    registry = governed()
    for where in ({"date_key": Between(19950301, 19950531)}, {"dim_date.month_key": 199504}, {"dim_date.year": 1995}):
        df = query(back, registry, ["revenue_net", "units_sold"], by=["channel"], where=where)
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            df.explain("formatted")
        assert "PartitionFilters: [isnotnull(month_key" in plan.getvalue(), where
        whole = query(small, registry, ["revenue_net", "units_sold"], by=["channel"], where=where)
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, whole.collect()))


def test_period_answers_on_the_written_star_match(spark, sf_small, tmp_path):
    star, registry = build_star(Landed(spark, sf_small)), governed()
    write_star(star, str(tmp_path))
    written = read_star(spark, str(tmp_path))
    for answer in (A.revenue_by_channel, A.company_sales_total, A.filter_period, A.stockout_rate):
        assert sorted(map(str, answer(written, registry).collect())) == sorted(map(str, answer(star, registry).collect()))
    assert A.star_join(star).count() == star["fact_sales"].count()
    unknown = A.star_join(star).where(F.col("sku") == "UNMAPPED").select("product_name").distinct().collect()
    assert len(unknown) == 1 and unknown[0].product_name


def test_benchmark_is_exact_and_ignores_product_filters(spark):
    fact = spark.createDataFrame([("a", 2.0 / 3), ("b", 0.1), ("c", 0.1), ("d", 0.1), ("e", 0.3), ("f", 0.5)], "sku string, v double")
    dim = spark.createDataFrame([("a", "one", "A"), *[(x, "same", "A") for x in "bcd"], ("e", "two", "A"), ("f", "two", "B")], "sku string, category string, abc_class string")
    star = Star({"f": fact, "dim_product": dim}, relationships=(("f", "sku", "dim_product", "sku"),), bounded=frozenset())
    registry = Registry([Sum("v", "f", "v"), PeerAverage("avg_v", "v", member="dim_product.sku", peer="dim_product.category")])
    by = ["dim_product.sku", "dim_product.category"]
    rows = {r.sku: r for r in query(star, registry, ["v", "avg_v"], by=by, below=True).collect()}
    assert {k for k, r in rows.items() if r["avg_v" + BELOW]} == {"e"}     # neither alone nor among equals
    want = {"e": rows["e"].avg_v}
    for where in ({"abc_class": "A"}, {"dim_product.abc_class": "A"}):
        got = {r.sku: r.avg_v for r in query(star, registry, ["v", "avg_v"], by=by, where=where).collect()}
        assert got["e"] == want["e"], where
    split = query(star, registry, ["v", "avg_v"], by=["sku", "category", "abc_class"]).collect()
    assert {r.sku: r.avg_v for r in split}["e"] == want["e"]


def test_a_bad_landed_file_fails_the_job(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T

    from confluo.operators import quality as q
    from confluo.sources.landing import read_landed, write_csv

    rows = [("1", "03/02/1998", ""), ("x", "31/02/1998", None)]
    path = write_csv(spark.createDataFrame(rows, "QTY string, DAY string, NOTE string"), str(tmp_path / "t"))
    back = read_landed(spark, path)
    assert {r.QTY: r.NOTE for r in back.collect()} == {"1": "", "x": None}     # blank and null stay apart
    check = q.landed_schema_check({"t": back}, {"t": {"QTY": T.LongType(), "DAY": T.StringType(), "GONE": T.StringType()}}, {"t": ("DAY", "dd/MM/yyyy")})
    got = {r.column_name: (r.rows, r.unparsed_rows, r.ok) for r in check.collect()}
    assert got == {"QTY": (2, 1, False), "DAY": (2, 1, False), "GONE": (2, 2, False)}
    with pytest.raises(Exception, match="doesn't fit its type"):
        q.require_landed(check).collect()
