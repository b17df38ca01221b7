"""Shapes that hold at any size: snapshots dealt to tasks, nothing unbounded through the driver, aggregates by hash."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from confluo.operators import crosswalk as xw
from confluo.operators.dimensions import literal_rows
from confluo.plans import answers as A
from confluo.plans.governed import governed
from confluo.plans.metrics import small
from confluo.plans.star import Conformer
from confluo.sources import binding
from confluo.sources.binding import Landed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def parts(spark, tmp_path):
    rows = [(k, f"name {k}", "Brand#1", "SMALL", k % 40, 900.0) for k in range(60)]
    rows += [rows[5], (None, "nameless", "Brand#1", "SMALL", None, 1.0)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double") \
        .coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    return rows, str(tmp_path)


def test_snapshots_are_dealt_to_tasks(spark, parts, monkeypatch):
    monkeypatch.setattr(binding, "PARTS_PER_TASK", 10)
    for table in ("erp_inventory", "rt_stock_counts"):
        df = getattr(Landed(spark, parts[1]), table)
        assert df.select(F.spark_partition_id()).distinct().count() > 3


def test_snapshots_hold_every_product_place_and_day(spark, parts):
    rows, d = parts
    L = Landed(spark, d, "1999-12-30", 8)
    got = sorted(map(tuple, L.erp_inventory.collect()), key=str)
    day = [dt.date(1999, 12, 30) + dt.timedelta(n) for n in range(8)]
    want = []
    for k, *_, size, _ in rows:
        for loc in range(15):
            for n, x in enumerate(day, 1):
                held = None if k is None else (k * 7 + loc * 13 + n * 5) % 97
                want.append((int(f"{x:%Y%m%d}"), None if k is None else f"SKU-{k:06d}", f"LOC-{loc:02d}", held,
                             None if size is None else size % 20, 1 if held == 0 else 0))
    assert got == sorted(want, key=str)
    weekly = {(r.COUNT_DATE, r.STORE_CODE) for r in L.rt_stock_counts.collect()}
    assert weekly == {(x, f"STR-{s}") for x in ("30/12/1999", "06/01/2000") for s in range(15, 25)}
    assert L.between(20000101, 20000102).erp_inventory.count() == len(rows) * 15 * 2
    assert L.between(20010101, None).erp_inventory.count() == 0


def test_literal_rows_have_a_known_size(spark):
    df = literal_rows(spark, [("a", 1), ("b", None)], "x string, n bigint")
    assert small(df) and df.dtypes == [("x", "string"), ("n", "bigint")]
    assert sorted(map(tuple, df.collect())) == [("a", 1), ("b", None)]
    assert literal_rows(spark, [], "x string").count() == 0


def test_inventory_is_never_broadcast_for_its_places(spark, sf_small):
    star = Conformer(Landed(spark, sf_small)).star()
    assert small(star["dim_location"]) and small(star["dim_channel"])
    for df in (A.sell_through_by_network(star, governed()), A.avg_on_hand(star, governed())):
        assert "BuildLeft" not in plan(df)


def test_code_maps_are_joined_by_merge(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "code string, id bigint")
    codes = spark.createDataFrame([("a", "S1")], "c string, sku string")
    for df in (xw.resolve(fact, codes, "code", "c"), xw.resolve_text(fact, "code", codes, "c"), xw.unmapped(fact, codes, "code", "c")):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)


def test_latest_snapshot_aggregates_by_hash_and_takes_one_row(spark):
    rows = [("A", "L1", 1, 9, 9), ("A", "L1", 3, 5, 50), ("A", "L1", 3, 6, 60), ("A", "L1", None, 7, 70), ("B", "L1", None, 1, 1), ("C", "L1", 2, None, 4)]
    df = A.latest_snapshot(spark.createDataFrame(rows, "sku string, location_id string, date_key int, on_hand_qty bigint, safety_stock bigint").repartition(3))
    assert "SortAggregate" not in plan(df) and "HashAggregate" in plan(df)
    got = {r.sku: tuple(r)[2:] for r in df.collect()}
    assert got["A"] in {(3, 5, 50), (3, 6, 60)} and got["B"] == (None, None, None) and got["C"] == (2, None, 4)


def test_star_join_shuffles_no_more_than_the_fact(spark, sf_small):
    """A row's own key and the bounded dimensions' attributes were shuffled with every fact row."""
    from confluo.plans import answers, legacy
    from confluo.plans.star import build_star
    from confluo.sources.binding import Landed

    landed = Landed(spark, sf_small)
    for star, fact in ((legacy.raw_star(landed), "erp_inventory"), (build_star(landed), "fact_sales")):
        joined = answers.star_join(star, fact)
        own, node = set(star[fact].columns), joined._jdf.queryExecution().optimizedPlan()
        merges = []

        def walk(node):
            if node.nodeName() == "Join" and "strategy=merge" in node.toString().split("\n")[0]:
                merges.append(node)
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        walk(node)
        assert merges
        left = [merges[0].children().apply(0).output().apply(i).name() for i in range(merges[0].children().apply(0).output().size())]
        assert set(left) <= own, left
        names = list(star[fact].columns)
        for _, dim, dk in star.edges(fact):
            names += [c for c in star[dim].columns if c not in names and c != dk]
        assert joined.columns == names
        assert joined.count() == star[fact].count()
