"""One small inline-frame test per planted trap and per metric semantic."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from confluo.functions.dates import date_key, parse_text_date
from confluo.operators import crosswalk as xw
from confluo.operators.quality import answer_scorecard
from confluo.plans.answers import latest_snapshot
from confluo.plans.metrics import (Count, NotIn, PeerAverage, Registry, SemiAdditive, Sum,
                                   query, ratio)
from confluo.plans.star import Star


def test_day_first_text_date_and_bad_text(spark):
    df = spark.createDataFrame([("03/02/2026",), ("31/02/2026",), ("junk",)], "d string")
    out = df.select(parse_text_date("d").alias("x"), date_key(parse_text_date("d")).alias("k")).collect()
    assert out[0].x == dt.date(2026, 2, 3) and out[0].k == 20260203
    assert out[1].x is None and out[2].x is None      # no ANSI error, just null


def test_crosswalk_clean_drops_status_words_keeps_null_notes(spark):
    x = spark.createDataFrame([("S1", "retired SKU"), ("S2", "CONFLICT dup"), ("S3", None), ("S4", "ok")],
                              "sku string, notes string")
    kept = {r.sku for r in xw.clean(x, "notes", ("retired", "CONFLICT")).collect()}
    assert kept == {"S3", "S4"}


def test_blank_codes_are_not_mappings(spark):
    x = spark.createDataFrame([("S1", ""), ("S2", None), ("S3", "C3")], "sku string, code string")
    assert [tuple(r) for r in xw.mapping(x, "code").collect()] == [("C3", "S3")]


def test_resolve_unknown_member_and_no_row_loss(spark):
    fact = spark.createDataFrame([(1, "L1"), (2, "L9"), (3, ""), (4, None)], "id int, code string")
    m = spark.createDataFrame([("L1", "S1")], "code string, sku string")
    out = {r.id: r.sku for r in xw.resolve(fact, m, "code", "code", unknown="UNMAPPED",
                                           row_id="id").collect()}
    assert out == {1: "S1", 2: "UNMAPPED", 3: "UNMAPPED", 4: "UNMAPPED"}


def test_free_text_resolution_normalises_but_never_guesses(spark):
    tickets = spark.createDataFrame([(1, "  RED BOLT 7 "), (2, "red bolt7"), (3, ""), (4, None)],
                                    "id int, ref string")
    names = spark.createDataFrame([("red bolt 7", "S7")], "name string, sku string")
    out = {r.id: r.sku for r in xw.resolve_text(tickets, "ref", names, "name", unknown="UNRESOLVED",
                                                row_id="id").collect()}
    assert out == {1: "S7", 2: "UNRESOLVED", 3: "UNRESOLVED", 4: "UNRESOLVED"}


def test_fallback_key_for_local_only_codes(spark):
    local = spark.createDataFrame([("RTL-000002",), ("RTL-000066",)], "c string")
    m = spark.createDataFrame([("RTL-000002", "SKU-000002")], "c string, sku string")
    out = {r.c: r.c_sku for r in xw.with_fallback(local, m, "c", "c", "RTX-", 5).collect()}
    assert out == {"RTL-000002": "SKU-000002", "RTL-000066": "RTX-000066"}
    only = [r.c for r in xw.unmapped(local, m, "c", "c").collect()]
    assert only == ["RTL-000066"]


# ------------------------------------------------------------ tiny star
@pytest.fixture(scope="module")
def tiny(spark):
    sales = spark.createDataFrame([
        ("ERP", 20000101, "A", "L1", 10, Decimal("100.00"), Decimal("100.00")),
        ("ERP", 20000102, "B", "L1", 5, Decimal("50.00"), Decimal("50.00")),
        ("MP", 20000101, "UNMAPPED", "LM", 1, Decimal("20.00"), Decimal("17.20")),
        ("RT", 20000103, None, "L2", 4, Decimal("40.00"), Decimal("40.00")),
    ], "source string, date_key int, sku string, location_id string, qty bigint, "
       "gross_amount decimal(18,2), net_amount decimal(18,2)")
    inv = spark.createDataFrame([
        (20000101, "A", "L1", 10, "daily"), (20000101, "A", "L2", 30, "daily"),
        (20000102, "A", "L1", 20, "daily"),
        (20000101, "B", "L1", 5, "daily"), (20000108, "B", "L2", 7, "weekly"),
    ], "date_key int, sku string, location_id string, on_hand_qty bigint, grain string")
    tickets = spark.createDataFrame([("t1", 20000101, "A"), ("t2", 20000101, "A"), ("t3", 20000101, "UNRESOLVED")],
                                    "ticket_id string, date_key int, sku string")
    prod = spark.createDataFrame([("A", "cat1"), ("B", "cat1"), ("C", "cat2"), ("UNMAPPED", "Unknown"),
                                  ("UNRESOLVED", "Unknown")], "sku string, category string")
    dates = spark.createDataFrame([(20000101, 200001), (20000102, 200001), (20000103, 200001),
                                   (20000108, 200001)], "date_key int, month_key int")
    loc = spark.createDataFrame([("L1", "DC"), ("L2", "Store"), ("LM", "Online")],
                                "location_id string, location_type string")
    rel = (("fs", "date_key", "dd", "date_key"), ("fs", "sku", "dp", "sku"), ("fs", "location_id", "dl", "location_id"),
           ("fi", "date_key", "dd", "date_key"), ("fi", "sku", "dp", "sku"), ("fi", "location_id", "dl", "location_id"),
           ("fh", "date_key", "dd", "date_key"), ("fh", "sku", "dp", "sku"))
    star = Star({"fs": sales, "fi": inv, "fh": tickets, "dp": prod, "dd": dates, "dl": loc},
                relationships=rel, bounded=frozenset({"dd", "dl"}))
    R = Registry([
        Sum("net", "fs", "net_amount"), Sum("units", "fs", "qty"),
        Sum("erp_net", "fs", "net_amount", {"source": "ERP"}),
        SemiAdditive("avg_oh", "fi", "on_hand_qty"),
        Count("tickets", "fh"),
        ratio("sell_through", "units", "avg_oh"),
        ratio("per_1k", "tickets", "units", 1000),
        PeerAverage("bench", "sell_through", member="dp.sku", peer="dp.category", dim="dp",
                    exclude=("UNMAPPED", "UNRESOLVED")),
    ])
    return star, R


def test_filter_on_same_column_is_replaced(tiny):
    star, R = tiny
    r = query(star, R, ["net", "erp_net"], where={"source": "MP"}).collect()[0]
    assert r.net == Decimal("17.20") and r.erp_net == Decimal("150.00")


def test_semi_additive_mean_over_dates_with_data(tiny):
    star, R = tiny
    rows = {r.sku: r.avg_oh for r in query(star, R, ["avg_oh"], by=["sku"]).collect()}
    assert rows["A"] == pytest.approx(30.0)       # (10+30 on day 1, 20 on day 2) / 2 dates
    assert rows["B"] == pytest.approx(6.0)        # daily 5 and weekly 7 on their own dates


def test_drill_across_merges_facts_and_null_group(tiny):
    star, R = tiny
    rows = {r.sku: (r.units, r.tickets) for r in query(star, R, ["units", "tickets"], by=["sku"]).collect()}
    assert rows["A"] == (10, 2) and rows["UNRESOLVED"] == (None, 1) and rows[None] == (4, None)


def test_ratio_division_by_missing_is_null(tiny):
    star, R = tiny
    rows = {r.sku: r.per_1k for r in query(star, R, ["per_1k", "tickets"], by=["sku"]).collect()}
    assert rows["A"] == pytest.approx(200.0) and rows["UNRESOLVED"] is None


def test_peer_average_ignores_outer_product_filter(tiny):
    star, R = tiny
    out = query(star, R, ["sell_through", "bench"], by=["dp.sku", "dp.category"],
                where={"dp.sku": ["A"]}).collect()
    assert len(out) == 1
    # A: 10 / 30 ; B: 5 / 6 -> benchmark is the mean of both, though B is filtered out
    assert out[0].bench == pytest.approx(round((10 / 30 + 5 / 6) / 2, 9))


def test_dimension_filter_restricts_facts(tiny):
    star, R = tiny
    r = query(star, R, ["units"], where={"dl.location_type": "DC"}).collect()[0]
    assert r.units == 15


def test_unknown_members_excluded_with_sql_null_semantics(tiny):
    star, R = tiny
    skus = {r.sku for r in query(star, R, ["units"], by=["sku"], where={"sku": NotIn(("UNMAPPED",))}).collect()}
    assert skus == {"A", "B"}


def test_latest_snapshot_with_hot_key(spark):
    rows = [("A", "L1", d, d * 2, 1) for d in range(1, 3001)] + [("B", "L1", 5, 0, 1)]
    inv = spark.createDataFrame(rows, "sku string, location_id string, date_key int, on_hand_qty int, safety_stock int")
    out = {r.sku: (r.date_key, r.on_hand_qty) for r in latest_snapshot(inv).collect()}
    assert out == {"A": (3000, 6000), "B": (5, 0)}


def test_answer_scorecard(spark):
    s = spark.createDataFrame([("q1", "raw", 2), ("q2", "raw", -1), ("q3", "raw", 0),
                               ("q1", "star", 2), ("q2", "star", 2), ("q3", "star", 1)],
                              "question string, agent string, score int")
    out = {r.agent: r for r in answer_scorecard(s).collect()}
    assert out["raw"].total == 1 and out["raw"].answered == 1 and out["raw"].n_wrong == 1
    assert out["star"].total == 5 and out["star"].max_total == 6
    assert out["star"].pct_of_max == pytest.approx(500 / 6)
