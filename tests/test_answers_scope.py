"""What answers say about themselves: period, sources, basis, unresolved share, plausibility; types and formats."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from confluo.functions.formats import NumberFormat, display
from confluo.operators.inference import inferred_columns, is_key
from confluo.plans import answers as A
from confluo.plans.governed import governed
from confluo.plans.metrics import AtLeast, Between, HalfOpen, MetricQuery, NotIn, _Ref, days, plausible, within
from confluo.plans.star import build_star
from confluo.sources.binding import Landed


@pytest.fixture(scope="module")
def star(spark, sf_small):
    return build_star(Landed(spark, sf_small))


def test_days_of_filters():
    day, month, year, date = _Ref("fact", "date_key"), _Ref("dim", "month_key", "dim_date"), _Ref("dim", "year", "dim_date"), _Ref("dim", "date", "dim_date")
    assert days(day, Between(19980101, 19980331)) == (19980101, 19980331)
    assert days(day, HalfOpen(19980101, 19980301)) == (19980101, 19980228)
    assert days(day, AtLeast(20000101)) == (20000101, None) and days(day, 20000229) == (20000229, 20000229)
    assert days(day, [20000105, 20000101]) == (20000101, 20000105)
    assert days(month, 200002) == (20000201, 20000229) and days(month, Between(199811, 199902)) == (19981101, 19990228)
    assert days(month, HalfOpen(199811, 199902)) == (19981101, 19990131)
    assert days(year, 1999) == (19990101, 19991231) and days(date, HalfOpen(dt.date(1998, 4, 1), dt.date(1998, 7, 1))) == (19980401, 19980630)
    for ref, spec in ((day, NotIn((1,))), (day, None), (_Ref("fact", "sku"), "A"), (_Ref("dim", "day", "dim_date"), 3)):
        assert days(ref, spec) == (None, None)
    assert within([(None, 5), (2, None), (3, 9)]) == (3, 5) and within([]) == (None, None)


def covers(star, metrics, where=None):
    row = MetricQuery(star, governed(), metrics, where=where, scope=True).run().first().asDict()
    return {k: v for k, v in row.items() if k not in metrics}


def test_scope_follows_measures_and_filters(star):
    window = star["dim_date"].agg(F.min("date_key"), F.max("date_key")).first()
    assert covers(star, ["revenue_net"]) == {"period_from": window[0], "period_to": window[1], "sources": "ERP, MARKETPLACE, RETAILER", "basis": "net"}
    assert covers(star, ["erp_revenue", "marketplace_gross_revenue"])["sources"] == "ERP, MARKETPLACE"
    assert covers(star, ["erp_revenue", "marketplace_gross_revenue"])["basis"] == "gross, net"
    assert covers(star, ["revenue_net"], {"source": ["ERP", "RETAILER"]})["sources"] == "ERP, RETAILER"
    assert covers(star, ["stockout_rate"])["sources"] == "ERP" and covers(star, ["avg_on_hand"], {"grain": "weekly"})["sources"] == "RETAILER"
    assert covers(star, ["tickets"])["sources"] == "HELPDESK" and covers(star, ["tickets"])["basis"] == "quantity"
    shops = covers(star, ["units_sold", "tickets"], {"dim_location.location_type": "Retail Store"})
    assert shops["sources"] == "HELPDESK, RETAILER"
    both = covers(star, ["revenue_net"], [("date_key", AtLeast(19980110)), ("dim_date.month_key", 199801)])
    assert (both["period_from"], both["period_to"]) == (19980110, 19980131)


def test_unresolved_share_is_that_of_the_references(star):
    where = [("date_key", Between(19970101, 20001231))]
    got = covers(star, ["tickets_per_1k"], where)["unresolved_share"]
    own = star["fact_helpdesk"].where(F.col("date_key").between(19970101, 20001231))
    assert got == pytest.approx(own.where("sku = 'UNRESOLVED'").count() / own.count())
    both = covers(star, ["after_sale_per_1k"])["unresolved_share"]
    rows = [star[f].agg(F.count_if(F.col("sku") == "UNRESOLVED"), F.count(F.lit(1))).first() for f in ("fact_helpdesk", "fact_service_parts")]
    assert both == pytest.approx(sum(r[0] for r in rows) / sum(r[1] for r in rows))
    assert "unresolved_share" not in covers(star, ["sell_through"])


def test_guard(spark, star):
    df = spark.createDataFrame([(0.0,), (0.04,), (0.05,), (9.9,), (10.0,), (300.0,), (None,)], "x double")
    assert [r[0] for r in df.select(plausible(F.col("x"), 0.05, 10.0)).collect()] == ["near zero", "near zero", "ok", "ok", "too large", "too large", None]
    assert covers(star, ["sell_through"])["sell_through_check"] == "ok"


def test_every_business_answer_says_what_it_covers(spark, sf_small, star):
    R, landed = governed(), Landed(spark, sf_small)
    answers = [A.revenue_by_channel(star, R), A.stockout_rate(star, R), A.company_sales_total(star, R), A.tickets_per_1k(star, R), A.parts_attach(star, R), A.a_class_at_risk(star),
               A.sell_through_by_network(star, R), A.sales_on_day(star, R, landed), A.revenue_since_event(star, R), A.attributable_share(star, R), A.after_sale_rate(star, R), A.overstocked_products(star, R)]
    for a in answers:
        assert {"period_from", "period_to", "sources", "basis"} <= set(a.columns)
    for k in (3, 4, 10):
        assert "unresolved_share" in answers[k].columns
    for k in (6, 11):
        assert "sell_through_check" in answers[k].columns


def test_types_are_the_least_that_hold_all_values(spark):
    columns = {
        "whole": (["1", "-5", None, "0"], ("int", None)), "wide": (["1", "3000000000"], ("bigint", None)), "huge": (["1", "99999999999999999999"], ("string", None)),
        "money": (["1.50", "-22.5", "7"], ("decimal(4,2)", None)), "science": (["1.5", "2E10"], ("double", None)), "code": (["007", "12"], ("string", None)),
        "plus": (["+1", "2"], ("string", None)), "padded": ([" 1", "2"], ("string", None)), "flag": (["true", "false"], ("boolean", None)), "flags": (["true", "1"], ("string", None)),
        "iso": (["2020-01-31", "2021-12-01"], ("date", "yyyy-MM-dd")), "bad": (["2020-02-31", "2021-12-01"], ("string", None)),
        "time": (["2020-01-31T10:00:00", "2020-01-31"], ("timestamp", "yyyy-MM-dd'T'HH:mm:ss")), "dayfirst": (["03/02/2020", "31/01/2020"], ("date", "dd/MM/yyyy")),
        "monthfirst": (["03/02/2020", "01/31/2020"], ("date", "MM/dd/yyyy")), "either": (["03/02/2020", "01/02/2020"], ("date", "dd/MM/yyyy")),
        "neither": (["13/01/2020", "01/13/2020"], ("string", None)), "none": ([None, ""], ("string", None)), "blank": (["", " ", "4"], ("int", None)), "mixed": (["4", "2020-01-31"], ("string", None)),
    }
    height = max(len(v) for v, _ in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v, _ in columns.values()) for i in range(height)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = {r.column_name: r for r in inferred_columns({"t": df, "empty": df.where("false")}).where("table_name = 't'").collect()}
    assert {c: (r.inferred_type, r.date_format) for c, r in got.items()} == {c: want for c, (_, want) in columns.items()}
    assert (got["blank"].rows, got["blank"].non_null, got["blank"].blank) == (height, 3, 2)
    assert {c for c, r in got.items() if r.default_agg == "sum"} == {"whole", "wide", "money", "science", "blank"}
    empty = inferred_columns({"t": df.where("false")}).collect()
    assert len(empty) == len(columns) and all((r.inferred_type, r.rows) == ("string", 0) for r in empty)
    assert [is_key(n) for n in ("date_key", "categoryId", "STORE_CODE", "sku", "sellerSku", "ItemCode", "paid", "barcode", "QTY", "valid")] == [True] * 6 + [False] * 4


def test_number_patterns(spark):
    cases = [("#,##0", "1234567.5", "1,234,568"), ("#,##0", "-1234.4", "-1,234"), ("0.0%", "0.0125", "1.3%"), ("0.0%", "0.9999", "100.0%"), ("0.00", "1234.565", "1234.57"),
             ("0.0", "2.25", "2.3"), ("#,##0.00", "1234.5", "1,234.50"), ("$#,##0", "-5", "-$5"), ("0.00x", "1.7", "1.70x"), ("0", "0.5", "1"), ("0.0", "-0.04", "0.0")]
    for pattern, value, want in cases:
        df = spark.createDataFrame([(Decimal(value),), (None,)], "v decimal(20,6)")
        assert [r[0] for r in df.select(display(F.col("v"), pattern)).collect()] == [want, None], (pattern, value)
        got = spark.createDataFrame([(float(value),)], "v double").select(display(F.col("v"), pattern)).first()[0]
        assert got == want, (pattern, value)
    with pytest.raises(ValueError, match="not a number pattern"):
        NumberFormat.parse("#.#.#")
