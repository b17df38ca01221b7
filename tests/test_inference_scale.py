"""Inference at size: no text is cast that a pattern can tell from numbers, and columns are grouped by number."""

from pyspark.sql import functions as F

from confluo.operators.inference import DECIMAL, INT, LONG, TEXT, inferred_columns, value_class


def test_numbers_are_told_by_a_pattern_before_any_cast(spark):
    """A failing cast costs an exception; only text of digits is cast, in a plan that groups by numbers, not names."""
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = inferred_columns({"t": df})._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan
    found = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert found and all("Aggregate [k#" in line for line in found)


def test_classes_of_odd_numbers(spark):
    odd = {"0": INT, "-1": INT, "007": TEXT, "-0": TEXT, "+1": TEXT, "2147483647": INT, "2147483648": LONG, "-2147483649": LONG,
           "9223372036854775807": LONG, "9223372036854775808": TEXT, "1\n": TEXT, "0.50": DECIMAL, ".5": TEXT, "1.": TEXT, "01.5": TEXT,
           "--1.5": TEXT, "9" * 37 + ".1": DECIMAL, "9" * 38 + ".1": TEXT, "٣": TEXT, "": None, "  ": None}
    df = spark.createDataFrame([(x,) for x in odd], "v string")
    assert {r["v"]: r["c"] for r in df.select("v", value_class(F.col("v")).alias("c")).collect()} == odd


def test_columns_of_the_same_name_stay_apart(spark):
    one, two = spark.createDataFrame([("1", " "), ("-22", None)], "a string, b string"), spark.createDataFrame([("x",)], "a string")
    rows = {(r["table_name"], r["column_name"]): (r["inferred_type"], r["rows"], r["non_null"], r["blank"]) for r in inferred_columns({"one": one, "two": two}).collect()}
    assert rows == {("one", "a"): ("int", 2, 2, 0), ("one", "b"): ("string", 2, 1, 1), ("two", "a"): ("string", 1, 1, 0)}
