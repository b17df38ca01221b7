"""Column types inferred from landed text, over all rows.

Every value belongs to one class: whole numbers of 32 or 64 bits, decimals,
other numbers, truth values, ISO dates, ISO timestamps, dates with slashes, or
text. A column's classes are bits of one number, merged by bit-or, and the widths
of its numbers by max, so the whole inference of a table is one aggregate that
combines before any shuffle. The type is the least one above all classes seen
(32-bit whole < 64-bit whole < decimal < double; date < timestamp; else text).

A number must be written the way Spark writes it: codes such as ``007`` or ``+1``
stay text, so that nothing is lost by the type. Slash dates are day-first if all
values allow it (the convention for ambiguous ones), else month-first. Null and
blank values say nothing; a column of nothing else is text.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT, LONG, DECIMAL, DOUBLE, BOOL, DATE, TIMESTAMP, SLASH, TEXT, NOT_DAY_FIRST, NOT_MONTH_FIRST = (1 << k for k in range(11))
DAY_FIRST, MONTH_FIRST, ISO_DATE, ISO_TIME = "dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss"
#: A decimal of more digits than this is a double.
MOST_DIGITS = 38


#: Whole numbers and decimals the way Spark writes them. A cast of other text would fail by an exception, at many times a pattern's cost.
WHOLE, FRACTION = r"\A(0|-?[1-9][0-9]{0,18})\z", r"\A-?(0|[1-9][0-9]*)\.[0-9]+\z"


def _missing(c: Column) -> Column:
    return c.isNull() | _blank(c)


def _blank(c: Column) -> Column:
    return (c == "") | (c.startswith(" ") & (F.trim(c) == ""))


def value_class(c: Column) -> Column:
    """The bits of one value (null for a missing one)."""
    size, minus = F.length(c), c.startswith("-")
    numeric = ((c >= "0") & (c < ":")) | minus
    whole = c.try_cast("bigint")
    integer = F.when(size < 10, INT).when(whole.isNull(), TEXT).when(whole.between(-(1 << 31), (1 << 31) - 1), INT).otherwise(LONG)
    fraction = (size - minus.cast("int") - 1 <= MOST_DIGITS) & c.rlike(FRACTION)
    day, month = F.try_to_date(c, DAY_FIRST), F.try_to_date(c, MONTH_FIRST)
    slash = SLASH + F.when(day.isNull(), NOT_DAY_FIRST).otherwise(0) + F.when(month.isNull(), NOT_MONTH_FIRST).otherwise(0)
    slashed = (size == 10) & (F.substring(c, 3, 1) == "/") & (F.substring(c, 6, 1) == "/")
    return (
        F.when(_missing(c), F.lit(None).cast("int"))
        .when(numeric & (size <= 20) & c.rlike(WHOLE), integer)
        .when(numeric & fraction, DECIMAL)
        .when((size == 10) & numeric & (F.substring(c, 5, 1) == "-") & F.try_to_date(c, ISO_DATE).isNotNull(), DATE)
        .when((size == 19) & numeric & (F.substring(c, 11, 1) == "T") & F.try_to_timestamp(c, F.lit(ISO_TIME)).isNotNull(), TIMESTAMP)
        .when(slashed & (day.isNotNull() | month.isNotNull()), slash)
        .when(numeric & (F.instr(F.upper(c), "E") > 0) & c.try_cast("double").isNotNull(), DOUBLE)
        .when(c.isin("true", "false"), BOOL)
        .otherwise(TEXT)
    )


def _widths(c: Column) -> tuple[Column, Column]:
    """Digits before and after the point of a number."""
    size, sign, dot = F.length(c), c.startswith("-").cast("int"), F.instr(c, ".")
    return F.when(dot > 0, dot - 1).otherwise(size) - sign, F.when(dot > 0, size - dot).otherwise(0)


def _within(seen: Column, *classes: int) -> Column:
    return seen.bitwiseAND(~sum(classes)) == 0


def column_type(seen: Column, before: Column, after: Column) -> Column:
    """The type's name, from the classes seen and the widest numbers."""
    decimal = F.format_string("decimal(%d,%d)", before + after, after)
    return (
        F.when(seen.isNull(), "string")
        .when(_within(seen, INT), "int")
        .when(_within(seen, INT, LONG), "bigint")
        .when(_within(seen, INT, LONG, DECIMAL) & (before + after <= MOST_DIGITS), decimal)
        .when(_within(seen, INT, LONG, DECIMAL, DOUBLE), "double")
        .when(_within(seen, BOOL), "boolean")
        .when(_within(seen, DATE), "date")
        .when(_within(seen, DATE, TIMESTAMP), "timestamp")
        .when(_within(seen, SLASH, NOT_MONTH_FIRST) | _within(seen, SLASH, NOT_DAY_FIRST), "date")
        .otherwise("string")
    )


def column_format(seen: Column) -> Column:
    """How dates are written; null for other types."""
    return (
        F.when(_within(seen, DATE), ISO_DATE)
        .when(_within(seen, DATE, TIMESTAMP), ISO_TIME)
        .when(_within(seen, SLASH, NOT_MONTH_FIRST), DAY_FIRST)
        .when(_within(seen, SLASH, NOT_DAY_FIRST), MONTH_FIRST)
    )


def is_key(name: str) -> bool:
    """Whether a column's name is that of a key or code, in any of the systems' spellings."""
    words = "".join(f"_{c.lower()}" if c.isupper() and not name.isupper() and "_" not in name else c.lower() for c in name).strip("_").split("_")
    return words[-1] in ("key", "id", "sku", "code")


def inferred_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """For each column of the ``tables`` (all text): inferred_type, date_format, default_agg (numbers that aren't keys are
    summed), hidden, rows, non_null and blank. One pass over each table; an empty table's columns are text of 0 rows."""
    spark = next(iter(tables.values())).sparkSession
    # the columns' values as rows of one table, each with its column's number, so that one small expression classifies them all
    names = [(k, t, n, is_key(n)) for k, (t, n) in enumerate((t, n) for t, df in tables.items() for n in df.columns)]
    number_of = {(t, n): k for k, t, n, _ in names}
    values = [df.select(F.explode(F.array(*[F.struct(F.lit(number_of[t, n]).alias("k"), F.col(f"`{n}`").alias("v")) for n in df.columns])).alias("c")) for t, df in tables.items()]
    v, (before, after) = F.col("v"), _widths(F.col("v"))
    rows = reduce(lambda x, y: x.unionByName(y), values).select("c.k", "c.v")
    rows = rows.select("k", "v", value_class(v).alias("seen"))
    number = F.col("seen").bitwiseAND(INT | LONG | DECIMAL) > 0
    found = rows.groupBy("k").agg(
        F.bit_or("seen").alias("seen"), F.max(F.when(number, before)).alias("before"), F.max(F.when(number, after)).alias("after"),
        F.count(F.lit(1)).alias("rows"), F.count("v").alias("non_null"), F.count_if(_blank(v)).alias("blank"))
    names = spark.createDataFrame(names, "column_number int, table_name string, column_name string, hidden boolean")
    all_ = names.join(found, F.col("column_number") == F.col("k"), "left").fillna(0, ["before", "after", "rows", "non_null", "blank"])
    kind = column_type(F.col("seen"), F.col("before"), F.col("after"))
    sums = kind.rlike("^(int|bigint|double|decimal)") & ~F.col("hidden")
    return all_.select(
        "table_name", "column_name", kind.alias("inferred_type"), column_format(F.col("seen")).alias("date_format"),
        F.when(sums, "sum").otherwise("none").alias("default_agg"), "hidden", "rows", "non_null", "blank")
