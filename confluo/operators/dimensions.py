"""Dimension builders: calendar, union dimensions with unknown members."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_DIM_COLUMNS = ("date_key", "date", "year", "quarter", "month", "month_name", "month_key",
                    "day", "day_of_week", "is_weekend", "fiscal_year", "fiscal_quarter",
                    "is_post_event")


def _as_date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x.isoformat()[:10]).cast("date")
    return F.lit(str(x)).cast("date")


def date_dim(spark: SparkSession, start, end, event_date) -> DataFrame:
    """One row per day in [start, end] with calendar attributes.

    ``start``/``end`` may be literals or scalar-subquery Columns (e.g. the min
    and max date of the facts).  The row count is bounded by the calendar
    window, so the dimension is safe to broadcast.
    """
    d = F.col("date")
    days = spark.range(1).select(
        F.explode(F.sequence(_as_date(start), _as_date(end), F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyyMM").cast("int").alias("month_key"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.year(d).alias("fiscal_year"),
        F.concat(F.lit("FY"), F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
         .alias("fiscal_quarter"),
        (d >= _as_date(event_date)).alias("is_post_event"),
    )


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Inline literal relation (unknown members, channel list, pseudo locations), of a
    size the optimizer knows: rows from Python count as endless, and the other side
    of a join with them, a fact say, is broadcast instead."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    items = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, r, strict=True)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*items))) if items else spark.createDataFrame([], T.StructType(fields))


def unknown_members(spark: SparkSession, members: Sequence[tuple[str, str]], category: str,
                    like: T.StructType) -> DataFrame:
    """Explicit unknown rows shaped like ``like``: key, name, category, rest null/default."""
    base = literal_rows(spark, members, "sku string, product_name string")
    cols = []
    for f in like.fields:
        if f.name in ("sku", "product_name"):
            cols.append(F.col(f.name))
        elif f.name in ("category", "subcategory", "brand"):
            cols.append(F.lit(category).alias(f.name))
        elif f.name == "abc_class":
            cols.append(F.lit("C").alias(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            cols.append(F.lit(False).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return base.select(*cols)


def union_dim(parts: Sequence[DataFrame]) -> DataFrame:
    """Union-all by column name; missing columns become typed nulls."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
