"""Data-quality jobs: row counts, coverage, parity, landed types, catalogs,
answer score cards.  Each returns a report DataFrame; none collects data to
the driver (counts are aggregates computed by Spark)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _one_row_count(df: DataFrame, label: str, col: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(label).alias("table_name"), col)


def row_count_check(actual: Mapping[str, DataFrame], expected: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, rows expected (counted from the sources that feed it), ok."""
    parts = []
    for name, df in actual.items():
        a = _one_row_count(df, name)
        e = expected[name].agg(F.sum("n").cast("bigint")).scalar()   # scalar subquery
        parts.append(a.select("table_name", "rows", e.alias("expected_rows")))
    out = reduce(lambda x, y: x.unionByName(y), parts)
    return out.withColumn("ok", F.col("rows") == F.col("expected_rows"))


def counted(*dfs: DataFrame) -> DataFrame:
    """A one-column ``n`` frame with the row counts of ``dfs`` (for expectations)."""
    return reduce(lambda x, y: x.unionByName(y), [d.agg(F.count(F.lit(1)).alias("n")) for d in dfs])


def coverage(df: DataFrame, subject: str, unknown: F.Column) -> DataFrame:
    """Rows not tied to a real member, of all rows."""
    return df.agg(F.count_if(unknown).alias("unknown_rows"), F.count(F.lit(1)).alias("total_rows")) \
        .select(F.lit(subject).alias("subject"), "unknown_rows", "total_rows",
                F.try_divide(F.col("unknown_rows").cast("double"), F.col("total_rows").cast("double"))
                .alias("unknown_share"))


def parity(raw_totals: DataFrame, star_totals: DataFrame, key: str, value: str) -> DataFrame:
    """Raw vs star totals per key; difference must be zero."""
    r = raw_totals.select(F.col(key), F.col(value).alias("raw_total"))
    s = star_totals.select(F.col(key), F.col(value).alias("star_total"))
    j = r.join(s, key, "full")
    return j.withColumn("difference", F.coalesce("star_total", F.lit(0)) - F.coalesce("raw_total", F.lit(0))) \
            .withColumn("ok", F.col("difference") == 0)


def landed_schema_check(tables: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, T.DataType]],
                        text_dates: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Per expected column of the landed files (all text): the declared type, the
    rows, how many values don't parse as it (day-first text dates: as a date), and
    whether the column is there and all of them do."""
    text_dates = text_dates or {}
    parts = []
    for tname, cols in expected.items():
        df, (dated, fmt) = tables[tname], text_dates.get(tname, (None, None))

        def unparsed(c, t, dated=dated, fmt=fmt):
            value = F.try_to_date(F.col(c), fmt) if c == dated else F.col(c).try_cast(t)
            return F.count_if(F.col(c).isNotNull() & value.isNull())

        present = [c for c in cols if c in df.columns]
        stats = df.agg(F.count(F.lit(1)).alias("__rows"), *[unparsed(c, cols[c]).alias(f"__bad_{c}") for c in present])   # one pass
        items = [F.struct(
            F.lit(tname).alias("table_name"), F.lit(c).alias("column_name"), F.lit(t.simpleString()).alias("expected_type"),
            F.col("__rows").alias("rows"), (F.col(f"__bad_{c}") if c in present else F.col("__rows")).alias("unparsed_rows"),
            (F.lit(c in present) & ((F.col(f"__bad_{c}") if c in present else F.lit(0)) == 0)).alias("ok")) for c, t in cols.items()]
        parts.append(stats.select(F.explode(F.array(*items)).alias("r")).select("r.*"))
    return reduce(lambda x, y: x.unionByName(y), parts)


def require_landed(check: DataFrame) -> DataFrame:
    """The check's rows; a row that isn't ok fails the job that reads them."""
    said = F.concat(F.lit("landed column doesn't fit its type: "), "table_name", F.lit("."), "column_name")
    return check.withColumn("ok", F.when(F.col("ok"), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))


KEY_ENDS = ("_key", "_id", "sku", "code")
# what the conformed columns mean, in our own words
DESCRIPTIONS = {
    "date_key": "Day of the row as yyyymmdd.", "sku": "Product of the row; a label where none was found.",
    "location_id": "Place of the row.", "channel": "Way the sale came about.", "source": "System the row came from.",
    "qty": "Units of the row.", "gross_amount": "Price paid.", "net_amount": "Price paid less marketplace fees.",
    "on_hand_qty": "Units counted.", "safety_stock": "Units that should never be undercut.", "is_stockout": "1 if none were left.",
    "grain": "Whether a count is daily or weekly.", "product_name": "Name of the product.", "category": "Group of products or of tickets.",
    "abc_class": "Importance of the product.", "list_price": "Price on the list.", "supplier_name": "Who delivers it.",
    "is_retailer_only": "True for products that only the stores carry.", "location_type": "Kind of place.",
    "is_complaint": "True for tickets of the complaint category.", "is_open": "True while nobody has closed the ticket.",
    "labor_hours": "Hours worked.", "qty_used": "Parts fitted.", "month_key": "Month as yyyymm."}


def default_agg(name: str, dtype: T.DataType) -> str:
    """Numeric measures sum; key-like and calendar columns do not aggregate."""
    if name.endswith(KEY_ENDS) or name in ("year", "quarter", "month", "day", "fiscal_year"):
        return "none"
    if isinstance(dtype, (T.IntegralType, T.FractionalType, T.DecimalType)):
        return "sum"
    return "none"


def column_catalog(tables: Mapping[str, DataFrame], descriptions: Mapping[str, str] | None = None) -> DataFrame:
    """Per table column: type, default aggregation, description and a profile
    (rows, non-null values) computed in one pass per table; keys are hidden
    from report builders."""
    descriptions = DESCRIPTIONS if descriptions is None else descriptions
    parts = []
    for tname, df in tables.items():
        stats = df.agg(F.count(F.lit(1)).alias("__rows"),   # one pass over the table
                       *[F.count(F.col(f"`{f.name}`")).alias(f"__nn{i}") for i, f in enumerate(df.schema.fields)])
        items = [F.struct(
            F.lit(tname).alias("table_name"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(default_agg(f.name, f.dataType)).alias("default_agg"),
            F.lit(descriptions.get(f.name)).cast("string").alias("description"),
            F.lit(f.name.endswith("_key")).alias("hidden"),
            F.col("__rows").alias("rows"), F.col(f"__nn{i}").alias("non_null"))
            for i, f in enumerate(df.schema.fields)]
        parts.append(stats.select(F.explode(F.array(*items)).alias("r")).select("r.*"))
    return reduce(lambda x, y: x.unionByName(y), parts)


def answer_scorecard(scores: DataFrame, max_per_question: int = 2) -> DataFrame:
    """Score sheet (question, agent, score in {2,1,0,-1}) -> per agent: total,
    maximum, % of maximum, count per score, questions answered (score > 0)."""
    s = F.col("score")
    return (scores.groupBy("agent").agg(
        F.sum(s).cast("bigint").alias("total"),
        (F.count(F.lit(1)) * max_per_question).cast("bigint").alias("max_total"),
        F.count_if(s == 2).alias("n_correct"), F.count_if(s == 1).alias("n_partial"),
        F.count_if(s == 0).alias("n_unanswered"), F.count_if(s == -1).alias("n_wrong"),
        F.count_if(s > 0).alias("answered"))
        .withColumn("pct_of_max", F.try_divide(F.col("total").cast("double") * 100.0,
                                               F.col("max_total").cast("double"))))
