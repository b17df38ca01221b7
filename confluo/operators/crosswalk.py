"""Crosswalk cleaning and key resolution.

A crosswalk holds one row per canonical key with one column per foreign code
and a free-text status.  Resolution is always a *left* join of a fact onto a
code -> key mapping followed by an explicit unknown member, so no fact row
is ever dropped or guessed.

Scale notes: mappings are joined by merge.  Their size grows with the product
catalogue, and the planner's estimates are those of compressed files, before
any generator: it would broadcast millions of rows through the driver, of the
mapping or of the fact.  A hot code on the fact side is handled by AQE's
skew-join split; rows whose key can never match (null or
blank) get a per-row non-matching key so they do not pile into one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.functions.text import lacks_all, normalise, not_blank

_NO_MATCH = "\u0001"   # prefix no real code starts with


def clean(xref: DataFrame, status_col: str, drop_words: Iterable[str]) -> DataFrame:
    """Drop crosswalk rows whose status text mentions any of ``drop_words``."""
    return xref.where(lacks_all(status_col, tuple(drop_words)))


def mapping(xref_clean: DataFrame, code_col: str, key_col: str = "sku",
            code_alias: str | None = None) -> DataFrame:
    """(code, key) pairs for one foreign code column; blank codes are not mappings."""
    return (xref_clean.where(not_blank(code_col))
            .select(F.col(code_col).alias(code_alias or code_col), F.col(key_col)))


def code_rollup(xref_clean: DataFrame, key_col: str, code_cols: list[str]) -> DataFrame:
    """One row per key with the max of each code column (stops fan-out when a
    key has several crosswalk rows)."""
    return xref_clean.groupBy(key_col).agg(*[F.max(c).alias(c) for c in code_cols])


def _spread(key: Column, row_id: Column | None) -> Column:
    """Null/blank keys never match; give them a unique non-matching key."""
    if row_id is None:
        return key
    return F.when(not_blank(key), key).otherwise(
        F.concat(F.lit(_NO_MATCH), row_id.cast("string")))


def _winner(mapping_df: DataFrame, code: str = "__code") -> DataFrame:
    """One key for each code: the smallest."""
    return mapping_df.where(F.col(code).isNotNull()).groupBy(code).agg(F.min("__key").alias("__key"))


def duplicate_codes(mapping_df: DataFrame, code: str, key: str = "sku") -> DataFrame:
    """Codes that map to several keys: the code, how many keys, and the one that wins."""
    return (mapping_df.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("code"))
            .agg(F.countDistinct(key).alias("keys"), F.min(key).alias("winner")).where(F.col("keys") > 1))


def mapping_check(maps: dict[str, DataFrame], key: str = "sku") -> DataFrame:
    """One row for each code map (named for its code column): pairs, codes, and codes with several keys."""
    out = None
    for code, m in maps.items():
        per = m.where(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("k"))
        row = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("pairs"), F.count(F.lit(1)).alias("codes"),
                      F.count_if(F.col("k") > 1).alias("duplicated")).select(F.lit(code).alias("map"), "pairs", "codes", "duplicated")
        out = row if out is None else out.unionByName(row)
    return out


def resolve(fact: DataFrame, mapping_df: DataFrame, fact_code: str, map_code: str,
            key_col: str = "sku", out_col: str = "sku", unknown: str | None = None,
            row_id: str | None = None) -> DataFrame:
    """Left-join ``fact`` to a (code -> key) mapping; unmatched rows get ``unknown``
    (or keep null when ``unknown`` is None).  A code mapped twice goes to its
    smallest key, so no fact row is ever doubled; ``duplicate_codes`` reports it."""
    m = _winner(mapping_df.select(F.col(map_code).alias("__code"), F.col(key_col).alias("__key")))
    joined = fact.join(
        m.hint("merge"), _spread(F.col(fact_code), F.col(row_id) if row_id else None) == F.col("__code"), "left")
    key = F.col("__key") if unknown is None else F.coalesce(F.col("__key"), F.lit(unknown))
    out = joined.withColumn(out_col, key) if out_col not in fact.columns else \
        joined.drop(out_col).withColumn(out_col, key)
    return out.drop("__code", "__key")


def resolve_text(fact: DataFrame, ref_col: str, names: DataFrame, name_col: str,
                 key_col: str = "sku", out_col: str = "sku", unknown: str | None = None,
                 row_id: str | None = None) -> DataFrame:
    """Free-text resolution: upper(trim(ref)) = upper(trim(name)); blank refs never
    match; unmatched rows get ``unknown``; a name of several keys goes to the smallest."""
    m = _winner(names.select(normalise(name_col).alias("__norm"), F.col(key_col).alias("__key")), "__norm")
    ref = normalise(ref_col)
    joined = fact.join(m.hint("merge"), _spread(ref, F.col(row_id) if row_id else None) == F.col("__norm"), "left")
    key = F.col("__key") if unknown is None else F.coalesce(F.col("__key"), F.lit(unknown))
    return joined.withColumn(out_col, key).drop("__norm", "__key")


def fallback_key(code_col: str, prefix: str, digits_from: int) -> Column:
    """Synthesised local key: prefix + the code's characters from ``digits_from`` on."""
    return F.concat(F.lit(prefix), F.expr(f"substring(`{code_col}`, {int(digits_from)})"))


def with_fallback(local: DataFrame, local_map: DataFrame, code_col: str, map_code: str,
                  prefix: str, digits_from: int, out_col: str = "c_sku") -> DataFrame:
    """Local code -> canonical key, else the synthesised fallback key (never null)."""
    r = resolve(local, local_map, code_col, map_code, out_col="__sku")
    return (r.withColumn(out_col, F.coalesce(F.col("__sku"), fallback_key(code_col, prefix, digits_from)))
            .drop("__sku"))


def unmapped(local: DataFrame, local_map: DataFrame, code_col: str, map_code: str) -> DataFrame:
    """Local rows whose code has no mapping (anti join)."""
    m = local_map.select(F.col(map_code).alias("__code"))
    return local.join(m.hint("merge"), F.col(code_col) == F.col("__code"), "left_anti")
