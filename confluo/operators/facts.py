"""Fact unification: several source-shaped frames into one conformed schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class SourceMap:
    """How one source maps onto the conformed fact: ``columns`` is target name
    -> Column expression over ``df`` (literals for provenance columns)."""
    df: DataFrame
    columns: dict[str, Column]
    where: Column | None = None
    tags: dict[str, str] = field(default_factory=dict)


def unify(sources: Sequence[SourceMap], schema: T.StructType) -> DataFrame:
    """Project every source to ``schema`` (cast, typed nulls for gaps) and union all."""
    out = None
    for s in sources:
        df = s.df.where(s.where) if s.where is not None else s.df
        cols = []
        for f in schema.fields:
            if f.name in s.columns:
                cols.append(s.columns[f.name].cast(f.dataType).alias(f.name))
            elif f.name in s.tags:
                cols.append(F.lit(s.tags[f.name]).cast(f.dataType).alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out
