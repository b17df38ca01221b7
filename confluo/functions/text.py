"""Text predicates and normalisation used by code and free-text resolution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(c: Column | str) -> Column:
    """upper(trim(coalesce(x, ''))): the join key for free-text references."""
    return F.upper(F.trim(F.coalesce(_c(c), F.lit(""))))


def not_blank(c: Column | str) -> Column:
    """Code present: not null and not the empty string."""
    x = _c(c)
    return x.isNotNull() & (x != "")


def is_blank(c: Column | str) -> Column:
    return ~not_blank(c)


def lacks_all(c: Column | str, words) -> Column:
    """Null-safe 'text contains none of words' (null text contains nothing)."""
    x = F.coalesce(_c(c), F.lit(""))
    return reduce(lambda a, b: a & b, [~x.contains(w) for w in words], F.lit(True))


def initcap_words(c: Column | str) -> Column:
    """First letter of each space-separated word upper, the rest lower."""
    return F.initcap(_c(c))
