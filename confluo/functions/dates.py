"""Date helpers: all JVM-side built-ins, safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_text_date(c: Column | str, fmt: str = "dd/MM/yyyy") -> Column:
    """Day-first (or any pattern) text to DATE; bad text gives null, never an error."""
    return F.try_to_date(_c(c), fmt)


def parse_iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text ('yyyy-MM-ddTHH:mm:ss' or a bare date) to TIMESTAMP, null if bad."""
    return F.try_to_timestamp(_c(c))


def date_key(c: Column | str) -> Column:
    """DATE / TIMESTAMP / ISO text to an integer yyyyMMdd key."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def text_date_key(c: Column | str, fmt: str = "dd/MM/yyyy") -> Column:
    return date_key(parse_text_date(c, fmt))


def iso_date_key(c: Column | str) -> Column:
    return date_key(parse_iso_timestamp(c))


def key_to_date(c: Column | str) -> Column:
    """yyyyMMdd integer key back to DATE."""
    return F.try_to_date(_c(c).cast("string"), "yyyyMMdd")
