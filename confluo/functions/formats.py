"""Spreadsheet number patterns as column expressions.

A pattern is digits (``0`` or ``#,##0``, the comma meaning groups of three), decimals after a point (``0`` for kept
ones), and text around them; ``%`` in that text multiplies by 100. Halves are rounded away from zero, in decimal
arithmetic, so what is shown doesn't depend on binary fractions beyond the tenth place.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_PATTERN = re.compile(r"^(?P<before>[^#0]*)(?P<digits>#,##0|0)(?:\.(?P<decimals>0+))?(?P<after>[^#0.]*)$")


@dataclass(frozen=True)
class NumberFormat:
    before: str
    grouped: bool
    decimals: int
    after: str

    @property
    def percent(self) -> bool:
        return "%" in self.before + self.after

    @classmethod
    def parse(cls, pattern: str) -> NumberFormat:
        m = _PATTERN.match(pattern)
        if m is None:
            raise ValueError(f"not a number pattern: {pattern}")
        return cls(m["before"], m["digits"] != "0", len(m["decimals"] or ""), m["after"])

    def column(self, value: Column) -> Column:
        """The value as text; null stays null."""
        exact = value.cast("decimal(38,10)")
        shown = F.round(exact * 100 if self.percent else exact, self.decimals)
        text = F.format_number(F.abs(shown), self.decimals)
        text = text if self.grouped else F.translate(text, ",", "")
        sign = F.when(shown < 0, F.lit("-")).otherwise(F.lit(""))
        return F.concat(sign, F.lit(self.before), text, F.lit(self.after))


def display(value: Column, pattern: str) -> Column:
    return NumberFormat.parse(pattern).column(value)
