"""Exact whole-number arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, by: int) -> Column:
    """Floor division in longs; doubles would lose digits of large numbers."""
    value = value.cast("long")
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))
