"""Scalar helpers for which Spark has no single expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_list(value: str | Column, branches: Sequence[tuple[Sequence, object]], default=None):
    """CASE with several values per branch; the first branch holding the value wins."""
    col = F.col(value) if isinstance(value, str) else value
    out = None
    for values, result in branches:
        out = (F if out is None else out).when(col.isin(list(values)), F.lit(result))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def is_digit(value: str | Column) -> Column:
    """True when the text form is one or more ASCII digits."""
    col = F.col(value) if isinstance(value, str) else value
    return col.cast("string").rlike("^[0-9]+$")


def time_of_day(ts: str | Column) -> Column:
    """The time part as HH:mm:ss text."""
    return F.date_format(ts, "HH:mm:ss")
