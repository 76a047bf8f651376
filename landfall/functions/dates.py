"""Date-dimension parts (P16) and year predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(c: str | Column) -> list[Column]:
    """day, ISO week, month, year and weekday (Monday = 0) of a DATE column."""
    d = F.col(c) if isinstance(c, str) else c
    return [
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.weekday(d).alias("weekday"),
    ]


def year_range(c: str | Column, year: int) -> Column:
    """``year(c) = year`` written as a half-open date range.

    A range on the raw column reaches the Parquet reader as pushed filters
    (row-group min/max pruning); ``year(c) = y`` would not.
    """
    d = F.col(c) if isinstance(c, str) else c
    lo = _dt.date(year, 1, 1)
    hi = _dt.date(year + 1, 1, 1)
    return (d >= F.lit(lo)) & (d < F.lit(hi))
