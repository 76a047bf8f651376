"""Source period labels.

A monthly extract is named ``i94_<mon><yy>_sub.<ext>``; the period is the
second ``_``-separated part of the file stem, e.g. ``apr16``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: a month's three letters and two digits of the year.
PERIOD_LABEL = "^(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[0-9]{2}$"


def period_of(year: str | Column, month: str | Column) -> Column:
    """Period label from year and month numbers: (2016, 4) -> ``apr16``."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    y, m = y.try_cast("int"), m.try_cast("int")
    # a month or year that is none gives no period; make_date itself would raise
    first = F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))
    return F.concat(F.lower(F.date_format(first, "MMM")), F.lpad((y % 100).cast("string"), 2, "0"))


def in_periods(column: str | Column, periods: list) -> Column:
    """Whether a row belongs to one of ``periods``; None among them stands for rows without a period."""
    c = F.col(column) if isinstance(column, str) else column
    known = c.isin([p for p in periods if p is not None])
    return (known | c.isNull()) if None in periods else known


def period_from_file_name(path: str | Column) -> Column:
    """Period label from a file name or path: ``.../i94_apr16_sub.parquet`` -> ``apr16``.

    The stem is the last path segment up to its first dot.  The label is lower
    case whatever the name's; a name without a month there has no period (null).
    """
    p = F.col(path) if isinstance(path, str) else path
    name = F.substring_index(p, "/", -1)
    stem = F.substring_index(name, ".", 1)
    label = F.lower(F.split_part(stem, F.lit("_"), F.lit(2)))
    return F.when(label.rlike(PERIOD_LABEL), label)


def period_from_path(path: str | Column) -> Column:
    """Like :func:`period_from_file_name`, for a full file path.

    A ``source_period=`` folder names the period; a file that a Spark job
    wrote (``.../i94_apr16_sub.csv/part-00000-....csv``) takes the name of
    its folder."""
    p = F.col(path) if isinstance(path, str) else path
    folder_period = F.regexp_extract(p, "/source_period=([^/]+)/", 1)
    name = F.substring_index(p, "/", -1)
    folder = F.substring_index(F.substring_index(p, "/", -2), "/", 1)
    from_name = period_from_file_name(F.when(name.startswith("part-"), folder).otherwise(name))
    return (F.when(folder_period == "__HIVE_DEFAULT_PARTITION__", F.lit(None).cast("string"))
            .when(F.lower(folder_period).rlike(PERIOD_LABEL), F.lower(folder_period))
            .when(folder_period != "", folder_period).otherwise(from_name))
