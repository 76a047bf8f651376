"""Typing of raw extract columns.

Spark 4 runs in ANSI mode, where a plain ``cast`` raises on bad input; all
casts here are ``try_cast`` so an unparsable value becomes null, as the
non-ANSI casts of older Spark versions did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.schemas import INT_COLUMNS, LONG_COLUMNS, SAS_DATE_COLUMNS, SAS_EPOCH, TEXT_COLUMNS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_long(c: str | Column) -> Column:
    """Double/text -> bigint, truncating toward zero; null when out of range."""
    return _col(c).try_cast("bigint")


def to_int(c: str | Column) -> Column:
    """Double/text -> int, truncating toward zero; null when out of range."""
    return _col(c).try_cast("int")


def to_text(c: str | Column) -> Column:
    """Binary (UTF-8 bytes) or any atomic value -> string."""
    return _col(c).try_cast("string")


def sas_date(c: str | Column) -> Column:
    """SAS day number (days since 1960-01-01) -> DATE.

    The fraction is truncated toward zero and null stays null:
    20545 -> 2016-04-01, -3 -> 1959-12-29.
    """
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), to_int(c))


def typed_extract_columns(columns: list[str]) -> list[Column]:
    """One projection that types every known extract column and passes the
    others (e.g. the ``source_period`` partition column) through."""
    out = []
    for name in columns:
        if name in LONG_COLUMNS:
            out.append(to_long(name).alias(name))
        elif name in INT_COLUMNS:
            out.append(to_int(name).alias(name))
        elif name in TEXT_COLUMNS:
            out.append(to_text(name).alias(name))
        elif name in SAS_DATE_COLUMNS:
            out.append(sas_date(name).alias(name))
        else:
            out.append(F.col(name))
    return out
