"""Cells that do not parse (P02-P05): kept in a table instead of vanishing as nulls.

A raw cell that is not null but whose typed value is null is rejected.  A
rejected cell is stored with its column, period and text, and how often it
occurs; how many there are by column comes with the profile's own pass, and a
second pass reads only the periods that have any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.casts import typed_extract_columns
from landfall.functions.periods import in_periods
from landfall.schemas import I94_RAW_COLUMNS, PERIOD_COLUMN, TEXT_COLUMNS
from landfall.sources.landing import CELLS

BAD_PREFIX = "bad_"


def _cells(df: DataFrame) -> dict[str, tuple[Column, Column]]:
    """{column: (the cell as text, whether it is rejected)} of every column that is cast."""
    typed = dict(zip(df.columns, typed_extract_columns(df.columns)))
    out = {}
    for c in I94_RAW_COLUMNS:
        if c in df.columns and c not in TEXT_COLUMNS:
            text = F.col(f"{CELLS}.{c}") if CELLS in df.columns else F.col(c).cast("string")
            # the missing value is asked for first: few cells need their text; a CSV cell of blanks is an empty cell
            out[c] = text, typed[c].isNull() & F.coalesce(F.trim(text) != "", F.lit(False))
    return out


def bad_counts(df: DataFrame) -> list[Column]:
    """Aggregates bad_<column>: rejected cells of a group of raw rows."""
    return [F.count_if(bad).alias(f"{BAD_PREFIX}{c}") for c, (_, bad) in _cells(df).items()]


def rejected_cells(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(*by, column_name, cell, cells)`` of raw rows (with ``_cells`` where they come from CSV).

    Equal cells are counted in the tasks first: a column that is broken
    throughout by one value makes one row a task.
    """
    by = [PERIOD_COLUMN] if by is None else by
    each = F.array(*[F.when(bad, F.struct(F.lit(c).alias("column_name"), text.alias("cell")))
                     for c, (text, bad) in _cells(df).items()])
    rows = df.select(*by, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("r"))
    return rows.groupBy(*by, F.col("r.column_name").alias("column_name"), F.col("r.cell").alias("cell")).agg(
        F.count(F.lit(1)).alias("cells"))


def rejects_of(df: DataFrame, counts: DataFrame, by: list[str] | None = None) -> DataFrame | None:
    """The rejected cells of raw rows whose ``counts`` are stored; only periods that have any are read, None where none has."""
    total = sum((F.col(c) for c in counts.columns if c.startswith(BAD_PREFIX)), F.lit(0))
    periods = [r[0] for r in counts.where(total > 0).select(PERIOD_COLUMN).distinct().collect()]
    return rejected_cells(df.where(in_periods(PERIOD_COLUMN, periods)), by) if periods else None
