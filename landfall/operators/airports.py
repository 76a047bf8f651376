"""Airport table cleaning (F03: P03, P06, P09, P10, P18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.airports import airport_code
from landfall.schemas import AIRPORT_ELEVATION_DEFAULT, AIRPORT_TEXT_DEFAULT


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column, for inspection."""
    return df.select(column).distinct()


def clean_airports(df: DataFrame) -> DataFrame:
    """Typed and filled airports with a derived ``airport_code``.

    * ``elevation_ft`` -> int (truncated), null -> -1000;
    * null ``continent`` / ``iso_country`` -> ``'NA'`` (North America /
      Namibia, which a CSV reader may have turned into null);
    * ``airport_code`` = first present of IATA, local code, ident.

    One projection; other columns pass through unchanged.
    """
    cols = []
    for name in df.columns:
        c = F.col(name)
        if name == "elevation_ft":
            c = F.coalesce(c.try_cast("int"), F.lit(AIRPORT_ELEVATION_DEFAULT))
        elif name in ("continent", "iso_country"):
            c = F.coalesce(c, F.lit(AIRPORT_TEXT_DEFAULT))
        cols.append(c.alias(name))
    return df.select(*cols, airport_code().alias("airport_code"))
