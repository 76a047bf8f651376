"""Airport code rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def airport_code(iata: str = "iata_code", local: str = "local_code", ident: str = "ident") -> Column:
    """First present of IATA code, local code and ident."""
    return F.coalesce(F.col(iata), F.col(local), F.col(ident))
