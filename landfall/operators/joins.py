"""Size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side, in bytes by Spark's own estimate, that a join may broadcast.
# A scan's estimate is the size of its files; label lists take kilobytes and
# a date dimension some 100 KB a century.  A larger side is joined by a
# shuffle, with AQE's skew handling.
BROADCAST_BYTES = 16 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``: file sizes carried through the plan; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated size is at most ``max_bytes``, else ``df``."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df
