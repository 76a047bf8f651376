"""Enrichment and staging (F05: A01, J01-J05, P08).

The batch is first summed to the staging grain -- fewer rows go through
the lookups -- then joined to the five label lookups.  Each lookup is
broadcast after a size check, so the joins need no shuffle of the large
side and a hot code (e.g. ``'missing'``) cannot skew them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.operators.joins import BROADCAST_BYTES, bounded_broadcast
from landfall.operators.lookups import Lookups
from landfall.schemas import MISSING, PERIOD_COLUMN, STAGING, STAGING_COLUMNS, STAGING_KEYS


def staging_aggregate(profiled: DataFrame, period_col: str | None = PERIOD_COLUMN) -> DataFrame:
    """``sum(count)`` by the eight staging keys (plus the period, when present).

    Null keys group together.  The sum is bigint.
    """
    keys = list(STAGING_KEYS)
    if period_col and period_col in profiled.columns:
        keys.append(period_col)
    return profiled.groupBy(*keys).agg(F.sum("count").alias("count"))


def join_label(df: DataFrame, lookup: DataFrame, key: str, label: str, how: str = "left",
               max_bytes: int = BROADCAST_BYTES, sized: bool = False) -> DataFrame:
    """Attach one lookup's value as column ``label`` by ``key = code``.

    ``sized=True`` means the lookup already carries its broadcast decision
    (``Lookups.sized_for_broadcast``); otherwise it is size-checked here.
    """
    code = f"__{label}_code"
    side = lookup.select(F.col("code").alias(code), F.col("value").alias(label))
    if not sized:
        side = bounded_broadcast(side, max_bytes)
    return df.join(side, F.col(key) == F.col(code), how).drop(code)


def enrich(agg: DataFrame, lookups: Lookups, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Attach the five labels.

    Visa, country, state and port are left outer joins; mode is an **inner**
    join, so rows with a null or unlisted mode leave the staging table
    (``operators.quality.mode_dropped`` reports them).
    """
    lk = lookups.sized_for_broadcast(max_bytes)
    df = join_label(agg, lk.visa, "i94visa", "visa_category", "left", sized=True)
    df = join_label(df, lk.citizenship, "i94cit", "country_of_citizenship", "left", sized=True)
    df = join_label(df, lk.state, "i94addr", "destination_state", "left", sized=True)
    df = join_label(df, lk.port, "i94port", "port_of_entry", "left", sized=True)
    return join_label(df, lk.mode, "i94mode", "mode_of_entry", "inner", sized=True)


def fill_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null text -> ``'missing'`` (P08); other types are left as they are."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    subset = [c for c in (columns or text) if c in text]
    return df.na.fill(MISSING, subset=subset) if subset else df


def build_staging(profiled: DataFrame, lookups: Lookups, period_col: str | None = PERIOD_COLUMN,
                  max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Profiled batch -> staging table (schema ``STAGING`` plus the period column)."""
    agg = staging_aggregate(profiled, period_col)
    joined = enrich(agg, lookups, max_bytes)
    extra = [period_col] if period_col and period_col in agg.columns else []
    cols = []
    for f in STAGING.fields:
        c = F.col(f.name)
        if f.name != "count" and not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return fill_missing(joined.select(*cols, *extra), [c for c in STAGING_COLUMNS])
