"""Profiling and cleaning of monthly extracts (F02: P02-P05, P07-P08, P11, A05, A07, A08).

The reference profiles with one Spark job per column; here every null count
and the row count come from **one** aggregate whose single result row is the
only thing collected to the driver.  The drop decision is taken once per
batch, so every month of a run shares one schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.casts import typed_extract_columns
from landfall.schemas import I94_RAW_COLUMNS, MISSING, NULL_RATIO_LIMIT, PERIOD_COLUMN, REQUIRED_COLUMNS


def type_extract(raw: DataFrame) -> DataFrame:
    """Cast raw extract columns to their profiled types in one projection."""
    return raw.select(*typed_extract_columns(raw.columns))


def _profiled_columns(df: DataFrame, exclude: tuple[str, ...] = (PERIOD_COLUMN,)) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def null_count_exprs(columns: list[str]) -> list:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Long-format null counts: ``(*by, column_name, null_rows, total_rows)`` (A05 + A07).

    One aggregate computes the row count and every column's null count
    (grouped by ``by`` when given, e.g. the source period); ``unpivot`` turns
    the wide result into rows.
    """
    by = by or []
    cols = _profiled_columns(df, exclude=tuple(by) + (PERIOD_COLUMN,))
    aggs = [F.count(F.lit(1)).alias("__total")] + null_count_exprs(cols)
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    long = wide.unpivot(ids=by + ["__total"], values=cols,
                        variableColumnName="column_name", valueColumnName="null_rows")
    return long.select(*by, "column_name", "null_rows", F.col("__total").alias("total_rows"))


def null_ratio(df: DataFrame, limit: float = NULL_RATIO_LIMIT) -> DataFrame:
    """``(column_name, null_rows, total_rows, null_ppm, dropped)`` for one batch.

    ``dropped`` is the strict rule ``null_rows / total_rows > limit``; an
    empty batch drops nothing.  ``null_ppm`` is the null share in parts per
    million, rounded down (exact integer arithmetic).
    """
    counts = null_counts(df)
    ratio = F.when(F.col("total_rows") > 0, F.col("null_rows") / F.col("total_rows"))
    ppm = F.when(F.col("total_rows") > 0,
                 F.expr("(null_rows * 1000000) div total_rows")).otherwise(F.lit(0).cast("bigint"))
    return counts.select(
        "column_name", "null_rows", "total_rows", ppm.alias("null_ppm"),
        F.coalesce(ratio > F.lit(limit), F.lit(False)).alias("dropped"))


@dataclass
class ProfileResult:
    """The cleaned batch and what the profile decided."""

    df: DataFrame
    total_rows: int
    nulls: dict[str, int]
    dropped: list[str] = field(default_factory=list)
    filled: list[str] = field(default_factory=list)

    @property
    def columns_with_nulls(self) -> list[str]:
        return [c for c, n in self.nulls.items() if n > 0]


def decide_drops(nulls: dict[str, int], total_rows: int, limit: float = NULL_RATIO_LIMIT) -> list[str]:
    """Columns whose null share is strictly over ``limit``; none for an empty batch."""
    if total_rows <= 0:
        return []
    return [c for c, n in nulls.items() if n / total_rows > limit]


def observe_nulls(raw: DataFrame, name: str = "null_profile") -> tuple[DataFrame, Observation]:
    """Attach the null profile of the *typed* columns to ``raw`` as observed metrics.

    The counts are gathered by whatever action next runs over the returned
    DataFrame (e.g. the landing write), so the profile needs no scan of its
    own; read them with :func:`observed_counts` after that action.  The
    typed expressions are evaluated only inside the metrics -- the rows keep
    their raw form.
    """
    obs = Observation(name)
    typed = typed_extract_columns(raw.columns)
    cols = [c for c in raw.columns if c != PERIOD_COLUMN]
    by_name = {c: e for c, e in zip(raw.columns, typed)}
    metrics = [F.count(F.lit(1)).alias("__total")] + [
        F.count_if(by_name[c].isNull()).alias(c) for c in cols]
    return raw.observe(obs, *metrics), obs


def observed_counts(obs: Observation) -> tuple[int, dict[str, int]]:
    """``(total_rows, {column: nulls})`` from an :func:`observe_nulls` observation."""
    got = dict(obs.get)
    total = int(got.pop("__total"))
    return total, {c: int(n) for c, n in got.items()}


def ratio_over(nulls: int, total: int, limit: float = NULL_RATIO_LIMIT) -> bool:
    """The strict drop rule for one column; false for no rows."""
    return total > 0 and nulls / total > limit


NULL_PREFIX = "null_"


def profile_counts(raw: DataFrame, by: list[str], more: list[Column] = ()) -> DataFrame:
    """``(*by, row_count, null_<column>...)`` of the *typed* columns, in one pass over raw rows.

    ``more`` aggregates, a ``row_count`` among them, take the place of the bare row count.

    The counts of disjoint parts add up, so a stored table of them answers for
    any set of parts (:func:`merged_profile`).
    """
    typed = dict(zip(raw.columns, typed_extract_columns(raw.columns)))
    counts = [F.count_if(typed[c].isNull()).alias(f"{NULL_PREFIX}{c}") for c in I94_RAW_COLUMNS if c in typed]
    return raw.groupBy(*by).agg(*(more or [F.count(F.lit(1)).alias("row_count")]), *counts)


def merged_profile(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Stored counts of many parts -> ``(*by, column_name, null_rows, total_rows)``, as one profile over all their rows."""
    names = [c for c in counts.columns if c.startswith(NULL_PREFIX)]
    wide = counts.groupBy(*by).agg(F.sum("row_count").alias("__total"), *[F.sum(c).alias(c[len(NULL_PREFIX):]) for c in names])
    long = wide.unpivot(ids=[*by, "__total"], values=[c[len(NULL_PREFIX):] for c in names],
                        variableColumnName="column_name", valueColumnName="null_rows")
    return long.where(F.col("__total").isNotNull()).select(*by, "column_name", "null_rows", F.col("__total").alias("total_rows"))


def totals_of(counts: DataFrame) -> tuple[int, dict[str, int]]:
    """(rows, {column: nulls}) of all parts of a stored profile: 28 rows reach the driver."""
    rows = merged_profile(counts).collect()
    return (rows[0]["total_rows"] if rows else 0), {r["column_name"]: r["null_rows"] for r in rows}


def sparse_columns(counts: DataFrame) -> list[str]:
    """Columns over the null limit in all parts together (28 rows reach the driver); needed ones are never among them."""
    total, nulls = totals_of(counts)
    return [c for c in decide_drops(nulls, total) if c not in REQUIRED_COLUMNS]


def fill_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null text -> ``'missing'`` in ``columns`` (all text columns by default)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
            and (f.name in columns if columns else f.name != PERIOD_COLUMN)]
    return df.na.fill(MISSING, subset=text) if text else df


def profile_extract(raw: DataFrame, limit: float = NULL_RATIO_LIMIT,
                    required: list[str] | None = None, typed: bool = False,
                    counts: tuple[int, dict[str, int]] | None = None) -> ProfileResult:
    """Type, profile and clean one batch of extracts.

    1. one projection types the raw columns (``typed=True`` skips it);
    2. one aggregate counts rows and nulls -- the only collected row -- unless
       ``counts`` (from :func:`observe_nulls` during landing) are given, in
       which case the profile runs no Spark job at all;
    3. columns over the null limit are dropped (never a ``required`` one:
       that raises, since staging could not be built without it);
    4. null text in the remaining columns becomes ``'missing'``; null
       numbers and dates stay null.
    """
    required = REQUIRED_COLUMNS if required is None else required
    df = raw if typed else type_extract(raw)
    cols = _profiled_columns(df)
    if counts is not None:
        total, nulls = counts
        nulls = {c: nulls[c] for c in cols}
    else:
        row = df.agg(F.count(F.lit(1)).alias("__total"), *null_count_exprs(cols)).first()
        total = int(row["__total"])
        nulls = {c: int(row[c]) for c in cols}
    dropped = decide_drops(nulls, total, limit)
    bad = [c for c in dropped if c in required]
    if bad:
        raise ValueError(f"profile would drop required columns {bad}; "
                         f"null shares: {[round(nulls[c] / total, 4) for c in bad]}")
    kept = df.drop(*dropped)
    text = {f.name for f in kept.schema.fields if isinstance(f.dataType, T.StringType)}
    filled = [c for c in cols if c not in dropped and c in text and nulls[c] > 0]
    if filled:
        kept = kept.na.fill(MISSING, subset=filled)
    return ProfileResult(kept, total, nulls, dropped, filled)
