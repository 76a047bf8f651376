"""Data-quality checks (D01-D08) as DataFrames.

Every check yields rows ``(check_name, table_name, column_name, bad_rows, passed)``,
so a whole suite is one union that can be shown, written or asserted on.
Per table, the not-null and width checks share one aggregate (one scan);
non-emptiness reads at most one row; key and foreign-key checks aggregate
or anti-join without collecting anything to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.fingerprint import FINGERPRINT
from landfall.operators.joins import bounded_broadcast
from landfall.operators.lookups import NAMES, Lookups
from landfall.schemas import CONTRACTS, PERIOD_COLUMN

RESULT = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("column_name", T.StringType(), True),
    T.StructField("bad_rows", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


def _row(df: DataFrame, check: str, table: str, column: str | None, bad) -> DataFrame:
    bad = bad.cast("bigint")
    return df.select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(column).cast("string").alias("column_name"),
                     bad.alias("bad_rows"), (bad == 0).alias("passed"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def nonempty(tables: dict[str, DataFrame]) -> DataFrame:
    """A table passes when it has at least one row (reads at most one)."""
    parts = []
    for name, df in tables.items():
        probe = df.select(F.lit(1).alias("x")).limit(1).agg(F.count(F.lit(1)).alias("n"))
        parts.append(_row(probe, "nonempty", name, None, F.lit(1) - F.col("n")))
    return _union(parts)


def column_checks(tables: dict[str, DataFrame], contracts=CONTRACTS,
                  with_nonempty: bool = False) -> DataFrame:
    """D05 (declared NOT NULL) and D08 (declared width) in one aggregate per table.

    ``bad_rows`` is the number of null values, or of values longer than the
    declared width.  ``with_nonempty`` adds D01/D02 from the same scan (the
    row count is free once the table is read anyway).
    """
    parts = []
    for name, df in tables.items():
        c = contracts.get(name)
        aggs, labels = [], []
        if with_nonempty:
            aggs.append(F.when(F.count(F.lit(1)) > 0, 0).otherwise(1).alias("n0"))
            labels.append(("nonempty", None))
        for col in (c.not_null if c else []):
            if col in df.columns:
                aggs.append(F.count_if(F.col(col).isNull()).alias(f"n{len(aggs)}"))
                labels.append(("not_null", col))
        for col, width in (c.widths.items() if c else []):
            if col in df.columns:
                aggs.append(F.count_if(F.length(F.col(col)) > F.lit(width)).alias(f"n{len(aggs)}"))
                labels.append(("width", col))
        if not aggs:
            continue
        wide = df.agg(*aggs)
        stack = ", ".join(f"'{chk}', {('NULL' if col is None else repr(col))}, CAST(n{i} AS BIGINT)"
                          for i, (chk, col) in enumerate(labels))
        long = wide.selectExpr(f"stack({len(labels)}, {stack}) AS (check_name, column_name, bad)")
        parts.append(long.select("check_name", F.lit(name).alias("table_name"),
                                 F.col("column_name").cast("string").alias("column_name"),
                                 F.col("bad").cast("bigint").alias("bad_rows"),
                                 (F.col("bad") == 0).alias("passed")))
    return _union(parts)


def not_null(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    return column_checks(tables, contracts).where(F.col("check_name") == "not_null")


def width(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    return column_checks(tables, contracts).where(F.col("check_name") == "width")


def unique_key(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Rows whose primary key value occurs more than once."""
    parts = []
    for name, df in tables.items():
        c = contracts.get(name)
        if c is None or not c.key:
            continue
        dup = (df.groupBy(*c.key).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > 1).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad")))
        parts.append(_row(dup, "unique_key", name, ",".join(c.key), F.col("bad")))
    return _union(parts)


def foreign_keys(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Child rows whose non-null key has no parent row.

    All foreign keys of one child table are checked in **one** pass: each
    parent's distinct keys join (broadcast where small) as a left join carrying a match marker, and one aggregate counts
    the unmatched non-null keys per column.
    """
    parts = []
    for name, df in tables.items():
        c = contracts.get(name)
        fks = [(col, p, pc) for col, (p, pc) in (c.foreign_keys.items() if c else []) if p in tables]
        if not fks:
            continue
        sides = {f"{i}": tables[p].select(F.col(pc).alias(f"__k{i}")).distinct()
                 .withColumn(f"__m{i}", F.lit(True)) for i, (_, p, pc) in enumerate(fks)}
        sides = {k: bounded_broadcast(s) for k, s in sides.items()}
        joined = df.select(*[col for col, _, _ in fks])
        for i, (col, _, _) in enumerate(fks):
            joined = joined.join(sides[f"{i}"], F.col(col) == F.col(f"__k{i}"), "left")
        wide = joined.agg(*[F.count_if(F.col(col).isNotNull() & F.col(f"__m{i}").isNull()).alias(f"n{i}")
                            for i, (col, _, _) in enumerate(fks)])
        stack = ", ".join(f"'{col}', CAST(n{i} AS BIGINT)" for i, (col, _, _) in enumerate(fks))
        long = wide.selectExpr(f"stack({len(fks)}, {stack}) AS (column_name, bad)")
        parts.append(long.select(F.lit("foreign_key").alias("check_name"), F.lit(name).alias("table_name"),
                                 "column_name", F.col("bad").alias("bad_rows"),
                                 (F.col("bad") == 0).alias("passed")))
    return _union(parts)


def mode_dropped(staging_agg: DataFrame, mode_lookup: DataFrame) -> DataFrame:
    """Rows the inner mode join removes: ``(i94mode, groups, total_count)`` per
    mode code that is null or has no label."""
    codes = bounded_broadcast(mode_lookup.select(F.col("code").alias("__mode")))
    lost = staging_agg.join(codes, F.col("i94mode") == F.col("__mode"), "left_anti")
    return lost.groupBy("i94mode").agg(F.count(F.lit(1)).alias("groups"),
                                       F.sum("count").alias("total_count"))


def reconcile(source: DataFrame, target: DataFrame, by: str = PERIOD_COLUMN) -> DataFrame:
    """Rows per ``by`` value on both sides; a value absent on one side fails.

    ``(by, source_rows, target_rows, passed)``.  Both sides are aggregated
    first, so the outer join only sees one row per period.
    """
    s = source.groupBy(by).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(by).agg(F.count(F.lit(1)).alias("target_rows"))
    # null-safe: rows without a value are one group, on both sides
    t = t.withColumnRenamed(by, "__by")
    j = s.join(t, F.col(by).eqNullSafe(F.col("__by")), "full_outer").withColumn(by, F.coalesce(by, "__by"))
    src = F.coalesce(F.col("source_rows"), F.lit(0))
    tgt = F.coalesce(F.col("target_rows"), F.lit(0))
    return j.select(by, src.alias("source_rows"), tgt.alias("target_rows"), (src == tgt).alias("passed"))


def reconcile_content(source: DataFrame, target: DataFrame, by: str = PERIOD_COLUMN) -> DataFrame:
    """Whether both sides hold the same rows per ``by`` value, cell by cell.

    Either side is a table of fingerprints (``functions.fingerprint``), one
    aggregate over its rows.  ``(by, source_rows, target_rows, passed)``; equal
    counts with different contents fail, and a value absent on one side does.
    """
    t = target.select(F.col(by).alias("__by"), *[F.col(c).alias(f"__{c}") for c in FINGERPRINT])
    j = source.select(by, *FINGERPRINT).join(t, F.col(by).eqNullSafe(F.col("__by")), "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in FINGERPRINT])
    return j.select(F.coalesce(by, "__by").alias(by), F.coalesce("row_count", F.lit(0)).alias("source_rows"),
                    F.coalesce("__row_count", F.lit(0)).alias("target_rows"), same.alias("passed"))


def reconcile_totals(profiled: DataFrame, staging: DataFrame, mode_lookup: DataFrame,
                     by: str = PERIOD_COLUMN) -> DataFrame:
    """``sum(count)`` per period before staging equals staging's sum plus what the mode join lost.

    ``(by, source_total, lost_total, staged_total, passed)``.
    """
    codes = bounded_broadcast(mode_lookup.select(F.col("code").alias("__mode")).distinct().withColumn("__known", F.lit(1)))
    n = F.coalesce(F.col("count"), F.lit(0))
    s = (profiled.select(by, "i94mode", "count").join(codes, F.col("i94mode") == F.col("__mode"), "left").groupBy(by)
         .agg(F.sum(n).cast("bigint").alias("source_total"),
              F.sum(F.when(F.col("__known").isNull(), n).otherwise(0)).cast("bigint").alias("lost_total")))
    t = staging.groupBy(F.col(by).alias("__by")).agg(F.sum(n).cast("bigint").alias("staged_total"))
    j = s.join(t, F.col(by).eqNullSafe(F.col("__by")), "full_outer")
    total, lost, staged = (F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in ("source_total", "lost_total", "staged_total"))
    return j.select(F.coalesce(by, "__by").alias(by), total.alias("source_total"), lost.alias("lost_total"),
                    staged.alias("staged_total"), (total == lost + staged).alias("passed"))


def lookup_keys(lookups: Lookups) -> DataFrame:
    """D06 for the lookups: entries whose code occurs more than once, which would count matching rows twice."""
    parts = []
    for name in NAMES:
        dup = (getattr(lookups, name).where(F.col("code").isNotNull()).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > 1).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad")))
        parts.append(_row(dup, "unique_key", f"lookup_{name}", "code", F.col("bad")))
    return _union(parts)


def star_suite(tables: dict[str, DataFrame], contracts=CONTRACTS) -> DataFrame:
    """Every declared check over the given tables: per table one aggregate
    (rows, nulls, widths), one key aggregate per dimension, one pass per
    child table for its foreign keys."""
    return _union([column_checks(tables, contracts, with_nonempty=True),
                   unique_key(tables, contracts), foreign_keys(tables, contracts)])
