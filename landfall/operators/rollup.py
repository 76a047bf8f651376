"""Year rollup of the fact, and check counts kept with it (Q1, Q3-Q6; D01, D02, D05, D07, D08).

One ``GROUPING SETS`` aggregate holds, for every arrival year, the sums and row
counts by each set of key columns that a question or a foreign key needs.  A
set's rows of a year depend on that year's fact partition alone, so a refresh
replaces the touched years.  Questions whose columns a set holds are answered
from it; so are the fact's declared checks, since every checked column is in
some set.  Staging's check counts are kept by period in the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.joins import bounded_broadcast
from landfall.schemas import CONTRACTS, Contract

YEAR = "arrival_year"
#: Key columns of each grouping set, smallest sets first.
SETS = [["visatype"], ["i94mode"], ["i94port"], ["visatype", "i94addr"], ["i94cit", "gender"]]
COLUMNS = list(dict.fromkeys(c for s in SETS for c in s))


def gid(columns: list[str]) -> int:
    """``grouping_id()`` of a set; the year is in every set and leads the columns, so it adds no bit."""
    return sum(1 << (len(COLUMNS) - 1 - i) for i, c in enumerate(COLUMNS) if c not in columns)


def year_rollup(fact: DataFrame) -> DataFrame:
    """``(arrival_year, gid, key columns, count, row_count)`` of fact rows that carry their arrival year."""
    sets = [[YEAR, *s] for s in SETS]
    return fact.groupingSets(sets, YEAR, *COLUMNS).agg(F.grouping_id().alias("gid"), F.sum("count").alias("count"),
                                                       F.count(F.lit(1)).alias("row_count"))


def set_for(columns: list[str]) -> list[str] | None:
    """The smallest set that holds all of ``columns``."""
    return next((s for s in SETS if set(columns) <= set(s)), None)


def totals(rollup: DataFrame, columns: list[str], year: int) -> DataFrame | None:
    """``(columns of a set, count)`` of one year, or None where no set holds ``columns``."""
    s = set_for(columns)
    return None if s is None else rollup.where((F.col(YEAR) == F.lit(year)) & (F.col("gid") == F.lit(gid(s)))).select(*s, "count")


def _rows(df: DataFrame, check: str, table: str, column: str | None, bad) -> DataFrame:
    n = F.coalesce(F.sum(F.when(bad, F.col("row_count")).otherwise(0)), F.lit(0)).cast("bigint")
    return df.agg(n.alias("bad_rows")).select(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                                              F.lit(column).cast("string").alias("column_name"), "bad_rows",
                                              (F.col("bad_rows") == 0).alias("passed"))


def fact_checks(rollup: DataFrame, parents: dict[str, DataFrame], contract: Contract = CONTRACTS["immigration"]) -> DataFrame:
    """The fact's check rows (``quality.star_suite``) from its rollup: the fact itself is not read."""
    def of(column):
        return rollup.where(F.col("gid") == F.lit(gid(set_for([column]))))

    one = rollup.where(F.col("gid") == F.lit(gid(SETS[0])))
    name = contract.name
    rows = one.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n")).select(
        F.lit("nonempty").alias("check_name"), F.lit(name).alias("table_name"), F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("bad_rows"), (F.col("n") > 0).alias("passed"))
    parts = [rows]
    for c in contract.not_null:  # a row without an arrival date has no arrival year either
        parts.append(_rows(one if c == "arrdate" else of(c), "not_null", name, c, F.col(YEAR if c == "arrdate" else c).isNull()))
    for c, width in contract.widths.items():
        parts.append(_rows(of(c), "width", name, c, F.length(c) > width))
    for c, (parent, key) in contract.foreign_keys.items():
        known = bounded_broadcast(parents[parent].select(F.col(key).alias("__key")).distinct().withColumn("__known", F.lit(True)))
        met = of(c).join(known, F.col(c) == F.col("__key"), "left")
        parts.append(_rows(met, "foreign_key", name, c, F.col(c).isNotNull() & F.col("__known").isNull()))
    return reduce(DataFrame.unionByName, parts)


def staging_counts(contract: Contract = CONTRACTS["immigration_stage"]) -> list[Column]:
    """Aggregates ``width_<column>``: beside the rows, what staging's declared checks need."""
    return [F.count_if(F.length(c) > w).alias(f"width_{c}") for c, w in contract.widths.items()]


def staging_checks(counts: DataFrame, contract: Contract = CONTRACTS["immigration_stage"]) -> DataFrame:
    """Staging's check rows (``quality.star_suite``), merged from the rows ``(n, width_<column>...)`` stored by period."""
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                      *[F.coalesce(F.sum(f"width_{c}"), F.lit(0)).cast("bigint").alias(f"w{i}") for i, c in enumerate(contract.widths)])
    each = [F.struct(F.lit("nonempty").alias("check_name"), F.lit(None).cast("string").alias("column_name"),
                     F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("bad_rows"))]
    each += [F.struct(F.lit("width").alias("check_name"), F.lit(c).cast("string").alias("column_name"), F.col(f"w{i}").alias("bad_rows"))
             for i, c in enumerate(contract.widths)]
    return sums.select(F.inline(F.array(*each))).select("check_name", F.lit(contract.name).alias("table_name"), "column_name",
                                                        "bad_rows", (F.col("bad_rows") == 0).alias("passed"))
