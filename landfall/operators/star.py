"""Star schema from the staging table (F06: A02-A04, S12).

One fact (``immigration``) and six dimensions.  All seven are aggregates
of the staging table: with partial (map-side) aggregation each shuffles
only distinct keys, so a hot key costs one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.dates import date_parts
from landfall.schemas import CONTRACTS, FACT_KEYS, PERIOD_COLUMN, UNKNOWN_MEMBERS


def fact_immigration(staging: DataFrame) -> DataFrame:
    """``sum(count)`` at the fact grain: the staging keys without ``i94visa``."""
    return staging.groupBy(*FACT_KEYS).agg(F.sum("count").alias("count"))


def with_unknown_member(spark: SparkSession, dim: DataFrame, table: str) -> DataFrame:
    """Add the table's unknown member unless its key is already present."""
    if table not in UNKNOWN_MEMBERS:
        return dim
    key = CONTRACTS[table].key[0]
    member = spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name)
                                     for v, f in zip(UNKNOWN_MEMBERS[table], dim.schema.fields)])
    return dim.unionByName(member.join(dim.select(key), key, "left_anti"))


# Dimension -> (staging columns forming its grouping set, output names).
DIMENSION_SETS: dict[str, list[tuple[str, str]]] = {
    "visa": [("visatype", "visatype"), ("i94visa", "visa_category_code"), ("visa_category", "visa_category")],
    "citizenship_country": [("i94cit", "id"), ("country_of_citizenship", "country_of_citizenship")],
    "destination_state": [("i94addr", "id"), ("destination_state", "destination_state")],
    "entry_mode": [("i94mode", "id"), ("mode_of_entry", "mode_of_entry")],
    "entry_port": [("i94port", "id"), ("port_of_entry", "port_of_entry")],
    "date": [("arrdate", "date")],
}
_MEMBER_COLS = [c for cols in DIMENSION_SETS.values() for c, _ in cols]


def _gid(cols: list[str]) -> int:
    """``grouping_id()`` of a grouping set: one bit per grouping column not in it."""
    n = len(_MEMBER_COLS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_MEMBER_COLS) if c not in cols)


#: ``grouping_id()`` of the set that is a whole period.
PERIOD_GID = _gid([])


def dimension_members(staging: DataFrame) -> DataFrame:
    """Distinct members of all six dimensions from **one** scan of staging.

    A single ``GROUPING SETS`` aggregate (one set per dimension): each row
    is expanded once per set on the map side and partially aggregated
    before the one shuffle, so only distinct members move.  ``gid`` tells
    the sets apart, also when a member's key is null.
    """
    sets = [[c for c, _ in cols] for cols in DIMENSION_SETS.values()]
    return staging.groupingSets(sets, *_MEMBER_COLS).agg(F.grouping_id().alias("gid"))


def member_counts(staging: DataFrame, more: list[Column] = ()) -> DataFrame:
    """``(source_period, gid, member columns, n, more...)``: in how many staging rows of a period each member occurs.

    The counts of one period depend on that period alone, so a period that is
    staged again replaces its own; a member that no period counts has left.
    A further set, ``PERIOD_GID``, has one row for the whole period; the
    aggregates ``more`` go along, so that one scan serves them too.
    """
    sets = [[PERIOD_COLUMN, *[c for c, _ in cols]] for cols in DIMENSION_SETS.values()] + [[PERIOD_COLUMN]]
    # the period is in every set, so it adds no bit to the grouping id
    return staging.groupingSets(sets, PERIOD_COLUMN, *_MEMBER_COLS).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), *more)


def counted_members(counts: DataFrame) -> DataFrame:
    """The members that any period counts, as :func:`dimension_members` gives them."""
    return counts.groupBy("gid", *_MEMBER_COLS).agg(F.sum("n").alias("n")).where(F.col("n") > 0).drop("n")


def changed_dimensions(before: DataFrame, after: DataFrame) -> list[str]:
    """Dimensions whose members differ between two tables of member counts."""
    a, b = (x.select("gid", *_MEMBER_COLS).distinct() for x in (before, after))
    gids = {r[0] for r in a.exceptAll(b).unionByName(b.exceptAll(a)).select("gid").distinct().collect()}  # six at most
    return [name for name, cols in DIMENSION_SETS.items() if _gid([c for c, _ in cols]) in gids]


def split_members(members: DataFrame) -> dict[str, DataFrame]:
    """The six dimension tables out of :func:`dimension_members`."""
    out = {}
    for name, cols in DIMENSION_SETS.items():
        sel = members.where(F.col("gid") == F.lit(_gid([c for c, _ in cols])))
        sel = sel.select(*[F.col(c).alias(o) for c, o in cols])
        if name == "date":
            sel = sel.where(F.col("date").isNotNull()).select("date", *date_parts("date"))
        out[name] = sel
    return out


@dataclass
class Star:
    """The seven star tables; ``staging`` is kept for visa-grain questions.

    ``members`` is the one-scan aggregate the six dimensions are cut from
    (set by :func:`build_star`); a writer may cache it so staging is read
    once for all of them.
    """

    immigration: DataFrame
    visa: DataFrame
    citizenship_country: DataFrame
    destination_state: DataFrame
    entry_mode: DataFrame
    entry_port: DataFrame
    date: DataFrame
    staging: DataFrame | None = None
    members: DataFrame | None = None
    # the fact's year rollup (``operators.rollup``), where the warehouse keeps one
    rollup: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)
                if f.name not in ("staging", "members", "rollup") and getattr(self, f.name) is not None}


def build_star(staging: DataFrame) -> Star:
    """All seven tables as lazy DataFrames over ``staging``.

    The fact is one aggregate at the fact grain; the six dimensions come
    from one grouping-sets aggregate.  The date dimension uses staging's
    arrival dates directly: the set equals the fact's (the fact groups
    staging by a superset of ``arrdate``), so the fact need not be read back.
    """
    members = dimension_members(staging)
    return Star(immigration=fact_immigration(staging), staging=staging, members=members,
                **split_members(members))
