"""End-to-end flows: labels -> profile -> staging -> star.

Each flow writes its result once and hands the written table to the next
step, so every stage starts from a short lineage (a Parquet scan) and a
lost executor only recomputes from the last written table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.fingerprint import fingerprint
from landfall.functions.periods import in_periods, period_of
from landfall.operators.lookups import Lookups
from landfall.operators.profile import ProfileResult, fill_text, profile_counts, profile_extract, totals_of, type_extract
from landfall.operators.staging import build_staging
from landfall.operators.quality import lookup_keys
from landfall.operators.star import DIMENSION_SETS, Star, with_unknown_member
from landfall.schemas import I94_RAW_COLUMNS, PERIOD_COLUMN
from landfall.sources.labels import parse_label_lines
from landfall.sources.warehouse import FACT_SORT, YEAR_PARTITION, Warehouse


def with_period(raw: DataFrame) -> DataFrame:
    """Add ``source_period`` from the record's own year and month, for
    inputs that do not come from per-month files."""
    if PERIOD_COLUMN in raw.columns:
        return raw
    return raw.withColumn(PERIOD_COLUMN, period_of("i94yr", "i94mon"))


def clean_labels(spark: SparkSession, lines: DataFrame, warehouse: Warehouse | None = None) -> Lookups:
    """Label lines -> the five typed lookups (F04), written once when a warehouse is given."""
    lookups = Lookups.from_parsed(parse_label_lines(lines))
    if warehouse is not None:
        lookups = lookups.materialize(spark, warehouse.path("lookups"))
    return lookups


@dataclass
class BuildResult:
    profile: ProfileResult
    staging: DataFrame
    star: Star
    profiled: DataFrame
    lookups: Lookups


def build_warehouse(spark: SparkSession, raw: DataFrame, lines: DataFrame,
                    warehouse: Warehouse, counts: DataFrame | None = None,
                    periods: list | None = None, seed_unknown: bool = False) -> BuildResult:
    """Profile a batch of extracts, stage it, and (re)build the star.

    Spark jobs: the profile aggregate (a single collected row; with stored
    ``counts``, as the landing leaves them, a merge of those of all periods),
    the profiled write, the staging write, the fact write and one scan of
    staging for all six dimensions.  Labels whose codes are not unique stop
    the build: they would count rows twice.

    ``periods`` are those that ``raw`` holds; other periods staged before stay.
    Without them the whole staging table is replaced.  ``seed_unknown`` adds
    the unknown members to the dimensions that have one (S12).
    """
    lookups = clean_labels(spark, lines, warehouse)
    twice = [r["table_name"] for r in lookup_keys(lookups).where("NOT passed").collect()]
    if twice:
        raise ValueError(f"codes occur more than once in {twice}")
    raw = with_period(raw)
    prof = profile_extract(raw, counts=None if counts is None else totals_of(counts))
    # every typed column is stored and the sparse ones are left out on reading, so that months
    # profiled at different times share the schema that all of them together decide
    typed = fill_text(type_extract(raw))
    warehouse.write("profiled", typed, partition_by=[PERIOD_COLUMN], replace_all=periods is None)
    profiled = warehouse.spark.read.schema(typed.schema).parquet(warehouse.path("profiled")).select(*prof.df.columns)
    if periods is not None:
        profiled = profiled.where(in_periods(PERIOD_COLUMN, periods))
    staging = warehouse.write_staging(build_staging(profiled, lookups), periods)
    star = rebuild_star(warehouse, seed_unknown)
    return BuildResult(prof, staging, star, profiled, lookups)


def rebuild_star(warehouse: Warehouse, seed_unknown: bool = False) -> Star:
    """Re-derive the star from the whole staging table: the fact and its year rollup, the member and check counts of
    every period, and the dimensions from the member counts."""
    from landfall.operators.rollup import staging_counts, year_rollup
    from landfall.operators.star import counted_members, fact_immigration, member_counts

    staging = warehouse.read_staging()
    fact = fact_immigration(staging).withColumn(YEAR_PARTITION, F.year("arrdate"))
    fact = warehouse.write("immigration", fact, partition_by=[YEAR_PARTITION], sort_by=FACT_SORT, rebalance=True, replace_all=True)
    warehouse.write("rollup", year_rollup(fact), partition_by=[YEAR_PARTITION], rebalance=True, replace_all=True)
    counts = warehouse.write("period_counts", member_counts(staging, staging_counts()), partition_by=[PERIOD_COLUMN], spread=True,
                             replace_all=True)
    _write_dimensions(warehouse, counted_members(counts), list(DIMENSION_SETS), seed_unknown)
    return warehouse.read_star()


def _write_dimensions(warehouse: Warehouse, members: DataFrame, names: list[str], seed_unknown: bool) -> None:
    from landfall.operators.star import split_members

    members = members.persist()  # labels and days; one read of the counts serves all dimensions
    try:
        for name, dim in split_members(members).items():
            if name in names:
                warehouse.write_dimension(name, with_unknown_member(warehouse.spark, dim, name) if seed_unknown else dim)
    finally:
        members.unpersist()


def stored_checks(warehouse: Warehouse) -> DataFrame:
    """Every declared check of ``quality.star_suite``, from the counts kept with the tables.

    Neither staging nor the fact is read: their counts were made when their
    periods and years were written.  The dimensions, which are small, are
    checked whole.
    """
    from landfall.operators import quality
    from landfall.operators.rollup import fact_checks, staging_checks
    from landfall.operators.star import PERIOD_GID

    star = warehouse.read_star(with_staging=False)
    dims = {n: d for n, d in star.tables().items() if n != "immigration"}
    periods = warehouse.read("period_counts").where(F.col("gid") == F.lit(PERIOD_GID))
    return (staging_checks(periods).unionByName(fact_checks(star.rollup, dims))
            .unionByName(quality.column_checks(dims, with_nonempty=True)).unionByName(quality.unique_key(dims)))


def staging_totals(staging: DataFrame) -> DataFrame:
    """Rows and ``sum(count)`` per period of a staging table."""
    return staging.groupBy(PERIOD_COLUMN).agg(F.count(F.lit(1)).alias("row_count"),
                                              F.sum("count").alias("total"))


@dataclass
class LandResult:
    lake: DataFrame
    lines: DataFrame
    airports: DataFrame | None
    reconciliation: DataFrame
    # the periods that this landing brought; lake and reconciliation hold just these
    periods: list
    # stored null counts of every period in the lake, those landed earlier too
    counts: DataFrame | None = None
    files: DataFrame | None = None
    # rejected cells of every period in the lake; None when this landing brought none
    rejects: DataFrame | None = None


def land_all(spark: SparkSession, extracts: str, labels: str, lake_root: str,
             airports_csv: str | None = None, extract_format: str = "parquet",
             extract_options: dict | None = None) -> LandResult:
    """land extracts, label files and airports, then reconcile.

    ``extracts`` holds monthly files (``i94_<mon><yy>_sub.*`` or
    ``source_period=`` folders); ``labels`` holds the ``*.txt`` label
    files.  Extracts are rewritten as Parquet partitioned by period; label
    lines are kept as read (parsing happens in :func:`clean_labels`).  Periods
    landed earlier stay in the lake and take no part in this result.  The
    extracts are read twice: once for all counts, once to be written.
    """
    from landfall.operators.quality import reconcile_content
    from landfall.operators.rejects import bad_counts, rejects_of
    from landfall.sources.labels import read_label_lines
    from landfall.sources.landing import CELLS, land_airports, land_rows, read_airports_csv, read_extracts

    tables = Warehouse(spark, lake_root)
    source = read_extracts(spark, extracts, extract_format, options=extract_options, cells=True)
    # one pass over the source: fingerprints, null profile and rejected cells by period
    counts = profile_counts(source, [PERIOD_COLUMN], [*fingerprint(I94_RAW_COLUMNS), *bad_counts(source)])
    counts = tables.write("source_counts", counts, replace_all=True)
    periods = [r[0] for r in counts.select(PERIOD_COLUMN).collect()]  # month labels
    lake = land_rows(source.drop(CELLS), f"{lake_root}/immigration").where(in_periods(PERIOD_COLUMN, periods))
    tables.write_periods("profile_counts", counts, periods, spread=True)
    rejects = rejects_of(source, counts)
    tables.write_periods("rejects", rejects, periods)
    label_source = read_label_lines(spark, labels)
    label_source.write.mode("overwrite").parquet(f"{lake_root}/labels")
    lines = spark.read.parquet(f"{lake_root}/labels")
    landed = lake.groupBy(PERIOD_COLUMN).agg(*fingerprint(I94_RAW_COLUMNS))
    landed = tables.write("target_counts", landed, replace_all=True)
    files = files_compared({"immigration": (counts.select(F.col(PERIOD_COLUMN).alias("name")),
                                            landed.select(F.col(PERIOD_COLUMN).alias("name"))),
                            "labels": (label_source.select(F.col("label").alias("name")),
                                       lines.select(F.col("label").alias("name")))})
    airports = None
    if airports_csv:
        airports = land_airports(spark, read_airports_csv(spark, airports_csv), f"{lake_root}/airports")
    return LandResult(lake, lines, airports, reconcile_content(counts, landed), periods,
                      tables.read("profile_counts"), files, tables.read("rejects") if rejects is not None else None)


def files_compared(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(source, source_files, target_files, passed)`` from rows ``(name)`` of either side.

    A delivered file is known by its name -- the period of an extract, the
    stem of a label file -- and passes when the target holds rows of it.
    """
    out = None
    for source, (before, after) in pairs.items():
        s = before.distinct().select("name", F.lit(1).alias("in_source"))
        t = after.distinct().select(F.col("name").alias("_name"), F.lit(1).alias("in_target"))
        j = s.join(t, F.col("name").eqNullSafe(F.col("_name")), "full_outer")
        one = j.agg(F.count("in_source").alias("source_files"), F.count("in_target").alias("target_files"),
                    F.count_if(F.col("in_source").isNull() | F.col("in_target").isNull()).alias("bad"))
        one = one.select(F.lit(source).alias("source"), "source_files", "target_files", (F.col("bad") == 0).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


def run_all(spark: SparkSession, extracts: str, labels: str, root: str,
            airports_csv: str | None = None, extract_format: str = "parquet",
            extract_options: dict | None = None, seed_unknown: bool = False) -> tuple[Star, DataFrame]:
    """Every flow in order: land (F01), airports (F03), labels (F04), profile
    (F02), staging (F05), star (F06), then all checks.

    Returns the written star and the written table of check rows
    ``(check_name, table_name, column_name, bad_rows, passed)``.  Beside the
    declared checks it has, for the periods of this run, the contents landed
    (``reconcile_land``), files against targets (``files``), cells that did
    not parse (``rejected_cells``), the sums staged (``reconcile_staged``)
    and, as a report that always passes, the records the mode join lost
    (``mode_loss``).  A second run over one root brings
    other months to the same tables.
    """
    from landfall.operators import quality
    from landfall.operators.airports import clean_airports

    landed = land_all(spark, extracts, labels, f"{root}/lake", airports_csv, extract_format,
                      extract_options)
    wh = Warehouse(spark, f"{root}/warehouse")
    if landed.airports is not None:
        wh.write("airports", clean_airports(landed.airports))
    res = build_warehouse(spark, landed.lake, landed.lines, wh, landed.counts, landed.periods, seed_unknown)
    def as_checks(rec: DataFrame, check: str, column: str, bad) -> DataFrame:
        return rec.select(F.lit(check).alias("check_name"), F.lit("immigration").alias("table_name"),
                          F.col(column).alias("column_name"), bad.cast("bigint").alias("bad_rows"), F.col("passed"))

    staged = quality.reconcile_totals(res.profiled, res.staging.where(in_periods(PERIOD_COLUMN, landed.periods)),
                                      res.lookups.mode)
    missed = F.col("source_total") - F.col("lost_total") - F.col("staged_total")
    checks = (stored_checks(wh).unionByName(quality.lookup_keys(res.lookups))
              .unionByName(as_checks(landed.reconciliation, "reconcile_land", PERIOD_COLUMN,
                                     F.when(F.col("passed"), 0).otherwise(F.greatest(
                                         F.lit(1), F.abs(F.col("source_rows") - F.col("target_rows"))))))
              .unionByName(as_checks(landed.files, "files", "source", F.abs(F.col("source_files") - F.col("target_files"))))
              .unionByName(as_checks(staged, "reconcile_staged", PERIOD_COLUMN, F.abs(missed)))
              .unionByName(as_checks(staged.withColumn("passed", F.lit(True)), "mode_loss", PERIOD_COLUMN,
                                     F.col("lost_total"))))
    if landed.rejects is not None:
        lost = landed.rejects.where(in_periods(PERIOD_COLUMN, landed.periods)).groupBy("column_name").agg(F.sum("cells").alias("cells"))
        checks = checks.unionByName(as_checks(lost.withColumn("passed", F.lit(False)), "rejected_cells", "column_name", F.col("cells")))
    return res.star, wh.write("checks", checks)


def arrival_years(staging: DataFrame, periods: list) -> set:
    """Arrival years present in the given periods of a staging table (a few values); reads no column."""
    return {r[0] for r in staging.where(in_periods(PERIOD_COLUMN, periods)).select(YEAR_PARTITION).distinct().collect()}


def refresh_star(warehouse: Warehouse, years: set, periods: list, seed_unknown: bool = False) -> Star:
    """Bring the star up to date after some ``periods`` were re-staged.

    Only the fact partitions of the touched arrival ``years`` are recomputed,
    from every staging row of those years, whatever period it came in; staging
    is partitioned by year too, so nothing else is read.  A year that has no
    row left loses its partition.  ``None`` in ``years`` stands for rows
    without an arrival date.

    The rollup of these years and the check counts of these periods are
    replaced likewise.  The members of the re-staged periods are counted again.
    A dimension is written again, from the stored counts alone, where these periods gained or
    lost a member of it: a member leaves with its last row.
    """
    from landfall.operators.rollup import staging_counts, year_rollup
    from landfall.operators.star import changed_dimensions, counted_members, fact_immigration, member_counts

    if not all(warehouse.exists(t) for t in ("immigration", "period_counts", "rollup")):
        return rebuild_star(warehouse, seed_unknown)
    staging = warehouse.read_staging()
    mine = in_periods(PERIOD_COLUMN, periods)
    if years:
        years = sorted(years, key=lambda y: (y is not None, y))
        touched = in_periods(YEAR_PARTITION, years)
        fact = fact_immigration(staging.where(touched)).withColumn(YEAR_PARTITION, F.year("arrdate"))
        warehouse.write_parts("immigration", fact, YEAR_PARTITION, years, sort_by=FACT_SORT, rebalance=True)
        rollup = year_rollup(warehouse.read("immigration").where(touched))
        warehouse.write_parts("rollup", rollup, YEAR_PARTITION, years, rebalance=True)
    stored = warehouse.read("period_counts")
    now = member_counts(staging.where(mine), staging_counts()).persist()
    try:
        changed = changed_dimensions(stored.where(mine), now)
        if changed:  # before the counts are stored: a refresh that breaks off here is made again
            others = stored.where(~F.coalesce(mine, F.lit(False)))
            _write_dimensions(warehouse, counted_members(others.unionByName(now)), changed, seed_unknown)
        warehouse.write_periods("period_counts", now, periods, spread=True)
    finally:
        now.unpersist()
    return warehouse.read_star()
