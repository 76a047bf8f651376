"""One callable per operator / flow / question: ``(spark, sf_dir) -> DataFrame``.

Each reads the test tables under ``sf_dir`` through ``sources.fixtures`` and
runs the library's operators over the whole of them.  Steps that are
stored tables in production (lookups, staging, the star) are written once
per session and input folder under the session's shared checkpoint folder
and read back, exactly as the flows do.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.fingerprint import fingerprint
from landfall.functions.periods import period_from_file_name, period_of
from landfall.operators import quality, rollup
from landfall.operators.airports import clean_airports, distinct_values
from landfall.operators.lookups import Lookups, label_addr, label_int, label_port
from landfall.operators.profile import merged_profile, null_counts, null_ratio, profile_counts, profile_extract, type_extract
from landfall.operators.staging import fill_missing, join_label, staging_aggregate
from landfall.operators.star import Star, with_unknown_member
from landfall.plans import analysis
from landfall.plans.flows import build_warehouse, files_compared, run_all, stored_checks, with_period
from landfall.schemas import I94_RAW_COLUMNS, INT_COLUMNS, LONG_COLUMNS, PERIOD_COLUMN, STAR_TABLES, TEXT_COLUMNS
from landfall.session import freed_shuffles, open_files, scratch_path
from landfall.sources import fixtures
from landfall.sources.labels import parse_label_lines, read_label_lines, scan_labels_csv, write_label_csv
from landfall.sources.landing import land_airports, land_extracts, read_airports_csv, write_lake
from landfall.sources.warehouse import YEAR_PARTITION, Warehouse

# The star year of the test tables (the reference asks about 2016; the
# test tables' ship dates centre on the mid-1990s).
YEAR = 1996
# Of the second drop: the month delivered without a name, and the one dated long ago.
UNNAMED, OLD = "feb97", "mar97"
# Countries excluded by Q4 on the test tables (label names are upper case).
Q4_EXCLUDE = ("NATION_1", "NATION_2")

_LOCK = threading.RLock()
_BUILT: dict[tuple[str, str], tuple[Warehouse, object]] = {}
_MADE: dict[tuple[str, str, str], str] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir))


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """``make(path)`` once per session and input folder; the path, a fresh one under the shared folder."""
    k = (*_key(spark, sf_dir), name)
    with _LOCK:
        if k not in _MADE:
            path = scratch_path(spark, name)
            make(path)
            _MADE[k] = path
        return _MADE[k]


def inbox(spark: SparkSession, sf_dir: str) -> str:
    """Monthly extract folders of the test tables."""
    return _once(spark, sf_dir, "inbox", lambda p: write_lake(fixtures.i94_raw(spark, sf_dir, by_period=True), p))


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inbox, landed."""
    source = inbox(spark, sf_dir)
    return spark.read.parquet(_once(spark, sf_dir, "lake", lambda p: land_extracts(spark, source, p)))


def label_files(spark: SparkSession, sf_dir: str) -> str:
    """Label files by name: ``I94Port.txt`` and so on."""
    def make(path):
        lines = fixtures.label_lines(spark, sf_dir)
        for r in lines.select("label").distinct().collect():  # six labels
            lines.where(F.col("label") == r["label"]).select("line").write.text(f"{path}/{r['label']}.txt")
    return _once(spark, sf_dir, "label-files", make)


def fixture_warehouse(spark: SparkSession, sf_dir: str):
    """Build (once per session and folder) lookups, staging and star for ``sf_dir``."""
    k = _key(spark, sf_dir)
    with _LOCK:
        if k not in _BUILT:
            wh = Warehouse(spark, scratch_path(spark, "fixture-warehouse"))
            # counted as the rows come, and dealt by period to be written
            counts = profile_counts(fixtures.i94_raw(spark, sf_dir), [])
            res = build_warehouse(spark, fixtures.i94_raw(spark, sf_dir, by_period=True),
                                  fixtures.label_lines(spark, sf_dir), wh, counts)
            _BUILT[k] = (wh, res)
        return _BUILT[k]


def star(spark: SparkSession, sf_dir: str) -> Star:
    wh, _ = fixture_warehouse(spark, sf_dir)
    return wh.read_star()


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, _ = fixture_warehouse(spark, sf_dir)
    return wh.read_staging()


def lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    wh, _ = fixture_warehouse(spark, sf_dir)
    return Lookups.read(spark, wh.path("lookups"))


def parsed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_label_lines(fixtures.label_lines(spark, sf_dir))


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_extract(fixtures.i94_raw(spark, sf_dir)).df


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_extract(fixtures.i94_raw(spark, sf_dir))


# -- sources and sinks ---------------------------------------------------------

def land_i94(spark, sf_dir):
    """Monthly folders -> lake partitioned by period; rows and sum(count) per period."""
    return lake(spark, sf_dir).groupBy(PERIOD_COLUMN).agg(F.count(F.lit(1)).alias("row_count"),
                                                          F.sum("count").cast("bigint").alias("total_count"))


def land_i94_csv(spark, sf_dir):
    """CSV extracts whose headers differ in order and columns, landed by name."""
    def make(path):
        raw = fixtures.i94_raw(spark, sf_dir, by_period=True)
        text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
        for part, cond in (("a", F.expr("double(i94yr)") <= YEAR), ("b", F.expr("double(i94yr)") > YEAR)):
            own = [c for c in text.columns if c != PERIOD_COLUMN]
            cols = own if part == "a" else ["row_no", *reversed(own)]
            rows = text.where(cond).withColumn("row_no", F.lit("7")).select(*cols, PERIOD_COLUMN, F.ceil(F.expr("double(i94mon)") / 3).alias("quarter"))
            # gzipped, as plain text takes several times the disk of the tables; by quarters, as a write holds its shuffles
            for q in range(1, 5):
                with open_files(spark), freed_shuffles(spark):
                    (rows.where(F.col("quarter") == q).drop("quarter").write.mode("append").partitionBy(PERIOD_COLUMN).option("header", True)
                     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(f"{path}/{part}"))
    landed = land_extracts(spark, _once(spark, sf_dir, "csv-extracts", make), scratch_path(spark, "csv-lake"), "csv")
    n = {c: F.sum(c).cast("bigint").alias(f"total_{c}") for c in ("count", "i94cit", "i94res", "arrdate", "admnum")}
    return landed.groupBy(PERIOD_COLUMN).agg(F.count(F.lit(1)).alias("row_count"), *n.values(),
                                             F.count("gender").alias("n_gender"), F.min("visatype").alias("first_visatype"))


def land_airports_csv(spark, sf_dir):
    """An airport CSV with other columns and another order, landed by name with all columns."""
    path = scratch_path(spark, "airports-csv")
    df = fixtures.airports(spark, sf_dir)
    df = df.withColumn("name", F.concat(F.lit("airport "), "ident")).withColumn("coordinates", F.lit("1.5, -2.5"))
    df.select("coordinates", *reversed(df.columns[:-1])).write.option("header", True).csv(path)
    return land_airports(spark, read_airports_csv(spark, path), scratch_path(spark, "airports"))


def label_lines_parsed(spark, sf_dir):
    """S02 + P15: label text files -> (label, code, value); the files are
    written as text and read back with ``spark.read.text``."""
    root = scratch_path(spark, "labels")
    lines = fixtures.label_lines(spark, sf_dir)
    (lines.write.partitionBy("label").text(root))
    back = (spark.read.text(root).select(F.col("label"), F.col("value").alias("line")))
    return parse_label_lines(back)


def land_airports_q(spark, sf_dir):
    """Airports landed as Parquet and read back."""
    return land_airports(spark, fixtures.airports(spark, sf_dir), scratch_path(spark, "airports"))


def scan_labels_csv_q(spark, sf_dir):
    """Parsed labels landed as CSV with a header and read back as text columns."""
    root = scratch_path(spark, "labels-csv")
    write_label_csv(parsed_labels(spark, sf_dir), root)
    return scan_labels_csv(spark, root)


def sink_parquet_roundtrip(spark, sf_dir):
    """Cleaned airports written as Parquet, twice (the rerun overwrites), read back."""
    target = scratch_path(spark, "airports-clean")
    df = clean_airports(fixtures.airports(spark, sf_dir))
    for _ in range(2):
        df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def source_period(spark, sf_dir):
    """Period parsed back from extract file names built from each record."""
    raw = fixtures.i94_raw(spark, sf_dir)
    name = F.concat(F.lit("s3://lake/immigration/i94_"), period_of("i94yr", "i94mon"),
                    F.lit("_sub.sas7bdat"))
    return (raw.select(period_from_file_name(name).alias(PERIOD_COLUMN))
            .groupBy(PERIOD_COLUMN).agg(F.count(F.lit(1)).alias("row_count")))


def incremental_new_files(spark, sf_dir):
    """Three availableNow runs (early months; the rest, with files dated
    long ago and one without a month in its name; nothing new) -> staging
    totals per period, equal to one full load."""
    return (_loaded(spark, sf_dir, False).read_staging().groupBy(PERIOD_COLUMN)
            .agg(F.count(F.lit(1)).alias("row_count"), F.sum("count").alias("total_count")))


def _loaded(spark, sf_dir, refresh: bool) -> Warehouse:
    from landfall.streaming.incremental import IncrementalLoader

    raw = fixtures.i94_raw(spark, sf_dir, by_period=True)
    drop = scratch_path(spark, "stream-inbox")
    wh = Warehouse(spark, scratch_path(spark, "stream-warehouse"))
    lk = Lookups.from_parsed(parsed_labels(spark, sf_dir)).materialize(spark, wh.path("lookups"))
    loader = IncrementalLoader(spark, drop, wh, lk, refresh_star=refresh)
    early, unnamed = F.col("i94yr") <= F.lit(float(YEAR)), F.col(PERIOD_COLUMN) == UNNAMED
    write_lake(raw.where(early), drop, "append")
    loader.run()
    write_lake(raw.where((~early | F.col("i94yr").isNull()) & ~unnamed), drop, "append")
    set_file_age(spark, f"{drop}/{PERIOD_COLUMN}={OLD}", 60)
    raw.where(unnamed).drop(PERIOD_COLUMN).write.parquet(f"{drop}/february.parquet")
    loader.run()
    loader.run()
    return wh


# Of the delivered months: first faulty and then corrected, delivered twice, and completed later.
CORRECTED, TWICE, COMPLETED = "jun96", "mar97", "apr96"


def _delivered(spark, sf_dir):
    """A loader after four deliveries whose newest contents are the whole input.

    First every month, one with a wrong port and one incomplete; then one
    month a second time from another folder, in other files; the corrected
    month, from a third folder; and the rest of the incomplete one, beside its
    first part.
    """
    from landfall.streaming.incremental import IncrementalLoader

    def loader(path):
        wh = Warehouse(spark, f"{path}/warehouse")
        return IncrementalLoader(spark, f"{path}/inbox", wh, Lookups.read(spark, wh.path("lookups")), refresh_star=True)

    def make(path):
        raw = fixtures.i94_raw(spark, sf_dir, by_period=True)
        Lookups.from_parsed(parsed_labels(spark, sf_dir)).materialize(spark, f"{path}/warehouse/lookups")
        load, period, late = loader(path), F.col(PERIOD_COLUMN), F.col("cicid") % 5 == 0
        wrong = F.when((period == CORRECTED) & (F.col("cicid") % 3 == 0), F.lit("QXQ").cast("binary")).otherwise(F.col("i94port"))
        first = raw.where(~((period == COMPLETED) & late)).withColumn("i94port", wrong)
        write_lake(first, f"{path}/inbox/a")
        load.run()
        write_lake(raw.where(period.isin(TWICE, CORRECTED, COMPLETED)), f"{path}/months")
        again = spark.read.parquet(f"{path}/months")
        write_lake(again.where(period == TWICE).repartition(3), f"{path}/inbox/b")
        load.run()
        write_lake(again.where(period == CORRECTED), f"{path}/inbox/c")
        load.run()
        write_lake(again.where((period == COMPLETED) & late), f"{path}/inbox/a", "append")
        load.run()
    return loader(_once(spark, sf_dir, "delivered", make))


def redelivered_month(spark, sf_dir):
    """What the ledger did with every month's deliveries, and the staging totals they left."""
    load = _delivered(spark, sf_dir)
    steps = (load.ledger.deliveries().groupBy(PERIOD_COLUMN)
             .agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("version", "action"))), lambda x: x["action"]))
                  .alias("actions")))
    totals = load.warehouse.read_staging().groupBy(PERIOD_COLUMN).agg(F.count(F.lit(1)).alias("row_count"),
                                                                     F.sum("count").alias("total_count"))
    return steps.join(totals, PERIOD_COLUMN, "full_outer")


def staging_merged(spark, sf_dir):
    """Staging merged from the partial sums of every delivery."""
    return _delivered(spark, sf_dir).warehouse.read_staging().drop(YEAR_PARTITION)


def members_corrected(spark, sf_dir):
    """The dimensions' members after a correction took a port away."""
    s = _delivered(spark, sf_dir).warehouse.read_star()
    cols = {"visa": ("visatype", "visa_category"), "citizenship_country": ("id", "country_of_citizenship"),
            "destination_state": ("id", "destination_state"), "entry_mode": ("id", "mode_of_entry"),
            "entry_port": ("id", "port_of_entry"), "date": ("date", "weekday")}
    parts = [s.tables()[n].select(F.lit(n).alias("table_name"), F.col(a).cast("string").alias("id"), F.col(b).cast("string").alias("label"))
             for n, (a, b) in cols.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def checks_stored(spark, sf_dir):
    """Every declared check, merged from the counts kept by year and period."""
    return stored_checks(_delivered(spark, sf_dir).warehouse)


def year_rollup(spark, sf_dir):
    """The fact's totals by year and question, refreshed by year."""
    kept = _delivered(spark, sf_dir).warehouse.read("rollup")
    parts = []
    for s in rollup.SETS:
        two = [F.col(c).cast("string") for c in s] + [F.lit(None).cast("string")]
        parts.append(kept.where(F.col("gid") == F.lit(rollup.gid(s))).select(
            F.lit(",".join(s)).alias("columns"), YEAR_PARTITION, two[0].alias("first_key"), two[1].alias("second_key"),
            F.col("count").alias("totalcount"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts_stored(spark, sf_dir):
    """Null counts by period, merged from the stored counts of every delivery."""
    return merged_profile(_delivered(spark, sf_dir).profile_counts(), [PERIOD_COLUMN])


def profile_stored(spark, sf_dir):
    """The months as profiled by the counts of all deliveries together."""
    return _delivered(spark, sf_dir).profiled().drop(PERIOD_COLUMN)


def rejected_cells_q(spark, sf_dir):
    """Cells that do not parse, of CSV extracts and of Parquet ones, landed by a whole run."""
    def make(path):
        raw = fixtures.i94_raw(spark, sf_dir, by_period=True)
        n = F.col("cicid").cast("long")
        big = raw.withColumn("biryear", F.when(n % 103 == 0, F.lit(1e12)).otherwise(F.col("biryear")))
        write_lake(big.where(F.col("i94yr") > YEAR), f"{path}/parquet")
        text = raw.where(F.col("i94yr") <= YEAR).select(*[F.col(c).cast("string").alias(c) for c in raw.columns], n.alias("n"))
        text = (text.withColumn("i94cit", F.when(F.col("n") % 97 == 0, F.concat(F.lit("x"), F.col("n") % 5)).otherwise(F.col("i94cit")))
                .withColumn("arrdate", F.when(F.col("n") % 101 == 0, "n/a").otherwise(F.col("arrdate"))))
        with open_files(spark):
            text.drop("n").write.partitionBy(PERIOD_COLUMN).option("header", True).csv(f"{path}/csv")
        for fmt in ("csv", "parquet"):
            run_all(spark, f"{path}/{fmt}", label_files(spark, sf_dir), f"{path}/out-{fmt}", extract_format=fmt)
    root = _once(spark, sf_dir, "rejects", make)
    return spark.read.parquet(f"{root}/out-csv/lake/rejects").unionByName(spark.read.parquet(f"{root}/out-parquet/lake/rejects"))


def set_file_age(spark: SparkSession, folder: str, days: int) -> None:
    """Date the files of a folder ``days`` back, as a late copy would be."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(path):
        fs.setTimes(f.getPath(), f.getModificationTime() - days * 86_400_000, -1)


def star_refresh(spark, sf_dir):
    """the star kept up to date by the loader, as rows per table and the fact's sum."""
    s = _loaded(spark, sf_dir, True).read_star()
    out = s.immigration.agg(F.sum("count").alias("row_count")).select(F.lit("immigration_total").alias("table_name"), "row_count")
    for name, df in s.tables().items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = out.unionByName(one)
    return out


def run_all_checks(spark, sf_dir):
    """F01-F06 over files on disk: every check row of one run."""
    def make(path):
        run_all(spark, inbox(spark, sf_dir), label_files(spark, sf_dir), path)
    return spark.read.parquet(f"{_once(spark, sf_dir, 'run', make)}/warehouse/checks")


def run_twice(spark, sf_dir):
    """Two drops into one root -> staging totals, and whether every period's own run reconciled."""
    raw = fixtures.i94_raw(spark, sf_dir, by_period=True)
    root, seen = scratch_path(spark, "run-twice"), []
    for name, cond in (("first", F.col("i94yr") <= YEAR), ("second", F.col("i94yr") > YEAR)):
        write_lake(raw.where(cond), f"{root}/{name}")
        _, checks = run_all(spark, f"{root}/{name}", label_files(spark, sf_dir), f"{root}/out")
        part = checks.where(F.col("check_name").isin("reconcile_land", "reconcile_staged"))
        write = part.select(F.col("column_name").alias(PERIOD_COLUMN), "passed").write
        write.parquet(f"{root}/checks-{name}")
        seen.append(spark.read.parquet(f"{root}/checks-{name}"))
    ok = seen[0].unionByName(seen[1]).groupBy(PERIOD_COLUMN).agg(F.every("passed").alias("reconciled"))
    totals = (Warehouse(spark, f"{root}/out/warehouse").read_staging().groupBy(PERIOD_COLUMN)
              .agg(F.count(F.lit(1)).alias("row_count"), F.sum("count").alias("total_count")))
    return totals.join(ok, PERIOD_COLUMN, "full_outer")


def dim_with_unknown(spark, sf_dir):
    """Dimensions seeded with their unknown member, added only when absent."""
    s = star(spark, sf_dir)
    visa = with_unknown_member(spark, s.visa, "visa").select(
        F.lit("visa").alias("table_name"), F.col("visatype").alias("id"),
        F.col("visa_category_code").alias("code"), F.col("visa_category").alias("label"))
    cit = with_unknown_member(spark, s.citizenship_country, "citizenship_country").select(
        F.lit("citizenship_country").alias("table_name"), F.col("id").cast("string").alias("id"),
        F.lit(None).cast("int").alias("code"), F.col("country_of_citizenship").alias("label"))
    st = with_unknown_member(spark, s.destination_state, "destination_state").select(
        F.lit("destination_state").alias("table_name"), F.col("id"),
        F.lit(None).cast("int").alias("code"), F.col("destination_state").alias("label"))
    return visa.unionByName(cit).unionByName(st)


# -- projections, casts, labels -------------------------------------------------

def cast_i94_types(spark, sf_dir):
    return typed(spark, sf_dir).select(*LONG_COLUMNS, *INT_COLUMNS)


def cast_binary_text(spark, sf_dir):
    return typed(spark, sf_dir).select(*TEXT_COLUMNS)


def sas_dates(spark, sf_dir):
    return typed(spark, sf_dir).select("cicid", "arrdate", "depdate")


def airport_code_q(spark, sf_dir):
    return clean_airports(fixtures.airports(spark, sf_dir)).select("ident", "airport_code")


def fill_missing_q(spark, sf_dir):
    return fill_missing(typed(spark, sf_dir).select(*TEXT_COLUMNS))


def airports_clean(spark, sf_dir):
    return clean_airports(fixtures.airports(spark, sf_dir))


def distinct_continent(spark, sf_dir):
    return distinct_values(fixtures.airports(spark, sf_dir), "continent")


def profile_i94(spark, sf_dir):
    return profiled(spark, sf_dir)


def label_port_q(spark, sf_dir):
    return label_port(parsed_labels(spark, sf_dir))


def label_addr_q(spark, sf_dir):
    return label_addr(parsed_labels(spark, sf_dir))


def label_int_q(spark, sf_dir):
    return label_int(parsed_labels(spark, sf_dir))


# -- joins -------------------------------------------------------------------------

def _agg(spark, sf_dir):
    return staging_aggregate(profiled(spark, sf_dir))


def _join(which: str, key: str, label: str, how: str = "left"):
    def run(spark, sf_dir):
        lk = Lookups.from_parsed(parsed_labels(spark, sf_dir))
        return join_label(_agg(spark, sf_dir), getattr(lk, which), key, label, how)
    run.__name__ = f"join_{which}"
    return run


def orphans(spark, sf_dir):
    s = star(spark, sf_dir)
    return quality.foreign_keys(s.tables())


# -- aggregates ----------------------------------------------------------------------

def staging_agg(spark, sf_dir):
    return _agg(spark, sf_dir)


def staging_q(spark, sf_dir):
    return staging(spark, sf_dir).drop(YEAR_PARTITION)


def fact_immigration(spark, sf_dir):
    return star(spark, sf_dir).immigration.drop(YEAR_PARTITION)


def _dim(name: str):
    def run(spark, sf_dir):
        return getattr(star(spark, sf_dir), name)
    run.__name__ = f"dim_{name}"
    return run


def row_counts(spark, sf_dir):
    """Rows of every stage, as (table_name, rows)."""
    s = star(spark, sf_dir)
    parts = [("i94_raw", fixtures.i94_raw(spark, sf_dir)), ("immigration_stage", s.staging)]
    parts += [(n, s.tables()[n]) for n in STAR_TABLES]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def files_per_source(spark, sf_dir):
    """Delivered files against landed ones, by period and by label."""
    def names(df, column):
        return df.select(F.col(column).alias("name"))

    def make(path):
        read_label_lines(spark, label_files(spark, sf_dir)).write.parquet(path)
    landed = spark.read.parquet(_once(spark, sf_dir, "labels-landed", make))
    return files_compared({
        "immigration": (names(spark.read.parquet(inbox(spark, sf_dir)), PERIOD_COLUMN), names(lake(spark, sf_dir), PERIOD_COLUMN)),
        "labels": (names(read_label_lines(spark, label_files(spark, sf_dir)), "label"), names(landed, "label"))})


def null_counts_q(spark, sf_dir):
    return null_counts(with_period(typed(spark, sf_dir)), by=[PERIOD_COLUMN])


def null_ratio_q(spark, sf_dir):
    return null_ratio(typed(spark, sf_dir))


# -- quality --------------------------------------------------------------------------

def _all_tables(spark, sf_dir):
    s = star(spark, sf_dir)
    t = {"immigration_stage": s.staging.drop(PERIOD_COLUMN, YEAR_PARTITION)}
    t.update({n: df.drop(YEAR_PARTITION) if n == "immigration" else df for n, df in s.tables().items()})
    return t


def dq_nonempty(spark, sf_dir):
    return quality.nonempty(_all_tables(spark, sf_dir))


def dq_not_null(spark, sf_dir):
    return quality.not_null(_all_tables(spark, sf_dir))


def dq_width(spark, sf_dir):
    return quality.width(_all_tables(spark, sf_dir))


def dq_unique_key(spark, sf_dir):
    return quality.unique_key(_all_tables(spark, sf_dir))


def dq_mode_dropped(spark, sf_dir):
    lk = Lookups.from_parsed(parsed_labels(spark, sf_dir))
    return quality.mode_dropped(_agg(spark, sf_dir), lk.mode)


def dq_reconcile_land(spark, sf_dir):
    """Rows per period in the source folders and in the lake."""
    return quality.reconcile(spark.read.parquet(inbox(spark, sf_dir)), lake(spark, sf_dir))


def dq_reconcile_content(spark, sf_dir):
    """The contents of every period, cell by cell, in the source folders and in the lake."""
    def sides(df):
        return df.groupBy(PERIOD_COLUMN).agg(*fingerprint(I94_RAW_COLUMNS))
    return quality.reconcile_content(sides(spark.read.parquet(inbox(spark, sf_dir))), sides(lake(spark, sf_dir)))


def dq_reconcile_profile(spark, sf_dir):
    """Rows per period in the lake and in the profiled output."""
    target = scratch_path(spark, "profiled")
    write_lake(profile_extract(lake(spark, sf_dir)).df, target)
    return quality.reconcile(lake(spark, sf_dir), spark.read.parquet(target))


# -- questions --------------------------------------------------------------------------

def q1(spark, sf_dir):
    return analysis.top_visa_types(star(spark, sf_dir), YEAR)


def q2(spark, sf_dir):
    return analysis.top_visa_categories(star(spark, sf_dir), YEAR, gender="F")


def q3(spark, sf_dir):
    return analysis.state_totals_by_visa(star(spark, sf_dir), YEAR)


def q3_top_state(spark, sf_dir):
    return analysis.top_state_per_visa(star(spark, sf_dir), YEAR)


def q4(spark, sf_dir):
    return analysis.top_countries(star(spark, sf_dir), YEAR, gender="F", exclude=Q4_EXCLUDE)


def q5(spark, sf_dir):
    return analysis.top_mode_except(star(spark, sf_dir), YEAR, exclude="Air")


def q6(spark, sf_dir):
    return analysis.top_ports(star(spark, sf_dir), YEAR)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources and sinks
    "land_i94": land_i94,
    "label_lines_parsed": label_lines_parsed,
    "land_airports": land_airports_q,
    "land_i94_csv": land_i94_csv,
    "land_airports_csv": land_airports_csv,
    "scan_labels_csv": scan_labels_csv_q,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "source_period": source_period,
    "incremental_new_files": incremental_new_files,
    "redelivered_month": redelivered_month,
    "dim_with_unknown": dim_with_unknown,
    # projections and scalar functions
    "cast_i94_types": cast_i94_types,
    "cast_binary_text": cast_binary_text,
    "sas_dates": sas_dates,
    "airport_code": airport_code_q,
    "fill_missing": fill_missing_q,
    "airports_clean": airports_clean,
    "distinct_continent": distinct_continent,
    "profile_i94": profile_i94,
    "profile_stored": profile_stored,
    "rejected_cells": rejected_cells_q,
    "label_port": label_port_q,
    "label_addr": label_addr_q,
    "label_int": label_int_q,
    # joins
    "join_visa": _join("visa", "i94visa", "visa_category"),
    "join_country": _join("citizenship", "i94cit", "country_of_citizenship"),
    "join_state": _join("state", "i94addr", "destination_state"),
    "join_port": _join("port", "i94port", "port_of_entry"),
    "join_mode": _join("mode", "i94mode", "mode_of_entry", "inner"),
    "orphans": orphans,
    # aggregates and flows
    "staging_agg": staging_agg,
    "staging": staging_q,
    "staging_merged": staging_merged,
    "members_corrected": members_corrected,
    "fact_immigration": fact_immigration,
    "dim_visa": _dim("visa"),
    "dim_country": _dim("citizenship_country"),
    "dim_port": _dim("entry_port"),
    "dim_mode": _dim("entry_mode"),
    "dim_state": _dim("destination_state"),
    "dim_date": _dim("date"),
    "row_counts": row_counts,
    "files_per_source": files_per_source,
    "star_refresh": star_refresh,
    "year_rollup": year_rollup,
    "run_all_checks": run_all_checks,
    "run_twice": run_twice,
    "null_counts": null_counts_q,
    "null_ratio": null_ratio_q,
    "null_counts_stored": null_counts_stored,
    # quality
    "dq_nonempty": dq_nonempty,
    "dq_not_null": dq_not_null,
    "dq_width": dq_width,
    "dq_unique_key": dq_unique_key,
    "dq_mode_dropped": dq_mode_dropped,
    "checks_stored": checks_stored,
    "dq_reconcile_land": dq_reconcile_land,
    "dq_reconcile_content": dq_reconcile_content,
    "dq_reconcile_profile": dq_reconcile_profile,
    # questions
    "q1": q1,
    "q2": q2,
    "q3": q3,
    "q3_top_state": q3_top_state,
    "q4": q4,
    "q5": q5,
    "q6": q6,
}
