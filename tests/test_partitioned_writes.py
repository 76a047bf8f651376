"""Writes by period without a sort, extracts dealt by period, and path columns made once a file."""

import pytest
from pyspark.sql import functions as F

from landfall.functions.periods import period_from_path
from landfall.operators.rejects import rejected_cells
from landfall.plans.flows import with_period
from landfall.session import open_files
from landfall.sources import fixtures, landing
from landfall.sources.ledger import delivery_stem
from landfall.sources.landing import list_files, read_extracts, with_path_columns, write_lake
from landfall.sources.warehouse import Warehouse
from tests.conftest import SF001, rows

CONF = "spark.sql.maxConcurrentOutputFileWriters"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_open_files_holds_within_and_is_restored(spark):
    before = spark.conf.get(CONF, "0")
    with pytest.raises(ValueError):
        with open_files(spark, 7):
            assert spark.conf.get(CONF) == "7"
            raise ValueError
    assert spark.conf.get(CONF, "0") == before


def test_tasks_with_more_folders_than_open_files_write_every_row(spark, scratch):
    df = spark.range(3000).withColumn("p", F.col("id") % 30).repartition(3)
    with open_files(spark, 4):
        df.write.partitionBy("p").parquet(scratch)
    assert rows(spark.read.parquet(scratch).groupBy("p").count()) == [(p, 100) for p in range(30)]


def test_partitioned_writes_run_with_open_files(spark, scratch):
    """The write of a lake or a table by folder sees the setting; a table sorted in its files does not."""
    seen = []

    df = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("source_period"))
    real = type(df.write).parquet

    def parquet(self, *a, **b):
        seen.append(int(spark.conf.get(CONF, "0")) > 0)
        return real(self, *a, **b)

    type(df.write).parquet = parquet
    try:
        write_lake(df, f"{scratch}/lake")
        wh = Warehouse(spark, scratch)
        wh.write("plain", df, partition_by=["source_period"])
        wh.write("sorted", df, partition_by=["source_period"], sort_by=["id"])
    finally:
        type(df.write).parquet = real
    assert seen == [True, True, False]
    for t in ("lake", "plain", "sorted"):
        assert spark.read.parquet(f"{scratch}/{t}").count() == 40


def test_extracts_dealt_by_period_make_a_file_a_month(spark, scratch):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # as with many tasks
    try:
        write_lake(fixtures.i94_raw(spark, SF001, by_period=True), scratch)
    finally:
        spark.conf.set(name, before)
    back = spark.read.parquet(scratch)
    files = list_files(spark, scratch).where(F.col("file").contains("/part-")).count()
    assert files == back.select("source_period").distinct().count() > 50
    want = with_period(fixtures.i94_raw(spark, SF001))
    assert back.exceptAll(want).count() == want.exceptAll(back).count() == 0


def test_path_columns_are_made_once_a_file(spark, scratch, monkeypatch):
    df = with_period(fixtures.i94_raw(spark, SF001)).where(F.col("source_period").isin("jan96", "feb96"))
    write_lake(df, f"{scratch}/in")
    got = read_extracts(spark, f"{scratch}/in", more={"stem": delivery_stem})
    assert "Join LeftOuter" in plan(got)
    of = {"source_period": period_from_path, "stem": delivery_stem}
    raw = spark.read.parquet(f"{scratch}/in/source_period=jan96", f"{scratch}/in/source_period=feb96")
    # a file that came after the listing
    late = with_path_columns(raw, f"{scratch}/in/source_period=jan96", of, ["cicid"])
    monkeypatch.setattr(landing, "NAMED_FILES", 0)  # row by row
    each = read_extracts(spark, f"{scratch}/in", more={"stem": delivery_stem})
    assert "Join" not in plan(each)
    assert got.columns == each.columns and rows(got.select(each.columns)) == rows(each)
    assert rows(late) == rows(each.select("cicid", *of))
    assert {r["stem"] for r in got.select("stem").distinct().collect()} == {"jan96", "feb96"}


def test_rejected_cells_of_text_numbers(spark):
    """A cell of text that is no number is rejected; a blank one is empty."""
    df = spark.createDataFrame([("x", 1.0), ("  ", 2.0), (None, 1e30), ("7", None)], "i94cit string, biryear double")
    got = rejected_cells(df.withColumn("source_period", F.lit("jan96")))
    assert rows(got) == [("jan96", "biryear", "1.0E30", 1), ("jan96", "i94cit", "x", 1)]


def test_orders_meet_customers_before_lineitem(spark):
    """The largest table is moved once."""
    lines = plan(fixtures.i94_raw(spark, SF001)).splitlines()
    depth = {t: next(len(x) - len(x.lstrip(" :+-")) for x in lines if "Relation" in x and t in x)
             for t in ("l_orderkey", "o_orderkey", "c_custkey")}
    assert depth["l_orderkey"] < depth["o_orderkey"] == depth["c_custkey"]
