"""The checks catch injected faults."""

import datetime as dt

from pyspark.sql import functions as F

from landfall.operators import quality
from landfall.plans import catalog as C
from tests.conftest import SF001


def results(df):
    return {(r["check_name"], r["table_name"], r["column_name"]): r["bad_rows"] for r in df.collect()}


def tables(spark):
    s = C.star(spark, SF001)
    t = {n: d for n, d in s.tables().items()}
    t["immigration"] = t["immigration"].drop("arrival_year")
    return t


def test_clean_star_known_findings(spark):
    r = results(quality.star_suite(tables(spark)))
    # visa CP has three categories: the declared key is not unique
    assert r[("unique_key", "visa", "visatype")] == 3
    assert r[("unique_key", "entry_port", "id")] == 0
    # 'missing' (7 chars) does not fit gender CHAR(1)
    assert r[("width", "immigration", "gender")] > 0
    assert all(v == 0 for k, v in r.items() if k[0] in ("nonempty", "foreign_key", "not_null"))


def test_injected_faults_are_flagged(spark):
    t = tables(spark)
    fact = t["immigration"]
    bad_row = spark.createDataFrame(
        [(dt.date(1996, 5, 1), 999, "XXX", None, "S1", "F", "B2", 1)], fact.schema)
    t["immigration"] = fact.unionByName(bad_row)
    dup = t["entry_mode"].limit(1)
    t["entry_mode"] = t["entry_mode"].unionByName(dup)
    long_label = spark.createDataFrame([(777, "A" * 40)], t["citizenship_country"].schema)
    t["citizenship_country"] = t["citizenship_country"].unionByName(long_label)
    r = results(quality.star_suite(t))
    assert r[("foreign_key", "immigration", "i94cit")] == 1      # orphan country 999
    assert r[("foreign_key", "immigration", "i94port")] == 1     # orphan port XXX
    assert r[("not_null", "immigration", "i94mode")] == 1        # null mode
    assert r[("unique_key", "entry_mode", "id")] == 2            # duplicated key
    assert r[("width", "citizenship_country", "country_of_citizenship")] == 1


def test_empty_table_fails_nonempty(spark):
    t = tables(spark)
    r = results(quality.nonempty({"date": t["date"].where(F.lit(False)), "visa": t["visa"]}))
    assert r[("nonempty", "date", None)] == 1 and r[("nonempty", "visa", None)] == 0


def test_reconcile_reports_missing_period(spark):
    src = spark.createDataFrame([("jan16",), ("jan16",), ("feb16",)], "source_period string")
    tgt = spark.createDataFrame([("jan16",), ("jan16",)], "source_period string")
    got = {r[0]: tuple(r[1:]) for r in quality.reconcile(src, tgt).collect()}
    assert got == {"jan16": (2, 2, True), "feb16": (1, 0, False)}


def test_stored_checks_equal_the_full_suite(spark, scratch):
    """Counts kept by year and period give the rows of a full pass, also after one month, and read neither big table."""
    from landfall.plans.flows import build_warehouse, refresh_star, stored_checks, with_period
    from landfall.sources import fixtures
    from landfall.sources.warehouse import Warehouse

    raw = with_period(fixtures.i94_raw(spark, SF001)).where("source_period IN ('jan96', 'feb96', 'jan97')")
    wh = Warehouse(spark, scratch)
    build_warehouse(spark, raw, fixtures.label_lines(spark, SF001), wh)

    def full():
        s = wh.read_star()
        t = {"immigration_stage": s.staging.drop("source_period", "arrival_year")}
        t.update({n: d.drop("arrival_year") for n, d in s.tables().items()})
        return sorted(map(str, quality.star_suite(t).collect()))

    def stored():
        return sorted(map(str, stored_checks(wh).select("check_name", "table_name", "column_name", "bad_rows", "passed").collect()))

    assert stored() == full()
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = stored_checks(wh)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "/immigration]" not in plan and "/immigration_stage]" not in plan and "/rollup]" in plan
    # one month comes in with faults: an unknown mode is lost, a text too long, a null key
    staged = wh.read_staging().where("source_period = 'jan97'")
    faulty = staged.withColumn("i94addr", F.lit("X" * 30)).withColumn("i94cit", F.lit(None).cast("int"))
    faulty.write.parquet(f"{scratch}-faulty")
    wh.write_staging(spark.read.parquet(f"{scratch}-faulty"), ["jan97"])
    before = set(wh.files("rollup")), set(wh.files("period_counts"))
    refresh_star(wh, {1997}, ["jan97"])
    assert stored() == full() and any("width" in r and "i94addr" in r and "passed=False" in r for r in stored())
    changed = (set(wh.files("rollup")) ^ before[0]) | (set(wh.files("period_counts")) ^ before[1])
    assert changed and all("arrival_year=1997" in f or "source_period=jan97" in f for f in changed)
    # a dimension that loses a member makes orphans of years that were not touched
    ports = wh.read("entry_port")
    wh.write("entry_port", spark.createDataFrame([tuple(r) for r in ports.collect() if r["id"] != "P11"], ports.schema))
    assert stored() == full() and any("foreign_key" in r and "i94port" in r and "passed=False" in r for r in stored())
