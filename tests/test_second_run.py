"""Late, unnamed and corrected deliveries; several runs over one root."""

import types

import pytest
from pyspark.sql import functions as F

from landfall.functions import period_from_file_name, period_of
from landfall.operators import quality
from landfall.operators.lookups import Lookups
from landfall.plans import analysis
from landfall.plans import catalog as C
from landfall.plans.flows import build_warehouse, rebuild_star, run_all, with_period
from landfall.schemas import CONTRACTS
from landfall.session import shared_dir
from landfall.sources import fixtures
from landfall.sources.landing import land_extracts, read_airports_csv, write_lake
from landfall.sources.warehouse import Warehouse, create_table_ddl
from landfall.streaming.incremental import IncrementalLoader
from tests.conftest import SF001, rows


def months(spark, *names):
    return with_period(fixtures.i94_raw(spark, SF001)).where(F.col("source_period").isin(*names))


def loader(spark, scratch, **kw):
    wh = Warehouse(spark, f"{scratch}/wh")
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001)).materialize(spark, wh.path("lookups"))
    return wh, IncrementalLoader(spark, f"{scratch}/inbox", wh, lk, **kw)


def periods(df):
    return {r[0] for r in df.select("source_period").distinct().collect()}


def test_old_dated_and_unnamed_files_are_loaded(spark, scratch):
    wh, load = loader(spark, scratch, refresh_star=True)
    write_lake(months(spark, "jan96"), f"{scratch}/inbox")
    assert load.missing_files().count() > 0
    load.run()
    assert load.missing_files().count() == 0
    write_lake(months(spark, "feb96"), f"{scratch}/inbox")
    C.set_file_age(spark, f"{scratch}/inbox/source_period=feb96", 400)
    months(spark, "mar96").drop("source_period").coalesce(1).write.parquet(f"{scratch}/inbox/march.parquet")
    load.run()
    assert load.missing_files().count() == 0
    staged = wh.read_staging()
    assert periods(staged) == {"jan96", "feb96", None}
    whole = C.staging(spark, SF001).where("source_period IN ('jan96', 'feb96', 'mar96')")
    assert staged.agg(F.sum("count")).first() == whole.agg(F.sum("count")).first()
    assert rows(wh.read("visa")) == rows(rebuild_star(wh).visa)


def test_a_month_emptied_by_its_correction_leaves_staging_and_star(spark, scratch):
    wh, load = loader(spark, scratch, refresh_star=True)
    write_lake(months(spark, "jan96", "jan97"), f"{scratch}/inbox")
    load.run()
    assert {r[0] for r in wh.read("immigration").select("arrival_year").distinct().collect()} >= {1996, 1997}
    # the corrected month has only modes without a label
    bad = with_period(fixtures.i94_raw(spark, SF001)).where("source_period = 'jan97'").withColumn("i94mode", F.lit(7.0))
    write_lake(bad, f"{scratch}/fixed")
    run = build_warehouse(spark, spark.read.parquet(f"{scratch}/fixed"), fixtures.label_lines(spark, SF001), wh,
                          periods=["jan97"])
    assert periods(run.staging) == {"jan96"}
    assert {r[0] for r in run.star.immigration.select("arrival_year").distinct().collect()} == {1996}


def label_dir(spark, scratch):
    return C.label_files(spark, SF001)


def test_second_run_sees_only_its_own_months(spark, scratch):
    for drop in (("jan96", "feb96"), ("mar96",)):
        write_lake(months(spark, *drop), f"{scratch}/{drop[0]}")
        star, checks = run_all(spark, f"{scratch}/{drop[0]}", label_dir(spark, scratch), f"{scratch}/root", seed_unknown=True)
        got = {(r["check_name"], r["column_name"]): r for r in checks.collect()}
        landed = {c for n, c in got if n == "reconcile_land"}
        assert landed == set(drop)
        assert all(got[n, p]["passed"] for n in ("reconcile_land", "reconcile_staged") for p in drop)
        assert got["files", "immigration"]["passed"] and got["files", "labels"]["passed"]
        assert sum(got["mode_loss", p]["bad_rows"] for p in drop) > 0
    wh = Warehouse(spark, f"{scratch}/root/warehouse")
    assert periods(wh.read_staging()) == {"jan96", "feb96", "mar96"} == periods(wh.read("profiled"))
    whole = C.staging(spark, SF001).where("source_period IN ('jan96', 'feb96', 'mar96')")
    assert wh.read_staging().agg(F.sum("count")).first() == whole.agg(F.sum("count")).first()
    assert star.citizenship_country.where("id = 999").count() == 1  # seeded on demand


def test_lost_rows_fail_the_staged_check(spark, scratch):
    profiled = spark.createDataFrame([("jan16", 1, 2), ("jan16", None, 1), (None, 1, 1)], "source_period string, i94mode int, count long")
    modes = spark.createDataFrame([(1, "Air")], "code int, value string")
    staged = spark.createDataFrame([("jan16", 1), (None, 1)], "source_period string, count long")
    got = {r["source_period"]: tuple(r)[1:] for r in quality.reconcile_totals(profiled, staged, modes).collect()}
    assert got == {"jan16": (3, 1, 1, False), None: (1, 0, 1, True)}


def test_reconcile_takes_a_null_period_as_one_group(spark):
    df = spark.createDataFrame([(None,), ("jan16",)], "source_period string")
    got = {r[0]: tuple(r)[1:] for r in quality.reconcile(df, df).collect()}
    assert got == {None: (1, 1, True), "jan16": (1, 1, True)}


def test_repeated_lookup_codes_stop_the_build(spark, scratch):
    lines = fixtures.label_lines(spark, SF001)
    twice = lines.unionByName(spark.createDataFrame([("I94Port", " 'P10' = 'AGAIN'")], "label string, line string"))
    with pytest.raises(ValueError, match="lookup_port"):
        build_warehouse(spark, months(spark, "jan96"), twice, Warehouse(spark, scratch))


def write_csv(path, header, *lines):
    path.write_text("\n".join([header, *lines]) + "\n")


def test_csv_extracts_are_read_by_name(spark, scratch, tmp_path):
    need = "arrdate,i94port,i94mode,i94addr,gender,visatype,i94visa,count"
    write_csv(tmp_path / "i94_jan16_sub.csv", f"i94cit,i94res,{need}", "101,202,20454,NYC,1,NY,F,B2,2,1")
    write_csv(tmp_path / "i94_feb16_sub.csv", f",i94res,{need},i94cit", "0,202,20490,NYC,1,NY,F,B2,2,x,101")
    lake = land_extracts(spark, str(tmp_path), f"{scratch}/lake", "csv")
    got = {r["source_period"]: (r["i94cit"], r["i94res"], r["arrdate"], r["count"]) for r in lake.collect()}
    assert got == {"jan16": (101.0, 202.0, 20454.0, 1.0), "feb16": (101.0, 202.0, 20490.0, None)}
    write_csv(tmp_path / "i94_mar16_sub.csv", "i94res,i94cit", "1,2")
    with pytest.raises(ValueError, match="lacks"):
        land_extracts(spark, str(tmp_path), f"{scratch}/lake2", "csv")


def test_airport_csv_keeps_all_columns(spark, tmp_path):
    names = "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,coordinates"
    write_csv(tmp_path / "airports.csv", names, 'K1,small,"One, the",11,NA,US,US-NY,Town,K1,,L1,"1, 2"', "K2,large,Two,high,,,,,,I2,,")
    df = read_airports_csv(spark, str(tmp_path / "airports.csv"))
    assert sorted(df.columns) == sorted(names.split(","))
    got = {r["ident"]: (r["elevation_ft"], r["continent"], r["local_code"], r["name"]) for r in df.collect()}
    assert got == {"K1": (11.0, "NA", "L1", "One, the"), "K2": (None, None, None, "Two")}


def test_q4_leaves_out_china_by_default(spark):
    star = C.star(spark, SF001)
    names = spark.createDataFrame([(101, "CHINA, PRC"), (102, "INDIA"), (103, "ELSEWHERE")], "id int, country_of_citizenship string")
    star.citizenship_country = names
    assert [r[0] for r in analysis.top_countries(star, 1996).collect()] == ["ELSEWHERE"]


def test_building_a_question_runs_no_job(spark):
    star = C.star(spark, SF001)
    spark.sparkContext.setJobGroup("building", "")
    try:
        df = analysis.top_visa_types(star, 1996)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_staging_is_pruned_by_year(spark):
    star = C.star(spark, SF001)
    plan = analysis.top_visa_categories(star, 1996)._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.splitlines() if "FileScan" in x and "gender" in x][0]
    assert "arrival_year" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_periods_that_are_none(spark):
    df = spark.createDataFrame([(2016.0, 13.0), (2016.0, 4.0), (None, 1.0)], "y double, m double")
    assert [r[0] for r in df.select(period_of("y", "m")).collect()] == [None, "apr16", None]
    names = spark.createDataFrame([("x/february.parquet",), ("i94_jan16_sub.csv",), ("a_b_c.csv",)], "f string")
    assert [r[0] for r in names.select(period_from_file_name("f")).collect()] == [None, "jan16", None]


def test_tables_in_the_catalog(spark):
    wh, _ = C.fixture_warehouse(spark, SF001)
    names = wh.register_tables("landfall_test")
    assert "landfall_test.immigration" in names
    try:
        assert spark.table("landfall_test.immigration").where("arrival_year = 1996").count() \
            == wh.read("immigration").where("arrival_year = 1996").count() > 0
        told = {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql("DESCRIBE landfall_test.immigration").collect()}
        assert told["gender"] == ("string", "VARCHAR(1) NOT NULL")
        assert told["i94cit"] == ("int", "NOT NULL REFERENCES citizenship_country(id)")
        assert spark.table("landfall_test.immigration").columns == CONTRACTS["immigration"].columns + ["arrival_year"]
        assert spark.table("landfall_test.immigration_stage").columns[:14] == CONTRACTS["immigration_stage"].columns
        key = spark.sql("SHOW TBLPROPERTIES landfall_test.entry_port ('primary.key')").first()["value"]
        assert key == "id" and spark.table("landfall_test.entry_port").count() == wh.read("entry_port").count()
    finally:
        spark.sql("DROP DATABASE landfall_test CASCADE")
    assert wh.read("immigration").count() > 0  # the files stay
    with pytest.raises(ValueError, match="lacks"):
        create_table_ddl("t", "x", CONTRACTS["entry_port"], wh.read("entry_mode").schema)


def test_shared_folder_must_be_named_off_local():
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = types.SimpleNamespace(sparkContext=context, conf=types.SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake)
