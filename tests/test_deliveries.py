"""The delivery ledger, additive staging, counted members, content fingerprints, stored profile and rejected cells."""

import os

import pytest
from pyspark.sql import functions as F

from landfall.functions.fingerprint import FINGERPRINT, fingerprint
from landfall.functions.periods import period_from_file_name, period_from_path
from landfall.operators import quality
from landfall.operators.lookups import Lookups
from landfall.operators.profile import merged_profile, null_counts, type_extract
from landfall.operators.rejects import rejected_cells
from landfall.operators.star import build_star
from landfall.plans import catalog as C
from landfall.plans.flows import build_warehouse, run_all, with_period
from landfall.schemas import I94_RAW_COLUMNS
from landfall.sources import fixtures
from landfall.sources.landing import write_lake
from landfall.sources.ledger import delivery_location, delivery_stem
from landfall.sources.warehouse import Warehouse
from landfall.streaming.incremental import IncrementalLoader
from tests.conftest import SF001, rows


def months(spark, *names):
    return with_period(fixtures.i94_raw(spark, SF001)).where(F.col("source_period").isin(*names))


def loader(spark, scratch, **kw):
    wh = Warehouse(spark, f"{scratch}/wh")
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001)).materialize(spark, wh.path("lookups"))
    return IncrementalLoader(spark, f"{scratch}/inbox", wh, lk, **kw)


def drop(df, scratch, name):
    """One delivered file of ``name`` (a folder that Spark wrote)."""
    df.drop("source_period").coalesce(1).write.mode("overwrite").parquet(f"{scratch}/inbox/{name}")


def total(load):
    return load.warehouse.read_staging().agg(F.sum("count")).first()[0]


def actions(load):
    return [(r["stem"], r["action"]) for r in load.ledger.deliveries().orderBy("version", "stem").collect()]


def test_stems_and_places(spark):
    paths = {"file:/in/a/i94_jan96_sub.parquet": ("i94_jan96_sub", "file:/in/a"),
             "file:/in/a/i94_jan96_sub.csv/part-0-x.csv.gz": ("i94_jan96_sub", "file:/in/a"),
             "s3://b/in/source_period=jan96/part-00000.parquet": ("jan96", "s3://b/in"),
             "s3://b/in/source_period=jan96/i94_jan96_sub.parquet": ("i94_jan96_sub", "s3://b/in/source_period=jan96")}
    df = spark.createDataFrame([(p,) for p in paths], "f string").select("f", delivery_stem("f"), delivery_location("f"))
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == paths


def test_period_labels_have_one_case_and_are_months(spark):
    names = {"i94_JAN96_sub.sas": "jan96", "i94_jan96_sub.sas": "jan96", "i94_xyz16_sub.csv": None, "i94_Sep01_sub.csv": "sep01"}
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert {r[0]: r[1] for r in df.select("f", period_from_file_name("f")).collect()} == names
    one = spark.createDataFrame([("x/source_period=FEB97/part-0.parquet",)], "f string")
    assert one.select(period_from_path("f")).first()[0] == "feb97"


def test_a_month_delivered_twice_counts_once(spark, scratch):
    load = loader(spark, scratch, refresh_star=True)
    mar = months(spark, "mar97")
    drop(mar, scratch, "a/i94_mar97_sub.parquet")
    load.run()
    once, staged = total(load), rows(load.warehouse.read_staging())
    files = load.warehouse.files("immigration_stage")
    # the same rows in another folder, order and number of files
    mar.drop("source_period").repartition(4).write.parquet(f"{scratch}/inbox/b/i94_mar97_sub.parquet")
    load.run()
    assert total(load) == once and load.warehouse.files("immigration_stage") == files  # staging was not written again
    assert actions(load) == [("i94_mar97_sub", "replaced"), ("i94_mar97_sub", "duplicate")]
    assert load.current_lake().count() == mar.count() == load.lake().count()  # the second copy is not kept
    # a correction replaces it, from wherever it comes
    drop(mar.where("cicid % 2 = 0"), scratch, "c/i94_mar97_sub.parquet")
    load.run()
    want = C.staging(spark, SF001).where("source_period = 'mar97'")
    full = build_warehouse(spark, mar.where("cicid % 2 = 0"), fixtures.label_lines(spark, SF001), Warehouse(spark, f"{scratch}/one"))
    cols = [c for c in want.columns]
    assert rows(load.warehouse.read_staging().select(cols)) == rows(full.staging.select(cols)) != staged
    assert rows(load.warehouse.read_star().immigration) == rows(full.star.immigration)
    assert load.missing_files().count() == 0


def test_a_file_corrected_under_its_own_path_is_loaded(spark, scratch):
    load = loader(spark, scratch)
    jan = months(spark, "jan96")
    drop(jan, scratch, "i94_jan96_sub.parquet")
    load.run()
    folder = f"{scratch}/inbox/i94_jan96_sub.parquet".replace("file:", "")
    name = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    jan.where("cicid % 2 = 0").drop("source_period").coalesce(1).write.parquet(f"{scratch}/new")
    other = next(f for f in os.listdir(f"{scratch}/new".replace("file:", "")) if f.endswith(".parquet"))
    with open(os.path.join(f"{scratch}/new".replace("file:", ""), other), "rb") as f:
        data = f.read()
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)
    crc = os.path.join(folder, f".{name}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert load.missing_files().count() == 1
    load.run()
    assert actions(load) == [("i94_jan96_sub", "replaced")] * 2
    assert load.current_lake().count() == jan.where("cicid % 2 = 0").count()


def test_a_late_file_is_merged_without_reading_the_month(spark, scratch, monkeypatch):
    load = loader(spark, scratch, refresh_star=True)
    apr = months(spark, "apr96", "may96")
    write_lake(apr.where("cicid % 5 <> 0"), f"{scratch}/inbox")
    load.run()
    seen = []
    merge = load.partials
    monkeypatch.setattr(load, "partials", lambda p: seen.append(merge(p)) or seen[-1])
    apr.where("cicid % 5 = 0 AND source_period = 'apr96'").write.mode("append").partitionBy("source_period").parquet(f"{scratch}/inbox")
    load.run()
    assert actions(load)[-1] == ("apr96", "added") and len(seen) == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = load.partials(["apr96"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "lake_i94" not in plan
    assert "stage_partials" in plan
    scan = [x for x in plan.splitlines() if "FileScan" in x and "stage_partials" in x][0]
    assert "source_period" in scan.split("PartitionFilters: [")[1].split("]")[0]
    # only the late file was read: the version's landed rows are its own
    version = load.ledger.next_version() - 1
    assert load.lake().where(F.col("version") == version).count() == apr.where("cicid % 5 = 0 AND source_period = 'apr96'").count()
    full = C.staging(spark, SF001).where("source_period = 'apr96'")
    got = load.warehouse.read_staging().where("source_period = 'apr96'").select(full.columns)
    assert rows(got) == rows(full)


def test_a_load_that_broke_off_is_repeated(spark, scratch, monkeypatch):
    load = loader(spark, scratch, refresh_star=True)
    jan = months(spark, "jan96", "feb96")
    write_lake(jan.where("source_period = 'jan96'"), f"{scratch}/inbox")
    load.run()
    for step in ("_judge", "_sum_up", "_restage", "_clean"):
        with monkeypatch.context() as m:
            def broken(*a, **k):
                raise OSError("lost")
            m.setattr(load, step, broken)
            with pytest.raises(Exception):
                drop(jan.where("source_period = 'feb96'").where(f"cicid % 7 <> {len(step) % 7}"), scratch, "source_period=feb96")
                load._deliver([r["file"] for r in load._unread().collect()])
    drop(jan.where("source_period = 'feb96'"), scratch, "source_period=feb96")
    load.run()
    full = C.staging(spark, SF001).where("source_period IN ('jan96', 'feb96')")
    assert rows(load.warehouse.read_staging().select(full.columns)) == rows(full)
    star, want = load.warehouse.read_star(), build_star(full.drop("source_period"))
    assert rows(star.immigration.drop("arrival_year")) == rows(want.immigration)
    assert rows(star.entry_port) == rows(want.entry_port)


def test_members_leave_with_their_last_row(spark, scratch):
    load = loader(spark, scratch, refresh_star=True, seed_unknown=True)
    wrong = F.when(F.col("cicid") % 3 == 0, F.lit("QXQ").cast("binary")).otherwise(F.col("i94port"))
    drop(months(spark, "jan96"), scratch, "a/i94_jan96_sub.parquet")
    drop(months(spark, "feb96").withColumn("i94port", wrong), scratch, "a/i94_feb96_sub.parquet")
    load.run()
    wh = load.warehouse
    assert wh.read("entry_port").where("id = 'QXQ'").count() == 1
    visa = wh.files("visa")
    drop(months(spark, "feb96"), scratch, "b/i94_feb96_sub.parquet")
    load.run()
    assert wh.read("entry_port").where("id = 'QXQ'").count() == 0
    assert wh.files("visa") == visa  # its members did not change
    want = build_star(wh.read_staging().drop("source_period", "arrival_year"))
    for name in ("visa", "entry_port", "entry_mode", "date"):
        got = wh.read(name).where("visatype <> 'missing'") if name == "visa" else wh.read(name)
        assert rows(got) == rows(getattr(want, name)), name
    assert wh.read("citizenship_country").where("id = 999").count() == 1  # the seeded member stays


def test_a_bad_month_is_held_and_the_rest_goes_on(spark, scratch):
    load = loader(spark, scratch)
    bad = months(spark, "feb96").withColumn("gender", F.when(F.col("cicid") % 2 == 0, F.col("gender")))
    drop(months(spark, "jan96"), scratch, "a/i94_jan96_sub.parquet")
    drop(bad, scratch, "a/i94_feb96_sub.parquet")
    drop(months(spark, "mar96"), scratch, "a/i94_mar96_sub.parquet")
    load.run()
    assert {r[0] for r in load.warehouse.read_staging().select("source_period").distinct().collect()} == {"jan96", "mar96"}
    assert [(r["stem"], r["column_name"]) for r in load.held_back().collect()] == [("i94_feb96_sub", "gender")]
    drop(months(spark, "feb96"), scratch, "b/i94_feb96_sub.parquet")
    load.run()
    assert {r[0] for r in load.warehouse.read_staging().select("source_period").distinct().collect()} == {"jan96", "feb96", "mar96"}
    assert load.held_back().count() == 0
    # a bad correction does not take the good month away
    drop(bad, scratch, "c/i94_feb96_sub.parquet")
    load.run()
    assert load.held_back().count() == 1 and load.warehouse.read_staging().where("source_period = 'feb96'").count() > 0


def test_profile_does_not_depend_on_batches(spark, scratch):
    """One delivery of four months and four deliveries of one decide alike."""
    raw = months(spark, "jan96", "feb96", "mar96", "apr96")
    # sparse in one month only: far over the limit there, under it in all
    raw = raw.withColumn("airline", F.when(F.col("source_period") != "feb96", F.col("airline")))
    write_lake(raw, f"{scratch}/one/inbox")
    one = loader(spark, f"{scratch}/one")
    one.run()
    many = loader(spark, f"{scratch}/many", max_files_per_trigger=1)
    for p in ("feb96", "jan96", "mar96", "apr96"):
        raw.where(F.col("source_period") == p).write.mode("append").partitionBy("source_period").parquet(f"{scratch}/many/inbox")
        many.run()
    assert one.profiled().columns == many.profiled().columns and "airline" in one.profiled().columns
    assert "occup" not in one.profiled().columns
    stored = rows(merged_profile(many.profile_counts(), ["source_period"]))
    assert stored == rows(null_counts(type_extract(raw), by=["source_period"]))
    assert rows(one.profiled()) == rows(many.profiled().select(one.profiled().columns))


def test_fingerprints_see_one_cell(spark):
    base = months(spark, "jan96")
    def side(df):
        return df.groupBy("source_period").agg(*fingerprint(I94_RAW_COLUMNS))
    def passed(df):
        return [r["passed"] for r in quality.reconcile_content(side(base), side(df)).collect()]
    assert passed(base.repartition(5)) == [True]
    first = base.agg(F.min("cicid")).first()[0]
    here = F.col("cicid") == first
    assert passed(base.withColumn("i94port", F.when(here, F.lit("ZZ").cast("binary")).otherwise(F.col("i94port")))) == [False]
    # a value moved to the next, empty column; two rows swapping a cell; a row doubled for a lost one
    assert passed(base.withColumn("i94res", F.when(here, F.col("i94cit")).otherwise(F.col("i94res")))
                  .withColumn("i94cit", F.when(here, F.lit(None)).otherwise(F.col("i94cit")))) == [False]
    a, b = base.limit(2).collect()
    swapped = spark.createDataFrame([a[:4] + b[4:5] + a[5:], b[:4] + a[4:5] + b[5:]], base.schema)
    pair = spark.createDataFrame([tuple(a), tuple(b)], base.schema)
    got = quality.reconcile_content(side(pair), side(swapped)).first()
    assert (got["source_rows"], got["target_rows"], got["passed"]) == (2, 2, a[4] == b[4])
    twice = spark.createDataFrame([tuple(a), tuple(a)], base.schema)
    assert not quality.reconcile_content(side(pair), side(twice)).first()["passed"]
    other = base.withColumn("source_period", F.lit("dec99"))
    assert {(r[0], r["passed"]) for r in quality.reconcile_content(side(base), side(other)).collect()} == {("jan96", False), ("dec99", False)}


def test_fingerprints_add_up(spark):
    from landfall.sources.ledger import merged

    df = months(spark, "jan96", "feb96", "mar96")
    each = [[r[c] for c in FINGERPRINT] for r in df.groupBy("source_period").agg(*fingerprint(I94_RAW_COLUMNS)).collect()]
    assert merged(each) == [df.agg(*fingerprint(I94_RAW_COLUMNS)).first()[c] for c in FINGERPRINT]
    assert merged([]) == [df.where("false").agg(*fingerprint(I94_RAW_COLUMNS)).first()[c] for c in FINGERPRINT]


def test_a_swapped_cell_fails_the_run(spark, scratch, monkeypatch):
    from landfall.sources import landing

    write_lake(months(spark, "jan96"), f"{scratch}/in")
    whole = landing.land_rows
    flip = F.when(F.col("cicid") % 11 == 0, F.lit("XX").cast("binary")).otherwise(F.col("gender"))
    monkeypatch.setattr(landing, "land_rows", lambda df, *a: whole(df.withColumn("gender", flip), *a))
    _, checks = run_all(spark, f"{scratch}/in", C.label_files(spark, SF001), f"{scratch}/out")
    assert [(r["column_name"], r["bad_rows"], r["passed"]) for r in checks.where("check_name = 'reconcile_land'").collect()] == [("jan96", 1, False)]


def test_rejected_cells_of_csv_and_parquet(spark, scratch, tmp_path):
    need = "arrdate,i94port,i94mode,i94addr,gender,visatype,i94visa,count,i94cit"
    (tmp_path / "i94_jan16_sub.csv").write_text(f"{need}\n" + "20454,NYC,1,NY,F,B2,2,1,101\n" * 12 + "soon,NYC,1,NY,F,B2,2,1,x1\n ,NYC,1,NY,F,B2,2,1,x1\n")
    (tmp_path / "i94_feb16_sub.csv").write_text(f"{need}\n20490,NYC,1,NY,F,B2,2,1,101\n")
    want = {("jan16", "arrdate", "soon"): 1, ("jan16", "i94cit", "x1"): 2}
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001))
    load = IncrementalLoader(spark, str(tmp_path), Warehouse(spark, f"{scratch}/wh"), lk.materialize(spark, f"{scratch}/wh/lookups"), fmt="csv")
    load.run()
    assert {(r["source_period"], r["column_name"], r["cell"]): r["cells"] for r in load.rejects().collect()} == want
    _, checks = run_all(spark, str(tmp_path), C.label_files(spark, SF001), f"{scratch}/out", extract_format="csv")
    got = {r["column_name"]: (r["bad_rows"], r["passed"]) for r in checks.where("check_name = 'rejected_cells'").collect()}
    assert got == {"arrdate": (1, False), "i94cit": (2, False)}
    raw = months(spark, "jan96").withColumn("i94bir", F.when(F.col("cicid") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(None)))
    n = raw.where("cicid % 2 = 0").count()
    assert [tuple(r) for r in rejected_cells(raw).collect()] == [("jan96", "i94bir", "NaN", n)]
    assert rejected_cells(raw.where("false")).collect() == []


def test_csv_headers_are_read_without_a_job(spark, scratch, tmp_path):
    from landfall.sources.landing import by_header

    for i in range(6):
        (tmp_path / f"{i}.csv").write_text(f"a,b{i % 2}\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    spark.sparkContext.setJobGroup("headers", "")
    try:
        got = by_header(spark, [f"file:{tmp_path}/{f}" for f in sorted(os.listdir(tmp_path)) if f.endswith("csv")])
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {k: len(v) for k, v in got.items()} == {"a,b0": 3, "a,b1": 3}


def test_exists_asks_the_file_system(spark, scratch):
    wh = Warehouse(spark, scratch)
    assert not wh.exists("nothing")
    wh.write("one", spark.range(3))
    assert wh.exists("one")
