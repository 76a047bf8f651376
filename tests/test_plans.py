"""Plan shape: no Python UDFs, broadcast lookups, pushed filters, partition pruning."""

from dataclasses import replace

from landfall.operators import rollup
from landfall.operators.lookups import Lookups
from landfall.operators.profile import profile_extract
from landfall.operators.staging import build_staging
from landfall.plans import analysis
from landfall.plans import catalog as C
from landfall.sources import fixtures
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark):
    # loaders over files that Python lists: their results are plain scans, but building them takes minutes
    skip = {"incremental_new_files", "star_refresh", "run_all_checks", "run_twice", "land_i94_csv"}
    for name, fn in C.QUERIES.items():
        if name in skip:
            continue
        p = plan(fn(spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "PythonRDD" not in p, name   # no Python-side rows as a data source


def test_staging_uses_five_broadcast_joins(spark, scratch):
    """Over landed Parquet: partial aggregate below the one shuffle, then the
    five label joins, all broadcast; no sort-merge join anywhere."""
    fixtures.i94_raw(spark, SF001).write.parquet(scratch)
    raw = spark.read.parquet(scratch)
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001))
    st = build_staging(profile_extract(raw).df, lk)
    text = st._jdf.queryExecution().sparkPlan().toString()
    assert text.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    assert "partial_sum" in text
    # the scan reads only the nine columns staging needs
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan_text = st._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [ln for ln in plan_text.splitlines() if "FileScan parquet" in ln and "ReadSchema" in ln][0]
    read = scan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(f.split(":")[0] for f in read.split(",")) == sorted(
        ["arrdate", "i94cit", "i94port", "i94mode", "i94addr", "gender", "visatype", "i94visa", "count"])


def test_q1_prunes_year_partitions_and_pushes_date_range(spark):
    s = replace(C.star(spark, SF001), rollup=None)
    df = analysis.top_visa_types(s, 1996)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(arrival_year" in p and "(arrival_year" in p
    assert "PushedFilters: [IsNotNull(arrdate), GreaterThanOrEqual(arrdate,1996-01-01)" in p
    assert "TakeOrderedAndProject" in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_questions_read_the_rollup_alone(spark):
    """Q1, Q3-Q6 open one year of the rollup and never the fact; without one, or for other columns, the fact answers alike."""
    s = C.star(spark, SF001)
    bare = replace(s, rollup=None)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        for ask in (analysis.top_visa_types, analysis.state_totals_by_visa, analysis.top_state_per_visa, analysis.top_countries,
                    analysis.top_mode_except, analysis.top_ports):
            p = plan(ask(s, 1996))
            assert "/immigration]" not in p and "/rollup]" in p, ask.__name__
            scan = [x for x in p.splitlines() if "/rollup]" in x][0]
            assert "arrival_year" in scan.split("PartitionFilters: [")[1].split("]")[0]
            assert "/immigration]" in plan(ask(bare, 1996))
            assert ask(s, 1996).collect() == ask(bare, 1996).collect(), ask.__name__
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert rollup.set_for(["i94port", "gender"]) is None
    assert [r[0] for r in analysis._year_totals(s, 1996, ["i94port", "gender"]).groupBy().sum("count").collect()] == [
        r[0] for r in analysis._year_totals(s, 1996, ["i94mode"]).groupBy().sum("count").collect()]


def test_top_state_per_visa_uses_group_limit(spark):
    s = C.star(spark, SF001)
    p = analysis.top_state_per_visa(s, 1996)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in p


def test_dimensions_come_from_one_scan(spark):
    from landfall.operators.star import dimension_members

    staging = C.staging(spark, SF001)
    text = dimension_members(staging)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1
    assert "Expand" in text
