"""Profile: drop rule, fill rule, one job, required columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from landfall.operators.profile import decide_drops, null_ratio, profile_extract
from landfall.schemas import I94_RAW, I94_TYPED, REQUIRED_COLUMNS


def typed_rows(spark, n, null_every):
    """n typed extract rows; column ``occup`` is null on every ``null_every``-th row."""
    rows = []
    for i in range(n):
        r = {f.name: None for f in I94_TYPED.fields}
        r.update(cicid=i, i94yr=2016, i94mon=4, i94cit=101, i94port="NYC", i94mode=1, i94addr="NY",
                 arrdate=dt.date(2016, 4, 1),
                 gender="F", visatype="B2", i94visa=2, count=1, airline="AA")
        r["occup"] = None if (null_every and i % null_every == 0) else "STU"
        rows.append(r)
    return spark.createDataFrame(rows, I94_TYPED)


def test_decide_drops_strict_rule():
    assert decide_drops({"a": 3, "b": 4, "c": 0}, 10) == ["b"]   # 30 % kept, 40 % dropped
    assert decide_drops({"a": 5}, 0) == []                       # empty batch drops nothing


def test_exactly_thirty_percent_is_kept(spark):
    df = typed_rows(spark, 10, 0).withColumn("occup", F.when(F.col("cicid") < 3, None).otherwise(F.col("occup")))
    res = profile_extract(df, typed=True)
    assert "occup" in res.df.columns


def test_just_above_thirty_percent_is_dropped(spark):
    df = typed_rows(spark, 10, 0).withColumn("occup", F.when(F.col("cicid") < 4, None).otherwise(F.col("occup")))
    res = profile_extract(df, typed=True)
    assert "occup" not in res.df.columns and "occup" in res.dropped


def test_fill_touches_text_only(spark):
    df = typed_rows(spark, 10, 5)   # occup 20 % null: kept and filled
    df = df.withColumn("i94bir", F.when(F.col("cicid") % 5 == 0, None).otherwise(F.lit(30)))
    res = profile_extract(df, typed=True)
    got = res.df.select("occup", "i94bir").collect()
    assert sorted({r["occup"] for r in got}) == ["STU", "missing"]
    # a 20 %-null int column is kept and its nulls stay null
    assert sum(r["i94bir"] is None for r in got) == 2
    # all-null date and text columns are dropped (100 % > 30 %), never filled
    assert "depdate" in res.dropped and "insnum" in res.dropped


def test_empty_batch(spark):
    df = spark.createDataFrame([], I94_RAW)
    res = profile_extract(df)
    assert res.total_rows == 0 and res.dropped == [] and len(res.df.columns) == 28


def test_required_column_is_never_dropped(spark):
    df = typed_rows(spark, 10, 0).withColumn("gender", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="gender"):
        profile_extract(df, typed=True)
    assert "gender" in REQUIRED_COLUMNS


def test_profile_is_one_pass(spark, scratch):
    """Row count and every null count come from one aggregate: one job over
    the landed Parquet (AQE off here so that stages are not split into jobs)."""
    from landfall.sources import fixtures
    from tests.conftest import SF001

    fixtures.i94_raw(spark, SF001).write.parquet(scratch)
    raw = spark.read.parquet(scratch)
    sc = spark.sparkContext
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    sc.setJobGroup("profile-one-pass", "profile")
    try:
        res = profile_extract(raw)
    finally:
        sc.setJobGroup("other", "other")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sc.statusTracker().getJobIdsForGroup("profile-one-pass")) == 1
    assert res.dropped == ["visapost", "occup", "entdepu", "insnum"]


def test_null_ratio_matches_decision(spark):
    from landfall.operators.profile import type_extract
    from landfall.sources import fixtures
    from tests.conftest import SF001

    typed = type_extract(fixtures.i94_raw(spark, SF001))
    dropped = sorted(r["column_name"] for r in null_ratio(typed).where("dropped").collect())
    assert dropped == ["entdepu", "insnum", "occup", "visapost"]


def test_profile_observed_while_landing(spark, scratch):
    """The landing write gathers the typed null profile; the profile then runs no job."""
    from landfall.plans.flows import with_period
    from landfall.sources import fixtures
    from landfall.sources.landing import land_extracts, write_lake
    from tests.conftest import SF001

    write_lake(with_period(fixtures.i94_raw(spark, SF001)), f"{scratch}/inbox")
    lake, counts = land_extracts(spark, f"{scratch}/inbox", f"{scratch}/lake", with_profile=True)
    sc = spark.sparkContext
    sc.setJobGroup("observed-profile", "profile")
    try:
        observed = profile_extract(lake, counts=counts)
    finally:
        sc.setJobGroup("other", "other")
    assert len(sc.statusTracker().getJobIdsForGroup("observed-profile")) == 0
    scanned = profile_extract(lake)
    assert (observed.total_rows, observed.nulls, observed.dropped) == \
        (scanned.total_rows, scanned.nulls, scanned.dropped)
