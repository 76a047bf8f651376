"""Beyond the broadcast limit the joins fall back to shuffles with equal results;
a key holding a third of all rows is summed whole."""

from pyspark.sql import functions as F

from landfall.operators.lookups import Lookups
from landfall.operators.profile import profile_extract
from landfall.operators.staging import build_staging
from landfall.plans import catalog as C
from landfall.sources import fixtures
from tests.conftest import SF001, rows


def test_staging_without_broadcast_equals_with(spark):
    profiled = profile_extract(fixtures.i94_raw(spark, SF001)).df
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001))
    small = rows(build_staging(profiled, lk))           # all five lookups broadcast
    # every lookup "too large": no hint from the size check, and Spark's own
    # size-based broadcast switched off, so the joins must shuffle
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        big = build_staging(profiled, lk, max_bytes=1)
        text = big._jdf.queryExecution().sparkPlan().toString()
        got = rows(big)
    finally:
        for k in conf:
            spark.conf.unset(k)
    lookup_joins = text.count("SortMergeJoin")
    assert lookup_joins >= 5, text
    assert got == small


def test_hot_port_holding_a_third_of_rows(spark):
    raw = fixtures.i94_raw(spark, SF001)
    n = raw.count()
    # every row with cicid % 3 == 0 arrives through one port
    hot = raw.withColumn("i94port", F.when(F.col("cicid") % 3 == 0, F.lit(b"P10"))
                         .otherwise(F.col("i94port")))
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001))
    st = build_staging(profile_extract(hot).df, lk)
    got = st.agg(F.sum("count")).first()[0]
    lost = hot.where(F.col("i94mode").isNull() | ~F.col("i94mode").isin(1.0, 2.0, 3.0, 9.0)).count()
    assert got == n - lost                              # whole: nothing dropped but the mode join's loss
    share = st.where("i94port = 'P10'").agg(F.sum("count")).first()[0] / got
    assert share > 1 / 3
