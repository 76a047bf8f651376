"""The SQL form of each question equals its DataFrame form over the same warehouse."""

from landfall.plans import analysis
from landfall.plans import analysis_sql as Q
from landfall.plans import catalog as C
from tests.conftest import SF001


def test_sql_questions_equal_dataframe_questions(spark):
    wh, _ = C.fixture_warehouse(spark, SF001)
    views = wh.register_views()
    assert "immigration" in views and "immigration_stage" in views
    s = wh.read_star()
    ex = ["NATION_1", "NATION_2"]
    pairs = [
        (Q.q1(1996), analysis.top_visa_types(s, 1996)),
        (Q.q2(1996), analysis.top_visa_categories(s, 1996)),
        (Q.q3(1996), analysis.state_totals_by_visa(s, 1996)),
        (Q.q3_top_state(1996), analysis.top_state_per_visa(s, 1996)),
        (Q.q4(1996, exclude=ex), analysis.top_countries(s, 1996, exclude=ex)),
        (Q.q5(1996), analysis.top_mode_except(s, 1996)),
        (Q.q6(1996), analysis.top_ports(s, 1996)),
    ]
    for sql, df in pairs:
        got = spark.sql(sql)
        assert got.columns == df.columns, sql
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect())), sql
    plan = spark.sql(Q.q1(1996))._jdf.queryExecution().executedPlan().toString()
    assert "arrival_year" in plan and "PartitionFilters" in plan
