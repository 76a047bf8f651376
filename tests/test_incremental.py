"""Landing and incremental loading are idempotent; a new period touches only itself."""

import os

from pyspark.sql import functions as F

from landfall.operators.lookups import Lookups
from landfall.plans import catalog as C
from landfall.plans.flows import build_warehouse, with_period
from landfall.sources import fixtures
from landfall.sources.landing import land_extracts, write_lake
from landfall.sources.warehouse import Warehouse
from landfall.streaming.incremental import IncrementalLoader
from tests.conftest import SF001, rows


def totals(df):
    return rows(df.groupBy("source_period").agg(F.count(F.lit(1)), F.sum("count")))


def test_landing_twice_equals_once(spark, scratch):
    inbox, lake = f"{scratch}/inbox", f"{scratch}/lake"
    write_lake(with_period(fixtures.i94_raw(spark, SF001)), inbox)
    once = totals(land_extracts(spark, inbox, lake))
    twice = totals(land_extracts(spark, inbox, lake))
    assert once == twice and sum(r[1] for r in once) == 6000


def test_warehouse_rebuild_is_idempotent(spark, scratch):
    wh = Warehouse(spark, scratch)
    raw, lines = fixtures.i94_raw(spark, SF001), fixtures.label_lines(spark, SF001)
    build_warehouse(spark, raw, lines, wh)
    first = {n: rows(d) for n, d in wh.read_star().tables().items()}
    build_warehouse(spark, raw, lines, wh)
    second = {n: rows(d) for n, d in wh.read_star().tables().items()}
    assert first == second


def _files(path):
    out = set()
    for d, _, fs in os.walk(path.replace("file:", "")):
        out |= {os.path.join(d, f) for f in fs if f.endswith(".parquet")}
    return out


def test_new_period_only_restages_that_period(spark, scratch):
    raw = with_period(fixtures.i94_raw(spark, SF001))
    inbox = f"{scratch}/inbox"
    wh = Warehouse(spark, f"{scratch}/wh")
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001)).materialize(spark, wh.path("lookups"))
    loader = IncrementalLoader(spark, inbox, wh, lk)
    old = raw.where(F.col("source_period") != "jun96")
    old.write.partitionBy("source_period").parquet(inbox)
    loader.run()
    before = _files(wh.path("immigration_stage"))
    raw.where(F.col("source_period") == "jun96").write.mode("append").partitionBy("source_period").parquet(inbox)
    loader.run()
    after = _files(wh.path("immigration_stage"))
    assert before <= after                                   # no old period rewritten
    assert all("source_period=jun96" in f for f in after - before)
    loader.run()                                             # nothing new: no change
    assert _files(wh.path("immigration_stage")) == after
    assert totals(wh.read_staging()) == totals(C.staging(spark, SF001))


def test_csv_extracts_land_like_parquet(spark, scratch):
    """Monthly CSV files named i94_<mon><yy>_sub.csv: the period comes from the name."""
    from landfall.operators.profile import profile_extract

    raw = fixtures.i94_raw(spark, SF001)
    text = raw.select(*[F.col(c).cast("string").alias(c) if t == "binary" else F.col(c)
                        for c, t in raw.dtypes]).where("i94yr = 1996 AND i94mon IN (1, 2)")
    src = f"{scratch}/csv-in"
    for mon, name in ((1, "jan96"), (2, "feb96")):
        (text.where(F.col("i94mon") == mon).coalesce(1).write.option("header", True)
         .csv(f"{src}/i94_{name}_sub.csv"))
    lake = land_extracts(spark, f"{src}/*", f"{scratch}/lake", fmt="csv")
    got = dict(rows(lake.groupBy("source_period").count()))
    want = dict(rows(with_period(raw).where("i94yr = 1996 AND i94mon IN (1, 2)").groupBy("source_period").count()))
    assert got == want and set(got) == {"jan96", "feb96"}
    prof = profile_extract(lake)
    typed = prof.df.where("arrdate IS NOT NULL").first()
    assert isinstance(typed["i94cit"], int) and typed["visatype"] is not None


def test_stream_takes_period_from_file_names(spark, scratch):
    """Files dropped into the inbox as i94_<mon><yy>_sub.parquet (no period folders)."""
    raw = fixtures.i94_raw(spark, SF001).where("i94yr = 1997 AND i94mon IN (3, 4)")
    inbox = f"{scratch}/named-inbox"
    for mon, name in ((3, "mar97"), (4, "apr97")):
        raw.where(F.col("i94mon") == mon).coalesce(1).write.parquet(f"{inbox}/i94_{name}_sub.parquet")
    wh = Warehouse(spark, f"{scratch}/wh")
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001)).materialize(spark, wh.path("lookups"))
    IncrementalLoader(spark, f"{inbox}/*", wh, lk).run()
    periods = {r[0] for r in wh.read_staging().select("source_period").distinct().collect()}
    assert periods == {"mar97", "apr97"}


def test_incremental_star_refresh_rewrites_only_touched_years(spark, scratch):
    from landfall.operators.star import build_star

    raw = with_period(fixtures.i94_raw(spark, SF001))
    inbox = f"{scratch}/inbox"
    wh = Warehouse(spark, f"{scratch}/wh")
    lk = Lookups.from_parsed(C.parsed_labels(spark, SF001)).materialize(spark, wh.path("lookups"))
    loader = IncrementalLoader(spark, inbox, wh, lk, refresh_star=True)
    raw.where(F.col("source_period") != "jun96").write.partitionBy("source_period").parquet(inbox)
    loader.run()
    fact_dir = wh.path("immigration")
    before = _files(fact_dir)
    raw.where(F.col("source_period") == "jun96").write.mode("append").partitionBy("source_period").parquet(inbox)
    loader.run()
    after = _files(fact_dir)
    changed = {f.split("arrival_year=")[1].split("/")[0] for f in before ^ after}
    assert changed == {"1996"}                            # only the touched year was rewritten
    star = wh.read_star()
    full = build_star(wh.read_staging().drop("source_period"))
    assert rows(star.immigration.drop("arrival_year")) == rows(full.immigration)
    for name in ("visa", "citizenship_country", "destination_state", "entry_mode", "entry_port", "date"):
        assert rows(getattr(star, name)) == rows(getattr(full, name)), name


def test_full_star_rebuild_replaces_vanished_years(spark, scratch):
    from landfall.operators.star import build_star

    wh = Warehouse(spark, scratch)
    staging = C.staging(spark, SF001).drop("source_period")
    wh.write_star(build_star(staging))
    assert len(rows(wh.read("immigration").select("arrival_year").distinct())) > 1
    wh.write_star(build_star(staging.where("year(arrdate) = 1996")))
    assert rows(wh.read("immigration").select("arrival_year").distinct()) == [(1996,)]
