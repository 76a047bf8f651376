"""All flows from files on disk: monthly extract files, label .txt files, airport CSV."""

import os

from pyspark.sql import functions as F

from landfall.plans import analysis
from landfall.plans.flows import run_all, with_period
from landfall.sources import fixtures
from tests.conftest import SF001


def test_run_all_from_files(spark, scratch, tmp_path):
    # monthly extract files in source_period= folders
    extracts = f"{scratch}/extracts"
    with_period(fixtures.i94_raw(spark, SF001)).write.partitionBy("source_period").parquet(extracts)
    # label files named like the published ones (a handful of lines: written here directly)
    labels = tmp_path / "labels"
    labels.mkdir()
    for row in fixtures.label_lines(spark, SF001).groupBy("label").agg(F.collect_list("line").alias("l")).collect():
        (labels / f"{row['label']}.txt").write_text("\n".join(row["l"]))
    # airports CSV with a header; the text NA must stay text
    airports = tmp_path / "airports.csv"
    airports.write_text("ident,local_code,iata_code,elevation_ft,continent,iso_country\n"
                        "K1,L1,,10.5,NA,NA\nK2,,,,,\n")

    star, checks = run_all(spark, extracts, str(labels), f"{scratch}/run", str(airports))
    rows = {(r["check_name"], r["table_name"], r["column_name"]): r for r in checks.collect()}
    failed = sorted(k for k, r in rows.items() if not r["passed"])
    # the known findings of the test data, nothing else
    assert all(k[0] in ("unique_key", "width") for k in failed), failed
    assert rows[("unique_key", "visa", "visatype")]["bad_rows"] == 3
    assert all(r["passed"] for k, r in rows.items() if k[0] in ("reconcile_land", "reconcile_staged", "nonempty"))
    assert sum(1 for k in rows if k[0] == "reconcile_land") == 83

    star.staging = spark.read.parquet(f"{scratch}/run/warehouse/immigration_stage")
    got = [tuple(r) for r in analysis.top_visa_types(star, 1996).collect()]
    assert got == [("W2", 194), ("W1", 164), ("B2", 128), ("F1", 112), ("F2", 107)]
    ap = spark.read.parquet(f"{scratch}/run/warehouse/airports").orderBy("ident").collect()
    assert (ap[0]["continent"], ap[0]["airport_code"], ap[0]["elevation_ft"]) == ("NA", "L1", 10)
    assert (ap[1]["continent"], ap[1]["airport_code"], ap[1]["elevation_ft"]) == ("NA", "K2", -1000)


def test_command_line(spark, scratch, tmp_path, capsys):
    from landfall.__main__ import main

    extracts = f"{scratch}/extracts"
    with_period(fixtures.i94_raw(spark, SF001)).write.partitionBy("source_period").parquet(extracts)
    labels = tmp_path / "labels"
    labels.mkdir()
    for row in fixtures.label_lines(spark, SF001).groupBy("label").agg(F.collect_list("line").alias("l")).collect():
        (labels / f"{row['label']}.txt").write_text("\n".join(row["l"]))
    status = main(["--extracts", extracts, "--labels", str(labels), "--root", f"{scratch}/cli",
                   "--year", "1996", "--exclude", "NATION_1", "NATION_2"], spark=spark)
    out = capsys.readouterr().out
    assert status == 1                         # the test data's known findings (visa key, gender width)
    assert "Q1 top visa types (1996)" in out and "|W2      |194       |" in out
    assert "Sea" in out and "NATION_7, XX" in out
