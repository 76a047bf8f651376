"""CSV extracts of the test tables: dealt as narrow rows, gzipped, written by quarters without a shuffle left behind."""

import datetime as dt
import os
from collections import Counter

from landfall.plans import catalog
from tests.conftest import rows

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp")


def made(spark, root):
    """Tables of a line a month for three years, some months with more, one line twice and one without a date."""
    days = [dt.datetime(y, m, 1 + k) for y in (1995, 1996, 1998) for m in range(1, 13) for k in range(1 + m % 3)]
    line = [(i, i, i, 1 + i % 7, float(i % 50), "N", "O", d) for i, d in enumerate(days)] + [(0, 0, 0, 1, 0.0, "N", "O", days[0]),
                                                                                        (1, 9, 9, 9, 9.0, "N", "O", None)]
    spark.createDataFrame(line, LINE).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(i, i % 5, dt.datetime(1995, 1, 1)) for i in range(len(days))], "o_orderkey long, o_custkey long, o_orderdate timestamp") \
        .write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(i, i, "BUILDING") for i in range(5)], "c_custkey long, c_nationkey int, c_mktsegment string") \
        .write.parquet(f"{root}/customer.parquet")
    return Counter(d.strftime("%b%y").lower() for d in [*days, days[0]])


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").split("\n") if "/shuffle_" in f}


def test_csv_extracts_are_small_on_disk_and_land_whole(spark, tmp_path, monkeypatch):
    want, seen, land = made(spark, tmp_path), [], catalog.land_extracts

    def landed(spark, source, *a):
        seen.append((source, shuffled(spark) - before))
        return land(spark, source, *a)

    monkeypatch.setattr(catalog, "land_extracts", landed)
    before = shuffled(spark)
    got = rows(catalog.land_i94_csv(spark, str(tmp_path)).select("source_period", "row_count", "total_count"))
    assert got == sorted((p, n, n) for p, n in want.items())
    (source, left), = seen
    assert not left
    files = [f for d, _, fs in os.walk(source.removeprefix("file:")) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
