"""Edge cases of the column expressions, on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from landfall.functions import (
    airport_code, clean_value, date_parts, int_code, label_code, label_value, period_from_file_name,
    period_of, port_code, sas_date, state_code, to_int, to_long, to_text, year_range,
)
from landfall.sources.labels import parse_label_lines


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_sas_date(spark):
    got = one(spark, sas_date("d"), [(20545.0,), (-3.0,), (None,), (0.0,), (20545.9,)], "d double")
    assert got == [dt.date(2016, 4, 1), dt.date(1959, 12, 29), None, dt.date(1960, 1, 1), dt.date(2016, 4, 1)]


def test_casts_truncate_and_tolerate_bad_input(spark):
    assert one(spark, to_int("x"), [(3.9,), (-3.9,), (None,), (1e12,)], "x double") == [3, -3, None, None]
    assert one(spark, to_long("x"), [(1e12,)], "x double") == [1000000000000]
    assert one(spark, to_int("s"), [("abc",), ("12",)], "s string") == [None, 12]
    assert one(spark, to_text("b"), [(bytearray(b"F1"),), (None,)], "b binary") == ["F1", None]


def test_label_line_split_and_value_trim(spark):
    lines = [("   'ANC'\t=\t'ANCHORAGE, AK         '",), ("   582 =  'MEXICO Air Sea'",), (" 1 = Business",)]
    df = spark.createDataFrame(lines, "line string")
    got = df.select(label_code("line").alias("c"), clean_value(label_value("line")).alias("v")).collect()
    assert [tuple(r) for r in got] == [("   ANC\t", "ANCHORAGE, AK"), ("   582 ", "MEXICO Air Sea"),
                                       (" 1 ", "Business")]


def test_port_code_removes_every_blank(spark):
    codes = [("   AG\t\t",), ("   LIT \t",), ("   ANC\t",), ("   CP\t",)]
    assert one(spark, port_code("c"), codes, "c string") == ["AG", "LIT", "ANC", "CP"]


def test_state_code_is_last_two(spark):
    assert one(spark, state_code("c"), [("\tAL",), ("\t99",), ("  WY ",)], "c string") == ["AL", "99", "WY"]


def test_int_code(spark):
    got = one(spark, int_code("c"), [("   582 ",), ("1",), ("582.0",), ("x1",), ("\t12\t",), ("",)], "c string")
    assert got == [582, 1, 582, None, 12, None]


def test_sas_escaped_quote_is_deleted(spark):
    df = spark.createDataFrame([("I94Port", "   'INL'\t=\t'INT''L FALLS, MN   '")], "label string, line string")
    r = parse_label_lines(df).first()
    assert r["value"] == "INTL FALLS, MN"


def test_blank_lines_carry_no_entry(spark):
    df = spark.createDataFrame([("I94Mode", ""), ("I94Mode", "1 = 'Air'")], "label string, line string")
    assert parse_label_lines(df).count() == 1


def test_date_parts_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),), (dt.date(2016, 1, 4),)], "d date")
    got = [tuple(r) for r in df.select(*date_parts("d")).collect()]
    # 2016-01-01 is a Friday in ISO week 53 of 2015; 2016-01-04 a Monday (weekday 0)
    assert got == [(1, 53, 1, 2016, 4), (4, 1, 1, 2016, 0)]


def test_year_range(spark):
    df = spark.createDataFrame([(dt.date(2015, 12, 31),), (dt.date(2016, 1, 1),), (dt.date(2016, 12, 31),),
                                (dt.date(2017, 1, 1),), (None,)], "d date")
    assert df.where(year_range("d", 2016)).count() == 2


def test_periods(spark):
    names = [("s3://b/immigration/i94_apr16_sub.sas7bdat",), ("i94_jan16_sub.parquet",), ("/x/i94_dec15_sub",)]
    assert one(spark, period_from_file_name("p"), names, "p string") == ["apr16", "jan16", "dec15"]
    df = spark.createDataFrame([(2016.0, 4.0), (2001.0, 12.0)], "y double, m double")
    assert [r[0] for r in df.select(period_of("y", "m")).collect()] == ["apr16", "dec01"]


def test_airport_code_first_present(spark):
    df = spark.createDataFrame([("K1", "L1", "I1"), ("K2", "L2", None), ("K3", None, None), ("K4", None, "I4")],
                               "ident string, local_code string, iata_code string")
    assert [r[0] for r in df.select(airport_code()).collect()] == ["I1", "L2", "K3", "I4"]
