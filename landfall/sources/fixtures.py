"""Inputs of the pipeline's shapes, derived from the TPC-H-style test tables.

The test tables carry no arrival records, so each input is a projection of
them with the same schema and the same edge cases (sparse columns, unknown
codes, null codes, padded label lines).  Every view is a lazy DataFrame over
the Parquet tables: its size grows with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.periods import period_of
from landfall.schemas import I94_RAW, PERIOD_COLUMN, TEXT_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_DAYS = "datediff(CAST(l_shipdate AS DATE), DATE'1960-01-01')"

# The projection that gives the test tables the shape of a
# monthly extract (FIXTURES Part B).
_I94_RAW_EXPRS = {
    "cicid": "CAST(l_orderkey*8+l_linenumber AS DOUBLE)",
    "i94yr": "CAST(year(l_shipdate) AS DOUBLE)",
    "i94mon": "CAST(month(l_shipdate) AS DOUBLE)",
    "i94cit": "CAST(100+c_nationkey AS DOUBLE)",
    "i94res": "CAST(100+l_suppkey%25 AS DOUBLE)",
    "i94port": "CASE WHEN l_suppkey%10=9 THEN 'ZZZ' ELSE concat('P', CAST(10+l_suppkey%10 AS STRING)) END",
    "arrdate": f"CAST({_DAYS} AS DOUBLE)",
    "i94mode": "CAST(CASE l_orderkey%20 WHEN 0 THEN NULL WHEN 1 THEN 7 WHEN 2 THEN 9 WHEN 3 THEN 3 "
               "WHEN 4 THEN 2 ELSE 1 END AS DOUBLE)",
    "i94addr": "CASE WHEN l_partkey%20=0 THEN NULL WHEN l_partkey%20=1 THEN 'QQ' "
               "ELSE concat('S', CAST(l_partkey%8 AS STRING)) END",
    "depdate": f"CASE WHEN l_orderkey%9=0 THEN NULL ELSE CAST({_DAYS} AS DOUBLE)+l_quantity END",
    "i94bir": "CAST(CASE WHEN l_orderkey%50=0 THEN NULL ELSE l_quantity END AS DOUBLE)",
    "i94visa": "CAST(1+l_linenumber%3 AS DOUBLE)",
    "count": "CAST(1 AS DOUBLE)",
    "dtadfile": "CAST(year(o_orderdate) AS STRING)",
    "visapost": "CASE WHEN l_orderkey%10<6 THEN NULL ELSE c_mktsegment END",
    "occup": "CASE WHEN l_orderkey%100<99 THEN NULL ELSE 'STU' END",
    "entdepa": "l_returnflag",
    "entdepd": "CASE WHEN l_orderkey%9=0 THEN NULL ELSE l_linestatus END",
    "entdepu": "CAST(NULL AS STRING)",
    "matflag": "CASE WHEN l_orderkey%10<3 THEN NULL ELSE 'M' END",
    "biryear": "CAST(CASE WHEN l_orderkey%50=0 THEN NULL ELSE year(l_shipdate)-l_quantity END AS DOUBLE)",
    "dtaddto": "CAST(year(l_shipdate)+1 AS STRING)",
    "gender": "CASE WHEN l_partkey%10=0 THEN NULL WHEN l_partkey%2=0 THEN 'F' ELSE 'M' END",
    "insnum": "CASE WHEN l_orderkey%25<24 THEN NULL ELSE '3668' END",
    "airline": "CASE WHEN l_orderkey%33=0 THEN NULL ELSE concat('A', CAST(l_suppkey%7 AS STRING)) END",
    "admnum": "CAST(l_orderkey AS DOUBLE)*1000000",
    "fltno": "CASE WHEN l_orderkey%40=0 THEN NULL ELSE CAST(l_partkey%500 AS STRING) END",
    "visatype": "CASE WHEN l_orderkey%40=5 THEN 'CP' ELSE concat(CASE l_linenumber%3 WHEN 0 THEN 'B' "
                "WHEN 1 THEN 'W' ELSE 'F' END, CAST(1+l_partkey%2 AS STRING)) END",
}


def i94_raw(spark: SparkSession, sf_dir: str, by_period: bool = False) -> DataFrame:
    """Monthly-extract records (schema ``I94_RAW``: doubles and binary text).

    lineitem joins orders and customer on their keys; Catalyst picks the
    join strategies from the table statistics (no forced broadcast, the
    customer table grows with the data).  orders and customer meet first:
    they have fewer rows to move.

    ``by_period`` adds ``source_period``, from the record's year and month, and
    deals the rows by it, as few columns as they are before the projection: to
    be written as monthly files, one or a few each.  A large month takes several
    tasks.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    placed = od.join(cu, od.o_custkey == cu.c_custkey)
    joined = li.join(placed, li.l_orderkey == placed.o_orderkey)
    cols: list[Column] = []
    if by_period:
        period = period_of(F.expr(_I94_RAW_EXPRS["i94yr"]), F.expr(_I94_RAW_EXPRS["i94mon"]))
        joined = joined.withColumn(PERIOD_COLUMN, period).hint("rebalance", PERIOD_COLUMN)
    for field in I94_RAW.fields:
        e = F.expr(_I94_RAW_EXPRS[field.name])
        if field.name in TEXT_COLUMNS:
            e = e.cast("binary")
        else:
            e = e.cast("double")
        cols.append(e.alias(field.name))
    return joined.select(*cols, *([PERIOD_COLUMN] if by_period else []))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport rows (schema ``AIRPORTS``) from the part table."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('K', CAST(p_partkey AS STRING)) AS ident",
        "CASE WHEN p_partkey%3=0 THEN NULL ELSE concat('L', CAST(p_partkey AS STRING)) END AS local_code",
        "CASE WHEN p_partkey%2=0 THEN NULL ELSE concat('I', CAST(p_partkey AS STRING)) END AS iata_code",
        "CAST(CASE WHEN p_partkey%5=0 THEN NULL ELSE p_retailprice END AS DOUBLE) AS elevation_ft",
        "CASE WHEN p_size%4=0 THEN NULL ELSE 'EU' END AS continent",
        "CASE WHEN p_size%9=0 THEN NULL ELSE p_brand END AS iso_country",
    )


# The label-file lines built from the nation table; chr(39) is
# the quote and chr(9) the tab.
_LABEL_LINES = {
    "I94CIT_I94RES": ("nation",
                      "concat('   ', CAST(100+n_nationkey AS STRING), ' =  ', chr(39), n_name, chr(39), "
                      "CASE WHEN n_nationkey%3=0 THEN ' ' ELSE '' END)",
                      "n_nationkey%6<>5"),
    "I94Port": ("nation",
                "concat('   ', chr(39), 'P', CAST(10+n_nationkey AS STRING), chr(39), "
                "CASE n_nationkey WHEN 7 THEN concat(' ', chr(9)) WHEN 8 THEN concat(chr(9), chr(9)) "
                "ELSE chr(9) END, '=', chr(9), chr(39), n_name, ', XX     ', chr(39))",
                "n_nationkey<9"),
    "i94addr": ("nation",
                "concat(chr(9), chr(39), 'S', CAST(n_nationkey AS STRING), chr(39), '=', chr(39), "
                "'STATE ', n_name, chr(39))",
                "n_nationkey<8"),
    # a label that no lookup uses
    "I94Region": ("region", "concat('  ', CAST(r_regionkey AS STRING), ' = ', chr(39), r_name, chr(39))", "true"),
}
_SMALL_LABELS = {
    "I94Mode": [("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not reported")],
    "I94Visa": [("1", "Business"), ("2", "Pleasure"), ("3", "Student")],
}


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(label, line)`` rows shaped like the five label text files.

    Country, port and state lines derive from the nation table; the mode and
    visa lists are the fixed four and three entries of the data dictionary.
    """
    parts = []
    for label, (src, expr, cond) in _LABEL_LINES.items():
        parts.append(table(spark, sf_dir, src).where(cond)
                     .select(F.lit(label).alias("label"), F.expr(expr).alias("line")))
    def listed(label: str) -> DataFrame:
        # a literal row set planned in the JVM (no Python-side data source)
        rows = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(v).alias("v"))
                         for c, v in _SMALL_LABELS[label]])
        return spark.range(1).select(F.inline(rows))

    mode = listed("I94Mode").select(
        F.lit("I94Mode").alias("label"),
        F.concat("code", F.lit(" = "), F.lit("'"), "v", F.lit("'")).alias("line"))
    visa = listed("I94Visa").select(
        F.lit("I94Visa").alias("label"),
        F.concat(F.lit(" "), "code", F.lit(" = "), "v").alias("line"))
    out = parts[0]
    for p in parts[1:] + [mode, visa]:
        out = out.unionByName(p)
    return out
