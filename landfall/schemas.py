"""Declared schemas and table contracts.

Every boundary of the pipeline has a declared ``StructType``; the only
data-dependent schema is the profiled extract, whose sparse columns are
dropped (see ``operators.profile``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column roles of the monthly extract, the 30 % drop rule, the
# SAS epoch, the default fill values and the warehouse DDL widths / keys.
# They must equal the reference's for equal results.
# ---------------------------------------------------------------------------
LONG_COLUMNS = ["cicid", "admnum"]
INT_COLUMNS = ["i94yr", "i94mon", "i94cit", "i94res", "i94mode", "i94bir", "i94visa", "count", "biryear"]
TEXT_COLUMNS = ["i94port", "i94addr", "visapost", "occup", "entdepa", "entdepd", "matflag", "gender",
                "airline", "visatype", "fltno", "insnum", "dtadfile", "dtaddto", "entdepu"]
SAS_DATE_COLUMNS = ["arrdate", "depdate"]
NULL_RATIO_LIMIT = 0.3          # a column is dropped when nulls / rows > 0.3
SAS_EPOCH = "1960-01-01"        # SAS day numbers count from this date
MISSING = "missing"             # fill for null text in extracts and staging
AIRPORT_TEXT_DEFAULT = "NA"     # fill for continent / iso_country
AIRPORT_ELEVATION_DEFAULT = -1000

# Raw extract column order (data dictionary order).
I94_RAW_COLUMNS = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode",
                   "i94addr", "depdate", "i94bir", "i94visa", "count", "dtadfile", "visapost",
                   "occup", "entdepa", "entdepd", "entdepu", "matflag", "biryear", "dtaddto",
                   "gender", "insnum", "airline", "admnum", "fltno", "visatype"]

PERIOD_COLUMN = "source_period"

# Numbers are doubles and text is binary in the raw extract.
I94_RAW = T.StructType([
    T.StructField(c, T.BinaryType() if c in TEXT_COLUMNS else T.DoubleType(), True)
    for c in I94_RAW_COLUMNS
])

# The raw extract as delimited text: numbers parse as doubles, text stays text.
I94_RAW_TEXT = T.StructType([
    T.StructField(c, T.StringType() if c in TEXT_COLUMNS else T.DoubleType(), True)
    for c in I94_RAW_COLUMNS
])

# Same columns after typing (before the sparse-column drop).
I94_TYPED = T.StructType([
    T.StructField(
        c,
        T.LongType() if c in LONG_COLUMNS else
        T.IntegerType() if c in INT_COLUMNS else
        T.DateType() if c in SAS_DATE_COLUMNS else T.StringType(),
        True)
    for c in I94_RAW_COLUMNS
])

AIRPORTS = T.StructType([
    T.StructField("ident", T.StringType(), True),
    T.StructField("local_code", T.StringType(), True),
    T.StructField("iata_code", T.StringType(), True),
    T.StructField("elevation_ft", T.DoubleType(), True),
    T.StructField("continent", T.StringType(), True),
    T.StructField("iso_country", T.StringType(), True),
])

# The staging grain (A01) and the fact grain.
STAGING_KEYS = ["arrdate", "i94cit", "i94port", "i94mode", "i94addr", "gender", "visatype", "i94visa"]
FACT_KEYS = ["arrdate", "i94cit", "i94port", "i94mode", "i94addr", "gender", "visatype"]
# Columns a later stage needs; the profile must never drop them.
REQUIRED_COLUMNS = STAGING_KEYS + ["count"]

STAGING = T.StructType([
    T.StructField("arrdate", T.DateType(), True),
    T.StructField("i94cit", T.IntegerType(), True),
    T.StructField("country_of_citizenship", T.StringType(), True),
    T.StructField("i94port", T.StringType(), True),
    T.StructField("port_of_entry", T.StringType(), True),
    T.StructField("i94mode", T.IntegerType(), True),
    T.StructField("mode_of_entry", T.StringType(), True),
    T.StructField("i94addr", T.StringType(), True),
    T.StructField("destination_state", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("visatype", T.StringType(), True),
    T.StructField("i94visa", T.IntegerType(), True),
    T.StructField("visa_category", T.StringType(), True),
    T.StructField("count", T.LongType(), True),
])
STAGING_COLUMNS = [f.name for f in STAGING.fields]


@dataclass(frozen=True)
class Contract:
    """What the warehouse DDL declares for one table."""

    name: str
    columns: list[str]
    not_null: list[str] = field(default_factory=list)
    key: list[str] = field(default_factory=list)
    widths: dict[str, int] = field(default_factory=dict)
    # column -> (dimension table, dimension column)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)


CONTRACTS: dict[str, Contract] = {
    "immigration_stage": Contract(
        "immigration_stage", STAGING_COLUMNS,
        widths={"country_of_citizenship": 50, "i94port": 25, "port_of_entry": 25, "mode_of_entry": 25,
                "i94addr": 25, "destination_state": 25, "gender": 1, "visatype": 10,
                "visa_category": 25}),
    "immigration": Contract(
        "immigration", FACT_KEYS + ["count"],
        not_null=["arrdate", "i94cit", "i94port", "i94mode", "i94addr", "gender", "visatype"],
        widths={"i94port": 25, "i94addr": 25, "gender": 1, "visatype": 10},
        foreign_keys={"i94cit": ("citizenship_country", "id"), "i94port": ("entry_port", "id"),
                      "i94mode": ("entry_mode", "id"), "i94addr": ("destination_state", "id"),
                      "visatype": ("visa", "visatype")}),
    "visa": Contract(
        "visa", ["visatype", "visa_category_code", "visa_category"],
        not_null=["visatype"], key=["visatype"],
        widths={"visatype": 25, "visa_category": 25}),
    "citizenship_country": Contract(
        "citizenship_country", ["id", "country_of_citizenship"],
        not_null=["id", "country_of_citizenship"], key=["id"],
        widths={"country_of_citizenship": 25}),
    "destination_state": Contract(
        "destination_state", ["id", "destination_state"],
        not_null=["id", "destination_state"], key=["id"],
        widths={"id": 10, "destination_state": 25}),
    "entry_mode": Contract(
        "entry_mode", ["id", "mode_of_entry"],
        not_null=["id", "mode_of_entry"], key=["id"],
        widths={"mode_of_entry": 25}),
    "entry_port": Contract(
        "entry_port", ["id", "port_of_entry"],
        not_null=["id", "port_of_entry"], key=["id"],
        widths={"id": 10, "port_of_entry": 25}),
    "date": Contract(
        "date", ["date", "day", "week", "month", "year", "weekday"],
        not_null=["date", "day", "week", "month", "year", "weekday"], key=["date"]),
}

STAR_TABLES = ["immigration", "visa", "citizenship_country", "destination_state", "entry_mode",
               "entry_port", "date"]

# Countries that question 4 leaves out, by their full published names, upper case.
EXCLUDED_COUNTRIES = ("INDIA", "CHINA, PRC")

# Unknown members the dimensions are seeded with (code, label), by intent of the DDL.
UNKNOWN_MEMBERS: dict[str, tuple] = {
    "visa": (MISSING, 999, MISSING),
    "citizenship_country": (999, MISSING),
    "destination_state": (MISSING, MISSING),
}
