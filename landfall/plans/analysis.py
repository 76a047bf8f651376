"""The analysis questions over the star schema.

Where the warehouse keeps a year rollup of the fact, a question whose columns
one of its sets holds reads one small year partition of it.  Otherwise, and for
the visa categories, the plan shape is:

* the arrival-year condition is a half-open ``arrdate`` range (pushed into
  the Parquet scan) plus, when the fact is stored partitioned by
  ``arrival_year``, an equality on that partition column (partition pruning);
* every dimension is joined by broadcast after a size check;
* ``sum`` runs partial per task before the single shuffle on the labels;
* top-k is ``orderBy(...).limit(k)`` -> ``TakeOrderedAndProject``, with the
  label as tie-break so equal totals give one deterministic answer.

Label filters compare upper-cased full names given as parameters, because
the label files are upper case (``INDIA``) while questions are phrased in
mixed case (``India``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.functions.dates import year_range
from landfall.operators import rollup
from landfall.operators.joins import bounded_broadcast
from landfall.operators.star import Star
from landfall.schemas import EXCLUDED_COUNTRIES

YEAR_PARTITION = "arrival_year"


def _in_year(df: DataFrame, year: int) -> DataFrame:
    cond = year_range("arrdate", year)
    if YEAR_PARTITION in df.columns:
        cond = (F.col(YEAR_PARTITION) == F.lit(year)) & cond
    return df.where(cond)


def _top(df: DataFrame, label_cols: list[str], k: int | None) -> DataFrame:
    ordered = df.orderBy(F.col("totalcount").desc(), *[F.col(c).asc() for c in label_cols])
    return ordered.limit(k) if k else ordered


def _upper_set(names: Iterable[str]) -> list[str]:
    return [n.upper() for n in names]


def _year_totals(star: Star, year: int, columns: list[str]) -> DataFrame:
    """``(columns, count)`` of the year: from the stored rollup where one of its sets holds them, else the fact's rows."""
    if star.rollup is not None:
        kept = rollup.totals(star.rollup, columns, year)
        if kept is not None:
            return kept.select(*columns, "count")
    return _in_year(star.immigration, year).select(*columns, "count")


def _fact_known_visa(star: Star, year: int, columns: list[str]) -> DataFrame:
    """Totals or fact rows of the year whose visa type is a member of the visa dimension.

    A semi join: a visa type listed with several categories is counted once
    (an inner join on ``visatype`` would count it once per category).
    """
    types = bounded_broadcast(star.visa.select("visatype").distinct())
    return _year_totals(star, year, columns).join(types, "visatype", "left_semi")


def top_visa_types(star: Star, year: int, k: int = 5) -> DataFrame:
    """Q1: top ``k`` visa types of the year -> ``(visatype, totalcount)``."""
    agg = (_fact_known_visa(star, year, ["visatype"])
           .groupBy("visatype").agg(F.sum("count").alias("totalcount")))
    return _top(agg, ["visatype"], k)


def top_visa_categories(star: Star, year: int, gender: str = "F", k: int = 5) -> DataFrame:
    """Q2: top ``k`` visa categories for one gender -> ``(visa_category, gender, totalcount)``.

    The category depends on ``i94visa``, which the fact does not keep, so
    this reads the staging table and joins the visa dimension on the full
    key ``(visatype, i94visa)``.
    """
    if star.staging is None:
        raise ValueError("top_visa_categories needs the staging table (visa-category grain)")
    st = (_in_year(star.staging, year)
          .where(F.col("gender") == F.lit(gender))
          .select("visatype", F.col("i94visa").alias("visa_category_code"), "gender", "count"))
    visa = bounded_broadcast(star.visa.select("visatype", "visa_category_code", "visa_category"))
    agg = (st.join(visa, ["visatype", "visa_category_code"], "inner")
           .groupBy("visa_category", "gender").agg(F.sum("count").alias("totalcount")))
    return _top(agg, ["visa_category", "gender"], k)


def _state_totals(star: Star, year: int) -> DataFrame:
    state = bounded_broadcast(star.destination_state.select(
        F.col("id").alias("i94addr"), "destination_state"))
    return (_fact_known_visa(star, year, ["visatype", "i94addr"])
            .join(state, "i94addr", "inner")
            .groupBy("visatype", "destination_state").agg(F.sum("count").alias("totalcount")))


def state_totals_by_visa(star: Star, year: int) -> DataFrame:
    """Q3 as written: every (visa type, state) total, largest first, no limit."""
    return _top(_state_totals(star, year), ["visatype", "destination_state"], None)


def top_state_per_visa(star: Star, year: int) -> DataFrame:
    """Q3 as asked: the state with the largest total for each visa type.

    ``row_number`` over a window partitioned by visa type; Spark plans a
    ``WindowGroupLimit`` below the shuffle, so each task keeps only its
    local best row per visa type.
    """
    w = Window.partitionBy("visatype").orderBy(F.col("totalcount").desc(),
                                               F.col("destination_state").asc())
    return (_state_totals(star, year)
            .withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def top_countries(star: Star, year: int, gender: str = "F",
                  exclude: Iterable[str] = EXCLUDED_COUNTRIES, k: int = 5) -> DataFrame:
    """Q4: top ``k`` countries of citizenship for one gender, excluding some
    countries by full name -> ``(country_of_citizenship, totalcount)``.

    The ``'missing'`` member (codes without a label) counts as a country.
    """
    country = bounded_broadcast(star.citizenship_country.select(
        F.col("id").alias("i94cit"), "country_of_citizenship"))
    agg = (_year_totals(star, year, ["i94cit", "gender"])
           .where(F.col("gender") == F.lit(gender))
           .join(country, "i94cit", "inner")
           .where(~F.upper(F.col("country_of_citizenship")).isin(*_upper_set(exclude)))
           .groupBy("country_of_citizenship").agg(F.sum("count").alias("totalcount")))
    return _top(agg, ["country_of_citizenship"], k)


def top_mode_except(star: Star, year: int, exclude: str = "Air", k: int = 1) -> DataFrame:
    """Q5: the top mode of entry other than ``exclude`` -> ``(mode_of_entry, totalcount)``."""
    mode = bounded_broadcast(star.entry_mode.select(F.col("id").alias("i94mode"), "mode_of_entry"))
    agg = (_year_totals(star, year, ["i94mode"])
           .join(mode, "i94mode", "inner")
           .where(F.upper(F.col("mode_of_entry")) != F.lit(exclude.upper()))
           .groupBy("mode_of_entry").agg(F.sum("count").alias("totalcount")))
    return _top(agg, ["mode_of_entry"], k)


def top_ports(star: Star, year: int, k: int = 5) -> DataFrame:
    """Q6: top ``k`` ports of entry -> ``(port_of_entry, totalcount)``."""
    port = bounded_broadcast(star.entry_port.select(F.col("id").alias("i94port"), "port_of_entry"))
    agg = (_year_totals(star, year, ["i94port"])
           .join(port, "i94port", "inner")
           .groupBy("port_of_entry").agg(F.sum("count").alias("totalcount")))
    return _top(agg, ["port_of_entry"], k)
