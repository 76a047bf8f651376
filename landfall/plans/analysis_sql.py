"""The analysis questions as Spark SQL over the warehouse views.

For users who keep their questions as SQL text: register the tables with
``Warehouse.register_views()`` and run ``spark.sql(question(...))``.  The
statements carry the same decisions as ``plans.analysis``: the year is a
date range on ``arrdate`` plus the ``arrival_year`` partition (pruning),
a visa type counts once (semi join), visa categories join on the full key
``(visatype, i94visa)`` over staging, names compare upper-cased, and every
top-k has the label as tie-break.
"""

from __future__ import annotations

from landfall.schemas import EXCLUDED_COUNTRIES


def _year(alias: str, year: int) -> str:
    return (f"{alias}.arrival_year = {year} AND {alias}.arrdate >= DATE'{year}-01-01' "
            f"AND {alias}.arrdate < DATE'{year + 1}-01-01'")


def _names(names) -> str:
    return ", ".join("'" + n.upper().replace("'", "''") + "'" for n in names)


def q1(year: int, k: int = 5) -> str:
    return f"""
SELECT f.visatype, sum(f.count) AS totalcount
FROM immigration f LEFT SEMI JOIN visa v ON f.visatype = v.visatype
WHERE {_year('f', year)}
GROUP BY f.visatype
ORDER BY totalcount DESC, visatype
LIMIT {k}"""


def q2(year: int, gender: str = "F", k: int = 5) -> str:
    return f"""
SELECT v.visa_category, s.gender, sum(s.count) AS totalcount
FROM immigration_stage s
JOIN visa v ON v.visatype = s.visatype AND v.visa_category_code = s.i94visa
WHERE {_year('s', year)} AND s.gender = '{gender}'
GROUP BY v.visa_category, s.gender
ORDER BY totalcount DESC, visa_category, gender
LIMIT {k}"""


def _state_totals(year: int) -> str:
    return f"""
SELECT f.visatype, ds.destination_state, sum(f.count) AS totalcount
FROM immigration f LEFT SEMI JOIN visa v ON f.visatype = v.visatype
JOIN destination_state ds ON ds.id = f.i94addr
WHERE {_year('f', year)}
GROUP BY f.visatype, ds.destination_state"""


def q3(year: int) -> str:
    return _state_totals(year) + "\nORDER BY totalcount DESC, visatype, destination_state"


def q3_top_state(year: int) -> str:
    return f"""
SELECT visatype, destination_state, totalcount FROM (
  SELECT *, row_number() OVER (PARTITION BY visatype
                               ORDER BY totalcount DESC, destination_state) AS rn
  FROM ({_state_totals(year)}) t) r
WHERE rn = 1"""


def q4(year: int, gender: str = "F", exclude=EXCLUDED_COUNTRIES, k: int = 5) -> str:
    return f"""
SELECT cc.country_of_citizenship, sum(f.count) AS totalcount
FROM immigration f JOIN citizenship_country cc ON f.i94cit = cc.id
WHERE {_year('f', year)} AND f.gender = '{gender}'
  AND upper(cc.country_of_citizenship) NOT IN ({_names(exclude)})
GROUP BY cc.country_of_citizenship
ORDER BY totalcount DESC, country_of_citizenship
LIMIT {k}"""


def q5(year: int, exclude: str = "Air", k: int = 1) -> str:
    return f"""
SELECT em.mode_of_entry, sum(f.count) AS totalcount
FROM immigration f JOIN entry_mode em ON f.i94mode = em.id
WHERE {_year('f', year)} AND upper(em.mode_of_entry) <> {_names([exclude])}
GROUP BY em.mode_of_entry
ORDER BY totalcount DESC, mode_of_entry
LIMIT {k}"""


def q6(year: int, k: int = 5) -> str:
    return f"""
SELECT ep.port_of_entry, sum(f.count) AS totalcount
FROM immigration f JOIN entry_port ep ON f.i94port = ep.id
WHERE {_year('f', year)}
GROUP BY ep.port_of_entry
ORDER BY totalcount DESC, port_of_entry
LIMIT {k}"""
