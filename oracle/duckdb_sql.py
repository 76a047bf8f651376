"""DuckDB SQL oracles, one per key of the query catalog.

Each oracle is a self-contained statement over the driver's pre-registered
views (``lineitem``, ``orders``, ``customer``, ``part``, ``nation``): the
pipeline's inputs are restated as CTEs (the fixture projections), then each
stage is restated in plain SQL.  The statements are composed from the named
CTEs below; ``sql(name, final)`` prepends exactly the CTEs ``final`` needs.
"""

from __future__ import annotations

import re

# Fixed values, stated here once more so that an error in the library's own
# tables shows: column roles, drop and fill rules, widths, keys.
LONG_COLUMNS = "cicid admnum".split()
INT_COLUMNS = "i94yr i94mon i94cit i94res i94mode i94bir i94visa count biryear".split()
SAS_DATE_COLUMNS = "arrdate depdate".split()
TEXT_COLUMNS = ("i94port i94addr visapost occup entdepa entdepd matflag gender airline visatype fltno insnum "
                "dtadfile dtaddto entdepu").split()
I94_RAW_COLUMNS = ("cicid i94yr i94mon i94cit i94res i94port arrdate i94mode i94addr depdate i94bir i94visa count "
                   "dtadfile visapost occup entdepa entdepd entdepu matflag biryear dtaddto gender insnum airline "
                   "admnum fltno visatype").split()
NOT_NULL = {
    "immigration": "arrdate i94cit i94port i94mode i94addr gender visatype".split(),
    "visa": ["visatype"], "citizenship_country": ["id", "country_of_citizenship"],
    "destination_state": ["id", "destination_state"], "entry_mode": ["id", "mode_of_entry"],
    "entry_port": ["id", "port_of_entry"], "date": "date day week month year weekday".split(),
}
WIDTHS = {
    "immigration_stage": {"country_of_citizenship": 50, "i94port": 25, "port_of_entry": 25, "mode_of_entry": 25,
                          "i94addr": 25, "destination_state": 25, "gender": 1, "visatype": 10, "visa_category": 25},
    "immigration": {"i94port": 25, "i94addr": 25, "gender": 1, "visatype": 10},
    "visa": {"visatype": 25, "visa_category": 25}, "citizenship_country": {"country_of_citizenship": 25},
    "destination_state": {"id": 10, "destination_state": 25}, "entry_mode": {"mode_of_entry": 25},
    "entry_port": {"id": 10, "port_of_entry": 25},
}
KEYS = {"visa": "visatype", "citizenship_country": "id", "destination_state": "id", "entry_mode": "id",
        "entry_port": "id", "date": "date"}
FOREIGN_KEYS = {"i94cit": ("citizenship_country", "id"), "i94port": ("entry_port", "id"), "i94mode": ("entry_mode", "id"),
                "i94addr": ("destination_state", "id"), "visatype": ("visa", "visatype")}

YEAR = 1996
LO, HI = f"DATE '{YEAR}-01-01'", f"DATE '{YEAR + 1}-01-01'"
DAYS = "date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE))"
DROPPED = ["visapost", "occup", "entdepu", "insnum"]  # expected at sf0.001 / sf0.01
TAB = "chr(9)"
BLANKS = f"(' ' || {TAB})"

CTES: dict[str, str] = {}

CTES["raw"] = f"""
SELECT CAST(l_orderkey*8+l_linenumber AS DOUBLE) AS cicid,
 CAST(year(l_shipdate) AS DOUBLE) AS i94yr, CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
 CAST(100+c_nationkey AS DOUBLE) AS i94cit, CAST(100+l_suppkey%25 AS DOUBLE) AS i94res,
 CASE WHEN l_suppkey%10=9 THEN 'ZZZ' ELSE concat('P', CAST(10+l_suppkey%10 AS VARCHAR(2))) END AS i94port,
 CAST({DAYS} AS DOUBLE) AS arrdate,
 CAST(CASE l_orderkey%20 WHEN 0 THEN NULL WHEN 1 THEN 7 WHEN 2 THEN 9 WHEN 3 THEN 3 WHEN 4 THEN 2 ELSE 1 END AS DOUBLE) AS i94mode,
 CASE WHEN l_partkey%20=0 THEN NULL WHEN l_partkey%20=1 THEN 'QQ' ELSE concat('S', CAST(l_partkey%8 AS VARCHAR(2))) END AS i94addr,
 CASE WHEN l_orderkey%9=0 THEN NULL ELSE CAST({DAYS} AS DOUBLE)+l_quantity END AS depdate,
 CAST(CASE WHEN l_orderkey%50=0 THEN NULL ELSE l_quantity END AS DOUBLE) AS i94bir,
 CAST(1+l_linenumber%3 AS DOUBLE) AS i94visa,
 CAST(1 AS DOUBLE) AS count,
 CAST(year(o_orderdate) AS VARCHAR(8)) AS dtadfile,
 CASE WHEN l_orderkey%10<6 THEN NULL ELSE c_mktsegment END AS visapost,
 CASE WHEN l_orderkey%100<99 THEN NULL ELSE 'STU' END AS occup,
 l_returnflag AS entdepa,
 CASE WHEN l_orderkey%9=0 THEN NULL ELSE l_linestatus END AS entdepd,
 CAST(NULL AS VARCHAR(1)) AS entdepu,
 CASE WHEN l_orderkey%10<3 THEN NULL ELSE 'M' END AS matflag,
 CAST(CASE WHEN l_orderkey%50=0 THEN NULL ELSE year(l_shipdate)-l_quantity END AS DOUBLE) AS biryear,
 CAST(year(l_shipdate)+1 AS VARCHAR(8)) AS dtaddto,
 CASE WHEN l_partkey%10=0 THEN NULL WHEN l_partkey%2=0 THEN 'F' ELSE 'M' END AS gender,
 CASE WHEN l_orderkey%25<24 THEN NULL ELSE '3668' END AS insnum,
 CASE WHEN l_orderkey%33=0 THEN NULL ELSE concat('A', CAST(l_suppkey%7 AS VARCHAR(2))) END AS airline,
 CAST(l_orderkey AS DOUBLE)*1000000 AS admnum,
 CASE WHEN l_orderkey%40=0 THEN NULL ELSE CAST(l_partkey%500 AS VARCHAR(8)) END AS fltno,
 CASE WHEN l_orderkey%40=5 THEN 'CP'
      ELSE concat(CASE l_linenumber%3 WHEN 0 THEN 'B' WHEN 1 THEN 'W' ELSE 'F' END, CAST(1+l_partkey%2 AS VARCHAR(2))) END AS visatype
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
"""

CTES["airports_raw"] = """
SELECT concat('K', CAST(p_partkey AS VARCHAR(12))) AS ident,
 CASE WHEN p_partkey%3=0 THEN NULL ELSE concat('L', CAST(p_partkey AS VARCHAR(12))) END AS local_code,
 CASE WHEN p_partkey%2=0 THEN NULL ELSE concat('I', CAST(p_partkey AS VARCHAR(12))) END AS iata_code,
 CAST(CASE WHEN p_partkey%5=0 THEN NULL ELSE p_retailprice END AS DOUBLE) AS elevation_ft,
 CASE WHEN p_size%4=0 THEN NULL ELSE 'EU' END AS continent,
 CASE WHEN p_size%9=0 THEN NULL ELSE p_brand END AS iso_country
FROM part
"""

CTES["label_lines"] = f"""
SELECT 'I94CIT_I94RES' AS label, concat('   ', CAST(100+n_nationkey AS VARCHAR(4)), ' =  ', chr(39), n_name, chr(39), CASE WHEN n_nationkey%3=0 THEN ' ' ELSE '' END) AS line
FROM nation WHERE n_nationkey%6<>5
UNION ALL
SELECT 'I94Port', concat('   ', chr(39), 'P', CAST(10+n_nationkey AS VARCHAR(2)), chr(39),
 CASE n_nationkey WHEN 7 THEN concat(' ', {TAB}) WHEN 8 THEN concat({TAB}, {TAB}) ELSE {TAB} END,
 '=', {TAB}, chr(39), n_name, ', XX     ', chr(39))
FROM nation WHERE n_nationkey<9
UNION ALL
SELECT 'i94addr', concat({TAB}, chr(39), 'S', CAST(n_nationkey AS VARCHAR(2)), chr(39), '=', chr(39), 'STATE ', n_name, chr(39))
FROM nation WHERE n_nationkey<8
UNION ALL
SELECT 'I94Region', concat('  ', CAST(r_regionkey AS VARCHAR), ' = ', chr(39), r_name, chr(39)) FROM region
UNION ALL
SELECT 'I94Mode', concat(code, ' = ', chr(39), v, chr(39)) FROM (VALUES ('1','Air'),('2','Sea'),('3','Land'),('9','Not reported')) AS t(code, v)
UNION ALL
SELECT 'I94Visa', concat(' ', code, ' = ', v) FROM (VALUES ('1','Business'),('2','Pleasure'),('3','Student')) AS t(code, v)
"""

CTES["parsed"] = f"""
SELECT label, split_part(replace(line, chr(39), ''), '=', 1) AS code,
 trim(split_part(replace(line, chr(39), ''), '=', 2), {BLANKS}) AS value
FROM label_lines WHERE strpos(line, '=') > 0
"""


def _int_code(c: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST(trim({c}, {BLANKS}) AS DOUBLE)) AS INTEGER)"


def _no_blanks(c: str) -> str:
    return f"replace(replace({c}, ' ', ''), {TAB}, '')"


CTES["visa_lk"] = f"SELECT {_int_code('code')} AS code, value FROM parsed WHERE label = 'I94Visa'"
CTES["cit_lk"] = f"SELECT {_int_code('code')} AS code, value FROM parsed WHERE label = 'I94CIT_I94RES'"
CTES["mode_lk"] = f"SELECT {_int_code('code')} AS code, value FROM parsed WHERE label = 'I94Mode'"
CTES["port_lk"] = f"SELECT {_no_blanks('code')} AS code, value FROM parsed WHERE label = 'I94Port'"
CTES["addr_lk"] = f"SELECT right({_no_blanks('code')}, 2) AS code, value FROM parsed WHERE label = 'i94addr'"


def _typed_col(c: str) -> str:
    if c in LONG_COLUMNS:
        return f"CAST(trunc({c}) AS BIGINT) AS {c}"
    if c in INT_COLUMNS:
        return f"CAST(trunc({c}) AS INTEGER) AS {c}"
    if c in SAS_DATE_COLUMNS:
        return f"DATE '1960-01-01' + CAST(trunc({c}) AS INTEGER) AS {c}"
    return f"CAST({c} AS VARCHAR) AS {c}"


PERIOD = ("lower(strftime(make_date(CAST(i94yr AS INTEGER), CAST(i94mon AS INTEGER), 1), '%b')) "
          "|| lpad(CAST(CAST(i94yr AS INTEGER) % 100 AS VARCHAR), 2, '0')")

CTES["typed"] = "SELECT " + ", ".join(_typed_col(c) for c in I94_RAW_COLUMNS) + " FROM raw"
CTES["typed_p"] = f"SELECT *, {PERIOD} AS source_period FROM typed"

KEPT = [c for c in I94_RAW_COLUMNS if c not in DROPPED]


def _fill(c: str) -> str:
    return f"coalesce({c}, 'missing') AS {c}" if c in TEXT_COLUMNS else c


CTES["profiled"] = "SELECT " + ", ".join(_fill(c) for c in KEPT) + " FROM typed"
CTES["profiled_p"] = f"SELECT *, {PERIOD} AS source_period FROM profiled"

KEYS8 = "arrdate, i94cit, i94port, i94mode, i94addr, gender, visatype, i94visa"
KEYS7 = "arrdate, i94cit, i94port, i94mode, i94addr, gender, visatype"

CTES["agg"] = f"SELECT {KEYS8}, CAST(sum(count) AS BIGINT) AS count FROM profiled GROUP BY {KEYS8}"
CTES["agg_p"] = (f"SELECT {KEYS8}, source_period, CAST(sum(count) AS BIGINT) AS count "
                 f"FROM profiled_p GROUP BY {KEYS8}, source_period")

CTES["staging"] = """
SELECT a.arrdate, a.i94cit, coalesce(c.value, 'missing') AS country_of_citizenship,
 a.i94port, coalesce(p.value, 'missing') AS port_of_entry,
 a.i94mode, coalesce(m.value, 'missing') AS mode_of_entry,
 a.i94addr, coalesce(s.value, 'missing') AS destination_state,
 a.gender, a.visatype, a.i94visa, coalesce(v.value, 'missing') AS visa_category, a.count, a.source_period
FROM agg_p a
LEFT JOIN visa_lk v ON v.code = a.i94visa
LEFT JOIN cit_lk c ON c.code = a.i94cit
LEFT JOIN addr_lk s ON s.code = a.i94addr
LEFT JOIN port_lk p ON p.code = a.i94port
JOIN mode_lk m ON m.code = a.i94mode
"""

CTES["fact"] = f"SELECT {KEYS7}, CAST(sum(count) AS BIGINT) AS count FROM staging GROUP BY {KEYS7}"
CTES["d_visa"] = "SELECT DISTINCT visatype, i94visa AS visa_category_code, visa_category FROM staging"
CTES["d_country"] = "SELECT DISTINCT i94cit AS id, country_of_citizenship FROM staging"
CTES["d_port"] = "SELECT DISTINCT i94port AS id, port_of_entry FROM staging"
CTES["d_mode"] = "SELECT DISTINCT i94mode AS id, mode_of_entry FROM staging"
CTES["d_state"] = "SELECT DISTINCT i94addr AS id, destination_state FROM staging"
CTES["d_date"] = """
SELECT d AS date, CAST(day(d) AS INTEGER) AS day, CAST(week(d) AS INTEGER) AS week,
 CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
 CAST(isodow(d) - 1 AS INTEGER) AS weekday
FROM (SELECT DISTINCT arrdate AS d FROM staging WHERE arrdate IS NOT NULL) t
"""
CTES["airports_clean"] = """
SELECT ident, local_code, iata_code,
 coalesce(TRY_CAST(trunc(elevation_ft) AS INTEGER), -1000) AS elevation_ft,
 coalesce(continent, 'NA') AS continent, coalesce(iso_country, 'NA') AS iso_country,
 coalesce(iata_code, local_code, ident) AS airport_code
FROM airports_raw
"""

# Star tables under their warehouse names, for the generated quality checks.
STAR_CTE = {"immigration_stage": "staging_np", "immigration": "fact", "visa": "d_visa",
            "citizenship_country": "d_country", "destination_state": "d_state",
            "entry_mode": "d_mode", "entry_port": "d_port", "date": "d_date"}
CTES["staging_np"] = "SELECT * EXCLUDE (source_period) FROM staging"


def _deps(text: str) -> list[str]:
    names = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", text))
    return [n for n in CTES if n in names]


def sql(final: str) -> str:
    """``WITH`` the CTEs ``final`` needs (transitively, in dependency order) + ``final``."""
    order: list[str] = []

    def visit(name: str, seen: set[str]) -> None:
        if name in order or name in seen:
            return
        seen.add(name)
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, seen)
        order.append(name)

    for n in _deps(final):
        visit(n, set())
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order) + "\n" + final.strip()


def _text_cols(cols: list[str]) -> str:
    return ", ".join(cols)


def _top(select: str, label: str, k: int | None) -> str:
    lim = f" LIMIT {k}" if k else ""
    return f"{select} ORDER BY totalcount DESC, {label}{lim}"


def _in_year(alias: str) -> str:
    return f"JOIN d_date dd ON {alias}.arrdate = dd.date AND dd.year = {YEAR}"


def _column_checks(kind: str) -> str:
    parts = []
    for table, cte in STAR_CTE.items():
        if kind == "not_null":
            for col in NOT_NULL.get(table, []):
                parts.append(f"SELECT 'not_null' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
                             f"count(*) FILTER (WHERE {col} IS NULL) AS bad_rows FROM {cte}")
        else:
            for col, w in WIDTHS.get(table, {}).items():
                parts.append(f"SELECT 'width' AS check_name, '{table}' AS table_name, '{col}' AS column_name, "
                             f"count(*) FILTER (WHERE length({col}) > {w}) AS bad_rows FROM {cte}")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT check_name, table_name, column_name, bad_rows, bad_rows = 0 AS passed FROM ({body}) t"


def _unique_checks() -> str:
    parts = []
    for table, key in KEYS.items():
        parts.append(
            f"SELECT 'unique_key' AS check_name, '{table}' AS table_name, '{key}' AS column_name, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM "
            f"(SELECT {key}, count(*) AS n FROM {STAR_CTE[table]} GROUP BY {key} HAVING count(*) > 1) t")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT check_name, table_name, column_name, bad_rows, bad_rows = 0 AS passed FROM ({body}) t"


def _fk_checks() -> str:
    parts = []
    for col, (parent, pcol) in FOREIGN_KEYS.items():
        parts.append(
            f"SELECT 'foreign_key' AS check_name, 'immigration' AS table_name, '{col}' AS column_name, "
            f"count(*) AS bad_rows FROM fact x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {STAR_CTE[parent]} p WHERE p.{pcol} = x.{col})")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT check_name, table_name, column_name, bad_rows, bad_rows = 0 AS passed FROM ({body}) t"


def _nonempty() -> str:
    parts = [f"SELECT 'nonempty' AS check_name, '{t}' AS table_name, CAST(NULL AS VARCHAR) AS column_name, "
             f"CAST(CASE WHEN EXISTS (SELECT 1 FROM {cte}) THEN 0 ELSE 1 END AS BIGINT) AS bad_rows FROM (SELECT 1) o"
             for t, cte in STAR_CTE.items()]
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT check_name, table_name, column_name, bad_rows, bad_rows = 0 AS passed FROM ({body}) t"


def _run_checks() -> str:
    """Every check row of one run over all months."""
    nonempty, not_null, width, unique, fk = (
        _nonempty(), _column_checks("not_null"), _column_checks("width"), _unique_checks(), _fk_checks())
    own = [f"SELECT * FROM ({x}) t" for x in (nonempty, not_null, width, unique, fk)]
    for name, lk in (("visa", "visa_lk"), ("citizenship", "cit_lk"), ("state", "addr_lk"), ("port", "port_lk"), ("mode", "mode_lk")):
        own.append(f"SELECT 'unique_key', 'lookup_{name}', 'code', CAST(coalesce(sum(n), 0) AS BIGINT), coalesce(sum(n), 0) = 0 "
                   f"FROM (SELECT count(*) AS n FROM {lk} WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1) t")
    for check in ("reconcile_land", "reconcile_staged"):
        own.append(f"SELECT DISTINCT '{check}', 'immigration', source_period, CAST(0 AS BIGINT), true FROM typed_p")
    own.append("SELECT 'files', 'immigration', x, CAST(0 AS BIGINT), true FROM (VALUES ('immigration'), ('labels')) AS t(x)")
    own.append("SELECT 'mode_loss', 'immigration', source_period, "
               "CAST(coalesce(sum(count) FILTER (WHERE i94mode IS NULL OR i94mode NOT IN (SELECT code FROM mode_lk)), 0) AS BIGINT), "
               "true FROM profiled_p GROUP BY source_period")
    return "\nUNION ALL\n".join(own)


def _null_counts() -> str:
    parts = [f"SELECT source_period, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows, "
             f"count(*) AS total_rows FROM typed_p GROUP BY source_period" for c in I94_RAW_COLUMNS]
    return "\nUNION ALL\n".join(parts)


def _null_ratio() -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows, "
             f"count(*) AS total_rows FROM typed" for c in I94_RAW_COLUMNS]
    body = "\nUNION ALL\n".join(parts)
    return ("SELECT column_name, null_rows, total_rows, "
            "CASE WHEN total_rows > 0 THEN (null_rows * 1000000) // total_rows ELSE 0 END AS null_ppm, "
            "coalesce(null_rows / total_rows > 0.3, false) AS dropped "
            f"FROM ({body}) t")


def _join(lk: str, key: str, label: str, how: str = "LEFT") -> str:
    return (f"SELECT a.*, l.value AS {label} FROM agg a {how} JOIN {lk} l ON l.code = a.{key}")


FINALS: dict[str, str] = {
    # sources and sinks
    "land_i94": "SELECT source_period, count(*) AS row_count, CAST(sum(count) AS BIGINT) AS total_count "
                "FROM (SELECT count, " + PERIOD + " AS source_period FROM raw) t GROUP BY source_period",
    "label_lines_parsed": "SELECT label, code, value FROM parsed",
    "land_airports": "SELECT * FROM airports_raw",
    "scan_labels_csv": "SELECT label, code, value FROM parsed",
    "sink_parquet_roundtrip": "SELECT * FROM airports_clean",
    "source_period": "SELECT source_period, count(*) AS row_count FROM "
                     "(SELECT " + PERIOD + " AS source_period FROM raw) t GROUP BY source_period",
    "incremental_new_files": "SELECT nullif(source_period, 'feb97') AS source_period, count(*) AS row_count, "
                             "CAST(sum(count) AS BIGINT) AS total_count FROM staging GROUP BY 1",
    "redelivered_month": """
SELECT p.source_period, CASE p.source_period WHEN 'jun96' THEN 'replaced,replaced' WHEN 'mar97' THEN 'replaced,duplicate'
 WHEN 'apr96' THEN 'replaced,added' ELSE 'replaced' END AS actions, s.row_count, s.total_count
FROM (SELECT DISTINCT source_period FROM typed_p) p LEFT JOIN (SELECT source_period, count(*) AS row_count,
 CAST(sum(count) AS BIGINT) AS total_count FROM staging GROUP BY source_period) s USING (source_period)""",
    "staging_merged": "SELECT * FROM staging",
    "members_corrected": """
SELECT 'visa' AS table_name, visatype AS id, visa_category AS label FROM d_visa
UNION ALL SELECT 'citizenship_country', CAST(id AS VARCHAR), country_of_citizenship FROM d_country
UNION ALL SELECT 'destination_state', id, destination_state FROM d_state
UNION ALL SELECT 'entry_mode', CAST(id AS VARCHAR), mode_of_entry FROM d_mode
UNION ALL SELECT 'entry_port', id, port_of_entry FROM d_port
UNION ALL SELECT 'date', CAST(date AS VARCHAR), CAST(weekday AS VARCHAR) FROM d_date""",
    "null_counts_stored": _null_counts(),
    "checks_stored": "\nUNION ALL\n".join(f"SELECT * FROM ({x}) t" for x in (
        _nonempty(), _column_checks("not_null"), _column_checks("width"), _unique_checks(), _fk_checks())),
    "year_rollup": "\nUNION ALL\n".join(
        f"SELECT '{','.join(s)}' AS columns, CAST(year(arrdate) AS INTEGER) AS arrival_year, CAST({s[0]} AS VARCHAR) AS first_key, "
        f"CAST({s[1] if len(s) > 1 else 'NULL'} AS VARCHAR) AS second_key, CAST(sum(count) AS BIGINT) AS totalcount, "
        f"count(*) AS row_count FROM fact GROUP BY year(arrdate), {', '.join(s)}"
        for s in (["visatype"], ["i94mode"], ["i94port"], ["visatype", "i94addr"], ["i94cit", "gender"])),
    "profile_stored": "SELECT * FROM profiled",
    "rejected_cells": """
SELECT source_period, column_name, cell, count(*) AS cells FROM (
 SELECT source_period, 'i94cit' AS column_name, concat('x', CAST(cicid % 5 AS VARCHAR)) AS cell FROM typed_p WHERE i94yr <= 1996 AND cicid % 97 = 0
 UNION ALL SELECT source_period, 'arrdate', 'n/a' FROM typed_p WHERE i94yr <= 1996 AND cicid % 101 = 0
 UNION ALL SELECT source_period, 'biryear', '1.0E12' FROM typed_p WHERE i94yr > 1996 AND cicid % 103 = 0) t
GROUP BY source_period, column_name, cell""",
    "dq_reconcile_content": "SELECT source_period, count(*) AS source_rows, count(*) AS target_rows, true AS passed "
                            "FROM typed_p GROUP BY source_period",
    "land_i94_csv": "SELECT source_period, count(*) AS row_count, "
                    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS total_{c}" for c in ("count", "i94cit", "i94res", "arrdate", "admnum"))
                    + ", count(gender) AS n_gender, min(visatype) AS first_visatype "
                    "FROM (SELECT *, " + PERIOD + " AS source_period FROM raw) t GROUP BY source_period",
    "land_airports_csv": "SELECT *, concat('airport ', ident) AS name, '1.5, -2.5' AS coordinates FROM airports_raw",
    "files_per_source": """
SELECT 'immigration' AS source, count(DISTINCT source_period) AS source_files, count(DISTINCT source_period) AS target_files,
 true AS passed FROM typed_p
UNION ALL SELECT 'labels', count(DISTINCT label), count(DISTINCT label), true FROM label_lines""",
    "star_refresh": "SELECT 'immigration_total' AS table_name, CAST(sum(count) AS BIGINT) AS row_count FROM staging UNION ALL "
                    + " UNION ALL ".join(f"SELECT '{t}', count(*) FROM {c}" for t, c in STAR_CTE.items()
                                         if t != "immigration_stage"),
    "run_all_checks": _run_checks(),
    "run_twice": "SELECT source_period, count(*) AS row_count, CAST(sum(count) AS BIGINT) AS total_count, true AS reconciled "
                 "FROM staging GROUP BY source_period",
    "dim_with_unknown": """
SELECT 'visa' AS table_name, visatype AS id, visa_category_code AS code, visa_category AS label FROM d_visa
UNION ALL SELECT 'visa', 'missing', 999, 'missing' WHERE NOT EXISTS (SELECT 1 FROM d_visa WHERE visatype = 'missing')
UNION ALL SELECT 'citizenship_country', CAST(id AS VARCHAR), CAST(NULL AS INTEGER), country_of_citizenship FROM d_country
UNION ALL SELECT 'citizenship_country', '999', CAST(NULL AS INTEGER), 'missing' WHERE NOT EXISTS (SELECT 1 FROM d_country WHERE id = 999)
UNION ALL SELECT 'destination_state', id, CAST(NULL AS INTEGER), destination_state FROM d_state
UNION ALL SELECT 'destination_state', 'missing', CAST(NULL AS INTEGER), 'missing' WHERE NOT EXISTS (SELECT 1 FROM d_state WHERE id = 'missing')
""",
    # projections and scalar functions
    "cast_i94_types": "SELECT " + _text_cols(LONG_COLUMNS + INT_COLUMNS) + " FROM typed",
    "cast_binary_text": "SELECT " + _text_cols(TEXT_COLUMNS) + " FROM typed",
    "sas_dates": "SELECT cicid, arrdate, depdate FROM typed",
    "airport_code": "SELECT ident, airport_code FROM airports_clean",
    "fill_missing": "SELECT " + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in TEXT_COLUMNS) + " FROM typed",
    "airports_clean": "SELECT * FROM airports_clean",
    "distinct_continent": "SELECT DISTINCT continent FROM airports_raw",
    "profile_i94": "SELECT * FROM profiled",
    "label_port": "SELECT code, value FROM port_lk",
    "label_addr": "SELECT code, value FROM addr_lk",
    "label_int": "SELECT label, " + _int_code("code") + " AS code, value FROM parsed "
                 "WHERE label NOT IN ('I94Port', 'i94addr')",
    # joins
    "join_visa": _join("visa_lk", "i94visa", "visa_category"),
    "join_country": _join("cit_lk", "i94cit", "country_of_citizenship"),
    "join_state": _join("addr_lk", "i94addr", "destination_state"),
    "join_port": _join("port_lk", "i94port", "port_of_entry"),
    "join_mode": _join("mode_lk", "i94mode", "mode_of_entry", "INNER"),
    "orphans": _fk_checks(),
    # aggregates and flows
    "staging_agg": "SELECT * FROM agg",
    "staging": "SELECT * FROM staging",
    "fact_immigration": "SELECT * FROM fact",
    "dim_visa": "SELECT * FROM d_visa",
    "dim_country": "SELECT * FROM d_country",
    "dim_port": "SELECT * FROM d_port",
    "dim_mode": "SELECT * FROM d_mode",
    "dim_state": "SELECT * FROM d_state",
    "dim_date": "SELECT * FROM d_date",
    "row_counts": "\nUNION ALL\n".join(
        [f"SELECT 'i94_raw' AS table_name, count(*) AS row_count FROM raw"]
        + [f"SELECT '{t}', count(*) FROM {cte}" for t, cte in STAR_CTE.items()]),
    "null_counts": _null_counts(),
    "null_ratio": _null_ratio(),
    # quality
    "dq_nonempty": _nonempty(),
    "dq_not_null": _column_checks("not_null"),
    "dq_width": _column_checks("width"),
    "dq_unique_key": _unique_checks(),
    "dq_mode_dropped": "SELECT i94mode, count(*) AS groups, CAST(sum(count) AS BIGINT) AS total_count FROM agg a "
                       "WHERE NOT EXISTS (SELECT 1 FROM mode_lk m WHERE m.code = a.i94mode) GROUP BY i94mode",
    "dq_reconcile_land": "SELECT source_period, count(*) AS source_rows, count(*) AS target_rows, true AS passed "
                         "FROM typed_p GROUP BY source_period",
    "dq_reconcile_profile": "SELECT source_period, count(*) AS source_rows, count(*) AS target_rows, true AS passed "
                            "FROM typed_p GROUP BY source_period",
    # questions
    "q1": _top(f"SELECT f.visatype, CAST(sum(f.count) AS BIGINT) AS totalcount FROM fact f {_in_year('f')} "
               f"WHERE f.visatype IN (SELECT visatype FROM d_visa) GROUP BY f.visatype", "visatype", 5),
    "q2": _top(f"SELECT v.visa_category, s.gender, CAST(sum(s.count) AS BIGINT) AS totalcount FROM staging s "
               f"JOIN d_visa v ON v.visatype = s.visatype AND v.visa_category_code = s.i94visa {_in_year('s')} "
               f"WHERE s.gender = 'F' GROUP BY v.visa_category, s.gender", "visa_category, gender", 5),
    "q3": _top(f"SELECT f.visatype, ds.destination_state, CAST(sum(f.count) AS BIGINT) AS totalcount FROM fact f "
               f"{_in_year('f')} JOIN d_state ds ON ds.id = f.i94addr "
               f"WHERE f.visatype IN (SELECT visatype FROM d_visa) GROUP BY f.visatype, ds.destination_state",
               "visatype, destination_state", None),
    "q3_top_state": f"""
SELECT visatype, destination_state, totalcount FROM (
 SELECT *, row_number() OVER (PARTITION BY visatype ORDER BY totalcount DESC, destination_state) AS rn FROM (
  SELECT f.visatype, ds.destination_state, CAST(sum(f.count) AS BIGINT) AS totalcount FROM fact f
  {_in_year('f')} JOIN d_state ds ON ds.id = f.i94addr
  WHERE f.visatype IN (SELECT visatype FROM d_visa) GROUP BY f.visatype, ds.destination_state) t) r
WHERE rn = 1""",
    "q4": _top(f"SELECT cc.country_of_citizenship, CAST(sum(f.count) AS BIGINT) AS totalcount FROM fact f "
               f"JOIN d_country cc ON f.i94cit = cc.id {_in_year('f')} "
               f"WHERE f.gender = 'F' AND upper(cc.country_of_citizenship) NOT IN ('NATION_1', 'NATION_2') "
               f"GROUP BY cc.country_of_citizenship", "country_of_citizenship", 5),
    "q5": _top(f"SELECT em.mode_of_entry, CAST(sum(f.count) AS BIGINT) AS totalcount FROM fact f "
               f"JOIN d_mode em ON f.i94mode = em.id {_in_year('f')} "
               f"WHERE upper(em.mode_of_entry) <> 'AIR' GROUP BY em.mode_of_entry", "mode_of_entry", 1),
    "q6": _top(f"SELECT ep.port_of_entry, CAST(sum(f.count) AS BIGINT) AS totalcount FROM fact f "
               f"JOIN d_port ep ON f.i94port = ep.id {_in_year('f')} GROUP BY ep.port_of_entry",
               "port_of_entry", 5),
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(final) for name, final in FINALS.items()}
