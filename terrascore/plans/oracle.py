"""DuckDB oracle SQL, one statement per registered query.

Composed from the registry's data by other means than the Spark plans: CASE
ladders are generated from the rungs, facts are conditional aggregates, and a
statement carries only the common tables that it uses. Observations are
unnested from one list per group and materialised once. Constants are doubles
(``e0``) so that no engine switches to decimals.
"""

from __future__ import annotations

import math
import re

from .. import registry as R
from ..operators import views as V
from ..schemas import CLEAN
from . import io_queries as IO
from . import queries as Q

PROCESS_DATE = "2025-01-01"
EXTRACTION_DATE = "2025-01-01"
D1, D2 = "2025-01-01", "2025-01-02"


def _num(x: float) -> str:
    return f"{x:g}e0"


def _list(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _cols(names, table: str = "") -> str:
    return ", ".join(f'{table}"{n}"' for n in names)


# ---------------------------------------------------------------- adapter
def _half_up(num: str, den: str) -> str:
    return f"((200 * ({num}) + ({den})) // (2 * ({den})))"


def _hundredth(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


# The 13 values of a group, in registry order.
_VALUES = (
    _hundredth(_half_up("50 * n_r", "n")), _hundredth(_half_up("80 * n_f", "n")), _hundredth(_half_up("100 * n_n", "n")),
    _hundredth("s_price"), _hundredth("min_price"), _hundredth("max_price"),
    "CAST(max_disc + min_tax AS DOUBLE)", _hundredth("max_qty * 3"),
    _hundredth(_half_up("10 * s_tax", "n")), _hundredth(f"({_half_up('4 * s_tax', 'n')} - 400)"),
    _hundredth(_half_up("s_qty", "200")), _hundredth(_half_up("s_disc", "n")), _hundredth(_half_up("100 * n_pri", "n")),
)


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


_GROUPS = f"""
SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_r, count(*) FILTER (WHERE l_linestatus = 'F') AS n_f,
    count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
    count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS n_pri,
    {", ".join(f"{f}({_cents(c)}) AS {a}" for f, c, a in (
        ("sum", "l_extendedprice", "s_price"), ("min", "l_extendedprice", "min_price"), ("max", "l_extendedprice", "max_price"),
        ("max", "l_discount", "max_disc"), ("min", "l_tax", "min_tax"), ("max", "l_quantity", "max_qty"),
        ("sum", "l_tax", "s_tax"), ("sum", "l_quantity", "s_qty"), ("sum", "l_discount", "s_disc")))}
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL"""

_ENTRIES = ", ".join(
    f"{{'id': '{ind.code}', 'name': '{ind.name}', 'v': CASE WHEN (7 * k + 3 * yr + {i} * (k % 5)) % 11 >= 3 THEN {v} END}}"
    for i, (ind, v) in enumerate(zip(R.INDICATORS, _VALUES)))


def _observations(code: str, name: str, joins: str) -> str:
    return f"""
SELECT country_code, country_name, e.id AS indicator_id, e.name AS indicator_name,
    CAST(yr AS VARCHAR) AS "year", e.v AS "value", DATE '{EXTRACTION_DATE}' AS extraction_date
FROM (SELECT yr, {code} AS country_code, {name} AS country_name, unnest([{_ENTRIES}]) AS e FROM grp {joins})"""


_CUSTOMER_CODE = "CASE WHEN k % 97 = 0 THEN '' WHEN k % 89 = 0 THEN NULL ELSE 'C' || k END"
_KEY = "TRY_CAST(regexp_extract(country_code, '\\d+') AS BIGINT)"


def _cleaned(source: str) -> str:
    return f"""
SELECT country_code, country_name, indicator_id, indicator_name, TRY_CAST("year" AS INTEGER) AS "year", "value",
    extraction_date, DATE '{PROCESS_DATE}' AS process_date FROM {source}
WHERE "value" IS NOT NULL AND country_code <> '' AND TRY_CAST("year" AS INTEGER) IS NOT NULL"""


# ---------------------------------------------------------------- facts, scores
def _pivot(names, missing=()) -> str:
    return ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" if n in missing else
                     f"max(\"value\") FILTER (WHERE indicator_name = '{n}') AS {n}" for n in names)


def _fact(fact: str, source: str = "clean", missing=()) -> str:
    names = R.FACT_COLUMNS[fact]
    present = [n for n in names if n not in missing]
    test = f"indicator_name IN ({_list(present)})" if present else "false"
    return f'SELECT country_code, "year", {_pivot(names, missing)} FROM {source} WHERE {test} GROUP BY country_code, "year"'


def _ladder(value: str, rungs, floor: int, op: str) -> str:
    return (f"CASE WHEN {value} IS NULL THEN {R.MISSING_SCORE} "
            + " ".join(f"WHEN {value} {op} {t} THEN {s}" for t, s in rungs) + f" ELSE {floor} END")


def _penalty(column: str, segments) -> str:
    def rise(s: R.Segment) -> str:
        slope = f"({column} - {_num(s.knot)}) * {_num(s.num)} / {_num(s.den)}" if s.num else "0e0"
        return f"{_num(s.base)} + " + (slope if math.isinf(s.cap) else f"least({slope}, {_num(s.cap)})")
    steps = [f"WHEN {column} <= {_num(s.up_to)} THEN {rise(s)}" for s in segments[:-1]]
    return f"CASE {' '.join(steps)} ELSE {rise(segments[-1])} END" if steps else f"({rise(segments[-1])})"


def _ruled(rules) -> str:
    whens = []
    for r in rules:
        parts = [_penalty(c, s) for c, s in r.penalties.items()]
        total = (" - ".join(["100e0", *parts]) if r.divisor is None
                 else f"100e0 - ({' + '.join(parts)}) / {_num(r.divisor)}")
        whens.append(f"WHEN {' AND '.join(f'{c} IS NOT NULL' for c in r.penalties)} THEN {total}")
    return f"CASE {' '.join(whens)} ELSE {_num(R.MISSING_SCORE)} END"


SCORE_SQL = {
    "emp_score": _ruled(R.SCORE_RULES["emp_score"]),
    "gdp_score": _ladder("coalesce(gdp_per_capita_ppp, gdp_per_capita)", R.GDP_LADDER, R.GDP_FLOOR, ">"),
    "business_score": _ladder("ease_of_business", R.BUSINESS_LADDER, R.BUSINESS_FLOOR, "<="),
    "stability_score": _ruled(R.SCORE_RULES["stability_score"]),
    "edu_score": _ladder("school_enrollment", R.EDU_LADDER, R.EDU_FLOOR, ">"),
    "investment_score": _ladder("foreign_direct_investment", R.INVESTMENT_LADDER, R.INVESTMENT_FLOOR, ">"),
}
_INDEX = " + ".join(f"{name} * {_num(w)}" for name, w in R.INDEX_WEIGHTS)
_RANKED = [c for c in R.INDEX_OUTPUT_COLUMNS if c != "opportunity_rank"]

# ---------------------------------------------------------------- common tables
_MISSING = ("ease_of_business", "education_spending", "school_enrollment")
COMMON = {
    "grp": _GROUPS,
    "raw": _observations(_CUSTOMER_CODE, "c_name", "LEFT JOIN customer ON c_custkey = k"),
    "nation_raw": _observations("'N' || c_nationkey", "n_name",
                                "LEFT JOIN customer ON c_custkey = k LEFT JOIN nation ON n_nationkey = c_nationkey"),
    "drifting": f"""
SELECT * REPLACE (CASE WHEN {_KEY} % 13 = 0 AND "year"::INTEGER < 1998 THEN 'Old ' || country_name ELSE country_name END AS country_name,
    CASE WHEN ({_KEY} + "year"::INTEGER) % 31 = 0 THEN "year"[1:3] || 'x' ELSE "year" END AS "year") FROM raw""",
    "clean": _cleaned("raw"),
    "nation_clean": _cleaned("nation_raw"),
    "drifting_clean": _cleaned("drifting"),
    "emp": _fact("employment"), "econ": _fact("economic"), "edu": _fact("education"),
    "part_econ": _fact("economic", missing=_MISSING), "part_edu": _fact("education", missing=_MISSING),
    "gdp_rows": "SELECT * FROM clean WHERE indicator_name = 'gdp'",
    "dim_countries": "SELECT DISTINCT country_code, country_name, CAST(NULL AS VARCHAR) AS region, "
                     "CAST(NULL AS VARCHAR) AS income_group FROM gdp_rows",
    "dim_time": "SELECT DISTINCT \"year\", 'Y' || \"year\" AS year_label, CAST(\"year\" // 10 * 10 AS INTEGER) AS decade, "
                "\"year\" || '-01-01' AS year_start_date FROM gdp_rows",
}


def _index_tables(suffix: str, econ: str, edu: str) -> dict[str, str]:
    keys = _cols(R.KEYS)
    return {
        f"joined{suffix}": f"SELECT * FROM emp JOIN {econ} USING ({keys}) LEFT JOIN {edu} USING ({keys})",
        f"scored{suffix}": f"SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in SCORE_SQL.items())} FROM joined{suffix}",
        f"indexed{suffix}": f"SELECT *, CAST({_INDEX} AS DOUBLE) AS opportunity_index FROM scored{suffix}",
        f"oi{suffix}": f"SELECT {_cols(_RANKED)}, CAST(rank() OVER (PARTITION BY \"year\" ORDER BY opportunity_index DESC) "
                       f"AS INTEGER) AS opportunity_rank FROM indexed{suffix}",
    }


COMMON |= _index_tables("", "econ", "edu") | _index_tables("_part", "part_econ", "part_edu")
_KEPT = {"raw", "nation_raw", "clean", "nation_clean", "oi"}


def statement(body: str) -> str:
    """``body`` with the common tables that it uses, directly or not."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b\w+\b", text):
            if name in COMMON and name not in used:
                used.add(name)
                visit(COMMON[name])
    visit(body)
    tables = [f"{n} AS {'MATERIALIZED ' if n in _KEPT else ''}({sql.strip()})" for n, sql in COMMON.items() if n in used]
    return ("WITH " + ",\n".join(tables) + "\n" if tables else "") + body.strip()


# ---------------------------------------------------------------- views
def _spine_view(columns, floor: int, only: str = "true") -> str:
    """``columns`` for every country and dimension year from ``floor`` on."""
    keys = _cols(R.KEYS)
    joins = " ".join(f"LEFT JOIN {t} USING ({keys})" for t in ("emp", "econ", "edu"))
    ranks = f'(SELECT {keys}, opportunity_index, opportunity_rank FROM oi)'
    return (f"SELECT {_cols(columns)} FROM (SELECT country_code, country_name, \"year\", decade FROM dim_countries, dim_time "
            f"WHERE \"year\" >= {floor} AND {only}) {joins} LEFT JOIN {ranks} USING ({keys})")


def _best(k: int) -> str:
    return f'(SELECT * FROM oi WHERE "year" = (SELECT max("year") FROM oi) AND opportunity_rank <= {k})'


def _named(source: str, columns) -> str:
    return f"SELECT {_cols(columns)} FROM {source} JOIN dim_countries USING (country_code)"


def _dash(source: str, year: int, columns, test: str = "true") -> str:
    return _named(f'(SELECT * FROM {source} WHERE "year" = {year} AND {test})', columns)


_CHOSEN = (f"country_code IN (SELECT country_code FROM {_best(R.TRENDS_TOP_K)} UNION ALL "
           f"SELECT country_code FROM dim_countries WHERE country_name = '{Q.HOME}')")
COMPARISON = _spine_view(V.COMPARISON_COLUMNS, Q.COMPARISON_FLOOR)
TRENDS = _spine_view(V.TRENDS_COLUMNS, Q.TRENDS_FLOOR, _CHOSEN)
TOP = _named(_best(R.TOP_K), V.TOP_COLUMNS)


def _pair(*names: str) -> tuple[str, ...]:
    return ("country_code", "country_name", "year", *names)


_REASON = ("CASE WHEN \"value\" IS NULL THEN 'null_value' WHEN country_code IS NULL THEN 'null_code' "
           "WHEN country_code = '' THEN 'empty_code' WHEN TRY_CAST(\"year\" AS INTEGER) IS NULL THEN 'bad_year' END")
_BAD_YEARS = ("SELECT * FROM drifting WHERE \"value\" IS NOT NULL AND country_code <> '' "
              "AND TRY_CAST(\"year\" AS INTEGER) IS NULL")
_DATES = f"(SELECT unnest([DATE '{D1}', DATE '{D2}']) AS process_date)"
_TABLES = {"dim_countries": "dim_countries", "dim_time": "dim_time", "fact_employment_metrics": "emp",
           "fact_economic_indicators": "econ", "fact_education": "edu", "opportunity_index": "oi"}
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {cte}" for t, cte in _TABLES.items())
_PAGES = f"CAST(greatest(1, ceil(count(*) / {R.PAGE_SIZE}.0)) AS BIGINT)"
_EDGE = f"""
SELECT * FROM (
    SELECT 'C' || c_custkey AS country_code, c_name AS country_name, 'UNKNOWN' AS indicator_id,
        CAST(NULL AS VARCHAR) AS indicator_name, '2020' AS "year", 1.5e0 AS "value", DATE '{EXTRACTION_DATE}' AS extraction_date FROM customer
    UNION ALL SELECT 'C' || c_custkey, '', 'ASKED', 'asked_for', '2021', 2.5e0, DATE '{EXTRACTION_DATE}' FROM customer
    UNION ALL SELECT '', '', 'ASKED', 'asked_for', '2022', NULL, DATE '{EXTRACTION_DATE}' FROM customer
    UNION ALL SELECT 'C' || c_custkey, c_name, 'MIXED', NULL, '2023', 3.5e0, DATE '{EXTRACTION_DATE}' FROM customer
    UNION ALL SELECT 'C' || c_custkey, '', 'MIXED', NULL, '2025', 4e0, DATE '{EXTRACTION_DATE}' FROM customer)"""
# position, reason and text of the elements that are no records, per customer
_BAD_ELEMENTS = """
SELECT 1::BIGINT AS page, e.p::INTEGER AS "position", e.r AS reject_reason, e.t AS record FROM (SELECT unnest([
    {'p': 1, 'r': 'not_an_object', 't': '5'}, {'p': 2, 'r': 'not_an_object', 't': NULL}, {'p': 3, 'r': 'not_an_object', 't': 'C' || c_custkey},
    {'p': 4, 'r': 'not_an_object', 't': '[1]'},
    {'p': 5, 'r': 'bad_value', 't': '{"countryiso3code":"C' || c_custkey || '","date":"2024","value":"abc"}'},
    {'p': 6, 'r': 'bad_country', 't': '{"country":"' || c_name || '","value":1}'},
    {'p': 7, 'r': 'bad_indicator', 't': '{"indicator":[7],"value":1}'}]) AS e FROM customer)"""
_FLAWED = """
SELECT kind, whole, count(*) AS n_rows FROM (
    SELECT 'malformed_line' AS kind, indicator_name = 'gdp' AS whole FROM raw
        WHERE indicator_name = 'inflation' OR indicator_name = 'gdp' AND "value" IS NOT NULL
    UNION ALL SELECT 'clean', true FROM clean WHERE indicator_name NOT IN ('gdp', 'inflation')) GROUP BY ALL"""
_REGISTRY = "(SELECT unnest([" + ", ".join(f"{{'id': '{i.code}', 'name': '{i.name}'}}" for i in R.INDICATORS) + "]) AS i)"


def core_sql() -> dict[str, str]:
    everything = {f: f"SELECT * FROM {f}" for f in ("raw", "clean", "emp", "econ", "edu", "dim_countries", "dim_time", "oi")}
    q = {
        "raw_observations": everything["raw"],
        "clean_observations": everything["clean"],
        "raw_rejects": f"SELECT indicator_name, reject_reason, count(*) AS n_rows FROM (SELECT *, {_REASON} AS reject_reason "
                       "FROM raw) WHERE reject_reason IS NOT NULL GROUP BY ALL",
        "bad_years": _BAD_YEARS,
        "observations_in_window": "SELECT * FROM clean WHERE \"year\" BETWEEN {} AND {}".format(*Q.WINDOW_YEARS),
        "fact_employment": everything["emp"], "outer_join_chain": everything["emp"],
        "fact_economic": everything["econ"], "outer_join_chain_economic": everything["econ"],
        "fact_education": everything["edu"],
        "dim_countries": everything["dim_countries"], "dim_time": everything["dim_time"],
        "country_name_drift": "SELECT country_code, count(DISTINCT country_name) AS n_names, min(country_name) AS first_name, "
                              "max(country_name) AS last_name FROM drifting_clean WHERE indicator_name = 'gdp' "
                              "GROUP BY country_code HAVING count(DISTINCT country_name) > 1",
        "opportunity_index": f"SELECT {_cols((*R.KEYS, *SCORE_SQL, 'opportunity_index'))} FROM indexed",
        "opportunity_rank": everything["oi"], "opportunity_rank_window": everything["oi"],
        "index_from_facts": everything["oi"],
        "top_countries": TOP, "country_comparison": COMPARISON, "country_trends": TRENDS,
        "dash_index_map": _dash("oi", Q.MAP_YEAR, _pair("opportunity_index", "opportunity_rank")),
        "dash_top_business": _dash("econ", Q.BUSINESS_YEAR, _pair("ease_of_business"), "ease_of_business IS NOT NULL")
                             + f" ORDER BY ease_of_business, country_code, country_name LIMIT {Q.DASH_TOP_K}",
        "dash_business_vs_employment": _dash(
            "(SELECT * FROM econ JOIN emp USING (country_code, \"year\"))", Q.BUSINESS_YEAR,
            _pair("ease_of_business", "employment_ratio"), "ease_of_business IS NOT NULL AND employment_ratio IS NOT NULL"),
        "dash_top_employment": _dash("emp", Q.EMPLOYMENT_YEAR, _pair("employment_ratio"), "employment_ratio IS NOT NULL")
                               + f" ORDER BY employment_ratio DESC, country_code, country_name LIMIT {Q.DASH_TOP_K}",
        "missing_indicator": "SELECT * FROM oi_part",
        "duplicate_keys": 'SELECT indicator_name, country_code, "year", count(*) AS n_obs, min("value") AS min_value, '
                          'max("value") AS max_value FROM nation_clean GROUP BY ALL HAVING count(*) > 1',
        "fact_economic_duplicates": _fact("economic", "nation_clean"),
    }
    for score, name in Q.SCORE_QUERY_NAMES.items():
        q[name] = (f"SELECT {_cols((*R.KEYS, *Q.SCORE_INPUTS[score]))}, CAST({SCORE_SQL[score]} AS DOUBLE) AS {score} FROM joined")
    return q


def io_sql() -> dict[str, str]:
    return {
        "csv_roundtrip": "SELECT * FROM raw",
        "json_roundtrip": "SELECT * FROM raw",
        "flatten_envelopes": "SELECT * REPLACE (coalesce(country_code, '') AS country_code, coalesce(country_name, '') AS "
                             "country_name, coalesce(\"year\", '') AS \"year\") FROM raw",
        "flatten_edge_pages": _EDGE,
        "rejected_pages": "SELECT unnest(['error_payload', 'not_json_array']) AS reject_reason, count(*) AS n_pages FROM customer",
        "rejected_records": _BAD_ELEMENTS,
        "missing_pages": f"SELECT * FROM (SELECT indicator_id, unnest(range(1, pages + 1)) AS page FROM (SELECT indicator_id, "
                         f"{_PAGES} AS pages FROM raw GROUP BY ALL)) WHERE page % {IO.MISSING_EVERY} = 0",
        "malformed_in_job": _FLAWED, "stream_quarantine": _FLAWED,
        "landing_manifest": f"SELECT i.id AS indicator_id, i.name AS indicator_name, count(indicator_name) AS n_rows, "
                            f"CASE WHEN count(indicator_name) = 0 THEN 'skipped_empty' ELSE 'landed' END AS status, "
                            f"DATE '{EXTRACTION_DATE}' AS extraction_date FROM {_REGISTRY} LEFT JOIN raw "
                            "ON indicator_name = i.name AND indicator_name <> 'inflation' GROUP BY ALL",
        "landed_back": f"SELECT format, indicator_name, extraction_date, count(*) AS n_rows, count(\"value\") AS n_values, "
                       "max(\"value\") AS max_value FROM raw, (SELECT unnest(['csv', 'json']) AS format) GROUP BY ALL",
        "snapshot_on_or_before": "SELECT * FROM clean WHERE indicator_name IN ('gdp', 'inflation')",
        "serve_top_countries": TOP,
        "serve_index_map": _dash("oi", Q.MAP_YEAR, _pair("opportunity_index", "opportunity_rank")),
        "incremental_publish": f"SELECT * REPLACE (school_enrollment + CASE WHEN country_code = '{IO.CHANGED_COUNTRY}' "
                               f"THEN {_num(IO.CHANGED_BY)} ELSE 0e0 END AS school_enrollment), 2::BIGINT AS versions FROM edu",
        # every page of every indicator landed once: pages = ceil(rows / page size)
        "envelope_completeness": f"SELECT indicator_id, {_PAGES} AS pages_expected, {_PAGES} AS pages_landed, {_PAGES} AS "
                                 "pages_seen, count(*) AS rows_expected, count(*) AS rows_seen, true AS complete FROM raw GROUP BY ALL",
        "parquet_snapshot_overwrite": f"SELECT process_date, indicator_name, count(*) AS n_rows FROM "
                                      f"(SELECT indicator_name FROM clean), {_DATES} GROUP BY ALL",
        "rejects_written": f"SELECT process_date, reject_reason, count(*) AS n_rows FROM (SELECT {_REASON} AS reject_reason "
                           f"FROM raw), {_DATES} WHERE reject_reason IS NOT NULL GROUP BY ALL",
        "six_tables_dated": _COUNTS,
        "snapshot_one_date": f"SELECT {_cols(f.name for f in CLEAN.fields if f.name != 'process_date')}, DATE '{D2}' AS process_date "
                             "FROM clean WHERE indicator_name IN ('gdp', 'inflation')",
        "empty_indicator_landing": "SELECT indicator_name, count(*) AS n_rows FROM raw WHERE indicator_name <> 'inflation' GROUP BY ALL",
        "table_load_append_truncate": "SELECT * FROM dim_countries",
        "stream_clean_observations": "SELECT * FROM clean",
        "load_counts": _COUNTS,
        "view_top_countries": TOP, "view_country_comparison": COMPARISON, "view_country_trends": TRENDS,
    }


def all_sql() -> dict[str, str]:
    return {name: statement(body) for name, body in {**core_sql(), **io_sql()}.items()}
