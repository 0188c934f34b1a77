"""Declared schemas: no table in the engine relies on inference."""

from __future__ import annotations

from pyspark.sql import types as T

from .registry import FACT_COLUMNS, INDEX_OUTPUT_COLUMNS

S, I, D, L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Driver tables the adapter reads. Declaring them skips the footer-reading
# schema-inference job per scan (one per query and table) and pins the types.
DRIVER_TABLES = {
    "lineitem": _struct(
        ("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "orders": _struct(
        ("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
        ("o_orderdate", TS), ("o_orderpriority", S)),
    "customer": _struct(
        ("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
        ("c_mktsegment", S)),
    "nation": _struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
}

# Landed observation (CSV / JSON). Year stays text until the clean stage.
RAW = T.StructType([
    T.StructField("country_code", S),
    T.StructField("country_name", S),
    T.StructField("indicator_id", S),
    T.StructField("indicator_name", S),
    T.StructField("year", S),
    T.StructField("value", D),
    T.StructField("extraction_date", T.DateType()),
])

# Landed raw text (CSV read before casts): value may be any text.
RAW_TEXT = T.StructType([
    T.StructField(f.name, S if f.name in ("year", "value") else f.dataType)
    for f in RAW.fields
])

CLEAN = T.StructType([
    T.StructField("country_code", S, False),
    T.StructField("country_name", S),
    T.StructField("indicator_id", S),
    T.StructField("indicator_name", S),
    T.StructField("year", I, False),
    T.StructField("value", D, False),
    T.StructField("extraction_date", T.DateType()),
    T.StructField("process_date", T.DateType()),
])

# Refused observations, as the snapshot job writes them (year and value as cast).
REJECTED = T.StructType([
    *[T.StructField(f.name, I if f.name == "year" else f.dataType) for f in RAW.fields],
    T.StructField("reject_reason", S),
])

# What landed but could not be read as a record: where it stood, why, its text.
MALFORMED = _struct(("page_file", S), ("page", L), ("position", I), ("reject_reason", S), ("record", S))

# What a landing wrote per indicator, and what a load wrote per table.
LANDING_MANIFEST = T.StructType([
    *_struct(("indicator_id", S), ("indicator_name", S), ("n_rows", L), ("status", S)).fields,
    T.StructField("extraction_date", T.DateType()),
])
LOAD_LOG = T.StructType([
    *_struct(("table_name", S), ("version", S), ("disposition", S), ("n_rows", L)).fields,
    T.StructField("loaded_at", T.TimestampType()),
])

DIM_COUNTRIES = T.StructType([
    T.StructField("country_code", S),
    T.StructField("country_name", S),
    T.StructField("region", S),
    T.StructField("income_group", S),
])

DIM_TIME = T.StructType([
    T.StructField("year", I),
    T.StructField("year_label", S),
    T.StructField("decade", I),
    T.StructField("year_start_date", S),
])


def fact_schema(fact: str) -> T.StructType:
    return T.StructType(
        [T.StructField("country_code", S), T.StructField("year", I)]
        + [T.StructField(c, D) for c in FACT_COLUMNS[fact]]
    )


OPPORTUNITY_INDEX = T.StructType([
    T.StructField(c, S if c == "country_code" else I if c in ("year", "opportunity_rank") else D)
    for c in INDEX_OUTPUT_COLUMNS
])

# Declared schema of each published table (the warehouse load schema).
TABLE_SCHEMAS = {
    "dim_countries": DIM_COUNTRIES,
    "dim_time": DIM_TIME,
    "fact_employment_metrics": fact_schema("employment"),
    "fact_economic_indicators": fact_schema("economic"),
    "fact_education": fact_schema("education"),
    "opportunity_index": OPPORTUNITY_INDEX,
}

# One record inside a landed page envelope (an entry of element 1 of the JSON array).
ENVELOPE_RECORD = T.StructType([
    T.StructField("countryiso3code", S),
    T.StructField("country", T.StructType([T.StructField("id", S), T.StructField("value", S)])),
    T.StructField("indicator", T.StructType([T.StructField("id", S), T.StructField("value", S)])),
    T.StructField("date", S),
    T.StructField("value", S),  # as text: what is no number is told, not nulled
])
# Element 0 of a page envelope: paging metadata.
ENVELOPE_META = T.StructType([
    T.StructField("page", L), T.StructField("pages", L),
    T.StructField("per_page", L), T.StructField("total", L),
])
