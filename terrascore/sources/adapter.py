"""Driver tables -> landed raw observations (the FIXTURES adapter).

The test tables carry no country indicators, so a customer plays the country
and each (customer, order year) group yields the 13 indicator values. The
adapter is written the way it must run on a large cluster:

* lineitem is pre-aggregated per order before it meets ``orders`` (partial
  aggregation map-side, then one row per order key on both join sides — a
  customer or order holding a third of all rows cannot skew the join);
* the per-(customer, year) aggregate combines map-side before its shuffle;
* the customer name joins *after* aggregation (one row per group);
* the long form comes from one ``inline`` over a 13-element array — one scan,
  no 13-way union.

All arithmetic is exact integer-cent arithmetic; the only float operation is
the final ``cents / 100``. Half-up rounding to 2 places is done with integer
division, so every engine produces bit-identical values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import INDICATORS
from ..schemas import DRIVER_TABLES
from ..session import table_path

DEFAULT_EXTRACTION_DATE = dt.date(2025, 1, 1)
URGENT_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")

# Edge-case shaping of the landed data (FIXTURES §3): which groups land with an
# empty or missing country code and which values land as null. These do not
# select rows; every group and indicator is emitted.
EMPTY_CODE_MODULUS = 97
NULL_CODE_MODULUS = 89
NULL_VALUE_MODULUS, NULL_VALUE_BELOW = 11, 3


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


def _half_up(num: str, den: str, minus_cents: int = 0) -> Column:
    """round(num / den, 2) half-up as a double, for num >= 0 and den > 0."""
    cents = f"(200 * ({num}) + ({den})) div (2 * ({den}))"
    if minus_cents:
        cents = f"({cents} - {minus_cents})"
    return F.expr(f"CAST({cents} AS DOUBLE) / 100")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its declared schema (no inference job)."""
    return spark.read.schema(DRIVER_TABLES[name]).parquet(table_path(sf_dir, name))


def _line_measures() -> list[Column]:
    return [
        "l_orderkey",
        (F.col("l_returnflag") == "R").cast("int").alias("is_r"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_f"),
        (F.col("l_returnflag") == "N").cast("int").alias("is_n"),
        _cents(F.col("l_extendedprice")).alias("price_c"),
        _cents(F.col("l_discount")).alias("disc_c"),
        _cents(F.col("l_tax")).alias("tax_c"),
        _cents(F.col("l_quantity")).alias("qty_c"),
    ]


def _order_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("is_r").alias("n_r"),
        F.sum("is_f").alias("n_f"),
        F.sum("is_n").alias("n_n"),
        F.sum("price_c").alias("s_price"),
        F.min("price_c").alias("min_price"),
        F.max("price_c").alias("max_price"),
        F.max("disc_c").alias("max_disc"),
        F.min("tax_c").alias("min_tax"),
        F.max("qty_c").alias("max_qty"),
        F.sum("tax_c").alias("s_tax"),
        F.sum("qty_c").alias("s_qty"),
        F.sum("disc_c").alias("s_disc"),
    ]


def _group_aggs() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        F.sum("n_r").alias("n_r"),
        F.sum("n_f").alias("n_f"),
        F.sum("n_n").alias("n_n"),
        F.sum("s_price").alias("s_price"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.max("max_disc").alias("max_disc"),
        F.min("min_tax").alias("min_tax"),
        F.max("max_qty").alias("max_qty"),
        F.sum("s_tax").alias("s_tax"),
        F.sum("s_qty").alias("s_qty"),
        F.sum("s_disc").alias("s_disc"),
        F.sum(F.col("pri") * F.col("n")).alias("n_pri"),
    ]


def group_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer k, order year yr) with integer measures."""
    li = read_table(spark, sf_dir, "lineitem").select(*_line_measures())
    per_order = li.groupBy("l_orderkey").agg(*_order_aggs())
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("k"),
        F.year("o_orderdate").alias("yr"),
        F.col("o_orderpriority").isin(*URGENT_PRIORITIES).cast("long").alias("pri"),
    )
    return (per_order.join(orders, "l_orderkey").groupBy("k", "yr")
            .agg(*_group_aggs()))


def indicator_values() -> list[Column]:
    """The 13 values of a group, in registry order."""
    return [
        _half_up("50 * n_r", "n"),                       # unemployment_rate
        _half_up("80 * n_f", "n"),                       # youth_unemployment
        _half_up("100 * n_n", "n"),                      # employment_ratio
        F.col("s_price").cast("double") / 100,           # gdp
        F.col("min_price").cast("double") / 100,         # gdp_per_capita
        F.col("max_price").cast("double") / 100,         # gdp_per_capita_ppp
        (F.col("max_disc") + F.col("min_tax")).cast("double"),  # foreign_direct_investment
        (F.col("max_qty") * 3).cast("double") / 100,     # ease_of_business
        _half_up("10 * s_tax", "n"),                     # trade_percent_gdp
        _half_up("4 * s_tax", "n", minus_cents=400),     # inflation
        _half_up("s_qty", "200"),                        # government_debt
        _half_up("s_disc", "n"),                         # education_spending
        _half_up("100 * n_pri", "n"),                    # school_enrollment
    ]


def _entries(gaps: bool) -> Column:
    """The 13 (indicator, value) structs of a group, as one array."""
    k = F.col("k")

    def shaped(i: int, v: Column) -> Column:
        seen = (k * 7 + F.col("yr") * 3 + (k % 5) * i) % NULL_VALUE_MODULUS >= NULL_VALUE_BELOW
        return F.when(seen, v) if gaps else v
    return F.array(*[
        F.struct(
            F.lit(ind.code).alias("indicator_id"),
            F.lit(ind.name).alias("indicator_name"),
            shaped(i, v).alias("value"),
        )
        for i, (ind, v) in enumerate(zip(INDICATORS, indicator_values()))
    ])


def _long_form(groups: DataFrame, code: Column, name: Column,
               extraction_date: dt.date, gaps: bool = True) -> DataFrame:
    return groups.select(
        code.alias("country_code"),
        name.alias("country_name"),
        F.col("yr").cast("string").alias("year"),
        F.inline(_entries(gaps)),
    ).select(
        "country_code", "country_name", "indicator_id", "indicator_name", "year", "value",
        F.lit(extraction_date).alias("extraction_date"),
    )


def raw_observations(spark: SparkSession, sf_dir: str,
                     extraction_date: dt.date = DEFAULT_EXTRACTION_DATE, gaps: bool = True) -> DataFrame:
    """Raw observations, one customer per country (FIXTURES §3). ``gaps``
    shapes the edge cases of landed data into them (empty and missing codes,
    missing values); without it every code and value is real."""
    groups = group_measures(spark, sf_dir)
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), "c_name")
    # One row per group after aggregation: the name join cannot fan out or skew.
    named = groups.join(customers, "k", "left")
    k = F.col("k")
    code = F.concat(F.lit("C"), k.cast("string"))
    if gaps:
        code = (F.when(k % EMPTY_CODE_MODULUS == 0, F.lit(""))
                .when(k % NULL_CODE_MODULUS == 0, F.lit(None).cast("string")).otherwise(code))
    return _long_form(named, code, F.col("c_name"), extraction_date, gaps)


def drifting_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations with what long-lived sources bring: countries that
    change their name (every 13th, before 1998) and years that are no number
    (key plus year divisible by 31: the last digit reads ``x``)."""
    k = F.regexp_extract("country_code", r"\d+", 0).try_cast("long")
    yr = F.col("year").cast("long")
    raw = raw_observations(spark, sf_dir)
    renamed = F.when((k % 13 == 0) & (yr < 1998), F.concat(F.lit("Old "), "country_name")).otherwise(F.col("country_name"))
    year = F.when((k + yr) % 31 == 0, F.concat(F.substring("year", 1, 3), F.lit("x"))).otherwise(F.col("year"))
    return raw.withColumns({"country_name": renamed, "year": year})


def nation_observations(spark: SparkSession, sf_dir: str,
                        extraction_date: dt.date = DEFAULT_EXTRACTION_DATE) -> DataFrame:
    """Raw observations reported per *nation*: every customer group of a nation
    lands as a separate observation of the same (nation, year) key.

    Only 25 keys exist, each holding ~1/25 of all rows: the duplicate-key and
    hot-key input of the engine.
    """
    groups = group_measures(spark, sf_dir)
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nk"))
    nations = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nk"), "n_name")
    # No hint: Spark broadcasts the nation table only below its size threshold.
    named = groups.join(customers, "k", "left").join(nations, "nk", "left")
    code = F.concat(F.lit("N"), F.col("nk").cast("string"))
    return _long_form(named, code, F.col("n_name"), extraction_date)
