"""Analytical views and dashboard queries as DataFrame plans.

Country x year spine: the views list every country for every dimension year
from a floor on. The year list is a *bounded* scalar (one row per calendar
year), so the spine is an ``explode`` of that scalar subquery over the
country rows: linear in countries, no join operator, nothing broadcast that
grows with the data.

Fact columns come from the single wide fact aggregation (one row per key);
a left join of it equals the chain of per-fact left joins because a key
absent from a fact has nulls in that fact's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import KEYS
from .facts import fact_from_wide
from .index import latest_year_top

# --- fixed values: published column lists of the source domain ----------------
COMPARISON_COLUMNS = (
    "country_name", "country_code", "year",
    "unemployment_rate", "youth_unemployment", "employment_ratio",
    "gdp", "gdp_per_capita", "gdp_per_capita_ppp", "inflation", "government_debt",
    "foreign_direct_investment", "trade_percent_gdp",
    "education_spending", "school_enrollment",
    "opportunity_index", "opportunity_rank",
)
TOP_COLUMNS = (
    "country_name", "year",
    "unemployment_rate", "youth_unemployment", "employment_ratio",
    "gdp_per_capita", "gdp_per_capita_ppp", "inflation", "government_debt",
    "school_enrollment", "education_spending",
    "opportunity_index", "opportunity_rank",
)
TRENDS_COLUMNS = (
    "country_name", "year", "decade",
    "unemployment_rate", "youth_unemployment", "gdp_per_capita", "inflation",
    "school_enrollment", "opportunity_rank",
)


# -----------------------------------------------------------------------------


def year_spine(countries: DataFrame, dim_time: DataFrame, floor: int,
               time_cols: tuple[str, ...] = ("year",)) -> DataFrame:
    """countries x {dim_time rows with year >= floor}."""
    years = (dim_time.where(F.col("year") >= floor)
             .select(F.sort_array(F.collect_set(F.struct(*time_cols)))).scalar())
    return countries.select("*", F.inline(years))


def _facts_and_index(spine: DataFrame, wide: DataFrame, index: DataFrame, floor: int,
                     fact_cols, index_cols) -> DataFrame:
    w = wide.where(F.col("year") >= floor).select(*KEYS, *fact_cols)
    ix = index.where(F.col("year") >= floor).select(*KEYS, *index_cols)
    return spine.join(w, list(KEYS), "left").join(ix, list(KEYS), "left")


def country_comparison(countries: DataFrame, dim_time: DataFrame, wide: DataFrame,
                       index: DataFrame, floor: int) -> DataFrame:
    spine = year_spine(countries.select("country_code", "country_name"), dim_time, floor)
    fact_cols = [c for c in COMPARISON_COLUMNS[3:15]]
    out = _facts_and_index(spine, wide, index, floor, fact_cols,
                           ("opportunity_index", "opportunity_rank"))
    return out.select(*COMPARISON_COLUMNS)


def top_countries(index: DataFrame, countries: DataFrame, k: int) -> DataFrame:
    top = latest_year_top(index, k)
    return (top.join(countries.select("country_code", "country_name"), "country_code")
            .select(*TOP_COLUMNS).orderBy("opportunity_rank"))


def country_trends(countries: DataFrame, dim_time: DataFrame, wide: DataFrame,
                   index: DataFrame, floor: int, k: int, home: str, best: DataFrame | None = None) -> DataFrame:
    """``best``: the latest year's rows up to rank ``k``, where the caller has a
    cheaper way to them than the whole ``index``."""
    best = latest_year_top(index, k) if best is None else best
    keyset = best.select("country_code").unionByName(
        countries.where(F.col("country_name") == home).select("country_code"))
    chosen = countries.select("country_code", "country_name").join(
        keyset, "country_code", "left_semi")
    spine = year_spine(chosen, dim_time, floor, ("year", "decade"))
    # Facts and index of the chosen countries alone meet the spine.
    mine = chosen.select("country_code").distinct()
    out = _facts_and_index(
        spine, wide.join(mine, "country_code", "left_semi"), index.join(mine, "country_code", "left_semi"), floor,
        ("unemployment_rate", "youth_unemployment", "gdp_per_capita", "inflation",
         "school_enrollment"),
        ("opportunity_rank",))
    return out.select(*TRENDS_COLUMNS).orderBy("country_name", "year")


# ------------------------------------------------------------------ dashboards

def _named(df: DataFrame, countries: DataFrame) -> DataFrame:
    return df.join(countries.select("country_code", "country_name"), "country_code")


def dash_index_map(index: DataFrame, countries: DataFrame, year: int) -> DataFrame:
    """Index by country for one year (choropleth input)."""
    return _named(index.where(F.col("year") == year), countries).select(
        "country_code", "country_name", "year", "opportunity_index", "opportunity_rank")


def dash_top_business(wide: DataFrame, countries: DataFrame, year: int, k: int = 10) -> DataFrame:
    """Best (lowest) ease-of-business rank, top k, unique tie-break."""
    econ = fact_from_wide(wide, "economic").where(
        (F.col("year") == year) & F.col("ease_of_business").isNotNull())
    return (_named(econ, countries)
            .select("country_code", "country_name", "year", "ease_of_business")
            .orderBy(F.col("ease_of_business").asc(), "country_code", "country_name")
            .limit(k))


def dash_business_vs_employment(wide: DataFrame, countries: DataFrame, year: int) -> DataFrame:
    """Ease of business against employment ratio for one year.

    Both values non-null implies the key is in both facts (the inner join of
    the two facts), so this is one filter over the wide rows — no self-join.
    """
    pair = wide.where((F.col("year") == year) & F.col("employment_ratio").isNotNull()
                      & F.col("ease_of_business").isNotNull())
    return _named(pair, countries).select(
        "country_code", "country_name", "year", "ease_of_business", "employment_ratio")


def dash_top_employment(wide: DataFrame, countries: DataFrame, year: int, k: int = 10) -> DataFrame:
    """Highest employment ratio, top k, unique tie-break."""
    emp = fact_from_wide(wide, "employment").where(
        (F.col("year") == year) & F.col("employment_ratio").isNotNull())
    return (_named(emp, countries)
            .select("country_code", "country_name", "year", "employment_ratio")
            .orderBy(F.col("employment_ratio").desc(), "country_code", "country_name")
            .limit(k))
