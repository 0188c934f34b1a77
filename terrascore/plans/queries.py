"""Named queries over the driver tables: ``(spark, sf_dir) -> DataFrame``.

Each query reads the given tables through the adapter and composes the
engine's operators lazily, so Catalyst sees one plan from scan to result
(filters on year reach the aggregation and the scans; unused columns are
pruned). Parameters below map the source domain's defaults onto the driver
tables, whose order dates span 1995-2001.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry as R
from ..operators import clean as C
from ..operators import dims, facts, index, views
from ..session import stage_table
from ..sources import adapter

# Parameters for the driver tables (domain defaults: 2018 / 2010 / Indonesia).
COMPARISON_FLOOR = 1998
TRENDS_FLOOR = 1996
HOME = "Customer#000000005"
MAP_YEAR = 2000
BUSINESS_YEAR = 1998
EMPLOYMENT_YEAR = 2000
WINDOW_YEARS = (1996, 2000)
DASH_TOP_K = 10

# Score queries: score column -> its inputs.
SCORE_INPUTS = {
    "emp_score": ("unemployment_rate", "youth_unemployment"),
    "gdp_score": ("gdp_per_capita_ppp", "gdp_per_capita"),
    "edu_score": ("school_enrollment",),
    "stability_score": ("inflation", "government_debt"),
    "business_score": ("ease_of_business",),
    "investment_score": ("foreign_direct_investment",),
}
SCORE_QUERY_NAMES = {
    "emp_score": "score_employment", "gdp_score": "score_gdp", "edu_score": "score_education",
    "stability_score": "score_stability", "business_score": "score_business",
    "investment_score": "score_investment",
}


@dataclass
class Ctx:
    """Lazily built shared intermediates of one query."""

    spark: SparkSession
    sf_dir: str
    rank_method: str = "distributed"
    drop_indicators: tuple[str, ...] = field(default_factory=tuple)
    # Write the clean observations once when several jobs consume them (facts
    # and dimensions): later jobs read the file, and the tables are scanned once.
    stage_clean: bool = False
    # Only these indicators are needed; the rest is dropped before staging.
    indicators: tuple[str, ...] = field(default_factory=tuple)
    # Facts of this year only; the dimensions' indicator keeps every year.
    year: int | None = None
    # The same for the wide facts, where both the view and the index read them.
    stage_wide: bool = False

    @cached_property
    def raw(self) -> DataFrame:
        return adapter.raw_observations(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        df = C.clean_observations(self.raw)
        if self.drop_indicators:
            df = df.where(~F.col("indicator_name").isin(*self.drop_indicators))
        if self.indicators:
            df = df.where(F.col("indicator_name").isin(*self.indicators))
        if self.year is not None:
            df = df.where((F.col("indicator_name") == dims.DEFAULT_SOURCE) | (F.col("year") == self.year))
        if not self.stage_clean:
            return df
        # Partitioned by indicator: each fact and the gdp-only dimensions
        # read just their indicators' folders.
        return stage_table(df, "clean", partition_by=("indicator_name",))

    @cached_property
    def wide(self) -> DataFrame:
        wide = facts.build_wide(self.clean)
        return stage_table(wide, "wide_facts") if self.stage_wide else wide

    @cached_property
    def countries(self) -> DataFrame:
        return dims.country_dimension(self.clean)

    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.time_dimension(self.clean)

    @cached_property
    def index(self) -> DataFrame:
        """The ranked index. Scores over staged wide rows are cheap enough to be
        made for each of the rank's two reads; else the scored rows are staged."""
        return index.opportunity_index(self.wide, rank_method=self.rank_method, stage=not self.stage_wide)


Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[Ctx], DataFrame], **ctx_kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir, **ctx_kw))
    run.__doc__ = fn.__doc__
    return run


def _score_query(score: str) -> Query:
    return _q(lambda c: index.score_table(c.wide, score, SCORE_INPUTS[score]))


def _index_from_facts(c: Ctx) -> DataFrame:
    """The index of a user who holds the three fact tables only."""
    tables = {f: stage_table(facts.build_fact(c.clean, f), f"fact_{f}") for f in R.FACTS}
    return index.from_facts(tables["employment"], tables["economic"], tables["education"], c.rank_method)


def core_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources / clean (S, D9, F1, F2, F9)
        "raw_observations": _q(lambda c: c.raw),
        "clean_observations": _q(lambda c: c.clean),
        "raw_rejects": _q(lambda c: C.reject_summary(c.raw)),
        "bad_years": lambda spark, sf_dir: C.bad_years(adapter.drifting_observations(spark, sf_dir)),
        "observations_in_window": _q(
            lambda c: C.clean_observations(c.raw, year_range=WINDOW_YEARS)),
        # facts (D12-D14, J1-J3)
        "fact_employment": _q(lambda c: facts.build_fact(c.clean, "employment")),
        "fact_economic": _q(lambda c: facts.build_fact(c.clean, "economic")),
        "fact_education": _q(lambda c: facts.build_fact(c.clean, "education")),
        "outer_join_chain": _q(
            lambda c: facts.outer_join_chain(c.clean, R.FACT_COLUMNS["employment"]),
            stage_clean=True, indicators=R.FACT_COLUMNS["employment"]),
        "outer_join_chain_economic": _q(
            lambda c: facts.outer_join_chain(c.clean, R.FACT_COLUMNS["economic"]),
            stage_clean=True, indicators=R.FACT_COLUMNS["economic"]),
        # dimensions (D10, D11)
        "dim_countries": _q(lambda c: c.countries),
        "dim_time": _q(lambda c: c.dim_time),
        "country_name_drift": lambda spark, sf_dir: dims.name_drift(
            C.clean_observations(adapter.drifting_observations(spark, sf_dir))),
        # index (D7, D8, W1)
        "opportunity_index": _q(lambda c: index.scored(c.wide).select(
            *R.KEYS, *[s for s, _ in R.INDEX_WEIGHTS], "opportunity_index")),
        "opportunity_rank": _q(lambda c: c.index),
        "opportunity_rank_window": _q(lambda c: c.index, rank_method="window"),
        "index_from_facts": _q(_index_from_facts, stage_clean=True),
        # views (D15-D17)
        "top_countries": _q(lambda c: views.top_countries(
            index.ranked_latest_year(c.wide, R.TOP_K), c.countries, R.TOP_K), stage_clean=True, stage_wide=True),
        "country_comparison": _q(lambda c: views.country_comparison(
            c.countries, c.dim_time, c.wide, c.index, COMPARISON_FLOOR), stage_clean=True, stage_wide=True),
        "country_trends": _q(lambda c: views.country_trends(
            c.countries, c.dim_time, c.wide, c.index, TRENDS_FLOOR, R.TRENDS_TOP_K, HOME,
            best=index.ranked_latest_year(c.wide, R.TRENDS_TOP_K)), stage_clean=True, stage_wide=True),
        # dashboards (D18-D21)
        "dash_index_map": _q(lambda c: views.dash_index_map(
            index.opportunity_index(c.wide.where(F.col("year") == MAP_YEAR), c.rank_method), c.countries, MAP_YEAR),
            stage_clean=True, year=MAP_YEAR),
        "dash_top_business": _q(lambda c: views.dash_top_business(
            c.wide, c.countries, BUSINESS_YEAR, DASH_TOP_K), stage_clean=True, year=BUSINESS_YEAR,
            indicators=("gdp", "ease_of_business")),
        "dash_business_vs_employment": _q(lambda c: views.dash_business_vs_employment(
            c.wide, c.countries, BUSINESS_YEAR), stage_clean=True, year=BUSINESS_YEAR,
            indicators=("gdp", "ease_of_business", "employment_ratio")),
        "dash_top_employment": _q(lambda c: views.dash_top_employment(
            c.wide, c.countries, EMPLOYMENT_YEAR, DASH_TOP_K), stage_clean=True, year=EMPLOYMENT_YEAR,
            indicators=("gdp", "employment_ratio")),
        # edge behaviour (T2/T3, 2.13)
        "missing_indicator": _q(
            lambda c: c.index,
            drop_indicators=("ease_of_business", "education_spending", "school_enrollment")),
        "duplicate_keys": lambda spark, sf_dir: C.duplicate_keys(
            C.clean_observations(adapter.nation_observations(spark, sf_dir))),
        "fact_economic_duplicates": lambda spark, sf_dir: facts.build_fact(
            C.clean_observations(adapter.nation_observations(spark, sf_dir)), "economic"),
    }
    for score, name in SCORE_QUERY_NAMES.items():
        q[name] = _score_query(score)
    return q


def all_queries() -> dict[str, Query]:
    from .io_queries import io_queries
    return {**core_queries(), **io_queries()}
