"""Indicator registry, score ladders and index weights.

Everything a result depends on lives here as data; operators read these
tables instead of hard-coding literals, so the Spark plans and the SQL oracle
share one source of truth.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Indicator:
    code: str  # source-system indicator id
    name: str  # column name used in facts
    fact: str  # "employment" | "economic" | "education"


@dataclass(frozen=True)
class Segment:
    """One linear piece of a penalty: for values up to ``up_to`` it is
    ``base + min((value - knot) * num / den, cap)``."""
    up_to: float
    base: float
    knot: float
    num: float
    den: float
    cap: float


@dataclass(frozen=True)
class Rule:
    """Applies where all its inputs are present; the penalties are subtracted
    one by one, or, with a divisor, as their sum over it."""
    penalties: dict[str, tuple[Segment, ...]]
    divisor: float | None = None


# --- fixed values: must equal the source domain for identical results ---------
# Indicator source code -> column name, grouped by the fact table that holds it.
INDICATORS: tuple[Indicator, ...] = (
    Indicator("SL.UEM.TOTL.ZS", "unemployment_rate", "employment"),
    Indicator("SL.UEM.1524.ZS", "youth_unemployment", "employment"),
    Indicator("SL.EMP.TOTL.SP.ZS", "employment_ratio", "employment"),
    Indicator("NY.GDP.MKTP.CD", "gdp", "economic"),
    Indicator("NY.GDP.PCAP.CD", "gdp_per_capita", "economic"),
    Indicator("NY.GDP.PCAP.PP.KD", "gdp_per_capita_ppp", "economic"),
    Indicator("BX.KLT.DINV.WD.GD.ZS", "foreign_direct_investment", "economic"),
    Indicator("IC.BUS.EASE.XQ", "ease_of_business", "economic"),
    Indicator("NE.TRD.GNFS.ZS", "trade_percent_gdp", "economic"),
    Indicator("FP.CPI.TOTL.ZG", "inflation", "economic"),
    Indicator("GC.DOD.TOTL.GD.ZS", "government_debt", "economic"),
    Indicator("SE.XPD.TOTL.GD.ZS", "education_spending", "education"),
    Indicator("SE.TER.ENRR", "school_enrollment", "education"),
)

# Column order of each fact table (keys first).
FACT_COLUMNS: dict[str, tuple[str, ...]] = {
    "employment": ("unemployment_rate", "youth_unemployment", "employment_ratio"),
    "economic": (
        "gdp",
        "gdp_per_capita",
        "gdp_per_capita_ppp",
        "inflation",
        "foreign_direct_investment",
        "trade_percent_gdp",
        "government_debt",
        "ease_of_business",
    ),
    "education": ("education_spending", "school_enrollment"),
}

# Score ladders: (threshold, score) rungs tested top-down; first match wins.
# "gt" rungs match value > threshold, "le" rungs match value <= threshold.
GDP_LADDER = ((60000, 100), (45000, 90), (30000, 80), (20000, 70), (15000, 65),
              (10000, 60), (5000, 50), (2500, 40))
GDP_FLOOR = 30
EDU_LADDER = ((85, 100), (70, 85), (55, 70), (40, 55), (25, 40))
EDU_FLOOR = 25
BUSINESS_LADDER = ((20, 100), (40, 90), (60, 75), (80, 60), (100, 45), (120, 35), (140, 25))
BUSINESS_FLOOR = 15
INVESTMENT_LADDER = ((10, 100), (7, 90), (5, 80), (3, 70), (2, 60), (1, 50))
INVESTMENT_FLOOR = 40
MISSING_SCORE = 50

# Two-input scores: 100 less the penalties of the inputs that are there. A rule
# holds the penalty of each input as linear segments (see Segment); the rules
# of a score are listed with most inputs first.
_INF = float("inf")
SCORE_RULES: dict[str, tuple[Rule, ...]] = {
    "emp_score": (
        Rule({"unemployment_rate": (Segment(_INF, 0, 0, 1.5, 1, 30),),
              "youth_unemployment": (Segment(_INF, 0, 0, 1, 1, 40),)}, divisor=2.5),
        Rule({"unemployment_rate": (Segment(_INF, 0, 0, 3, 1, 90),)}),
        Rule({"youth_unemployment": (Segment(_INF, 0, 0, 2, 1, 100),)}),
    ),
    "stability_score": (
        Rule({"inflation": (Segment(2, 0, 0, 0, 1, _INF), Segment(5, 0, 0, 2, 1, _INF),
                            Segment(10, 10, 5, 3, 1, _INF), Segment(_INF, 25, 10, 1.5, 1, 25)),
              "government_debt": (Segment(40, 0, 0, 1, 8, _INF), Segment(80, 5, 40, 1, 4, _INF),
                                  Segment(120, 15, 80, 1, 4, _INF), Segment(_INF, 25, 120, 1, 6, 25))}),
        Rule({"inflation": (Segment(_INF, 0, 0, 3, 1, 60),)}),
        Rule({"government_debt": (Segment(_INF, 0, 0, 1, 3, 60),)}),
    ),
}

# Composite index weights, in summation order (order fixes float rounding).
INDEX_WEIGHTS: tuple[tuple[str, float], ...] = (
    ("emp_score", 0.35),
    ("gdp_score", 0.20),
    ("business_score", 0.15),
    ("stability_score", 0.10),
    ("edu_score", 0.10),
    ("investment_score", 0.10),
)

# Columns of the ranked output table, in order.
INDEX_OUTPUT_COLUMNS: tuple[str, ...] = (
    "country_code", "year",
    "unemployment_rate", "youth_unemployment", "employment_ratio",
    "gdp_per_capita", "gdp_per_capita_ppp", "inflation", "government_debt",
    "school_enrollment", "education_spending", "foreign_direct_investment",
    "opportunity_index", "opportunity_rank",
)

# View / dashboard defaults of the source domain.
COMPARISON_YEAR_FLOOR = 2018
TRENDS_YEAR_FLOOR = 2010
TOP_K = 30
TRENDS_TOP_K = 15
HOME_COUNTRY = "Indonesia"
SOURCE_YEAR_RANGE = (2012, 2025)
PAGE_SIZE = 1000
# -----------------------------------------------------------------------------

INDICATOR_NAMES: tuple[str, ...] = tuple(i.name for i in INDICATORS)
FACTS: tuple[str, ...] = tuple(FACT_COLUMNS)
KEYS: tuple[str, str] = ("country_code", "year")

assert abs(sum(w for _, w in INDEX_WEIGHTS) - 1.0) < 1e-12
assert {i.name for i in INDICATORS} == {c for cols in FACT_COLUMNS.values() for c in cols}


def registry_df(spark):
    """The registry as a small DataFrame (13 rows) for broadcast joins."""
    return spark.createDataFrame(
        [(i.code, i.name, i.fact) for i in INDICATORS],
        "indicator_id string, indicator_name string, fact string",
    )
