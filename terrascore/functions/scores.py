"""Score expressions: pure Column builders (JVM-side, whole-stage codegen).

Every score is non-null for any combination of null inputs. Ladders and
piecewise-linear penalties are registry data; two small builders turn them
into expressions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import registry as R


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ladder(value, rungs: Sequence[tuple[float, int]], floor: int, *, above: bool,
           missing: int = R.MISSING_SCORE) -> Column:
    """Threshold ladder: first rung whose test holds gives the score.

    ``above=True`` tests ``value > threshold``; ``above=False`` tests
    ``value <= threshold``. Null input gives ``missing``; no match gives ``floor``.
    """
    v = _c(value)
    expr = F.when(v.isNull(), F.lit(missing))
    for threshold, score in rungs:
        expr = expr.when(v > threshold if above else v <= threshold, F.lit(score))
    return expr.otherwise(F.lit(floor))


def piecewise(value, segments: Sequence[R.Segment]) -> Column:
    """The value's penalty on the segment it falls in; null for a null value
    (no rule applies a penalty to one)."""
    v = _c(value)

    def rise(s: R.Segment) -> Column:
        if not s.num:
            return F.lit(float(s.base))
        slope = (v - float(s.knot)) * float(s.num) / float(s.den)
        return float(s.base) + (slope if math.isinf(s.cap) else F.least(slope, F.lit(float(s.cap))))
    return F.coalesce(*[rise(s) if math.isinf(s.up_to) else F.when(v <= float(s.up_to), rise(s)) for s in segments])


def rule_score(rules: Sequence[R.Rule], names: dict[str, Column] | None = None,
               missing: int = R.MISSING_SCORE) -> Column:
    """100 less penalties by the first rule whose inputs are all present."""
    names = names or {}

    def applied(rule: R.Rule) -> Column:
        inputs = [_c(names.get(c, c)) for c in rule.penalties]
        parts = [piecewise(v, segments) for v, segments in zip(inputs, rule.penalties.values())]
        score = (reduce(Column.__sub__, parts, F.lit(100.0)) if rule.divisor is None
                 else 100.0 - reduce(Column.__add__, parts) / float(rule.divisor))
        return F.when(reduce(Column.__and__, [v.isNotNull() for v in inputs]), score)
    return F.coalesce(*[applied(r) for r in rules], F.lit(float(missing)))


def emp_score(unemployment="unemployment_rate", youth="youth_unemployment") -> Column:
    return rule_score(R.SCORE_RULES["emp_score"],
                      {"unemployment_rate": unemployment, "youth_unemployment": youth})


def gdp_score(ppp="gdp_per_capita_ppp", nominal="gdp_per_capita") -> Column:
    # PPP when present, else nominal: both fall through the same ladder.
    return ladder(F.coalesce(_c(ppp), _c(nominal)), R.GDP_LADDER, R.GDP_FLOOR, above=True)


def edu_score(enrollment="school_enrollment") -> Column:
    return ladder(enrollment, R.EDU_LADDER, R.EDU_FLOOR, above=True)


def business_score(rank="ease_of_business") -> Column:
    return ladder(rank, R.BUSINESS_LADDER, R.BUSINESS_FLOOR, above=False)


def investment_score(fdi="foreign_direct_investment") -> Column:
    return ladder(fdi, R.INVESTMENT_LADDER, R.INVESTMENT_FLOOR, above=True)


def stability_score(inflation="inflation", debt="government_debt") -> Column:
    return rule_score(R.SCORE_RULES["stability_score"],
                      {"inflation": inflation, "government_debt": debt})


SCORES = {
    "emp_score": emp_score,
    "gdp_score": gdp_score,
    "edu_score": edu_score,
    "stability_score": stability_score,
    "business_score": business_score,
    "investment_score": investment_score,
}


def weighted_index(weights=R.INDEX_WEIGHTS) -> Column:
    """sum(score * weight) in the registry order, as double."""
    return reduce(Column.__add__, [F.col(name) * w for name, w in weights]).cast("double")


def with_scores(df):
    """Add the six sub-scores and the composite ``opportunity_index``."""
    return df.withColumns({name: fn() for name, fn in SCORES.items()}).withColumn("opportunity_index", weighted_index())
