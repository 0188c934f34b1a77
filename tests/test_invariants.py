"""Invariants and an independent scalar reference.

The reference functions below are written from the score tables of
SURVEY §2.11, not from the engine's registry, and are compared with the
Spark expressions on rung boundaries and on a seeded random batch.
"""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrascore.functions.scores import with_scores
from terrascore.plans.queries import COMPARISON_FLOOR, Ctx
from terrascore.operators import views

SF = "/root/testdata/sf0.01"
COLS = ("unemployment_rate", "youth_unemployment", "gdp_per_capita", "gdp_per_capita_ppp",
        "school_enrollment", "inflation", "government_debt", "ease_of_business",
        "foreign_direct_investment")


def _gt_ladder(x, rungs, floor):
    if x is None:
        return 50
    for t, s in rungs:
        if x > t:
            return s
    return floor


def ref_scores(u, y, pc, ppp, en, f, g, b, fdi):
    if u is None and y is None:
        emp = 50
    elif u is None:
        emp = 100 - min(y, 50) * 2
    elif y is None:
        emp = 100 - min(u, 30) * 3
    else:
        emp = 100 - (min(u, 20) * 1.5 + min(y, 40) * 1.0) / 2.5
    gdp = _gt_ladder(ppp if ppp is not None else pc,
                     [(60000, 100), (45000, 90), (30000, 80), (20000, 70), (15000, 65),
                      (10000, 60), (5000, 50), (2500, 40)], 30)
    edu = _gt_ladder(en, [(85, 100), (70, 85), (55, 70), (40, 55), (25, 40)], 25)
    if b is None:
        bus = 50
    else:
        bus = next((s for t, s in [(20, 100), (40, 90), (60, 75), (80, 60), (100, 45),
                                    (120, 35), (140, 25)] if b <= t), 15)
    inv = _gt_ladder(fdi, [(10, 100), (7, 90), (5, 80), (3, 70), (2, 60), (1, 50)], 40)
    if f is None and g is None:
        stab = 50
    elif f is None:
        stab = 100 - min(g / 3, 60)
    elif g is None:
        stab = 100 - min(f * 3, 60)
    else:
        pf = 0 if f <= 2 else f * 2 if f <= 5 else 10 + (f - 5) * 3 if f <= 10 \
            else 25 + min((f - 10) * 1.5, 25)
        pg = g / 8 if g <= 40 else 5 + (g - 40) / 4 if g <= 80 else 15 + (g - 80) / 4 \
            if g <= 120 else 25 + min((g - 120) / 6, 25)
        stab = 100 - pf - pg
    idx = emp * 0.35 + gdp * 0.20 + bus * 0.15 + stab * 0.10 + edu * 0.10 + inv * 0.10
    return emp, gdp, edu, stab, bus, inv, idx


OUT = ("emp_score", "gdp_score", "edu_score", "stability_score", "business_score",
       "investment_score", "opportunity_index")


def _check(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS))
    got = with_scores(df).select(*COLS, *OUT).collect()
    assert len(got) == len(rows)
    for r in got:
        want = ref_scores(*[r[c] for c in COLS])
        for name, w in zip(OUT, want):
            assert r[name] == pytest.approx(w, abs=1e-9), (r.asDict(), name, w)


def _rungs():
    """On and just past every rung of every ladder and penalty knot."""
    base = [5.0, 12.0, None, 9000.0, 50.0, 3.0, 60.0, 50.0, 4.0]
    rows = []
    knots = {2: [2500, 5000, 10000, 15000, 20000, 30000, 45000, 60000],   # gdp (nominal)
             3: [2500, 5000, 10000, 15000, 20000, 30000, 45000, 60000],   # gdp (ppp)
             4: [25, 40, 55, 70, 85],                                     # enrolment
             5: [2, 5, 10, 26.67, 30],                                    # inflation
             6: [40, 80, 120, 270],                                       # debt
             7: [20, 40, 60, 80, 100, 120, 140],                          # business rank
             8: [1, 2, 3, 5, 7, 10],                                      # fdi
             0: [20, 30], 1: [40, 50]}                                    # caps
    for i, ts in knots.items():
        for t in ts:
            for x in (t - 0.01, float(t), t + 0.01):
                row = list(base)
                row[i] = x
                rows.append(tuple(row))
    return rows


def test_every_rung_boundary_matches_reference(spark):
    _check(spark, _rungs())


def test_random_batch_matches_reference(spark):
    rnd = random.Random(20250101)
    spans = [(-5, 60), (-5, 90), (0, 90000), (0, 90000), (0, 110), (-10, 60), (0, 300),
             (1, 190), (-5, 15)]
    rows = []
    for _ in range(3000):
        rows.append(tuple(None if rnd.random() < 0.25 else round(rnd.uniform(lo, hi), 2)
                          for lo, hi in spans))
    _check(spark, rows)


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF, stage_clean=True)


def test_index_invariants(ctx):
    ix = ctx.index
    assert ix.where(F.col("opportunity_index").isNull()).count() == 0
    # rank = 1 + rows of the year with a strictly larger index, via tie-group sizes
    ties = ix.groupBy("year", "opportunity_index").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("year").orderBy(F.desc("opportunity_index")).rowsBetween(
        Window.unboundedPreceding, -1)
    expect = ties.withColumn("want", F.coalesce(F.sum("n").over(above), F.lit(0)) + 1)
    bad = (ix.join(expect, ["year", "opportunity_index"])
           .where(F.col("want") != F.col("opportunity_rank")).count())
    assert bad == 0
    firsts = ix.groupBy("year").agg(F.min("opportunity_rank").alias("lo"))
    assert firsts.where(F.col("lo") != 1).count() == 0


def test_comparison_rows_are_countries_times_years(ctx):
    comp = views.country_comparison(ctx.countries, ctx.dim_time, ctx.wide, ctx.index,
                                    COMPARISON_FLOOR)
    n_c = ctx.countries.count()
    n_y = ctx.dim_time.where(F.col("year") >= COMPARISON_FLOOR).count()
    assert comp.count() == n_c * n_y
    assert comp.select("country_code", "country_name", "year").distinct().count() == n_c * n_y


def test_fact_pivot_property(spark):
    """Random observations (duplicates, gaps, other facts' indicators): every
    fact equals max-per-key-per-indicator over the keys present in any of its
    indicators; the outer-join chain gives the same rows."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from terrascore.operators import facts
    from terrascore.registry import FACT_COLUMNS, INDICATOR_NAMES

    obs = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(2000, 2002),
                             st.sampled_from(INDICATOR_NAMES),
                             st.floats(-100, 100, allow_nan=False).map(lambda x: round(x, 2))),
                   min_size=1, max_size=40)

    @settings(max_examples=10, deadline=None)
    @given(rows=obs, fact=st.sampled_from(sorted(FACT_COLUMNS)))
    def check(rows, fact):
        clean = spark.createDataFrame(rows, "country_code string, year int, "
                                            "indicator_name string, value double")
        names = FACT_COLUMNS[fact]
        want = {}
        for code, year, ind, v in rows:
            if ind in names:
                cell = want.setdefault((code, year), dict.fromkeys(names))
                cell[ind] = v if cell[ind] is None else max(cell[ind], v)
        got = {(r["country_code"], r["year"]): {n: r[n] for n in names}
               for r in facts.build_fact(clean, fact).collect()}
        assert got == want
        chain = {(r["country_code"], r["year"]): {n: r[n] for n in names}
                 for r in facts.outer_join_chain(clean, names).collect()}
        assert chain == want

    check()
