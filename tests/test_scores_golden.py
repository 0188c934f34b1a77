"""Golden score rows (FIXTURES §4), computed independently of the engine."""

import pytest
from pyspark.sql import functions as F

from terrascore.functions.scores import with_scores

N = None
COLS = ("unemployment_rate", "youth_unemployment", "gdp_per_capita", "gdp_per_capita_ppp",
        "school_enrollment", "inflation", "government_debt", "ease_of_business",
        "foreign_direct_investment")
# u, y, pc, ppp, en, f, g, b, fdi -> emp, gdp, edu, stab, bus, inv, index
GOLDEN = [
    ((N, N, N, N, N, N, N, N, N), (50, 50, 50, 50, 50, 50, 50.0)),
    ((5, 12, N, 50000, 80, 3, 60, 10, 4), (92.2, 90, 85, 84, 100, 70, 89.17)),
    ((N, 30, N, N, N, N, N, N, N), (40, 50, 50, 50, 50, 50, 46.5)),
    ((N, 70, N, N, N, N, N, N, N), (0, 50, 50, 50, 50, 50, 32.5)),
    ((40, N, N, N, N, N, N, N, N), (10, 50, 50, 50, 50, 50, 36.0)),
    ((25, 60, N, N, N, N, N, N, N), (72, 50, 50, 50, 50, 50, 57.7)),
    ((5, 12, 60000, N, 85, 2, 40, 20, 10), (92.2, 90, 85, 95, 100, 90, 92.27)),
    ((5, 12, 60000.01, N, 85.01, 2.01, 40.01, 20.01, 10.01),
     (92.2, 100, 100, 90.9775, 90, 100, 94.86775)),
    ((5, 12, 99999, 2500, 25, 5, 80, 140, 1), (92.2, 30, 25, 75, 25, 40, 56.02)),
    ((5, 12, N, 2500.01, 25.01, 10, 120, 140.01, 1.01), (92.2, 40, 40, 50, 15, 50, 56.52)),
    ((5, 12, N, 9000, N, -4, N, N, N), (92.2, 50, 50, 112, 50, 50, 70.97)),
    ((5, 12, N, 9000, N, -4, 30, N, -1), (92.2, 50, 50, 96.25, 50, 40, 68.395)),
    ((5, 12, N, 9000, N, N, 240, N, N), (92.2, 50, 50, 40, 50, 50, 63.77)),
    ((5, 12, N, 9000, N, 50, N, N, N), (92.2, 50, 50, 40, 50, 50, 63.77)),
    ((5, 12, N, 9000, N, 50, 400, N, N), (92.2, 50, 50, 0, 50, 50, 59.77)),
]
OUT = ("emp_score", "gdp_score", "edu_score", "stability_score", "business_score",
       "investment_score", "opportunity_index")


@pytest.fixture(scope="module")
def scored(spark):
    rows = [tuple(None if v is None else float(v) for v in inp) + (i,)
            for i, (inp, _) in enumerate(GOLDEN)]
    schema = ", ".join(f"{c} double" for c in COLS) + ", case_id int"
    df = spark.createDataFrame(rows, schema)
    return {r["case_id"]: r for r in with_scores(df).select("case_id", *OUT).collect()}


@pytest.mark.parametrize("case", range(len(GOLDEN)))
def test_golden_row(scored, case):
    expected = GOLDEN[case][1]
    row = scored[case]
    for name, want in zip(OUT, expected):
        assert row[name] is not None, name
        assert abs(row[name] - want) <= 1e-6, (case, name, row[name], want)


def test_weights_sum_to_one():
    from terrascore.registry import INDEX_WEIGHTS
    assert abs(sum(w for _, w in INDEX_WEIGHTS) - 1) < 1e-12


def test_scores_never_null_on_all_null_combinations(spark):
    import itertools
    vals = (None, 0.0, 25.0, 150.0, -5.0)
    rows = [r for r in itertools.product(vals, repeat=2)]
    df = spark.createDataFrame(
        [(a, b, a, b, a, b, a, b, a) for a, b in rows],
        ", ".join(f"{c} double" for c in COLS))
    out = with_scores(df)
    nulls = out.where(F.greatest(*[F.col(c).isNull().cast("int") for c in OUT]) > 0).count()
    assert nulls == 0
