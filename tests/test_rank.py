"""Rank plans: the distributed plan equals the window plan, incl. hot ties."""

from pyspark.sql import functions as F

from terrascore.operators.rank import rank_desc, rank_distributed, rank_window
from terrascore.plans.queries import Ctx
from terrascore.functions.scores import with_scores
from terrascore.operators.facts import index_input

SF = "/root/testdata/sf0.01"


def _same(a, b, cols):
    x = sorted((tuple(r) for r in a.select(*cols).collect()), key=repr)
    y = sorted((tuple(r) for r in b.select(*cols).collect()), key=repr)
    assert repr(x) == repr(y)


def test_distributed_equals_window_on_index(spark):
    scored = with_scores(index_input(Ctx(spark, SF).wide)).select(
        "country_code", "year", "opportunity_index").cache()
    w = rank_window(scored, "year", "opportunity_index", "r")
    d = rank_distributed(scored, "year", "opportunity_index", "r", ranges=20)
    _same(w, d, ["country_code", "year", "opportunity_index", "r"])
    # ties exist in every year, so this also checks rank gaps
    per_year = w.groupBy("year").agg(F.min("r").alias("lo"), F.countDistinct("r").alias("d"),
                                     F.count(F.lit(1)).alias("n")).collect()
    assert all(r["lo"] == 1 and r["d"] < r["n"] for r in per_year)


def test_distributed_with_hot_group_and_hot_tie(spark):
    # One order status holds most rows; a rounded price makes huge tie groups.
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_orderstatus",
        F.round(F.col("o_totalprice") / 50000).alias("v"))
    w = rank_window(orders, "o_orderstatus", "v", "r")
    d = rank_distributed(orders, "o_orderstatus", "v", "r", ranges=20)
    _same(w, d, ["o_orderkey", "o_orderstatus", "v", "r"])


def test_nulls_rank_last(spark):
    df = spark.createDataFrame(
        [("a", 1, 3.0), ("b", 1, None), ("c", 1, 3.0), ("d", 1, 1.0), ("e", 2, None)],
        "k string, g int, v double")
    w = rank_window(df, "g", "v", "r")
    d = rank_distributed(df, "g", "v", "r", ranges=20)
    _same(w, d, ["k", "r"])
    got = {r["k"]: r["r"] for r in d.collect()}
    assert got == {"a": 1, "c": 1, "d": 3, "b": 4, "e": 1}


def test_methods_by_name_only(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 1.0)], "k string, g int, v double")
    for method in ("window", "distributed"):
        assert sorted(r["r"] for r in rank_desc(df, "g", "v", "r", method).collect()) == [1, 2]
    try:
        rank_desc(df, "g", "v", "r", "auto")
        raised = False
    except ValueError:
        raised = True
    assert raised


def test_null_groups_are_a_group(spark):
    rows = [("a", None, 3.0), ("b", None, None), ("c", None, 5.0), ("d", 1, 1.0), ("e", None, 3.0)]
    df = spark.createDataFrame(rows, "k string, g int, v double")
    for n in (1, 3, 50):
        got = {r["k"]: r["r"] for r in rank_distributed(df, "g", "v", "r", ranges=n).collect()}
        assert got == {"a": 2, "b": 4, "c": 1, "d": 1, "e": 2}


def test_columns_may_be_called_like_internals(spark):
    df = spark.createDataFrame([(1, 2.0, 7, 8, 9), (1, 3.0, 7, 8, 9)], "g int, v double, n int, part int, offset int")
    got = sorted(tuple(r) for r in rank_distributed(df, "g", "v", "r").collect())
    assert got == [(1, 2.0, 7, 8, 9, 2), (1, 3.0, 7, 8, 9, 1)]


def test_nan_ranks_first_like_the_window(spark):
    df = spark.createDataFrame(
        [("a", 1, float("nan")), ("b", 1, 2.0), ("c", 1, None), ("d", 1, 5.0), ("e", 1, 2.0)],
        "k string, g int, v double")
    w = rank_window(df, "g", "v", "r")
    d = rank_distributed(df, "g", "v", "r", ranges=20)
    _same(w, d, ["k", "r"])


def test_distributed_rank_with_a_third_of_rows_on_one_value(spark):
    """600k rows in one group: a third share one value, a third sit in a very
    narrow range, the rest are spread out, plus nulls. Exact equality with the
    window plan (checked distributed, by join)."""
    n = 600_000
    df = spark.range(n).select(
        F.col("id"), F.lit(2024).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(50.0))
        .when(F.col("id") % 3 == 1, F.lit(70.0) + F.col("id") * 1e-10)
        .when(F.col("id") % 97 == 2, F.lit(None).cast("double"))
        .otherwise((F.col("id") * 7919 % 100_003) / 1000.0).alias("v"))
    df = df.cache()
    w = rank_window(df, "g", "v", "r")
    d = rank_distributed(df, "g", "v", "r", ranges=40)
    diff = (w.alias("a").join(d.alias("b"), "id")
            .where(F.col("a.r") != F.col("b.r")).count())
    assert diff == 0 and d.count() == n
    df.unpersist()


def test_distributed_rank_property(spark):
    """Random groups, values with many ties, NULL, NaN and +/-inf: the
    distributed plan equals RANK() for any bucket size."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    value = st.one_of(st.none(), st.sampled_from([float("nan"), float("inf"), float("-inf")]),
                      st.integers(-5, 5).map(float),
                      st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))
    rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), value), min_size=1, max_size=60)

    @settings(max_examples=15, deadline=None)
    @given(rows=rows, ranges=st.integers(1, 20))
    def check(rows, ranges):
        df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)],
                                   "k int, g int, v double")
        w = rank_window(df, "g", "v", "r")
        d = rank_distributed(df, "g", "v", "r", ranges=ranges)
        _same(w, d, ["k", "r"])

    check()
