"""Plan shape: one exchange per fact, no cartesian products, pushed filters."""

import re

from pyspark.sql import functions as F

from terrascore.operators import facts
from terrascore.operators.clean import clean_observations
from terrascore.plans.queries import Ctx, all_queries
from terrascore.registry import FACT_COLUMNS
from terrascore.session import stage_table
from terrascore.sources import adapter

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", _plan(df)))


def _clean_file(spark):
    return stage_table(clean_observations(adapter.raw_observations(spark, SF)), "plan_clean")


def test_fact_is_one_hash_exchange(spark):
    clean = _clean_file(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(facts.build_fact(clean, "economic")) == 1
        assert _exchanges(facts.build_wide(clean)) == 1
        chain = facts.outer_join_chain(clean, FACT_COLUMNS["economic"])
        assert _exchanges(chain) >= 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_indicator_filter_and_pruning_reach_scan(spark):
    clean = _clean_file(spark)
    plan = _plan(facts.build_fact(clean, "education"))
    assert "PushedFilters: [In(indicator_name" in plan or "indicator_name IN" in plan
    scan = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    assert "country_name" not in scan and "extraction_date" not in scan


def test_views_have_no_cartesian_product(spark):
    qs = all_queries()
    for name in ("country_comparison", "country_trends"):
        df = qs[name](spark, SF)
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Generate inline" in df._jdf.queryExecution().optimizedPlan().toString()


def test_top_list_ranks_one_year_with_a_group_limit(spark):
    plan = _plan(all_queries()["top_countries"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 1


def test_no_python_udf_in_any_plan(spark):
    ctx = Ctx(spark, SF)
    for df in (ctx.raw, ctx.clean, ctx.wide, ctx.countries, ctx.dim_time):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_rank_filter_gets_group_limit(spark):
    from pyspark.sql import Window
    ctx = Ctx(spark, SF)
    scored = ctx.wide.select("country_code", "year", F.col("gdp").alias("v"))
    w = Window.partitionBy("year").orderBy(F.col("v").desc())
    top = scored.withColumn("r", F.rank().over(w)).where(F.col("r") <= 30)
    assert "WindowGroupLimit" in _plan(top)


def test_bucketed_tables_leave_only_the_spine_shuffle(spark):
    """Published (country_code, year) tables are bucketed: the comparison
    view's four left joins shuffle only the country x year spine."""
    from terrascore.plans import io_queries as IO
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                            "spark.sql.autoBroadcastJoinThreshold")}
    db, _ = IO._published(spark, SF)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = spark.table(f"{db}.country_comparison_view")._jdf.queryExecution() \
            .executedPlan().toString()
        trends = spark.table(f"{db}.country_trends_view")._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert plan.count("SortMergeJoin") == 4
    assert plan.count("Exchange hashpartitioning") == 1
    # trends: the chosen-country join touches only the spine (no semi joins
    # copied onto the bucketed tables): spine by code, key set, spine by key
    assert "LeftSemi" not in trends
    assert trends.count("Exchange hashpartitioning") == 3


def test_staged_clean_is_pruned_by_indicator(spark):
    """View queries stage clean observations partitioned by indicator: the
    gdp-only dimensions read one folder, the facts only their indicators."""
    ctx = Ctx(spark, SF, stage_clean=True)
    dim = _plan(ctx.countries)
    assert "PartitionFilters: [isnotnull(indicator_name" in dim and "= gdp)" in dim
    edu = _plan(facts.build_fact(ctx.clean, "education"))
    assert "PartitionFilters: [indicator_name" in edu or \
        "PartitionFilters: [isnotnull(indicator_name" in edu
    assert ctx.clean.columns == ["country_code", "country_name", "indicator_id",
                                 "indicator_name", "year", "value", "extraction_date",
                                 "process_date"]


def test_no_registered_query_plans_a_cartesian_product_or_python_udf(spark):
    bad = {}
    for name, q in sorted(all_queries().items()):
        plan = _plan(q(spark, SF))
        hits = [p for p in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                            "ArrowEvalPython") if p in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad
