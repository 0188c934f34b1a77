"""Incremental publish and year-pruned serving."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrascore.operators import dims, facts, index
from terrascore.operators.clean import clean_observations
from terrascore.plans import serving
from terrascore.session import shared_path, stage_table
from terrascore.sinks.increments import bucket_digests, current_version, publish_changes, read_published
from terrascore.sources import adapter, files

ROW = "country_code string, year int, a double, b double"


def data(rows, spark):
    return spark.createDataFrame(rows, ROW)


def contents(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_only_changed_buckets_are_written(spark):
    root = shared_path(spark, "published")
    rows = [(f"C{i}", y, float(i), None) for i in range(40) for y in (2000, 2001)]
    first = publish_changes(data(rows, spark), root, ("country_code",), 16)
    assert first.version == 1 and not first.kept and contents(read_published(spark, root, data(rows, spark).schema)) == contents(data(rows, spark))

    def folders():
        return sorted(os.listdir(f"{root}/data".replace("file:", "")))
    before = folders()
    same = publish_changes(data(rows[::-1], spark).repartition(5), root, ("country_code",), 16)
    assert same.version == 1 and not same.written and len(same.kept) == len(first.written) and folders() == before

    moved = [(c, y, None, a) if c == "C5" and y == 2000 else (c, y, a, b) for c, y, a, b in rows]  # a value moves to the other column
    third = publish_changes(data(moved, spark), root, ("country_code",), 16)
    assert third.version == 2 and len(third.written) == 1 and len(third.kept) == len(first.written) - 1
    assert contents(read_published(spark, root, data(rows, spark).schema)) == contents(data(moved, spark))
    assert contents(read_published(spark, root, data(rows, spark).schema, version=1)) == contents(data(rows, spark))

    one = publish_changes(data(moved[:2], spark), root, ("country_code",), 16)
    assert one.version == 3 and len(one.dropped) == len(first.written) - 1 and len(current_version(spark, root)[1]) == 1
    none = publish_changes(data([], spark), root, ("country_code",), 16)
    assert none.version == 4 and publish_changes(data([], spark), root, ("country_code",), 16).version == 4 and read_published(spark, root, data([], spark).schema).count() == 0


def test_repeated_rows_and_nulls_change_the_digest(spark):
    base = [("A", 1, 1.0, None), (None, None, None, None)]
    def digest(rows):
        return sorted(map(tuple, bucket_digests(data(rows, spark), ("country_code",), 4).collect()))
    assert digest(base) == digest(base[::-1])
    assert digest(base) != digest(base + base[:1]) and digest(base + base[:1] * 2) != digest(base + base[:1])
    assert digest(base) != digest([("A", 1, None, 1.0), base[1]])


def test_a_failed_publish_keeps_the_version(spark):
    root = shared_path(spark, "published")
    good = data([("A", 1, 1.0, 2.0)], spark)
    publish_changes(good, root, ("country_code",), 4)
    broken = good.withColumn("a", F.when(F.col("year") == 1, F.raise_error(F.lit("lost")).cast("double")))
    try:
        publish_changes(broken, root, ("country_code",), 4)
        raise AssertionError("did not fail")
    except Exception as e:
        assert "lost" in str(e)
    assert contents(read_published(spark, root, good.schema)) == contents(good)


def test_one_year_of_the_stored_index_is_read(spark):
    clean = stage_table(clean_observations(adapter.raw_observations(spark, SF_SMALL)), "clean")
    path = shared_path(spark, "index")
    ranked = stage_table(index.opportunity_index(facts.build_wide(clean)), "ranked")
    for day in (dt.date(2025, 1, 1), dt.date(2025, 1, 3)):
        serving.store_index(ranked if day.day == 1 else ranked.where("year < 2000"), path, day)
    stored = serving.stored_index(spark, path, "2025-01-02", on_or_before=True)
    assert contents(stored) == contents(ranked)
    last = ranked.agg(F.max("year")).first()[0]
    assert serving.latest_year(stored) == last
    assert serving.latest_year(serving.stored_index(spark, path, "2025-01-03")) == 1999
    top = serving.top_countries(stored, dims.country_dimension(clean), 5)
    assert {r.year for r in top.collect()} == {last}
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert f"(year#" in plan and f"= {last})]" in plan.split("PartitionFilters: [")[1] and "LessThanOrEqual(opportunity_rank,5)" in plan
    year_files = files.partition_values(stored, "year")
    assert len(year_files) == ranked.select("year").distinct().count()
