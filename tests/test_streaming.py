"""Incremental landing stream: exactly-once across runs and restarts."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrascore.operators.clean import clean_observations
from terrascore.session import shared_path
from terrascore.sources import adapter
from terrascore.streaming.landing import run_landing


def test_landing_runs_are_incremental_and_exactly_once(spark):
    raw = adapter.raw_observations(spark, SF_SMALL)
    landing = shared_path(spark, "landing")
    out, ckpt = shared_path(spark, "out"), shared_path(spark, "ckpt")
    first = raw.where(F.col("indicator_name") < "h")
    second = raw.where(F.col("indicator_name") >= "h")

    first.write.json(f"{landing}/batch=1")
    run_landing(spark, landing, out, ckpt)
    n1 = spark.read.parquet(out).count()
    assert n1 == clean_observations(first).count()

    # A restart with nothing new changes nothing (the checkpoint knows the files).
    run_landing(spark, landing, out, ckpt)
    assert spark.read.parquet(out).count() == n1

    # Newly landed files are processed once, on the next run only.
    second.write.json(f"{landing}/batch=2")
    run_landing(spark, landing, out, ckpt)
    back = spark.read.parquet(out)
    assert back.count() == clean_observations(raw).count()
    keys = ["country_code", "indicator_name", "year"]
    assert back.groupBy(*keys).count().where(F.col("count") > 1).count() == 0
