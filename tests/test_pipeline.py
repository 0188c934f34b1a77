"""The one-date snapshot application end to end."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from harness import compare
from terrascore.plans import queries as Q
from terrascore.plans import snapshot_job as J
from terrascore.session import shared_path
from terrascore.sources import adapter

D = dt.date(2025, 1, 1)
ORACLE = E.oracle_sql()
TABLE_ORACLES = {
    "dim_countries": "dim_countries",
    "dim_time": "dim_time",
    "fact_employment_metrics": "fact_employment",
    "fact_economic_indicators": "fact_economic",
    "fact_education": "fact_education",
    "opportunity_index": "opportunity_rank",
}


def test_snapshot_job_tables_views_and_rerun(spark, duck_small):
    out = shared_path(spark, "job")
    db = f"job_{uuid.uuid4().hex[:8]}"
    raw = adapter.raw_observations(spark, SF_SMALL)
    params = dict(comparison_floor=Q.COMPARISON_FLOOR, trends_floor=Q.TRENDS_FLOOR, home=Q.HOME)
    tables = J.run(spark, raw, out, D, database=db, **params)
    for name, key in TABLE_ORACLES.items():
        rep = compare(tables[name], ORACLE[key], duck_small)
        assert rep["ok"], (name, rep)
    for view, key in (("country_comparison_view", "country_comparison"),
                      ("top_countries_for_grads_view", "top_countries"),
                      ("country_trends_view", "country_trends")):
        rep = compare(spark.table(f"{db}.{view}"), ORACLE[key], duck_small)
        assert rep["ok"], (view, rep)
    before = {n: df.count() for n, df in tables.items()}
    # Rerunning the same date replaces that date only: counts do not change.
    again = J.run(spark, raw, out, D, **params)
    assert {n: df.count() for n, df in again.items()} == before
    # A second date sits next to the first.
    J.run(spark, raw, out, dt.date(2025, 1, 2), **params)
    dates = (spark.read.parquet(f"{out}/opportunity_index")
             .select(F.col("process_date").cast("string").alias("d")).distinct().collect())
    assert sorted(r["d"] for r in dates) == ["2025-01-01", "2025-01-02"]


def test_snapshot_job_cli_from_landed_json(spark):
    landing = shared_path(spark, "landing")
    adapter.raw_observations(spark, SF_SMALL).write.json(landing)
    out = shared_path(spark, "cli")
    db = f"cli_{uuid.uuid4().hex[:8]}"
    assert J.main(["--date", "2025-01-01", "--source", "json", "--input", landing,
                   "--out", out, "--year-range", "1996", "2000",
                   "--database", db, "--buckets", "3"]) == 0
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.opportunity_index").where(
        F.col("col_name") == "Num Buckets").collect()
    assert detail and detail[0]["data_type"] == "3"
    ranked = spark.read.parquet(f"{out}/opportunity_index")
    per_year = ranked.groupBy("year").agg(F.min("opportunity_rank").alias("lo")).collect()
    assert sorted(r["year"] for r in per_year) == [1996, 1997, 1998, 1999, 2000]
    assert all(r["lo"] == 1 for r in per_year)


def test_raw_readers_take_flat_and_partitioned_layouts(spark):
    from terrascore.sinks.writers import write_raw_csv, write_raw_json
    from terrascore.sources import files
    raw = adapter.raw_observations(spark, SF_SMALL)
    n = raw.count()
    for writer, reader, opts in ((write_raw_json, files.read_raw_json, None),
                                 (write_raw_csv, files.read_raw_csv, files.CSV_SINK_OPTIONS)):
        for parts in (("indicator_name",), ()):
            path = shared_path(spark, "layout")
            writer(raw, path, partition_by=parts)
            back = reader(spark, path, opts) if opts else reader(spark, path)
            assert back.where(F.col("indicator_name").isNull()).count() == 0
            assert back.count() == n
            assert back.select("indicator_name").distinct().count() == 13


def test_job_reads_page_files_and_page_lines(spark, tmp_path):
    import json
    rec = lambda c, y, v: {"countryiso3code": c, "country": {"id": c[:2], "value": "N" + c},
                           "indicator": {"id": "NY.GDP.MKTP.CD", "value": "GDP"},
                           "date": y, "value": v}
    pages = [
        [{"page": 1, "pages": 2, "per_page": 2, "total": 3},
         [rec("AAA", "2020", 1.5), rec("BBB", "2020", None)]],
        [{"page": 2, "pages": 2, "per_page": 2, "total": 3}, [rec("CCC", "2021", 2.5)]],
        [{"message": [{"id": "120", "value": "Invalid value"}]}],
    ]
    files_dir, lines_dir = tmp_path / "files", tmp_path / "lines"
    files_dir.mkdir()
    lines_dir.mkdir()
    for i, p in enumerate(pages):  # one pretty-printed page per file
        (files_dir / f"page{i}.json").write_text(json.dumps(p, indent=2))
    (lines_dir / "pages.json").write_text("\n".join(json.dumps(p) for p in pages) + "\n")
    for source, path in (("envelopes", files_dir), ("envelope-lines", lines_dir)):
        raw = J.load_raw(spark, source, str(path), D)
        got = sorted((r.country_code, r.indicator_name, r.year, r.value) for r in raw.collect())
        assert got == [("AAA", "gdp", "2020", 1.5), ("BBB", "gdp", "2020", None),
                       ("CCC", "gdp", "2021", 2.5)], source
