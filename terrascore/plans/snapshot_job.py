"""One Spark application for a daily snapshot, with one date parameter.

raw (landed CSV / JSON / page envelopes, or the driver tables), parsed once: what
is no record goes to ``malformed`` with file, position, reason and text
-> optional raw landing (CSV and JSON Lines with a manifest per indicator)
-> clean snapshot (Parquet, partitioned by date and indicator, dynamic overwrite)
with the refused observations beside it (``rejected``)
-> dimensions, three facts and the ranked index (Parquet, partitioned by date; the
index by year too, for one-year reads)
-> optional catalog publish (tables + views + load log).

Stage boundaries are written tables in the shared folder: each stage reads
its input back with partition pruning, a lost executor recomputes from a
file rather than from the raw scan, and a failure raises (no blanket catch).

Usage::

    python -m terrascore.plans.snapshot_job --date 2025-01-01 \\
        --source csv --input <landing folder> --out <shared folder> [--database db]

    # cluster: spark-submit --py-files terrascore.zip scripts/snapshot_job.py ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry as R
from ..operators import clean as C
from ..operators import dims, facts, index
from ..schemas import MALFORMED
from ..session import build_session, stage_table
from ..sinks.writers import land_raw, write_snapshot
from ..sources import adapter, envelopes, files
from . import serving
from .catalog import publish


def build_tables(clean: DataFrame, rank_method: str = "distributed",
                 staging: str | None = None) -> dict[str, DataFrame]:
    """The six published tables from clean observations.

    The wide fact aggregation is staged once and shared by the three facts
    and the index (one shuffle of the observations in total). ``staging``: a
    folder for it, replaced on every run.
    """
    wide = stage_table(facts.build_wide(clean), "wide_facts", path=staging and f"{staging}/wide_facts")
    return {
        "dim_countries": dims.country_dimension(clean),
        "dim_time": dims.time_dimension(clean),
        "fact_employment_metrics": facts.fact_from_wide(wide, "employment"),
        "fact_economic_indicators": facts.fact_from_wide(wide, "economic"),
        "fact_education": facts.fact_from_wide(wide, "education"),
        "opportunity_index": index.opportunity_index(wide, rank_method=rank_method),
    }


SOURCES = ("tables", "csv", "json", "json-array", "envelopes", "envelope-lines")


def load_landed(spark: SparkSession, source: str, input_path: str, extraction_date: dt.date,
                staging: str | None = None, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(raw, malformed) of a source: the observations, and what landed but is no
    record (``schemas.MALFORMED``). The landed text is parsed once, into staged
    rows that both come from (``staging``: a folder for them, replaced on every
    run). Of a page that landed more than once the last landing counts."""
    at = staging and f"{staging}/landed"
    if source == "tables":
        return adapter.raw_observations(spark, input_path, extraction_date, gaps=False), spark.createDataFrame([], MALFORMED)
    if source in ("csv", "json", "json-array"):
        fmt, whole = ("csv", multi_line) if source == "csv" else ("json", source == "json-array")
        parsed = stage_table(files.read_parsed(spark, input_path, fmt, whole), "landed", path=at)
        return files.good_records(parsed), files.malformed_records(parsed)
    if source in ("envelopes", "envelope-lines"):
        # "envelopes": one page document per file (may span lines);
        # "envelope-lines": one page document per line.
        pages = envelopes.read_envelopes(spark, input_path, whole_files=(source == "envelopes"))
        elements = envelopes.page_elements(envelopes.latest_pages(pages))
        bad = F.col("reject_reason").isNotNull()
        elements = stage_table(elements.select("page_file", "page", "position", "reject_reason", "record",
                                               F.when(bad, F.col("element")).alias("element")), "landed", path=at)
        whole = envelopes.rejected_pages(pages).withColumnRenamed("envelope", "record").withColumns(
            {"page": F.lit(None), "position": F.lit(None)})
        return (envelopes.observations(elements, extraction_date),
                envelopes.bad_elements(elements).to(MALFORMED).unionByName(whole.to(MALFORMED)))
    raise ValueError(f"unknown source {source!r}")


def load_raw(spark: SparkSession, source: str, input_path: str, extraction_date: dt.date) -> DataFrame:
    """The observations alone."""
    return load_landed(spark, source, input_path, extraction_date)[0]


def run(spark: SparkSession, raw: DataFrame, out_root: str, process_date: dt.date,
        database: str | None = None, rank_method: str = "distributed",
        year_range: tuple[int, int] | None = None, malformed: DataFrame | None = None,
        land: bool = False, **view_params) -> dict[str, DataFrame]:
    """The snapshot of one date. ``malformed``: what ``load_landed`` could not
    read, written beside the rejects. ``land``: write the raw observations as CSV
    and JSON Lines below ``raw`` first, with their manifest."""
    root = out_root.rstrip("/")
    if malformed is not None:
        dated = malformed.to(MALFORMED).withColumn("process_date", F.lit(process_date).cast("date"))
        write_snapshot(dated, f"{root}/malformed", partition_by=("process_date", "reject_reason"), gather=False)
    if land:
        raw = stage_table(raw, "raw", path=f"{root}/_staging/{process_date}/raw")
        land_raw(raw, f"{root}/raw", process_date)
    observations = C.clean_observations(raw, process_date, year_range=year_range)
    write_snapshot(observations, f"{root}/observations", gather=False)
    clean = files.read_snapshot(spark, f"{root}/observations", process_date,
                                schema=observations.schema, missing_ok=True)
    # What the clean stage refused, dated and with its reason.
    rejects = C.rejected_observations(raw).withColumn("process_date", F.lit(process_date).cast("date"))
    write_snapshot(rejects, f"{root}/rejected", partition_by=("process_date", "reject_reason"), gather=False)
    tables = build_tables(clean, rank_method, f"{root}/_staging/{process_date}")
    out = {}
    for name, df in tables.items():
        path = f"{root}/{name}"
        dated = df.withColumn("process_date", F.lit(process_date).cast("date"))
        if name == "opportunity_index":  # one-year reads: the rows of a year together
            write_snapshot(dated, path, serving.INDEX_PARTITIONS)
        else:
            write_snapshot(dated, path, ("process_date",), gather=False)
        out[name] = files.read_snapshot(spark, path, process_date, schema=dated.schema,
                                        missing_ok=True).select(*df.columns)
    if database:
        publish(spark, out, database, f"{root}/_catalog", **view_params)
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--date", type=dt.date.fromisoformat, default=dt.date.today(),
                   help="snapshot date (ISO); default today")
    p.add_argument("--source", choices=SOURCES, required=True)
    p.add_argument("--input", required=True, help="landing folder or driver-table folder")
    p.add_argument("--out", required=True, help="shared output folder")
    p.add_argument("--database", default=None)
    p.add_argument("--rank-method", default="distributed", choices=("window", "distributed"))
    p.add_argument("--buckets", type=int, default=None,
                   help="bucket count of the published (country_code, year) tables; "
                        "default spark.sql.shuffle.partitions")
    p.add_argument("--year-range", type=int, nargs=2, metavar=("LO", "HI"), default=None,
                   help="keep observation years LO..HI (the source extracts "
                        f"{R.SOURCE_YEAR_RANGE[0]}..{R.SOURCE_YEAR_RANGE[1]}); default all")
    p.add_argument("--land", action="store_true",
                   help="write the raw observations as CSV and JSON Lines below <out>/raw, with a manifest")
    p.add_argument("--multi-line", action="store_true", help="quoted CSV fields may hold line breaks")
    a = p.parse_args(argv)
    spark = build_session()
    raw, malformed = load_landed(spark, a.source, a.input, a.date, f"{a.out.rstrip('/')}/_staging/{a.date}", a.multi_line)
    view_params = {"buckets": a.buckets} if a.buckets else {}
    tables = run(spark, raw, a.out, a.date, a.database, a.rank_method,
                 tuple(a.year_range) if a.year_range else None, malformed, a.land, **view_params)
    for name in tables:
        print(f"wrote {name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
