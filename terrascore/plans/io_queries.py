"""Queries that exercise sources, sinks, the catalog and the streaming path.

Each writes the adapter's rows through a real sink into the shared folder
(``spark.checkpoint.dir``), reads them back through the matching source and
returns what was read; the oracle is the source rows themselves. Intermediate
inputs are staged once so a query never recomputes the adapter per write.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..operators import clean as C
from ..operators import dims, facts, index
from ..schemas import CLEAN, MALFORMED, REJECTED, TABLE_SCHEMAS
from ..session import shared_path, stage_table
from ..sinks.increments import publish_changes, read_published
from ..sinks.writers import (PACKED, PACKED_PAGES, ensure_database, land_raw, load_log, load_table, loaded_rows, write_raw_csv, write_raw_json,
                             write_snapshot)
from ..sources import adapter, envelopes, files
from ..streaming.landing import read_quarantined, run_landing, run_quarantine
from . import queries as Q
from . import serving
from .catalog import load_log_path, publish
from .snapshot_job import build_tables, load_landed
from .snapshot_job import run as run_job

SNAPSHOT_DATES = (dt.date(2025, 1, 1), dt.date(2025, 1, 2))
CLEAN_COLUMNS = tuple(f.name for f in CLEAN.fields)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "raw_csv")
    write_raw_csv(adapter.raw_observations(spark, sf_dir), path)
    back = files.read_raw_csv(spark, path, files.CSV_SINK_OPTIONS)
    return back.withColumn("value", F.col("value").try_cast("double"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "raw_json")
    write_raw_json(adapter.raw_observations(spark, sf_dir), path)
    return files.read_raw_json(spark, path)


def _landed_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    path = shared_path(spark, "pages")
    pages.select("envelope").write.options(**PACKED_PAGES).text(path)
    return envelopes.read_envelopes(spark, path, whole_files=False)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's rows as pages (the test data's generator, not the operator)."""
    return envelopes.pack_envelopes(adapter.raw_observations(spark, sf_dir))


def _staged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages for two uses, staged as lines, which are read one at a time: a
    Parquet reader would hold a batch of thousands of pages at once."""
    path = shared_path(spark, "page_lines")
    _pages(spark, sf_dir).select(F.concat_ws("\t", "page", "envelope")).write.options(**PACKED_PAGES).text(path)
    line = F.col("value")  # in JSON a tab is escaped: the first one ends the number
    return spark.read.text(path).select(F.substring_index(line, "\t", 1).cast("long").alias("page"),
                                        F.expr("substr(value, instr(value, '\t') + 1)").alias("envelope"))


#: Every so many pages of an indicator land twice, or not at all.
REPEATED_EVERY, MISSING_EVERY = 2, 3


def flatten_landed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of every indicator, flattened. Every second one had landed
    before with other values: the last landing counts, once."""
    pages = _staged_pages(spark, sf_dir)
    path = shared_path(spark, "pages")
    stale = F.regexp_replace("envelope", r'"value":[0-9.E-]+\}', '"value":-1}')
    pages.where(F.col("page") % REPEATED_EVERY == 0).select(stale.alias("envelope")).write.options(
        **PACKED_PAGES).text(f"{path}/first")
    pages.select("envelope").write.options(**PACKED_PAGES).text(f"{path}/second")
    landed = envelopes.read_envelopes(spark, f"{path}/*", whole_files=False)
    return envelopes.flatten_envelopes(envelopes.latest_pages(landed), adapter.DEFAULT_EXTRACTION_DATE)


def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page of each indicator got lost; the others' metadata tell."""
    pages = _pages(spark, sf_dir).where(F.col("page") % MISSING_EVERY != 0)
    return envelopes.missing_pages(_landed_pages(spark, pages))


def envelope_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every page of every indicator, then check the landing against the
    pages' own metadata (all complete)."""
    return envelopes.envelope_completeness(_landed_pages(spark, _pages(spark, sf_dir)))


#: Pages with every flaw a landing brings: an id outside the registry, no id at
#: all, absent keys, an empty and a null answer, an error payload, cut JSON.
EDGE_PAGES = (
    '{meta},[{{"countryiso3code":"{c}","country":{{"id":"x","value":"{n}"}},"indicator":{{"id":"UNKNOWN"}},"date":"2020","value":1.5}}]]',
    '{meta},[{{"countryiso3code":"{c}","date":"2021","value":2.5}},{{"country":null,"date":"2022","value":null}}]]',
    # elements that are no records, beside good ones, and numbers written as text
    '{meta},[{{"countryiso3code":"{c}","country":{{"value":"{n}"}},"indicator":{{"id":"MIXED"}},"date":"2023","value":"3.5"}},5,null,"{c}",[1],'
    '{{"countryiso3code":"{c}","date":"2024","value":"abc"}},{{"country":"{n}","value":1}},{{"indicator":[7],"value":1}},'
    '{{"countryiso3code":"{c}","indicator":{{"id":"MIXED"}},"date":2025,"value":4}}]]',
    '{meta},[]]', '{meta},null]', '[{{"message":"no such indicator"}}]', '{meta},[{{"countryiso3code":"{c}"',
)


def edge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer of the table lands one page of each flawed kind."""
    customers = adapter.read_table(spark, sf_dir, "customer")
    kinds = []
    for page in EDGE_PAGES:
        text = page.format(meta='[{"page":1,"pages":1}', c="\u0001", n="\u0002")
        kinds.append(F.replace(F.replace(F.lit(text), F.lit("\u0001"), F.concat(F.lit("C"), F.col("c_custkey").cast("string"))),
                               F.lit("\u0002"), F.col("c_name")))
    return customers.select(F.explode(F.array(*kinds)).alias("envelope"))


def flatten_edge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No record is lost: known or unknown id, with or without a name."""
    path = shared_path(spark, "edge_pages")
    edge_pages(spark, sf_dir).write.text(path)
    return envelopes.flatten_envelopes(envelopes.read_envelopes(spark, path, whole_files=False),
                                       adapter.DEFAULT_EXTRACTION_DATE, indicator=("ASKED", "asked_for"))


def rejected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that gave no records, counted by what is wrong with them."""
    return (envelopes.rejected_pages(edge_pages(spark, sf_dir)).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("n_pages")))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that are no records, by place and reason, with their text; the
    records beside them are in ``flatten_edge_pages``."""
    return envelopes.rejected_records(edge_pages(spark, sf_dir))


def _flawed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations as JSON lines; every line of one indicator is cut short,
    and each of another has a text for its value."""
    raw = adapter.raw_observations(spark, sf_dir)
    whole = F.to_json(F.struct(*raw.columns))
    name = F.col("indicator_name")
    line = (F.when(name == "inflation", F.substring(whole, 1, 20))
            .when((name == "gdp") & F.col("value").isNotNull(), F.to_json(F.struct(
                *[c for c in raw.columns if c != "value"], F.lit("n/a").alias("value")))).otherwise(whole))
    return raw.select(line.alias("line"))


def malformed_in_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over flawed lines, run twice: what it wrote, by kind."""
    path, root = shared_path(spark, "landing"), shared_path(spark, "job")
    _flawed_lines(spark, sf_dir).write.options(**PACKED).text(path)
    for _ in range(2):
        raw, malformed = load_landed(spark, "json", path, SNAPSHOT_DATES[0])
        run_job(spark, raw, root, SNAPSHOT_DATES[0], malformed=malformed)
    dated = StructType([*MALFORMED.fields, StructField("process_date", DateType())])
    bad = files.read_snapshot(spark, f"{root}/malformed", SNAPSHOT_DATES[0], schema=dated)
    good = files.read_snapshot(spark, f"{root}/observations", SNAPSHOT_DATES[0], schema=CLEAN)
    return (bad.select(F.col("reject_reason").alias("kind"), F.col("record").endswith("}").alias("whole"))
            .unionByName(good.select(F.lit("clean").alias("kind"), F.lit(True).alias("whole")))
            .groupBy("kind", "whole").agg(F.count(F.lit(1)).alias("n_rows")))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flawed lines through the stream, run again with nothing new: observations
    and malformed records, each once."""
    landing, ckpt = shared_path(spark, "landing"), shared_path(spark, "stream_ckpt")
    out, bad = shared_path(spark, "stream_out"), shared_path(spark, "stream_malformed")
    _flawed_lines(spark, sf_dir).write.options(**PACKED).text(landing)
    for _ in range(2):
        run_quarantine(spark, landing, out, bad, ckpt)
    clean, malformed = read_quarantined(spark, out, bad)
    return (malformed.select(F.col("reject_reason").alias("kind"), F.col("record").endswith("}").alias("whole"))
            .unionByName(clean.select(F.lit("clean").alias("kind"), F.lit(True).alias("whole")))
            .groupBy("kind", "whole").agg(F.count(F.lit(1)).alias("n_rows")))


def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV and JSON landed, one indicator empty: the manifest, counted as it
    was written."""
    raw = stage_table(adapter.raw_observations(spark, sf_dir).where(F.col("indicator_name") != "inflation"), "raw")
    return land_raw(raw, shared_path(spark, "landing"), adapter.DEFAULT_EXTRACTION_DATE)


def landed_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a landing wrote, read back from both formats: rows by indicator."""
    root = shared_path(spark, "landing")
    land_raw(stage_table(adapter.raw_observations(spark, sf_dir), "raw"), root, adapter.DEFAULT_EXTRACTION_DATE)
    csv = files.read_raw_csv(spark, f"{root}/csv", files.CSV_SINK_OPTIONS).withColumn("value", F.col("value").try_cast("double"))
    both = csv.withColumn("format", F.lit("csv")).unionByName(
        files.read_raw_json(spark, f"{root}/json").withColumn("format", F.lit("json")))
    return both.groupBy("format", "indicator_name", "extraction_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"), F.max("value").alias("max_value"))


def snapshot_on_or_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date between two that were written reads as the earlier one."""
    path = shared_path(spark, "snapshots")
    clean = stage_table(C.clean_observations(adapter.raw_observations(spark, sf_dir)), "clean")
    for d, shift in ((SNAPSHOT_DATES[0], 0), (SNAPSHOT_DATES[1] + dt.timedelta(days=5), 1)):
        write_snapshot(clean.withColumns({"process_date": F.lit(d), "value": F.col("value") + shift}), path)
    return (files.read_snapshot(spark, path, SNAPSHOT_DATES[1], ("gdp", "inflation"), schema=CLEAN, on_or_before=True)
            .select(*CLEAN_COLUMNS))


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(index stored by year, country dimension), of the last date before one that
    was not written."""
    clean = stage_table(C.clean_observations(adapter.raw_observations(spark, sf_dir)), "clean", ("indicator_name",))
    path = shared_path(spark, "index_by_year")
    serving.store_index(index.opportunity_index(facts.build_wide(clean)), path, SNAPSHOT_DATES[0])
    return (serving.stored_index(spark, path, SNAPSHOT_DATES[1], on_or_before=True),
            stage_table(dims.country_dimension(clean), "dim_countries"))


def serve_top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_countries(*_stored(spark, sf_dir))


def serve_index_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.index_map(*_stored(spark, sf_dir), Q.MAP_YEAR)


#: The country whose rows change between two versions, and by how much.
CHANGED_COUNTRY, CHANGED_BY = "C5", 1.0


def incremental_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact published, published again unchanged, and again with one country's
    values changed: the current version, and how many versions there are."""
    fact = stage_table(facts.build_fact(C.clean_observations(adapter.raw_observations(spark, sf_dir)), "education"), "fact")
    changed = stage_table(fact.withColumn("school_enrollment", F.col("school_enrollment") + F.when(
        F.col("country_code") == CHANGED_COUNTRY, CHANGED_BY).otherwise(0.0)), "fact")
    root = shared_path(spark, "published")
    for version in (fact, fact, changed):
        done = publish_changes(version, root, ("country_code",))
    return read_published(spark, root, fact.schema).withColumn("versions", F.lit(done.version).cast("long"))


def _job_root(spark: SparkSession, sf_dir: str) -> str:
    """The snapshot job over the adapter's rows for two dates."""
    root = shared_path(spark, "job")
    raw = stage_table(adapter.raw_observations(spark, sf_dir), "raw")
    for d in SNAPSHOT_DATES:
        run_job(spark, raw, root, d)
    return root


def rejects_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job wrote of refused observations, by date and reason."""
    schema = StructType([*REJECTED.fields, StructField("process_date", DateType())])
    return (files.read_snapshot(spark, f"{_job_root(spark, sf_dir)}/rejected", schema=schema)
            .groupBy("process_date", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows")))


def six_tables_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the six dated tables of one date, read through the wildcard."""
    root = _job_root(spark, sf_dir)
    schemas = {t: StructType([*s.fields, StructField("process_date", DateType())]) for t, s in TABLE_SCHEMAS.items()}
    tables = files.read_tables(spark, root, schemas)
    parts = [df.where(F.col("process_date") == SNAPSHOT_DATES[1]).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def snapshot_one_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date and two indicators of a dated snapshot, by folder."""
    path = shared_path(spark, "snapshots")
    clean = stage_table(C.clean_observations(adapter.raw_observations(spark, sf_dir)), "clean")
    for d in SNAPSHOT_DATES:
        write_snapshot(clean.withColumn("process_date", F.lit(d)), path)
    return (files.read_snapshot(spark, path, SNAPSHOT_DATES[1], ("gdp", "inflation"), schema=CLEAN)
            .select(*CLEAN_COLUMNS))


def empty_indicator_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An indicator without rows leaves no folder, and the rest is read."""
    path = shared_path(spark, "raw_json")
    raw = adapter.raw_observations(spark, sf_dir)
    write_raw_json(raw.where(F.col("indicator_name") != "inflation"), path)
    return files.read_raw_json(spark, path).groupBy("indicator_name").agg(F.count(F.lit(1)).alias("n_rows"))


def parquet_snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write date 1, date 2, then date 1 again: counts must not change."""
    path = shared_path(spark, "snapshots")
    clean = stage_table(C.clean_observations(adapter.raw_observations(spark, sf_dir)), "clean")
    for d in (SNAPSHOT_DATES[0], SNAPSHOT_DATES[1], SNAPSHOT_DATES[0]):
        write_snapshot(clean.withColumn("process_date", F.lit(d)), path)
    return (files.read_snapshot(spark, path, schema=CLEAN).groupBy("process_date", "indicator_name")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def table_load_append_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncate, append, truncate: the table holds one copy of the input."""
    db = _fresh_db()
    ensure_database(spark, db, location=shared_path(spark, "database"))
    table, path = f"{db}.dim_countries", shared_path(spark, "dim_countries_table")
    dim = stage_table(dims.country_dimension(
        C.clean_observations(adapter.raw_observations(spark, sf_dir))), "dim_countries")
    n1 = load_table(dim, table, "WRITE_TRUNCATE", path=path)
    n2 = load_table(dim, table, "WRITE_APPEND", path=path)
    n3 = load_table(dim, table, "WRITE_TRUNCATE", path=path)
    if not (n1 == n2 == n3):
        raise AssertionError(f"observed load counts differ: {n1}, {n2}, {n3}")
    return spark.table(table)


def stream_clean_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land raw JSON files, run the availableNow stream, read the sink."""
    landing = shared_path(spark, "landing")
    out, ckpt = shared_path(spark, "stream_out"), shared_path(spark, "stream_ckpt")
    adapter.raw_observations(spark, sf_dir).write.options(**PACKED).json(landing)
    run_landing(spark, landing, out, ckpt, fmt="json")
    return files.read_snapshot(spark, out, schema=CLEAN).select(*CLEAN_COLUMNS)


# ------------------------------------------------------------------ catalog

def _fresh_db() -> str:
    return f"terrascore_{uuid.uuid4().hex[:10]}"


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Stage clean + wide once, load the six tables, create the views; (database,
    folder)."""
    db, root = _fresh_db(), shared_path(spark, "catalog")
    clean = stage_table(C.clean_observations(adapter.raw_observations(spark, sf_dir)), "clean")
    publish(spark, build_tables(clean), db, root,
            comparison_floor=Q.COMPARISON_FLOOR, trends_floor=Q.TRENDS_FLOOR,
            home=Q.HOME)
    return db, root


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every published table, from the load log: no table is read."""
    _, root = _published(spark, sf_dir)
    counts = loaded_rows(load_log(spark, load_log_path(root)))
    return counts.withColumn("table_name", F.substring_index("table_name", ".", -1))


def _view_query(view: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.table(f"{_published(spark, sf_dir)[0]}.{view}")
    return run


def io_queries() -> dict:
    return {
        "csv_roundtrip": csv_roundtrip,
        "json_roundtrip": json_roundtrip,
        "flatten_envelopes": flatten_landed_envelopes,
        "envelope_completeness": envelope_completeness,
        "parquet_snapshot_overwrite": parquet_snapshot_overwrite,
        "flatten_edge_pages": flatten_edge_pages,
        "rejected_pages": rejected_pages,
        "rejected_records": rejected_records,
        "missing_pages": missing_pages,
        "malformed_in_job": malformed_in_job,
        "stream_quarantine": stream_quarantine,
        "landing_manifest": landing_manifest,
        "landed_back": landed_back,
        "snapshot_on_or_before": snapshot_on_or_before,
        "serve_top_countries": serve_top_countries,
        "serve_index_map": serve_index_map,
        "incremental_publish": incremental_publish,
        "rejects_written": rejects_written,
        "six_tables_dated": six_tables_dated,
        "snapshot_one_date": snapshot_one_date,
        "empty_indicator_landing": empty_indicator_landing,
        "table_load_append_truncate": table_load_append_truncate,
        "stream_clean_observations": stream_clean_observations,
        "load_counts": load_counts,
        "view_top_countries": _view_query("top_countries_for_grads_view"),
        "view_country_comparison": _view_query("country_comparison_view"),
        "view_country_trends": _view_query("country_trends_view"),
    }
