"""Sinks: partitioned files, catalog tables with load dispositions, views.

* Raw CSV / JSON Lines land partitioned by extraction date and indicator: an
  indicator with no rows writes no partition (the "skip empty upload" rule
  falls out), and another day's landing stays. Rows of a partition are brought
  together before the write (``REBALANCE``: small ones share a task, large
  ones are split), so the number of files follows the data, not the tasks.
* Snapshots are Parquet partitioned by ``process_date`` (and indicator for
  observations) with *dynamic* partition overwrite: rewriting one date
  replaces only that date's folders. Rows that come from files (splits of a
  bounded size) and go to few folders are written from where they are read
  (``gather=False``), with no shuffle and no sort.
* A landing (``land_raw``) writes raw CSV and JSON Lines and a manifest with a row
  per indicator: what was landed, and which indicators were skipped for want of
  rows. The counts come from the write job itself.
* Catalog loads take a disposition — ``WRITE_TRUNCATE`` / ``WRITE_APPEND`` /
  ``WRITE_EMPTY`` — an optional schema override, and report the loaded row
  count through an ``Observation`` (collected by the write job itself, no
  second pass). With ``log`` each load appends a row to an audit table, from
  which ``loaded_rows`` tells every table's rows without reading any.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..registry import INDICATORS
from ..schemas import LANDING_MANIFEST, LOAD_LOG
from ..sources.files import CSV_SINK_OPTIONS

DISPOSITIONS = {
    "WRITE_TRUNCATE": "overwrite",
    "WRITE_APPEND": "append",
    "WRITE_EMPTY": "errorifexists",
}


RAW_PARTITIONS = ("extraction_date", "indicator_name")

#: Landed text is a tenth of its size when compressed. One such file is one task
#: to its reader, so none holds more lines than these (a page is a long line).
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}
PACKED_PAGES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 100}


#: Folders that a task writes to at once where rows are not brought together
#: first. Spark sorts the rest of a task's rows when it meets more.
OPEN_FOLDERS = 32
_OPEN_FOLDERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_folders(spark: SparkSession, n: int):
    before = spark.conf.get(_OPEN_FOLDERS_CONF)
    spark.conf.set(_OPEN_FOLDERS_CONF, n)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FOLDERS_CONF, before)


def _partitioned(df: DataFrame, partition_by, gather: bool = True):
    w = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by and gather else df
    return (w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by))


def write_raw_csv(raw: DataFrame, path: str, partition_by=RAW_PARTITIONS) -> None:
    _partitioned(raw, partition_by).options(**CSV_SINK_OPTIONS).csv(path)


def write_raw_json(raw: DataFrame, path: str, partition_by=RAW_PARTITIONS) -> None:
    _partitioned(raw, partition_by).options(**PACKED).json(path)


def land_raw(raw: DataFrame, root: str, extraction_date: dt.date,
             formats: tuple[str, ...] = ("csv", "json")) -> DataFrame:
    """Land ``raw`` below ``root`` in each format and return the date's manifest: a
    row per indicator of the registry with its rows and ``landed``, or
    ``skipped_empty``, and one without a name for rows of no known indicator.
    Every format reads ``raw`` anew: stage it where it is not read from files.

    The first write counts the rows as they are written, one metric per
    indicator: no second pass. Counted after the rows are brought together, in
    the tasks that write, so a recomputed shuffle counts nothing twice. Rerun,
    a landing replaces its own date only."""
    spark = raw.sparkSession
    raw = raw.withColumn("extraction_date", F.lit(extraction_date).cast("date"))
    names = [i.name for i in INDICATORS]
    name = F.col("indicator_name")
    metrics = [F.count_if(name == n).alias(n) for n in names]
    unknown = F.count_if(name.isNull() | ~name.isin(*names)).alias("unknown")
    obs = Observation(f"landing_{uuid.uuid4().hex[:8]}")
    together = raw.hint("rebalance", *[F.col(c) for c in RAW_PARTITIONS])
    for k, fmt in enumerate(formats):
        rows = together.observe(obs, *metrics, unknown) if k == 0 else together
        w = (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RAW_PARTITIONS)
             .options(**PACKED))
        (w.options(**CSV_SINK_OPTIONS) if fmt == "csv" else w).format(fmt).save(f"{root.rstrip('/')}/{fmt}")
    counts = obs.get
    rows = [(i.code, i.name, counts[i.name], "landed" if counts[i.name] else "skipped_empty", extraction_date) for i in INDICATORS]
    if counts["unknown"]:
        rows.append((None, None, counts["unknown"], "landed", extraction_date))
    path = f"{root.rstrip('/')}/manifest"
    (spark.createDataFrame(rows, LANDING_MANIFEST).coalesce(1).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("extraction_date").parquet(path))
    return spark.read.schema(LANDING_MANIFEST).parquet(path).where(F.col("extraction_date") == extraction_date)


def write_snapshot(df: DataFrame, path: str,
                   partition_by=("process_date", "indicator_name"), gather: bool = True) -> None:
    """Parquet, dynamic partition overwrite: other dates stay untouched.

    ``gather=False``: each task writes its rows to their folders as they come,
    a file per task and folder. For rows read from files, whose splits follow
    the data, and few folders (``OPEN_FOLDERS``; more are right, but sorted)."""
    w = _partitioned(df, partition_by, gather).option("compression", "zstd")
    if gather:
        w.parquet(path)
        return
    with _open_folders(df.sparkSession, OPEN_FOLDERS):
        w.parquet(path)


def load_table(df: DataFrame, table: str, disposition: str = "WRITE_TRUNCATE",
               schema: StructType | None = None, path: str | None = None,
               bucket_by: tuple[str, ...] | None = None,
               buckets: int | None = None, log: str | None = None) -> int:
    """Save ``df`` as a catalog table; returns the number of rows loaded.

    ``path`` makes it an external table in shared storage; each version of
    its data lives in its own ``<path>/v-<id>`` folder. ``WRITE_TRUNCATE``
    writes the new version next to the current one through a staging table
    and, once the write has committed, points the table at the new folder in
    one catalog change: a failed load leaves the previous table as it was, and
    there is no moment without a table. Only a load that changes the layout or
    the columns has to drop and rename. Replaced folders stay for their
    readers; deleting them is a matter of retention outside the load.
    ``WRITE_APPEND`` adds files to the current version; ``WRITE_EMPTY``
    fails if the table exists.

    ``schema`` reconciles columns by name and casts (``DataFrame.to``).
    ``bucket_by`` stores the table hash-bucketed and sorted on those columns
    (``buckets`` buckets, default ``spark.sql.shuffle.partitions``): later
    joins on the same keys read it co-partitioned, without a shuffle. The
    rows are hash-partitioned the same way first, so each task writes
    exactly one bucket file. ``log``: folder of the load log, to which the
    finished load appends its row.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown disposition {disposition!r}")
    spark = df.sparkSession
    if schema is not None:
        df = df.to(schema)
    obs = Observation(f"load_{table.replace('.', '_')}_{uuid.uuid4().hex[:6]}")
    n = None
    if bucket_by:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, *bucket_by)
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))  # in the writing tasks: a recomputed shuffle counts once
    exists = spark.catalog.tableExists(table)
    version = f"{path.rstrip('/')}/v-{uuid.uuid4().hex[:12]}" if path is not None else None
    if disposition == "WRITE_TRUNCATE" and exists and version is not None:
        staging = f"{table}__load_{uuid.uuid4().hex[:8]}"
        _save(df, staging, "errorifexists", version, bucket_by, n)
        if _layout(spark, staging) == _layout(spark, table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
            spark.sql(f"DROP TABLE {staging}")    # external: its files stay
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE {table}")
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    else:
        target = None if (disposition == "WRITE_APPEND" and exists) else version
        _save(df, table, DISPOSITIONS[disposition], target, bucket_by, n)
    rows = int(obs.get["rows"])
    if log is not None:
        entry = (table, version if disposition != "WRITE_APPEND" or not exists else None, disposition, rows, dt.datetime.now(dt.timezone.utc))
        spark.createDataFrame([entry], LOAD_LOG).coalesce(1).write.mode("append").parquet(log)
    return rows


def load_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOAD_LOG).parquet(log)


def loaded_rows(log: DataFrame) -> DataFrame:
    """(table_name, n_rows) as the log has them: what the last load that was no
    append wrote, and all appends since. No table is read."""
    table = Window.partitionBy("table_name")
    fresh = F.max(F.when(F.col("disposition") != "WRITE_APPEND", F.col("loaded_at"))).over(table)
    return (log.withColumn("_since", fresh).where(F.col("_since").isNull() | (F.col("loaded_at") >= F.col("_since")))
            .groupBy("table_name").agg(F.sum("n_rows").alias("n_rows")))


def _save(df: DataFrame, table: str, mode: str, path: str | None,
          bucket_by: tuple[str, ...] | None, n: int | None) -> None:
    w = df.write.mode(mode)
    if bucket_by:
        w = w.bucketBy(n, *bucket_by).sortBy(*bucket_by)
    if path is not None:
        w = w.option("path", path)
    w.format("parquet").saveAsTable(table)


def _layout(spark: SparkSession, table: str) -> tuple:
    """Columns and bucketing of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return (spark.table(table).schema.simpleString(),
            tuple(r["data_type"] for r in rows if r["col_name"] in ("Num Buckets", "Bucket Columns", "Sort Columns")))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def replace_view(spark: SparkSession, name: str, select_sql: str) -> None:
    """Atomic replace: no window in which the view is missing."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")
