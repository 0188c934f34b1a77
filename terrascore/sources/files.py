"""File sources with declared schemas (no inference pass, no type drift).

* landed CSV written by a pandas-style producer: header, RFC 4180 quote
  doubling (``escape='"'``), empty fields read as null;
* our own CSV sink profile additionally writes nulls as ``\\N`` so that an
  empty string and a null survive a round trip as different values;
* JSON Lines;
* Parquet snapshots partitioned by ``process_date`` / ``indicator_name`` —
  reads take the partition filters, so one date or one indicator touches
  only its directories.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import MALFORMED, RAW, RAW_TEXT

LANDED_CSV_OPTIONS = {"header": "true", "escape": '"'}
CSV_SINK_OPTIONS = {"header": "true", "escape": '"', "nullValue": "\\N"}
RAW_COLUMNS = tuple(f.name for f in RAW.fields)


def read_raw_csv(spark: SparkSession, path: str, options: dict | None = None, multi_line: bool = False) -> DataFrame:
    """Landed raw CSV; year and value stay text until the clean stage casts them.

    Works on both layouts: in ``indicator_name=<x>/`` folders the declared
    ``indicator_name`` column is the partition column (files hold the other
    columns, in order); in flat files it is read from the file. ``multi_line``:
    quoted fields may hold line breaks (a file is then one split).
    """
    return (spark.read.schema(RAW_TEXT).options(**(options or LANDED_CSV_OPTIONS)).option("multiLine", multi_line)
            .csv(path).select(*RAW_COLUMNS))


CORRUPT = "_corrupt_record"


def parsed_schema(fmt: str) -> StructType:
    """What a landed file is read as, with a column for records that cannot be."""
    return StructType([*(RAW_TEXT if fmt == "csv" else RAW).fields, StructField(CORRUPT, StringType())])


def parsed_options(fmt: str, multi_line: bool = False, options: dict | None = None) -> dict:
    own = (options or LANDED_CSV_OPTIONS) if fmt == "csv" else {}
    return {**own, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": str(multi_line).lower()}


def read_parsed(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False,
                options: dict | None = None) -> DataFrame:
    """Every landed record, parsed once: the raw columns, the text of a record
    that cannot be read (null for the others) and its file. Stage it and take
    ``good_records`` and ``malformed_records`` from the staged rows."""
    rows = spark.read.schema(parsed_schema(fmt)).options(**parsed_options(fmt, multi_line, options)).format(fmt).load(path)
    return rows.select(*RAW_COLUMNS, CORRUPT, F.col("_metadata.file_path").alias("page_file"))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).select(*RAW_COLUMNS)


def malformed_records(parsed: DataFrame) -> DataFrame:
    """``MALFORMED`` rows: the file, and the text as it landed."""
    bad = parsed.where(F.col(CORRUPT).isNotNull())
    file = F.col("page_file") if "page_file" in parsed.columns else F.lit(None)
    return bad.select(file.alias("page_file"), F.lit(None).alias("page"), F.lit(None).alias("position"),
                      F.lit("malformed_line").alias("reject_reason"), F.col(CORRUPT).alias("record")).to(MALFORMED)


def read_raw_with_rejects(spark: SparkSession, path: str, fmt: str = "json", multi_line: bool = False,
                          options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(observations, malformed): records that cannot be read, or whose value
    is no number where the format has types, go to ``malformed`` with their
    text, beside what could be read of them, instead of turning into nulls."""
    rows = read_parsed(spark, path, fmt, multi_line, options)
    bad = F.col(CORRUPT).isNotNull()
    return good_records(rows), rows.where(bad).select(F.col(CORRUPT).alias("record"), *RAW_COLUMNS)


def read_raw_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed raw JSON, partitioned by indicator_name or flat (the declared
    ``indicator_name`` comes from the folder or from the record).

    Default JSON Lines (our sink; splittable). ``multi_line=True`` reads files
    that each hold one JSON array of records (a pandas-style producer); such
    a file is one split, so it suits per-indicator landing files.
    """
    return (spark.read.schema(RAW).option("multiLine", multi_line).json(path)
            .select(*RAW_COLUMNS))


class SnapshotNotFound(ValueError):
    """No snapshot of the asked date."""


def partition_values(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a partition column, from the names of the files that
    the read would touch: no file is opened and no job runs."""
    marked = re.compile(rf"/{re.escape(column)}=([^/]*)/")
    return sorted({unquote(m[1]) for m in map(marked.search, df.inputFiles()) if m})


def snapshot_dates(spark: SparkSession, path: str, schema: StructType) -> list[dt.date]:
    """The dates a snapshot was written for, ascending."""
    return [dt.date.fromisoformat(v) for v in partition_values(spark.read.schema(schema).parquet(path), "process_date")]


def resolve_date(spark: SparkSession, path: str, schema: StructType, process_date: dt.date | str,
                 on_or_before: bool = False) -> dt.date:
    """``process_date`` if it was written; with ``on_or_before`` else the last date
    before it that was. Raises ``SnapshotNotFound`` where there is none."""
    asked = dt.date.fromisoformat(process_date) if isinstance(process_date, str) else process_date
    written = snapshot_dates(spark, path, schema)
    fit = [d for d in written if d == asked or on_or_before and d <= asked]
    if not fit:
        known = f"{written[0]} to {written[-1]} ({len(written)} dates)" if written else "none"
        raise SnapshotNotFound(f"no snapshot {'on or before' if on_or_before else 'of'} {asked} in {path}; written: {known}")
    return fit[-1]


def read_snapshot(spark: SparkSession, path: str, process_date: dt.date | str | None = None,
                  indicators: tuple[str, ...] | None = None, schema: StructType | None = None,
                  on_or_before: bool = False, missing_ok: bool = False) -> DataFrame:
    """Parquet snapshot with partition pruning on date and indicator.

    ``schema`` (partition columns included) skips inference and keeps an
    empty snapshot readable. A date that was never written raises
    ``SnapshotNotFound``; ``on_or_before`` takes the last one before it, and
    ``missing_ok`` reads no rows (for who has just written that date, perhaps
    without rows).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if process_date is not None:
        if not missing_ok:
            process_date = resolve_date(spark, path, df.schema, process_date, on_or_before)
        df = df.where(F.col("process_date") == F.lit(process_date).cast("date"))
    if indicators:
        df = df.where(F.col("indicator_name").isin(*indicators))
    return df


def read_tables(spark: SparkSession, root: str, schemas: dict[str, StructType],
                glob: str = "*.parquet") -> dict[str, DataFrame]:
    """Wildcard Parquet load of several table folders under one root."""
    return {n: spark.read.schema(schema).option("pathGlobFilter", glob).parquet(f"{root.rstrip('/')}/{n}")
            for n, schema in schemas.items()}
