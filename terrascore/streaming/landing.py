"""Incremental landing: newly landed raw files -> clean snapshot, exactly once.

A daily snapshot lands as files; a file-source stream with an
``availableNow`` trigger processes whatever has landed since the last run and
stops — batch cost, streaming bookkeeping. The clean stage is stateless
(casts + filters), so append mode suffices; the Parquet file sink commits
through its metadata log, and the checkpoint in the shared folder lets a
restarted job (or a lost executor) resume without duplicating or skipping a
file.

``start_quarantine`` keeps malformed records too: each micro-batch is parsed once
and goes to two Parquet sinks, the clean observations and the records that could
not be read, both below a folder of the batch's number. A batch that is run again
after a failure replaces its own folders in both, so neither sink ever holds a
batch twice, though two writes are not one commit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import DEFAULT_PROCESS_DATE, clean_observations
from ..schemas import CLEAN, MALFORMED, RAW
from ..sources.files import CSV_SINK_OPTIONS, good_records, malformed_records, parsed_options, parsed_schema


def start_landing(spark: SparkSession, landing_dir: str, output_dir: str, checkpoint_dir: str,
                  fmt: str = "json", process_date: dt.date = DEFAULT_PROCESS_DATE,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(RAW).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_SINK_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    clean = clean_observations(reader.load(landing_dir), process_date)
    return (clean.writeStream.format("parquet")
            .option("path", output_dir)
            .option("checkpointLocation", checkpoint_dir)
            .partitionBy("process_date", "indicator_name")
            .outputMode("append")
            .trigger(availableNow=True)
            .start())


def _sink(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def start_quarantine(spark: SparkSession, landing_dir: str, output_dir: str, malformed_dir: str, checkpoint_dir: str,
                     fmt: str = "json", process_date: dt.date = DEFAULT_PROCESS_DATE,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Whatever has landed since the last run: clean observations to
    ``output_dir``, unreadable records with file and text to ``malformed_dir``."""
    reader = spark.readStream.schema(parsed_schema(fmt)).format(fmt).options(
        **parsed_options(fmt, options=CSV_SINK_OPTIONS))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.load(landing_dir).select("*", F.col("_metadata.file_path").alias("page_file"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # parsed once for both sinks; a lost block is parsed again from its file
        try:
            _sink(clean_observations(good_records(batch), process_date), output_dir, batch_id)
            _sink(malformed_records(batch), malformed_dir, batch_id)
        finally:
            batch.unpersist()

    return (landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def run_quarantine(spark: SparkSession, landing_dir: str, output_dir: str, malformed_dir: str, checkpoint_dir: str,
                   **kw) -> None:
    """``start_quarantine`` until everything landed so far is processed."""
    q = start_quarantine(spark, landing_dir, output_dir, malformed_dir, checkpoint_dir, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_quarantined(spark: SparkSession, output_dir: str, malformed_dir: str) -> tuple[DataFrame, DataFrame]:
    """(clean observations, malformed records) of all batches."""
    return (spark.read.schema(CLEAN).parquet(output_dir).select(*CLEAN.names),
            spark.read.schema(MALFORMED).parquet(malformed_dir).select(*MALFORMED.names))


def run_landing(spark: SparkSession, landing_dir: str, output_dir: str, checkpoint_dir: str,
                **kw) -> None:
    """Process everything landed so far and return when done."""
    q = start_landing(spark, landing_dir, output_dir, checkpoint_dir, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
