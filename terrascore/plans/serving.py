"""Year-pruned serving: the ranked index stored by year, one year's files read.

The dashboards and the top list look at one year at a time. The snapshot job
stores the index in ``process_date`` / ``year`` folders, so a year is a folder: the
latest one is known from the folders' names (no scan for ``max(year)``), and the
filter on it leaves one folder to read at any number of years.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .. import registry as R
from ..operators import views
from ..schemas import OPPORTUNITY_INDEX
from ..sinks.writers import write_snapshot
from ..sources import files

#: The stored index: its own columns, then the folders'.
STORED_INDEX = StructType([*OPPORTUNITY_INDEX.fields, StructField("process_date", DateType())])
INDEX_PARTITIONS = ("process_date", "year")


def store_index(ranked: DataFrame, path: str, process_date: dt.date) -> None:
    write_snapshot(ranked.withColumn("process_date", F.lit(process_date).cast("date")), path, INDEX_PARTITIONS)


def stored_index(spark: SparkSession, path: str, process_date: dt.date | str, on_or_before: bool = False) -> DataFrame:
    """The index of a date that was stored, columns as published. Only that date's
    folder is listed."""
    day = files.resolve_date(spark, path, STORED_INDEX, process_date, on_or_before)
    return (spark.read.schema(STORED_INDEX).option("basePath", path)
            .parquet(f"{path.rstrip('/')}/process_date={day}").select(*R.INDEX_OUTPUT_COLUMNS))


def latest_year(index: DataFrame) -> int | None:
    """The last year of a stored index, from the names of its folders."""
    years = [int(y) for y in files.partition_values(index, "year") if y.lstrip("-").isdigit()]
    return max(years, default=None)


def top_countries(index: DataFrame, countries: DataFrame, k: int = R.TOP_K) -> DataFrame:
    """The top list of the latest year: one year's folder, ranks pushed down."""
    best = index.where((F.col("year") == F.lit(latest_year(index)).cast("int")) & (F.col("opportunity_rank") <= k))
    return (best.join(countries.select("country_code", "country_name"), "country_code")
            .select(*views.TOP_COLUMNS).orderBy("opportunity_rank"))


def index_map(index: DataFrame, countries: DataFrame, year: int) -> DataFrame:
    """Index by country of one year, from that year's folder."""
    return views.dash_index_map(index, countries, year)
