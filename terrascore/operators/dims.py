"""Country and time dimensions, derived distributed (no driver round trip)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_SOURCE = "gdp"


def _source(clean: DataFrame, source_indicator: str | None) -> DataFrame:
    if source_indicator is None:
        return clean
    return clean.where(F.col("indicator_name") == source_indicator)


def country_dimension(clean: DataFrame, source_indicator: str | None = DEFAULT_SOURCE) -> DataFrame:
    """Distinct (code, name) pairs; region and income group are typed nulls.

    ``source_indicator=None`` takes countries from every indicator.
    """
    return (_source(clean, source_indicator)
            .select("country_code", "country_name").distinct()
            .withColumns({"region": F.lit(None).cast("string"),
                          "income_group": F.lit(None).cast("string")}))


def time_dimension(clean: DataFrame, source_indicator: str | None = DEFAULT_SOURCE) -> DataFrame:
    """Distinct years with label ``Y<year>``, decade and ``<year>-01-01``."""
    y = F.col("year")
    return (_source(clean, source_indicator).select("year").distinct()
            .select(y.cast("int").alias("year"),
                    F.concat(F.lit("Y"), y.cast("string")).alias("year_label"),
                    (y - F.pmod(y, F.lit(10))).cast("int").alias("decade"),
                    F.concat(y.cast("string"), F.lit("-01-01")).alias("year_start_date")))


def name_drift(clean: DataFrame, source_indicator: str | None = DEFAULT_SOURCE) -> DataFrame:
    """Codes reported under more than one name (each gives one dimension row
    per name, so view rows repeat). Distinct (code, name) pairs first, then a
    count per code: both steps combine map-side, so a code holding a third
    of all rows is no hot spot."""
    pairs = _source(clean, source_indicator).select("country_code", "country_name").distinct()
    return (pairs.groupBy("country_code")
            .agg(F.count(F.lit(1)).alias("n_names"),
                 F.min("country_name").alias("first_name"),
                 F.max("country_name").alias("last_name"))
            .where(F.col("n_names") > 1))
