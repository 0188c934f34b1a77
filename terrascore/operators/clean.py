"""Clean stage: typed, filtered observations plus the rejected remainder.

One pass over all indicators at once (indicator is a column, not a file):
year and value are ``try_cast`` (ANSI-safe on bad text), rows without a value
or a country code are dropped, rows whose year is not an integer go to the
reject side instead of poisoning later arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_PROCESS_DATE = dt.date(2025, 1, 1)


def _typed(raw: DataFrame) -> DataFrame:
    return raw.withColumns({
        "year": F.col("year").try_cast("int"),
        "value": F.col("value").try_cast("double"),
    })


def reject_reason() -> Column:
    """First failed rule of a typed row, null when the row is clean."""
    code = F.col("country_code")
    return (F.when(F.col("value").isNull(), F.lit("null_value"))
            .when(code.isNull(), F.lit("null_code"))
            .when(code == "", F.lit("empty_code"))
            .when(F.col("year").isNull(), F.lit("bad_year")))


def clean_observations(raw: DataFrame, process_date: dt.date = DEFAULT_PROCESS_DATE,
                       year_range: tuple[int, int] | None = None,
                       exclude_codes: tuple[str, ...] = ()) -> DataFrame:
    """Observations with int year, non-null value and non-empty code.

    ``exclude_codes`` drops listed codes (e.g. aggregate regions reported
    next to countries); a short literal list, evaluated inside the scan's
    filter.
    """
    df = _typed(raw).where(
        F.col("value").isNotNull()
        & F.col("country_code").isNotNull() & (F.col("country_code") != "")
        & F.col("year").isNotNull())
    if year_range is not None:
        df = df.where(F.col("year").between(*year_range))
    if exclude_codes:
        df = df.where(~F.col("country_code").isin(*exclude_codes))
    return df.select(
        "country_code", "country_name", "indicator_id", "indicator_name", "year", "value",
        "extraction_date", F.lit(process_date).alias("process_date"))


def rejected_observations(raw: DataFrame) -> DataFrame:
    """The complement of the clean set, with the reason of rejection."""
    return _typed(raw).withColumn("reject_reason", reject_reason()).where(
        F.col("reject_reason").isNotNull())


def bad_years(raw: DataFrame) -> DataFrame:
    """Rows that pass the value and code rules but whose year text is not an
    integer (quarantined instead of reaching the facts), year text kept."""
    code = F.col("country_code")
    return raw.where(
        F.col("value").try_cast("double").isNotNull() & code.isNotNull() & (code != "")
        & F.col("year").try_cast("int").isNull())


def reject_summary(raw: DataFrame) -> DataFrame:
    """Rejected row counts by indicator and reason (map-side combined)."""
    return rejected_observations(raw).groupBy("indicator_name", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(clean: DataFrame) -> DataFrame:
    """(indicator, country, year) keys observed more than once.

    Partial aggregation bounds the shuffle per key: a key holding a third of
    all rows still crosses the network as one partial count per map task.
    """
    return (clean.groupBy("indicator_name", "country_code", "year")
            .agg(F.count(F.lit(1)).alias("n_obs"),
                 F.min("value").alias("min_value"),
                 F.max("value").alias("max_value"))
            .where(F.col("n_obs") > 1))
