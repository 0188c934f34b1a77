"""Fact tables: long observations -> wide (country, year) rows.

The source domain builds each fact as a chain of full outer joins, one per
indicator (for 8 inputs: 14 exchanges, 7 sort-merge joins). Here a fact is a
single conditional aggregation — one hash exchange, partial aggregation
map-side — and all three facts can come out of one shared aggregation.

Semantics: one row per (country_code, year) present in any of the fact's
indicators; a missing indicator is a null column (all declared columns are
always present); duplicate observations of a key collapse to their ``max``
(the join chain would multiply rows; ``duplicate_keys`` reports them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import FACT_COLUMNS, FACTS, INDICATOR_NAMES, KEYS


def _pivot_cols(names):
    return [F.max(F.when(F.col("indicator_name") == n, F.col("value"))).alias(n) for n in names]


def presence_col(fact: str) -> str:
    return f"_n_{fact}"


def build_fact(clean: DataFrame, fact: str) -> DataFrame:
    """One fact table by conditional aggregation (one shuffle).

    The indicator filter prunes partitions when ``clean`` is stored
    partitioned by ``indicator_name``.
    """
    names = FACT_COLUMNS[fact]
    return (clean.where(F.col("indicator_name").isin(*names))
            .groupBy(*KEYS).agg(*_pivot_cols(names)))


def build_wide(clean: DataFrame) -> DataFrame:
    """All 13 indicator columns plus a presence count per fact, one shuffle.

    A key belongs to fact X exactly when ``_n_X > 0``.
    """
    presence = [F.count(F.when(F.col("indicator_name").isin(*FACT_COLUMNS[f]), F.lit(1)))
                .alias(presence_col(f)) for f in FACTS]
    return (clean.where(F.col("indicator_name").isin(*INDICATOR_NAMES))
            .groupBy(*KEYS).agg(*_pivot_cols(INDICATOR_NAMES), *presence))


def fact_from_wide(wide: DataFrame, fact: str) -> DataFrame:
    return wide.where(F.col(presence_col(fact)) > 0).select(*KEYS, *FACT_COLUMNS[fact])


def index_input(wide: DataFrame) -> DataFrame:
    """employment INNER economic LEFT education, as a filter on the wide rows.

    Education columns of a key without education rows are null in ``wide``,
    which is exactly what the left join yields.
    """
    return wide.where((F.col(presence_col("employment")) > 0)
                      & (F.col(presence_col("economic")) > 0))


def outer_join_chain(clean: DataFrame, names) -> DataFrame:
    """The chained FULL OUTER JOIN form (kept as an operator, for plan and
    timing comparisons).

    Each input is first collapsed to one row per key (``max``, as in the
    pivot), so the chain can never multiply duplicate keys into all their
    pairs; its result then equals ``build_fact`` on any input. The collapse
    hash-partitions each side on the keys, which is the partitioning the
    join needs, so it adds no exchange.
    """
    out = None
    for n in names:
        part = (clean.where(F.col("indicator_name") == n)
                .groupBy(*KEYS).agg(F.max("value").alias(n)))
        out = part if out is None else out.join(part, list(KEYS), "full_outer")
    return out
