"""Opportunity index: scores -> weighted index -> rank within year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import SCORES, with_scores
from ..registry import INDEX_OUTPUT_COLUMNS, KEYS
from ..session import stage_table
from .facts import index_input
from .rank import rank_desc, rank_window


def scored(wide: DataFrame) -> DataFrame:
    """Index input rows with the six sub-scores and the composite index."""
    return with_scores(index_input(wide))


def score_table(wide: DataFrame, score: str, inputs: tuple[str, ...]) -> DataFrame:
    """Keys, the inputs of one score, and the score as double."""
    return index_input(wide).select(*KEYS, *inputs, SCORES[score]().cast("double").alias(score))


def index_columns(wide: DataFrame) -> DataFrame:
    """The output columns without the rank."""
    return scored(wide).select(*[c for c in INDEX_OUTPUT_COLUMNS if c != "opportunity_rank"])


def opportunity_index(wide: DataFrame, rank_method: str = "distributed", stage: bool = True) -> DataFrame:
    """The 14-column ranked index table.

    With ``stage`` the scored rows are written once to the shared folder
    before ranking: the rank reads them twice (values, rows) and a lost
    executor re-reads the file instead of recomputing the facts.
    """
    s = index_columns(wide)
    if stage:
        s = stage_table(s, "scored_index")
    return rank_desc(s, "year", "opportunity_index", "opportunity_rank", rank_method).select(*INDEX_OUTPUT_COLUMNS)


def from_facts(employment: DataFrame, economic: DataFrame, education: DataFrame,
               rank_method: str = "distributed", stage: bool = True) -> DataFrame:
    """The ranked index from three stored fact tables: employment with
    economic (inner), education where there is any (left)."""
    wide = employment.join(economic, list(KEYS)).join(education, list(KEYS), "left")
    s = with_scores(wide).select(*[c for c in INDEX_OUTPUT_COLUMNS if c != "opportunity_rank"])
    if stage:
        s = stage_table(s, "scored_index")
    return rank_desc(s, "year", "opportunity_index", "opportunity_rank", rank_method).select(*INDEX_OUTPUT_COLUMNS)


def ranked_latest_year(wide: DataFrame, k: int) -> DataFrame:
    """Ranked rows of the latest year with rank <= k (ties kept), for a top
    list alone: only that year is scored, and Spark keeps the k best of every
    task before the rank (a window group limit)."""
    s = index_columns(wide)
    latest = s.select(F.max("year")).scalar()
    ranked = rank_window(s.where(F.col("year") == latest), "year", "opportunity_index", "opportunity_rank")
    return ranked.where(F.col("opportunity_rank") <= k).select(*INDEX_OUTPUT_COLUMNS)


def latest_year_top(index: DataFrame, k: int) -> DataFrame:
    """Rows of the latest year with rank <= k (ties kept, so possibly > k)."""
    latest = index.select(F.max("year")).scalar()
    return index.where((F.col("year") == latest) & (F.col("opportunity_rank") <= k))
