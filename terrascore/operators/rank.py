"""Rank within a group by a value, descending, ties sharing a rank (SQL RANK).

``distributed`` (the default) is exact for groups of any size and at any row
count, with no group ever in one task:

1. collapse ties: ``(g, v) -> n`` (partial aggregation; a value held by a
   third of all rows becomes one row per map task);
2. range-partition the distinct values by ``(g, v desc)`` and stage them with
   the number of their range: ranges are found by Spark's sampling, equal
   values share one, and ranges are in rank order;
3. rows of ``g`` in earlier ranges (``offset``): a running sum over one row per
   (group, range);
4. inside (g, range): rows with a larger value, a running sum over one range;
5. ``rank = 1 + offset + before``, joined back on (g, v). All joins are
   null-safe: a null group is a group, and null values rank last in theirs.

``window`` is ``rank() OVER (PARTITION BY g ORDER BY v DESC)``: one exchange on
``g`` and one task per group, for callers that know their groups to be small.
Both give the same rows on any input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table


def rank_window(df: DataFrame, by: str, order: str, out: str) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.col(order).desc_nulls_last())
    return df.withColumn(out, F.rank().over(w))


def rank_distributed(df: DataFrame, by: str, order: str, out: str, ranges: int | None = None) -> DataFrame:
    """``ranges``: number of value ranges; by default Spark's shuffle partitions."""
    ties = df.groupBy(F.col(by).alias("g"), F.col(order).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    keys = (F.col("g").asc_nulls_first(), F.col("v").desc_nulls_last())
    ties = ties.repartitionByRange(ranges, *keys) if ranges else ties.repartitionByRange(*keys)
    ties = stage_table(ties.withColumn("part", F.spark_partition_id()), "rank_values")
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ties.groupBy("g", "part").agg(F.sum("n").alias("rows"))
               .withColumn("offset", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
               .select(F.col("g").alias("off_g"), F.col("part").alias("off_part"), "offset"))
    inside = Window.partitionBy("g", "part").orderBy(F.col("v").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    ranks = (ties.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
             .join(offsets, F.col("g").eqNullSafe(F.col("off_g")) & (F.col("part") == F.col("off_part")))
             .select(F.struct("g", "v").alias("_rank_key"),
                     (F.col("offset") + F.col("before") + 1).cast("int").alias("_rank")))
    rows = df.select(F.struct("*").alias("_rank_row"))
    same = (F.col(f"_rank_row.`{by}`").eqNullSafe(F.col("_rank_key.g"))
            & F.col(f"_rank_row.`{order}`").eqNullSafe(F.col("_rank_key.v")))
    return rows.join(ranks, same).select("_rank_row.*", F.col("_rank").alias(out))


def rank_desc(df: DataFrame, by: str, order: str, out: str, method: str = "distributed") -> DataFrame:
    if method == "window":
        return rank_window(df, by, order, out)
    if method == "distributed":
        return rank_distributed(df, by, order, out)
    raise ValueError(f"unknown rank method {method!r}")
