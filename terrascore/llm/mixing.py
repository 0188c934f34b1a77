"""Mixing sources to target weights by capped water-filling (op 9).

Each source gets a share of all words by its weight. A source may be repeated
at most ``max_epochs`` times, so its target is clamped there and the excess is
shared again by weight until no source is above. The fixed point has a closed
form: with sources ordered by ``cap / weight``, the water level is the largest
of ``(total - caps before) / weights from here on``, and a source's target is
``min(cap, weight * level)``.

A source's target is met by whole repetitions of every document plus one
fractional repetition: documents in the order of a seeded hash until the
remaining words are used up, the last one in part. The cut in that order is
found through sums per (source, hash prefix), so no task ever sorts a whole
source, and the decision for a row is a comparison of its hash with its
source's cut: the texts themselves are never shuffled.

Defined results: null text has size 0; a null source is a source of its own
and sorts last; sources without words get target 0; rows that share an id (and
so a hash) share what is left for them in proportion to their sizes, rounded
down; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrascore.llm.common import stage_table, word_count
from terrascore.session import stage_table_counted

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20260
#: Up to so many sources, their cuts are broadcast; beyond, joined by shuffle.
BROADCAST_SOURCES = 100_000
#: Hex digits of the hash that name a bucket: a source has 16**3 of them.
PREFIX = 3


def _order_key(id_col: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(src, size)`` -> one row per source: ``src, source_size, target``.
    The windows run over one row per source, not over documents."""
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight)
    cap = F.col("source_size").cast("double") * F.lit(float(max_epochs))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("src").asc_nulls_last())
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every).cast("double")
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("cap", cap).withColumn("level", level)
    per = per.withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(every)))
    return per.select("src", "source_size", "target")


def _cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repetitions, and where its fractional one ends:
    rows with a hash below ``cut`` are taken once more, rows at it in the
    proportion ``cut_left / cut_size``."""
    words = F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = (targets.withColumn("whole", whole)
            .withColumn("left", words - F.col("whole") * F.col("source_size")))
    bucket = F.substring("h", 1, PREFIX)
    running = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sizes.groupBy("src", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
            .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0))))
    p, s = plan.alias("p"), sums.alias("s")
    edge = (s.join(p, F.col("s.src").eqNullSafe(F.col("p.src")))
            .where("before < left and left <= before + words")
            .select("s.src", "bucket", (F.col("left") - F.col("before")).alias("rest")))
    # Only the rows of each source's edge bucket are ordered one by one.
    e, z = edge.alias("e"), sizes.withColumn("bucket", bucket).alias("z")
    ties = (z.join(e, F.col("z.src").eqNullSafe(F.col("e.src")) & (F.col("z.bucket") == F.col("e.bucket")))
            .groupBy("z.src", "h").agg(F.sum("size").alias("cut_size"), F.first("rest").alias("rest")))
    in_bucket = Window.partitionBy("src").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    cut = (ties.withColumn("cut_left", F.col("rest") - F.coalesce(F.sum("cut_size").over(in_bucket), F.lit(0)))
           .where("cut_left > 0 and cut_left <= cut_size")
           .select("src", F.col("h").alias("cut"), "cut_size", "cut_left"))
    c = cut.alias("c")
    cuts = (p.join(c, F.col("p.src").eqNullSafe(F.col("c.src")), "left")
            .select("p.src", "source_size", "target", "whole", "cut", "cut_size", "cut_left"))
    cuts, sources = stage_table_counted(cuts, "mix-cuts")
    return F.broadcast(cuts) if sources <= BROADCAST_SOURCES else cuts


def _taken() -> Column:
    part = (F.when(F.col("h") < F.col("cut"), F.col("size"))
            .when(F.col("h") == F.col("cut"),
                  F.floor(F.col("size") * F.col("cut_left") / F.col("cut_size")).cast("long"))
            .otherwise(0))
    return F.col("size") * F.col("whole") + F.coalesce(part, F.lit(0)).cast("long")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    return [F.col(source_col).cast("string").alias("src"), word_count(F.col(text_col)).alias("size"),
            _order_key(F.col(id_col), seed).alias("h")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per input row: its id, ``source``, ``size``, ``source_size``,
    ``target`` and ``taken`` (words the mix takes of it, repeats counted)."""
    sizes = stage_table(docs.select(F.col(id_col).alias("id"), *_sized(docs, id_col, text_col, source_col, seed)),
                        "mix-sizes")
    cuts = _cuts(sizes, source_targets(sizes, weights, max_epochs)).alias("c")
    return (sizes.alias("z").join(cuts, F.col("z.src").eqNullSafe(F.col("c.src")), "left")
            .select(F.col("id").alias(id_col), F.col("z.src").alias("source"), "size", "source_size",
                    "target", _taken().alias("taken")))


def materialise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: the input columns, one row per repetition (``copy_no``
    from 0) with ``copy_words``, the words of the text that this repetition
    counts (all of them, but for a source's one fractional document).
    Documents of which nothing is taken do not appear."""
    sizes = stage_table(docs.select(*_sized(docs, id_col, text_col, source_col, seed)), "mix-sizes")
    cuts = _cuts(sizes, source_targets(sizes, weights, max_epochs)).select(
        F.struct("*").alias("__mix_cut"), F.col("src").alias("__mix_src"))
    rows = docs.withColumn("__mix_doc", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    rows = rows.select("__mix_doc", F.struct(*_sized(docs, id_col, text_col, source_col, seed)).alias("__mix_row"))
    joined = rows.join(cuts, F.col("__mix_row.src").eqNullSafe(F.col("__mix_src")))
    flat = joined.select("__mix_doc", "__mix_row.*", *[F.col(f"__mix_cut.{c}") for c in
                         ("whole", "cut", "cut_size", "cut_left")])
    flat = flat.select("__mix_doc", "size", _taken().alias("taken")).where("taken > 0")
    copies = F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int"))
    out = flat.select("__mix_doc", "size", "taken", F.explode(copies).alias("copy_no"))
    return out.select("__mix_doc.*", "copy_no",
                      F.least("size", F.col("taken") - F.col("copy_no") * F.col("size")).alias("copy_words"))
