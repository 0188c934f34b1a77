"""Merkle dataset manifest (op 11).

Each row is a leaf; per source, and then over the sources' own roots, every
``RUN`` consecutive nodes become one until one is left. The manifest proves each
row against the one root, and shows which rows of a changed copy no longer do.

1. Leaves are hashed by built-in functions. Rows are dealt by ranges of (source,
   document id, leaf), so a source of any size spreads over many tasks; a row's
   place is its place in its range plus the rows of its source in earlier ranges.
2. ``BLOCK`` = ``RUN`` ** ``LEVELS`` consecutive nodes of a source are a superblock.
   One grouped pass turns each superblock into one node of the next tier, until
   every source has one node, its subroot. The subroots are a tree of their own,
   reduced alike.
3. Back down, tier by tier: the nodes of a superblock are cogrouped with the one
   row that holds the siblings outside of it (``lefts`` and ``rights``, one entry
   per level). The same task that rebuilds the local levels joins both parts of
   every proof, and at the leaves folds the proof up to the root.

No task ever holds more than one superblock and the path above it.

Defined results: a null field is ``-``, any other its UTF-8 length, a colon and
its value, so empty differs from null; a null source is a tree of its own that
comes first; a null id comes first in its source and is never tampered with;
rows equal in source and id are ordered by leaf, and fully equal rows are
leaves each; very long texts are hashed where they lie and never shuffled; other
columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrascore.llm.common import LOWER, UPPER, row_key, ship_code, stage_table

#: Nodes that become one, and the fields of a leaf in order.
RUN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels inside one superblock: 4,096 leaves and 4,369 hashes for one task.
LEVELS = 3
BLOCK = RUN ** LEVELS
TAMPERED_MOD = 5

NODES = "tree string, pos long, total long, digest string, name string"
OUTER = "tree string, block long, lefts array<string>, rights array<string>, subroot string, root string"


@dataclass
class Manifest:
    """``leaves``: a row per document with its place; ``tiers``: the nodes from
    the leaves up; ``subroots``: a row per source; ``root``: one row."""

    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    source_tiers: list[DataFrame]
    root: DataFrame


def leaf_digest(**replaced: Column) -> Column:
    """The leaf of a row, with some fields replaced."""
    def coded(name: str) -> Column:
        value = replaced.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[coded(f) for f in FIELDS]), 256)


def lower_cased(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0) within their ``tree``, in the order of the
    given columns, and ``total``, the tree's rows. Sorted by ranges and staged; a
    tree's counts per range give the offsets."""
    keys = ["tree", *order, "_tie"]
    ranges = rows.withColumn("_tie", row_key()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    ranges = stage_table(ranges.withColumn("_part", F.spark_partition_id()).withColumn("_at", row_key()), name)
    tree = Window.partitionBy("tree")
    parts = ranges.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("tree", "_part", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_n").over(tree).alias("total"))
    return (ranges.join(parts, ["tree", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift"))
            .drop("_part", "_at", "_shift"))


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def local_levels(digests: list[str], total: int) -> list[list[str]]:
    """A superblock's levels, its own nodes first: up to its tree's root where it
    is the tree's only one, else exactly ``LEVELS`` more."""
    levels = [digests]
    while len(levels[-1]) > 1 if total <= BLOCK else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest_of("".join(below[i:i + RUN])) for i in range(0, len(below), RUN)])
    return levels


def siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """What stands left and right of node ``i`` in its run, at each local level."""
    lefts, rights = [], []
    for level in levels[:-1]:
        start = i - i % RUN
        lefts.append("".join(level[start:i]))
        rights.append("".join(level[i + 1:start + RUN]))
        i //= RUN
    return lefts, rights


def fold(digest: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a node and the siblings on its path make."""
    for left, right in zip(lefts, rights):
        digest = digest_of(left + digest + right)
    return digest


def _reduced(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("pos")
    first, total = nodes.iloc[0], int(nodes["total"].iloc[0])
    top = local_levels(nodes["digest"].tolist(), total)[-1][0]
    return pd.DataFrame({"tree": [first["tree"]], "pos": [int(first["pos"]) // BLOCK], "total": [-(-total // BLOCK)],
                         "digest": [top], "name": [None]})


def _block() -> Column:
    return F.expr(f"pos div {BLOCK}")


def raise_tiers(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(tiers, tops): the nodes of each tier from ``nodes`` up, and the root of
    each tree with the ``tier`` whose only superblock made it. Tiers follow from
    the largest tree's size, one number."""
    biggest = nodes.agg(F.max("total")).first()[0] or 0
    tiers, tops = [nodes], []
    while True:
        raised = stage_table(tiers[-1].groupBy("tree", _block().alias("block")).applyInPandas(_reduced, NODES),
                             f"{name}_tier")
        tops.append(raised.where("total = 1").select("tree", "digest", F.lit(len(tiers) - 1).alias("tier")))
        if biggest <= BLOCK:
            return tiers, reduce(DataFrame.unionByName, tops)
        biggest = -(-biggest // BLOCK)
        tiers.append(raised.where("total > 1"))


def _handed_down(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Every node's own siblings before those of its superblock."""
    nodes, above = nodes.sort_values("pos"), outer.iloc[0]
    levels = local_levels(nodes["digest"].tolist(), int(nodes["total"].iloc[0]))
    paths = [siblings(levels, i) for i in range(len(nodes))]
    return pd.DataFrame({
        "tree": nodes["tree"].tolist(), "block": nodes["pos"].tolist(),
        "lefts": [[*left, *above["lefts"]] for left, _ in paths],
        "rights": [[*right, *above["rights"]] for _, right in paths],
        "subroot": above["subroot"], "root": above["root"], "name": nodes["name"].tolist()})


def _finished(leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proof and fold of every leaf of a superblock."""
    leaves, above = leaves.sort_values("pos"), outer.iloc[0]
    levels = local_levels(leaves["digest"].tolist(), int(leaves["total"].iloc[0]))
    proofs, folded = [], []
    for i, claimed in enumerate(leaves["claimed"].tolist()):
        left, right = siblings(levels, i)
        left, right = [*left, *above["lefts"]], [*right, *above["rights"]]
        proofs.append(digest_of("".join(a + b for a, b in zip(left, right))))
        folded.append(fold(claimed, left, right))
    return pd.DataFrame({"doc_id": leaves["doc_id"].tolist(), "leaf": levels[0], "subroot": above["subroot"],
                         "root": above["root"], "proof_sha256": proofs, "folded_root": folded})


def by_block(outer: DataFrame):
    """``outer`` by superblock; its columns are new ones, as both sides of a
    cogroup may come from the same staged table."""
    return outer.select(*[F.col(c).alias(c) for c in outer.columns]).groupBy("tree", "block")


def hand_down(tier: DataFrame, outer: DataFrame) -> DataFrame:
    return (tier.groupBy("tree", _block().alias("block")).cogroup(by_block(outer))
            .applyInPandas(_handed_down, f"{OUTER}, name string"))


def manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The trees over ``docs``. ``claimed``: the leaf that a row's holder brings
    to be proved; the true one where not given."""
    ship_code(docs.sparkSession)
    tree = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))  # null sources come first
    leaf = leaf_digest()
    rows = stage_table(docs.select(tree.alias("tree"), "doc_id", leaf.alias("digest"),
                                   (leaf if claimed is None else claimed).alias("claimed")), "merkle_leaves")
    leaves = stage_table(placed(rows, ["doc_id", "digest"], "merkle_order"), "merkle_places")
    nodes = leaves.select("tree", "pos", "total", "digest", F.lit(None).cast("string").alias("name"))
    tiers, subroots = raise_tiers(nodes, "merkle")
    members = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    sources = placed(members, ["name"], "merkle_sources").select("tree", "pos", "total", "digest", "name")
    source_tiers, root = raise_tiers(sources, "merkle_root")
    return Manifest(leaves, tiers, subroots, source_tiers, root.select("digest"))


def prove(m: Manifest) -> DataFrame:
    """A row per document: its leaf, its source's root, the dataset's root, the
    hash of its proof, the root that its claimed leaf folds to, and whether that
    is the dataset's."""
    nothing = F.array().cast("array<string>")
    outer = m.root.select(F.lit("").alias("tree"), F.lit(0).cast("long").alias("block"), nothing.alias("lefts"),
                          nothing.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    for tier in reversed(m.source_tiers):
        outer = hand_down(tier, outer)
    paths = stage_table(outer.select(F.col("name").alias("tree"), "lefts", "rights", "root"), "merkle_paths")
    ended = m.subroots.join(paths, "tree").select("tree", F.lit(0).cast("long").alias("block"), "lefts", "rights",
                                                  F.col("digest").alias("subroot"), "root", "tier")
    outer = None
    for t in reversed(range(len(m.tiers))):
        here = ended.where(F.col("tier") == t).drop("tier")
        outer = here if outer is None else here.unionByName(hand_down(m.tiers[t + 1], outer).drop("name"))
    # Ids travel as text: a column of numbers with nulls would reach pandas as floats.
    leaves = m.leaves.select("tree", "pos", "total", "digest", "claimed", _block().alias("block"),
                             F.col("doc_id").cast("string").alias("doc_id"))
    proved = leaves.groupBy("tree", "block").cogroup(by_block(outer)).applyInPandas(
        _finished, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return (proved.withColumn("doc_id", F.col("doc_id").cast(m.leaves.schema["doc_id"].dataType))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def tampered() -> Column:
    """The leaf of a copy whose texts are lower-cased in every fifth document."""
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_MOD == 0
    return F.when(hit, leaf_digest(text=lower_cased(F.col("text")))).otherwise(leaf_digest())
