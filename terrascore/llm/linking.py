"""Verified links and connected components at scale, shared by the two
near-duplicate operators.

A posting list (all nodes under one token) is never expanded into all pairs:

1. In lists of at most ``SMALL`` nodes all pairs are tried, a fixed number for
   each node. In longer lists every node is paired with one pivot, the member
   that shares most with others in the most of its lists. Verified links merge
   nodes into components.
2. What is left are the longer lists that still span several components. Each
   gets another pivot, the node with fewest items that no other node has (the
   nearest to a common origin).
3. Then the longer lists' pairs across components are tried, within exact bounds. Items that only
   one node has are in no intersection: a node that has too many of them leaves
   its lists. Every node has a bitmap of its other items, hashed; a bit that
   one has and the other has not stands for one more that is not shared. Near
   copies that each differ in their own way, which share most tokens but are
   not linked, fall to these bounds before a pair is made.

So a group of mutually similar nodes costs pairs in proportion to its size, and
still every candidate pair is verified, made needless by a path of verified
links, or excluded by an exact bound: no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascore.llm.common import ship_code, stage_table
from terrascore.session import stage_table_counted

#: Lists of so many nodes at most need no bounds.
SMALL = 8
#: 64-bit words of a node's bitmap, a power of two.
WORDS = 16
#: Edges that a task joins into one forest at a time.
EDGES = 2_000_000


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes of the edges whose least connected node is
    another one: union-find over arrays, hooking roots and halving paths."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        lo, hi = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (lo == hi).all():
            break
        np.minimum.at(root, hi, lo)
        while not (root[root] == root).all():
            root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: edges (u, v) to the forest of those of a task, EDGES at
    a time, which connects the same nodes with fewer edges."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1))
        node, root = forest(u, v)
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= EDGES:
            yield joined()
            held, size = [], 0
    if size:
        yield joined()


def components(links: DataFrame, per_task: int = EDGES) -> DataFrame:
    """(node, comp): the smallest node of each node's component, for the nodes
    of ``links(a, b)``. A distributed union-find: every task replaces its edges
    by their forest; the edges left are dealt to as many tasks as ``per_task``
    edges each need, which join them again. Where these are several tasks, and a
    node then still has several roots, or a root hangs elsewhere, alternating
    large-star and small-star steps move edges towards the least nodes, and
    forests are made again, until all tasks agree. Each star step is a grouped
    minimum and a join back, both of which Spark can split for a node with very
    many links; every round is cut by a staged table."""
    spark = links.sparkSession
    ship_code(spark)
    edges = "u long, v long"
    e = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    e, n = stage_table_counted(e.mapInArrow(_forests, edges), "links")
    while n:
        tasks = -(-n // per_task)
        e = stage_table(e.repartition(tasks).mapInArrow(_forests, edges).distinct(), "links")
        if tasks == 1:  # one forest of all edges
            break
        # a node with two roots, or a root that is no root elsewhere: not done
        seen = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("child")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("child")))).alias("x"))
        open_nodes = (seen.groupBy("x.node").agg(F.sum("x.child").alias("roots"), F.min("x.child").alias("least"))
                      .where("roots > 1 or (roots = 1 and least = 0)"))
        if open_nodes.isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e, n = stage_table_counted(small.select("x.u", "x.v").where("u > v").mapInArrow(_forests, edges).distinct(), "links")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()))


def _with_components(postings: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return postings.withColumn("comp", F.col("node"))
    return postings.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _open_lists(postings: DataFrame, rank: list[str]) -> DataFrame:
    """The lists that span several components, with their pivot: the member
    first by ``rank``, descending."""
    return (postings.groupBy("token")
            .agg(F.max(F.struct(*rank, "node", "comp")).alias("top"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                 F.count("*").alias("size"))
            .where("lo < hi").select("token", F.col("top.node").alias("pivot"), F.col("top.comp").alias("pivot_comp"), "size"))


def _bounds(nodes: DataFrame, items: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, n, shared, w0, w1, ...): the node's items, those of them that
    others have too, and its bitmap."""
    had = stage_table(items(nodes), "items")
    common = had.groupBy("item").agg(F.count("*").alias("k")).where("k > 1").select("item")
    sizes = had.groupBy("node").agg(F.count("*").alias("n"))
    bit = F.xxhash64("item").bitwiseAND(F.lit(64 * WORDS - 1))
    words = [F.expr(f"bit_or(CASE WHEN word = {k} THEN mask ELSE 0L END)").alias(f"w{k}") for k in range(WORDS)]
    maps = (had.join(common, "item", "left_semi").select("node", bit.alias("bit"))
            .select("node", F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, CAST(bit & 63 AS INT))").alias("mask"))
            .groupBy("node").agg(F.count("*").alias("shared"), *words))
    return sizes.join(maps, "node", "left").na.fill(0)


def link(postings: DataFrame, verify: Callable[[DataFrame], DataFrame], items: Callable[[DataFrame], DataFrame],
         percent: int) -> DataFrame:
    """Components (node, comp) of the links that ``verify`` confirms among the
    nodes that share a token. ``postings(token, node, score)``. ``verify`` maps
    pairs (a, b) to those whose similarity is at least ``percent``;
    ``items(nodes)`` gives (node, item), every item of a node's set once.
    Nodes without a link are left out."""
    spark = postings.sparkSession
    empty = spark.createDataFrame([], "a long, b long")
    links, tested, labels, bounds = empty, empty, None, None
    ordered = [F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")]
    lacks = lambda x, y: " + ".join(f"bit_count({x}_w{k} & ~{y}_w{k})" for k in range(WORDS))
    enough = f">= {percent} * (a_n + b_n)"
    close = F.expr(f"{100 + percent} * least(a_shared, b_shared) {enough} AND {100 + percent} * (a_shared - ({lacks('a', 'b')})) {enough} "
                   f"AND {100 + percent} * (b_shared - ({lacks('b', 'a')})) {enough}")
    for step in ("first", "own least", "pairs"):
        cur = _with_components(postings, labels)
        if bounds is not None:
            cur = cur.join(bounds, "node")
        cur = stage_table(cur, "postings")
        lists = _open_lists(cur, ["score"] if bounds is None else ["few_own", "score"])
        lists, n_lists = stage_table_counted(lists, "lists")
        if not n_lists:
            break
        if step == "first":
            few = cur.join(lists.where(F.col("size") <= SMALL).select("token"), "token", "left_semi")
            x, y = (few.select("token", F.col("node").alias(n)) for n in ("a", "b"))
            pairs = x.join(y, "token").where("a > b").select("a", "b")
            met = (cur.join(lists.where(F.col("size") > SMALL), "token").where("comp != pivot_comp")
                   .groupBy("node", "pivot").agg(F.count("*").alias("k")))
            pairs = pairs.unionByName(met.groupBy("node").agg(F.max(F.struct("k", "pivot")).alias("best"))
                                      .select("node", "best.pivot").select(*ordered))
        elif step == "own least":
            pairs = cur.join(lists, "token").where("comp != pivot_comp").select(*ordered)
        else:
            pairs = _pairs(cur, lists, close, percent)
        pairs, n_pairs = stage_table_counted(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        if n_pairs:
            good, found = stage_table_counted(verify(pairs).select("a", "b"), "links")
            tested = tested.unionByName(pairs)
            if found:
                links = links.unionByName(good)
                labels = stage_table(components(links), "components")
                links = labels.select(F.col("node").alias("a"), F.col("comp").alias("b"))  # connects what all links did
        if step == "first":  # from here on the longer lists
            longer = (_open_lists(_with_components(postings, labels), ["score"]).where(F.col("size") > SMALL).select("token"))
            postings, n_left = stage_table_counted(postings.join(longer, "token", "left_semi"), "postings")
            if not n_left:
                break
            bounds = _bounds(postings.select("node").distinct(), items)
            bounds = bounds.join(postings.groupBy("node").agg(F.sort_array(F.collect_set("token")).alias("tokens")), "node")
            bounds = stage_table(bounds.withColumn("few_own", F.col("shared") - F.col("n")), "bounds")
    return labels if labels is not None else spark.createDataFrame([], "node long, comp long")


def _pairs(cur: DataFrame, lists: DataFrame, close: Column, percent: int) -> DataFrame:
    """Pairs across components within the bound. A node leaves a list in which
    even a partner of the least size that had all its shareable items would
    not be similar enough; lists that fall to one component are dropped."""
    least = cur.groupBy("token").agg(F.min("n").alias("least_n"))
    able = (cur.join(lists.select("token"), "token", "left_semi").join(least, "token")
            .where(F.expr(f"{100 + percent} * shared >= {percent} * (n + least_n)")))
    able = stage_table(able, "able")
    still = able.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    able = able.join(still, "token", "left_semi")
    of = ["node", "comp", "n", "shared", "tokens", *(f"w{k}" for k in range(WORDS))]
    x, y = (able.select(F.col("token").alias(f"{s}_token"), *[F.col(c).alias(f"{s}_{c}") for c in of]) for s in ("a", "b"))
    across = (F.col("a_token") == F.col("b_token")) & (F.col("a_node") > F.col("b_node")) & (F.col("a_comp") != F.col("b_comp"))
    # a pair that meets in several lists is made in the first of them only
    once = F.array_min(F.array_intersect("a_tokens", "b_tokens")) == F.col("a_token")
    return x.join(y, across & close & once).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
