"""MinHash near-duplicates by a signature-coordinate inverted join (op 3).

Each distinct set of word shingles (exact copies are one class) gets a MinHash
signature of ``coords`` values and is posted under every (coordinate, value).
Two sets that reach the similarity agree on at least ``matches`` coordinates
(five standard deviations below the mean: a miss is a matter of 1e-6), so the
join is an overlap join of signatures:

* Prefix: with the coordinates of all signatures in one order, rarest posting
  first, two signatures with ``matches`` agreements must share one of the first
  ``coords - matches + 1``. Values that occur once cannot collide, so what is
  left of the prefix is found after they are dropped; a class with fewer than
  ``matches`` shared values has no partner at all.
* Skip: the long posting lists, which come last in the order, are never merged.
  A pair found through a short list has its collisions counted by comparing
  the two signatures.

Retained pairs are confirmed on the full sets (100 * intersection >= 85 *
union) and linked into components. A text of fewer words than a shingle is one
shingle as a whole. Lists are worked off by ``linking``, without all pairs.

Defined results: null, empty and blank texts have the empty set and are linked
with nothing, not even each other; rows that share an id are separate texts of
it; a null id has no number, so it never names a component (a component of
null ids only has a null id); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascore.llm import bytesvec as bv
from terrascore.llm.common import row_key, ship_code, stage_table
from terrascore.llm.linking import link
from terrascore.session import stage_table_counted

SHINGLE = 3
PERCENT = 85
COORDS = 48
#: Up to so many ids, the second scan of the texts is filtered by a broadcast.
BROADCAST_ROWS = 1_000_000
_A = bv.mix(np.arange(1, 513, dtype=np.uint64)) | np.uint64(1)


def match_threshold(coords: int, percent: int) -> int:
    """Coordinates that two sets of the least similarity agree on, five
    standard deviations below the mean, rounded down."""
    p = percent / 100
    return max(1, int(coords * p - 5 * (coords * p * (1 - p)) ** 0.5))


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = bv.string_buffers(column)
    for a, b, d, o in bv.chunks(data, offsets):
        d = bv.lower_az(d)
        starts, lengths, rows = bv.words(d, o)
        h = bv.word_hashes(d, starts, lengths)
        counts = np.bincount(rows, minlength=b - a)
        grams = bv.join_hashes(*[h[k:len(h) - size + 1 + k] for k in range(size)]) if len(h) >= size else h[:0]
        first = np.cumsum(counts) - counts
        for i in range(b - a):
            n, at = int(counts[i]), int(first[i])
            if n >= size:
                yield np.unique(grams[at:at + n - size + 1])
            elif n:
                yield bv.join_hashes(np.full(1, n, np.uint64), *[h[at + k:at + k + 1] for k in range(n)])
            else:
                yield h[:0]


def signature(s: np.ndarray, coords: int) -> np.ndarray:
    """Per coordinate the least 32-bit value of a multiplied set, in blocks so
    that a very large set needs no large matrix."""
    out = np.full(coords, 0xFFFFFFFF, dtype=np.uint64)
    for a in range(0, len(s), 4096):
        np.minimum(out, ((s[a:a + 4096, None] * _A[:coords]) >> np.uint64(32)).min(axis=0), out=out)
    return out.astype(np.uint32).view(np.int32)


def _keys(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit fingerprint of a set."""
    if not len(s):
        return 0, 0
    x = s + np.arange(1, len(s) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    k1, k2 = bv.mix(x).sum(dtype=np.uint64), bv.mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(k1.astype(np.int64)), int(k2.astype(np.int64))


def sign(docs: DataFrame, id_col: str, text_col: str, size: int, coords: int) -> DataFrame:
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, keys, sigs = [], [], []
                for s in shingle_sets(part.column(1), size):
                    n.append(len(s))
                    keys.append(_keys(s))
                    sigs.append(signature(s, coords))
                flat = pa.array(np.concatenate(sigs))
                offs = pa.array(np.arange(0, coords * len(n) + 1, coords), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array([k for k, _ in keys], pa.int64()),
                     pa.array([k for _, k in keys], pa.int64()), pa.ListArray.from_arrays(offs, flat)],
                    names=["id", "text_key", "n", "k1", "k2", "sig"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"), _text_key(text_col).alias("text_key"))
    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(run, f"id {kind}, text_key long, n long, k1 long, k2 long, sig array<int>")


def _text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def full_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                sets = list(shingle_sets(batch.slice(at, 256).column(0), size))
                offs = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]), pa.int32())
                flat = bv.as_long(np.concatenate(sets)) if sets else pa.array([], pa.int64())
                keys = [_keys(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in keys], pa.int64()), pa.array([k for _, k in keys], pa.int64()),
                     pa.ListArray.from_arrays(offs, flat)], names=["k1", "k2", "items"])

    return docs.select(F.col(text_col).cast("string").alias("body")).mapInArrow(run, "k1 long, k2 long, items array<long>")


def prefix_postings(classes: DataFrame, coords: int, matches: int) -> DataFrame:
    """(token, node, score): classes under the values of their prefix.
    ``score``, the sum of the postings' lengths, is highest for the member that
    shares most with others."""
    token = F.transform("sig", lambda v, i: F.shiftleft(i.cast("long"), 32).bitwiseOR(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
    posted = classes.select("cls", F.explode(token).alias("token"))
    shared = posted.groupBy("token").agg(F.count("*").alias("len")).where("len > 1")
    by = (posted.join(shared, "token").groupBy("cls")
          .agg(F.sum("len").alias("score"),
               F.sort_array(F.collect_list(F.struct("len", "token"))).alias("order"))  # at most ``coords``
          .where(F.size("order") >= matches))
    prefix = F.slice("order", F.lit(1), F.size("order") - (matches - 1))
    return by.select(F.explode(prefix).alias("p"), F.col("cls").alias("node"), "score").select(
        F.col("p.token").alias("token"), "node", "score")


def labelled(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, coords: int = COORDS) -> DataFrame:
    """One row per input row: ``id, text_key, n, component_id`` and ``chosen``
    (its text is the one that stays of its component; false for empty sets)."""
    matches = match_threshold(coords, percent)
    rows = stage_table(sign(docs, id_col, text_col, size, coords), "minhash-signatures")
    classes = (rows.where("n > 0").groupBy("k1", "k2")
               .agg(F.min("id").alias("first_id"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    classes = stage_table(classes.select(row_key().alias("cls"), "*"), "minhash-classes")
    postings = prefix_postings(classes, coords, matches)
    alone = postings.groupBy("token").agg(F.count("*").alias("len")).where("len > 1").select("token")
    postings, n_postings = stage_table_counted(postings.join(alone, "token", "left_semi"), "minhash-postings")
    own = classes.select("cls", "k1", "k2", "first_id")
    if n_postings:
        linked = _components(docs, id_col, text_col, size, percent, matches, classes, postings)
        named = own.join(linked, own["cls"] == linked["node"])
        # a struct of nulls last, so that a text without an id never names its component
        rank = F.struct(F.col("first_id").isNull(), "first_id", "cls")
        best = named.groupBy("comp").agg(F.min(rank).alias("best"))
        named = named.join(best, "comp").select("cls", F.col("best.first_id").alias("component_id"),
                                                F.col("best.cls").alias("best_cls"))
        own = (own.join(named, "cls", "left")
               .withColumn("component_id", F.when(F.col("best_cls").isNull(), F.col("first_id")).otherwise(F.col("component_id")))
               .withColumn("chosen", F.coalesce("best_cls", "cls") == F.col("cls")))
    else:
        own = own.withColumn("component_id", F.col("first_id")).withColumn("chosen", F.lit(True))
    out = rows.select("id", "text_key", "n", "k1", "k2").join(own.select("k1", "k2", "component_id", "chosen"), ["k1", "k2"], "left")
    comp = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "text_key", "n", comp.alias("component_id"), F.coalesce("chosen", F.lit(False)).alias("chosen"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT, coords: int = COORDS) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (the least
    id of its component), ``kept`` (id = component_id)."""
    out = labelled(docs, id_col, text_col, size, percent, coords)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _components(docs, id_col, text_col, size, percent, matches, classes, postings) -> DataFrame:
    """The texts of the classes that have postings are read once more for
    their full sets; then candidate pairs are verified against those."""
    node = postings.select(F.col("node").alias("cls")).distinct()
    wanted, n = stage_table_counted(node.join(classes, "cls").select("cls", "k1", "k2", "first_id", "sig"), "minhash-wanted")
    ids = wanted.select(F.col("first_id").alias("wanted_id")).distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    ids = F.broadcast(ids) if n <= BROADCAST_ROWS else ids
    texts = texts.join(ids, F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = full_sets(texts, "id", "body", size).join(wanted.select("cls", "k1", "k2", "sig"), ["k1", "k2"])
    sets = stage_table(sets.groupBy("cls").agg(F.first("sig").alias("sig"), F.first("items").alias("items")), "minhash-sets")

    def verify(pairs: DataFrame) -> DataFrame:
        sigs = sets.select("cls", "sig")
        agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda x, y: x == y), lambda same: same))
        close = (pairs.join(sigs.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a")), "a")
                 .join(sigs.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b")), "b")
                 .where(agree >= matches).select("a", "b"))
        items = sets.select("cls", "items")
        both = (close.join(items.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a")
                .join(items.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")
                .select("a", "b", F.size(F.array_intersect("x", "y")).alias("same"), (F.size("x") + F.size("y")).alias("all")))
        return both.where(100 * F.col("same") >= percent * (F.col("all") - F.col("same"))).select("a", "b")

    def items(nodes: DataFrame) -> DataFrame:
        return (sets.join(nodes, sets["cls"] == nodes["node"], "left_semi")
                .select(F.col("cls").alias("node"), F.explode("items").alias("item")))

    return link(postings, verify, items, percent)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, in their own columns, without near-duplicates: of each
    component one row stays, with the least id. Empty sets have no duplicates
    and stay."""
    flags = stage_table(labelled(docs, id_col, text_col, size, percent), "minhash-flags")
    stays = (F.col("n") == 0) | (F.col("chosen") & F.col("id").eqNullSafe(F.col("component_id")))
    gone = flags.where(~stays).select(F.col("id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__gone_id")) & (_text_key(text_col) == F.col("__gone_key"))
    kept = docs.join(gone, same, "left_anti")
    # rows that are equal in id and text: one of them stays
    equal = (flags.where((F.col("n") > 0) & stays).groupBy("id", "text_key").agg(F.count("*").alias("rows")).where("rows > 1")
             .select(F.col("id").alias("__gone_id"), F.col("text_key").alias("__gone_key")))
    if equal.isEmpty():
        return kept
    once = kept.join(equal, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(equal, same, "left_anti").unionByName(once)
