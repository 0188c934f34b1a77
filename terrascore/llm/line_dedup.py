"""Fuzzy line deduplication (op 8).

A line's shingles (``SHINGLE`` characters, code points) get a MinHash signature; bands
of it bring candidates together, exact Jaccard similarity confirms them, and
each component of confirmed links, exact copies included, keeps one line: the
first by document id and line number. Documents that lose all their lines go.

1. Python reads the texts once and deals (band hash, line key) pairs out to
   shards as packed arrays, so the shuffle moves few, compact rows. A band that
   different lines of a task share is known to be shared: its pairs are spread
   over all shards, and only two of them go to the band's own shard, where other
   tasks' single lines meet them. So a shard's share follows from its number,
   which follows from the input's bytes, and not from a band's frequency.
2. Line keys (64-bit hashes of whole lines) by document come from a second,
   built-in pass; copies of a line are counted by its key with partial sums.
3. Candidate lines get their texts back; ``linking`` works the lists off and
   exact similarities confirm the links.
4. Removals go back to their documents as line numbers.

Defined results: null, empty and blank texts, and blank lines, are left as
they are; a line shorter than a shingle is one shingle as a whole, so it only
matches copies of itself; rows equal in id and text are one document, of which
one row stays; ties between equal lines go to the least (id, text hash, line);
a null id sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascore.llm import bytesvec as bv
from terrascore.llm.common import WS_CHARS, ship_code, small_batches, stage_table
from terrascore.llm.linking import link
from terrascore.session import stage_table_counted

SHINGLE = 9
BANDS, ROWS = 12, 4
PERCENT = 80
#: (band, line) pairs gathered in a task before they are dealt out.
FLUSH = 500_000
#: Bytes of text for each shard of pairs, at most.
SHARD_BYTES = 8 << 20
#: Bytes of lines whose shingles are worked on at once, so that these arrays stay in
#: a core's cache (a longer line is by itself).
BLOCK = 1 << 16
#: Bytes of lines whose sets are compared at once (a longer pair is by itself).
PAIR_BLOCK = 1 << 18
#: Up to so many line keys, the second read of the texts is filtered by a broadcast.
BROADCAST_ROWS = 1_000_000
_SEED = 42  # the seed of Spark's xxhash64
_A = (bv.mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the lines with a word, in order, over all texts."""
    cuts = np.union1d(np.flatnonzero(data == 10) + 1, offsets)
    begin, end = cuts[:-1], cuts[1:]
    if len(begin):
        worded = np.logical_or.reduceat(bv.in_words(data), begin)
        begin, end = begin[worded], end[worded]
    return begin, end - (data[end - 1] == 10)


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number for each UTF-8 character, an ASCII one's its byte, and the
    number of characters before each byte and before the end."""
    lead = (data & 0xC0) != 0x80
    first = np.flatnonzero(lead)
    units = data[first].astype(np.uint32)
    wide = np.flatnonzero(units > 127)
    at, u = first[wide], units[wide]
    width = np.append(first, len(data))[wide + 1] - at
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    for k in (1, 2, 3):
        u = np.where(width > k, u << np.uint32(8) | padded[at + k], u)
    units[wide] = u
    return units, np.concatenate([[0], np.cumsum(lead)])


def rolling_hashes(units: np.ndarray, size: int) -> np.ndarray:
    """The polynomial hash of every ``size`` consecutive units, by doubling."""
    base, one = 0x100000001B3, units.astype(np.uint64)
    out, width = one, 1
    for bit in bin(size)[3:]:
        longer = out[:-width] * np.uint64(pow(base, width, 1 << 64))
        longer += out[width:]
        out, width = longer, 2 * width
        if bit == "1":
            out = out[:-1] * np.uint64(base)
            out += one[width:]
            width += 1
    return out


def shingle_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every line's shingles, line after line, and counts."""
    if len(data) and data.max() > 127:
        data, before = characters(data)
        begin, end = before[begin], before[end]
    n = np.maximum(end - begin - size + 1, 1)
    first = np.cumsum(n) - n
    h = rolling_hashes(np.concatenate([data, np.zeros(size, data.dtype)]), size)
    h = np.concatenate([h[a:a + k] for a, k in zip(begin.tolist(), n.tolist())])
    for i in np.flatnonzero(end - begin < size):  # shorter lines: the whole line
        h[first[i]] = xxhash.xxh64_intdigest(data[begin[i]:end[i]].astype(np.uint32).tobytes())
    return bv.mix(h), n


def band_hashes(shingles: np.ndarray, n: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(lines, bands) 64-bit hashes of the bands of each line's signature."""
    first = np.cumsum(n) - n
    shingles = (shingles >> np.uint64(32)).astype(np.uint32)
    out, v = np.empty((len(n), bands), np.uint64), np.empty_like(shingles)
    for b in range(bands):
        key = np.full(len(n), b + 1, np.uint64)
        for r in range(rows):
            np.multiply(shingles, _A[b * rows + r], out=v)
            key = bv.mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(v, first))
        out[:, b] = key
    return out


def blocks(begin: np.ndarray, end: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(first, after the last) of runs of lines of about ``size`` bytes."""
    p = 0
    while p < len(begin):
        q = max(p + 1, int(np.searchsorted(end, begin[p] + size, side="right")))
        yield p, q
        p = q


def signatures(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The ``band_hashes`` of every line, a block of lines at a time."""
    out = np.empty((len(begin), BANDS), np.uint64)
    for p, q in blocks(begin, end, BLOCK):
        a = begin[p]
        out[p:q] = band_hashes(*shingle_hashes(data[a:end[q - 1]], begin[p:q] - a, end[p:q] - a))
    return out


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return at, np.append(at[1:], len(x))


def _once(t: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (token, key) pairs in order."""
    order = np.argsort(t)
    t, k = t[order], k[order]
    again = np.zeros(len(t), bool)  # only keys of a token that recurs are put in order
    again[1:] = t[1:] == t[:-1]
    again[:-1] |= again[1:]
    among = np.flatnonzero(again)
    k[among] = k[among][np.lexsort((k[among], t[among]))]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    return t[fresh], k[fresh]


def dealt(tokens: np.ndarray, keys: np.ndarray, shards: int) -> pa.RecordBatch:
    """(shard, kind, tokens, keys): ``single`` are tokens with one key here, in
    the token's shard, and ``two`` two keys of each other token; ``shared`` are
    all pairs of those other tokens, spread by token and key."""
    t, k = _once(tokens, keys)
    at, end = _runs(t)
    many = np.repeat(end - at > 1, end - at)
    two = np.concatenate([at[end - at > 1], at[end - at > 1] + 1])
    rows = []
    for kind, x, y in (("single", t[~many], k[~many]), ("two", t[two], k[two]), ("shared", t[many], k[many])):
        by = bv.mix(x * np.uint64(0x9E3779B97F4A7C15) + y) if kind == "shared" else x
        shard = (by % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        x, y, shard = x[order], y[order], shard[order]
        rows += [(int(shard[a]), kind, x[a:b].tobytes(), y[a:b].tobytes()) for a, b in zip(*_runs(shard))]
    return pa.RecordBatch.from_arrays([pa.array(list(c), of) for c, of in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary(), pa.binary()))],
                                      names=["shard", "kind", "tokens", "keys"])


def shared_pairs(table: pa.Table) -> pa.Table:
    """(token, node) of one shard's dealt pairs whose token has several keys."""
    def of(*kinds: str) -> tuple[np.ndarray, np.ndarray]:
        part = table.filter(pc.is_in(table["kind"], pa.array(kinds)))
        return tuple(np.frombuffer(b"".join(part[c].to_pylist()), np.uint64) for c in ("tokens", "keys"))
    t, k = _once(*of("single", "two"))
    at, end = _runs(t)
    alike = np.repeat(end - at > 1, end - at)
    st, sk = _once(*of("shared"))
    return pa.table({"token": bv.as_long(np.concatenate([t[alike], st])), "node": bv.as_long(np.concatenate([k[alike], sk]))})


def band_postings(docs: DataFrame, text_col: str, shards: int) -> DataFrame:
    """(token, node): line keys under the bands that different lines share."""
    ship_code(docs.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, keys, held = [], [], 0
        for batch in batches:
            data, offsets = bv.string_buffers(batch.column(0))
            for _, _, d, o in bv.chunks(data, offsets):
                begin, end = line_spans(d, o)
                if not len(begin):
                    continue
                raw = d.tobytes()
                key = np.array([xxhash.xxh64_intdigest(raw[a:b], _SEED) for a, b in zip(begin.tolist(), end.tolist())], np.uint64)
                one = np.sort(np.unique(key, return_index=True)[1])
                key, begin, end = key[one], begin[one], end[one]
                tokens.append(signatures(d, begin, end).reshape(-1))
                keys.append(np.repeat(key, BANDS))
                held += len(tokens[-1])
                if held >= FLUSH:
                    yield dealt(np.concatenate(tokens), np.concatenate(keys), shards)
                    tokens, keys, held = [], [], 0
        if held:
            yield dealt(np.concatenate(tokens), np.concatenate(keys), shards)

    body = docs.select(F.col(text_col).cast("string").alias("body")).where("body is not null")
    # a pair may come both from its token's shard and from its own
    return (body.mapInArrow(deal, "shard int, kind string, tokens binary, keys binary")
            .groupBy("shard").applyInArrow(shared_pairs, "token long, node long").distinct())


def _doc_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def _texts(docs: DataFrame, text_col: str, nodes: DataFrame, few: bool) -> DataFrame:
    """(node, line): one text per wanted line key."""
    lines = docs.select(F.explode(F.split(text_col, "\n")).alias("line")).select("line", F.xxhash64("line").alias("node"))
    lines = lines.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    return lines.groupBy("node").agg(F.first("line").alias("line"))


def line_sets(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, shingle): the distinct shingles of every line, in order of both."""
    h, n = shingle_hashes(data, begin, end)
    line = np.repeat(np.arange(len(n)), n)
    for a, k in zip((np.cumsum(n) - n).tolist(), n.tolist()):
        h[a:a + k].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    return line[fresh], h[fresh]


def similar_lines(line: np.ndarray, shingle: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sets of the lines ``x`` and ``y``, pair by pair, are similar
    enough; (``line``, ``shingle``) from ``line_sets``."""
    size = np.bincount(line)
    first = np.cumsum(size) - size
    out = np.zeros(len(x), bool)
    able = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
    for i, p, m, q, n in zip(*(c[able].tolist() for c in (np.arange(len(x)), first[x], size[x], first[y], size[y]))):
        both = np.concatenate((shingle[p:p + m], shingle[q:q + n]))
        both.sort()
        same = int(np.count_nonzero(both[1:] == both[:-1]))
        out[i] = 100 * same >= percent * (m + n - same)
    return out


def _similar(percent: int):
    """Arrow function: the pairs (a, b) whose lines x, y are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            (xd, xo), (yd, yo) = (bv.string_buffers(batch.column(k)) for k in (2, 3))
            keep = np.zeros(len(a), bool)
            for p, q, _, _ in bv.chunks(xd, xo + yo, PAIR_BLOCK):
                _, one, at = np.unique(np.concatenate([a[p:q], b[p:q]]), return_index=True, return_inverse=True)
                x, y = xd[xo[p]:xo[q]], yd[yo[p]:yo[q]]
                begin = np.concatenate([xo[p:q] - xo[p], yo[p:q] - yo[p] + len(x)])[one]
                end = np.concatenate([xo[p + 1:q + 1] - xo[p], yo[p + 1:q + 1] - yo[p] + len(x)])[one]
                sets = line_sets(np.concatenate([x, y]), begin, end)
                keep[p:q] = similar_lines(*sets, at[:q - p], at[q - p:], percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return run


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: (node, line) to (node, item) for every shingle."""
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        for p, q, d, o in bv.chunks(*bv.string_buffers(batch.column(1)), PAIR_BLOCK):
            line, item = line_sets(d, o[:-1], o[1:])
            yield pa.RecordBatch.from_arrays([pa.array(nodes[p:q][line]), bv.as_long(item)], names=["node", "item"])


def line_components(docs: DataFrame, text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(node, comp) for the line keys that have similar other lines."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0] or 0
    shards = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    postings, n = stage_table_counted(band_postings(docs, text_col, shards), "line-bands")
    if not n:
        return spark.createDataFrame([], "node long, comp long")
    nodes, n = stage_table_counted(postings.groupBy("node").agg(F.count("*").alias("score")), "line-nodes")
    texts = stage_table(_texts(docs, text_col, nodes.select("node"), n <= BROADCAST_ROWS), "line-texts")
    # the member with the longest lists shares most with others
    longest = postings.groupBy("token").agg(F.count("*").alias("len"))
    score = postings.join(longest, "token").groupBy("node").agg(F.sum("len").alias("score"))
    posted = stage_table(postings.join(score, "node").select("token", "node", "score"), "line-postings")

    def verify(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("x")), "a")
                .join(texts.select(F.col("node").alias("b"), F.col("line").alias("y")), "b"))
        return both.select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long")

    def items(nodes: DataFrame) -> DataFrame:
        return texts.join(nodes, "node", "left_semi").select("node", "line").mapInArrow(_items, "node long, item long")

    return link(posted, verify, items, percent)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Staged (doc, copies, lines, gone): per document key the number of equal
    rows, its lines with a word, and the numbers of the lines to remove."""
    with small_batches(docs.sparkSession):
        linked = line_components(docs, text_col, percent)
    keys = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"),
                       lambda x: F.when(F.ltrim(x, F.lit(WS_CHARS)) != "", F.xxhash64(x)))
    d = docs.select(F.col(id_col).alias("id"), _doc_key(id_col, text_col).alias("doc"), keys.alias("keys"))
    d = stage_table(d.groupBy("id", "doc").agg(F.count("*").alias("copies"), F.first("keys").alias("keys")), "line-keys")
    at = d.select("id", "doc", F.posexplode("keys").alias("line", "node")).where("node is not null")
    first = at.groupBy("node").agg(F.min(F.struct("id", "doc", "line")).alias("first"), F.count("*").alias("n"))
    # lines with a copy or a similar line; no others can go
    named = first.join(linked, "node", "left").where("n > 1 or comp is not null")
    named = stage_table(named.select("node", "first", F.coalesce("comp", "node").alias("comp")), "line-first")
    best = named.groupBy("comp").agg(F.min("first").alias("best"))
    best = named.join(best, "comp").select("node", F.col("best.id").alias("best_id"), F.col("best.doc").alias("best_doc"),
                                           F.col("best.line").alias("best_line"))
    lost = (at.join(best, "node")
            .where(~(F.col("id").eqNullSafe(F.col("best_id")) & (F.col("doc") == F.col("best_doc")) & (F.col("line") == F.col("best_line"))))
            .groupBy("id", "doc").agg(F.collect_list("line").alias("gone"))
            .select(F.col("id").alias("lost_id"), F.col("doc").alias("lost_doc"), "gone"))
    out = d.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("doc") == F.col("lost_doc")), "left")
    return stage_table(out.select("id", "doc", "copies", F.size(F.filter("keys", lambda k: k.isNotNull())).alias("lines"),
                                  F.coalesce("gone", F.array().cast("array<int>")).alias("gone")), "line-removals")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents, in their own columns, without repeated lines; those left
    without a line go."""
    plan = removals(docs, id_col, text_col, percent).where("size(gone) > 0 or copies > 1")
    one = _cleaned(docs, plan.where("copies = 1"), plan.where("copies > 1"), id_col, text_col)
    again = plan.where("copies > 1")
    if again.isEmpty():
        return one
    several = _cleaned(docs, again, None, id_col, text_col)
    return one.unionByName(several.dropDuplicates([id_col, text_col]))


def _cleaned(docs: DataFrame, plan: DataFrame, others: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the removals of ``plan``; the rows of ``others`` left out,
    or, without ``others``, only the rows of ``plan``."""
    if others is not None:
        plan = plan.unionByName(others)
    plan = plan.select(F.struct("id", "doc", "copies", "lines", "gone").alias("__line_plan"))
    p = F.col("__line_plan")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__line_doc"),
                       F.col(id_col).alias("__line_id"), _doc_key(id_col, text_col).alias("__line_key"))
    rows = rows.join(plan, F.col("__line_id").eqNullSafe(p["id"]) & (F.col("__line_key") == p["doc"]),
                     "inner" if others is None else "left")
    gone, copies = F.coalesce(F.size(p["gone"]), F.lit(0)), F.coalesce(p["copies"], F.lit(1))
    rows = rows.where((gone < F.coalesce(p["lines"], F.lit(1))) | (gone == 0))
    if others is not None:
        rows = rows.where(copies == 1)
    body = F.col(f"__line_doc.`{text_col}`")
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda x, i: ~F.array_contains(p["gone"], i)), "\n")
    text = F.when(gone > 0, kept).otherwise(body)
    return rows.select(*[(text if c == text_col else F.col(f"__line_doc.`{c}`")).alias(c) for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: id, ``copies`` (equal rows), ``n_lines`` (with a
    word), ``n_removed``, ``removed`` (numbers of the lines, from 0) and
    ``kept`` (false if it loses all its lines)."""
    plan = removals(docs, id_col, text_col, percent)
    return plan.select(F.col("id").alias(id_col), "copies", F.col("lines").cast("long").alias("n_lines"),
                       F.size("gone").cast("long").alias("n_removed"), F.sort_array("gone").alias("removed"),
                       ((F.size("gone") < F.col("lines")) | (F.col("lines") == 0)).alias("kept"))
