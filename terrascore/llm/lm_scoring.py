"""LM scoring: an interpolated modified Kneser-Ney n-gram model (op 1).

Counting runs in Spark. A first pass counts the words and numbers them. Tasks
then count the n-grams they have read and deal them out to shards as packed
arrays of word numbers, sorted and byte by byte, so that they compress; a shard
sums its n-grams and writes them as sorted arrays (hash, count) into the shared
folder, from where every worker maps them into memory, and likewise the
statistics of its contexts. From each shard come, already summed, the shorter
n-grams it gives a continuation count to; those are dealt out and written
likewise, order by order. The driver sees counts of counts and one row per shard.

An n-gram's shard follows from its context, so that a context's n-grams meet
in one place. Contexts made of very frequent words only (more than a shard's
share of all tokens) are spread by the n-gram instead; their statistics are
dealt out and merged in a pass of their own.

Score: with ``c`` the count (for the highest order) or the number of different
words before it (lower orders), D the order's three discounts, and n1, n2, n3+
the context's n-grams by count,
``p(w|h) = max(c - D(c), 0) / total(h) + (D1 n1 + D2 n2 + D3 n3+) / total(h) * p(w|h')``,
down to a uniform share of 1 / (V + 1) for any word at all. A context that was
never seen passes on to the shorter one.

Text: A-Z lower-cased; words are runs of non-white space; every text ends with
one end token, which counts as a token. Words are known by 64-bit hashes; n-grams of word
numbers and contexts by their shard and 48 bits of theirs.

Defined results: null, empty and blank texts have the end token only; equal
texts get equal scores; without any training row the model is uniform and the
counts are 0; an empty table gives an empty result. Files are written under a
temporary name and renamed, so a task that runs twice writes the same file.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrascore.llm import bytesvec as bv
from terrascore.llm.common import shared_path, ship_code, shuffles_removed, stage_table

#: Order of the registered query's model.
ORDER = 3
#: N-grams that a task holds before it deals them out.
FLUSH = 2_000_000
#: Tokens of the training texts for each shard of n-grams, and their bytes for each of words, at most.
SHARD_TOKENS, SHARD_BYTES = 2_000_000, 32 << 20
#: Tokens that are scored at once.
SCORED_AT_ONCE = 400_000
END, BEGIN = np.uint64(0x1D8E4E27C47D124F), np.uint64(0x7FB5D329728EA185)
U64 = np.uint64
#: Statistics of a context: sum of the counts, n-grams by count.
CONTEXT = ("total", "n1", "n2", "n3")


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """Whether crc32(id as text) mod ``folds`` is ``fold`` (a null id: as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def token_stream(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens with padding, positions of real tokens, row of each of those):
    per text ``order - 1`` begin marks, the word hashes and the end token."""
    low = bv.lower_az(data)
    starts, lengths, rows = bv.words(low, offsets)
    hashes = bv.word_hashes(low, starts, lengths)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    size = counts + order
    first = np.cumsum(size) - size
    out = np.full(int(size.sum()), BEGIN, U64)
    out[first[rows] + order - 1 + np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]] = hashes
    out[first + size - 1] = END
    real = np.ones(len(out), bool)
    for k in range(order - 1):
        real[first + k] = False
    at = np.flatnonzero(real)
    return out, at, np.repeat(np.arange(n), counts + 1)


def ngrams(tokens: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """Columns of the ``k``-grams that end at ``at``."""
    return [tokens[at - k + 1 + j] for j in range(k)]


def context_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of all but the last word of each n-gram."""
    if len(columns) == 1:
        return np.zeros(len(columns[0]), U64)
    return bv.join_hashes(*columns[:-1])


def gram_hash(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    return bv.mix(context * U64(0xD6E8FEB86659FD93) + last)


def is_spread(columns: list[np.ndarray], hot: np.ndarray) -> np.ndarray:
    """Whether the n-grams of a context are spread over all shards."""
    spread = np.ones(len(columns[-1]), bool)
    for c in columns[:-1]:
        spread &= np.isin(c, hot)
    return spread


def shard_of(columns: list[np.ndarray], context: np.ndarray, gram: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    return (bv.mix(np.where(is_spread(columns, hot), gram, context)) % U64(shards)).astype(np.int64)


def unique_rows(columns: list[np.ndarray], counts: np.ndarray, gram: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """N-grams once each, in the order of their hashes, with summed counts."""
    order = np.argsort(gram, kind="stable")
    gram = gram[order]
    at = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return [c[order][at] for c in columns], total, gram[at]


def _planes(x: np.ndarray) -> bytes:
    """The values' lowest bytes, then the next, as far as any is not 0."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    width = len(data) // n if n else 0
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(-1)


def _shard_order(shard: np.ndarray) -> np.ndarray:
    """The stable order by shard; numbers of 16 bits are sorted by radix."""
    return np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 65536 else shard, kind="stable")


def _pack(shard: np.ndarray, arrays: list[np.ndarray], kind: str) -> Iterator[dict]:
    order = _shard_order(shard)
    shard, arrays = shard[order], [a[order] for a in arrays]
    at = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(at, np.append(at[1:], len(shard))):
        yield {"kind": kind, "shard": int(shard[a]), "n": int(b - a), "parts": [_planes(x[a:b]) for x in arrays]}


_BLOB = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("n", pa.int64()), ("parts", pa.list_(pa.binary()))])
BLOB = "kind string, shard int, n long, parts array<binary>"


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_BLOB)


def _unpack(table: pa.Table, columns: int) -> list[np.ndarray]:
    parts, sizes = table["parts"].to_pylist(), table["n"].to_pylist()
    return [np.concatenate([_from_planes(p[k], n) for p, n in zip(parts, sizes)]) for k in range(columns)]


def _save(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    array.tofile(tmp)
    os.replace(tmp, os.path.join(folder, name))


def _key_bytes(keys: np.ndarray, wide: bool) -> np.ndarray:
    """Sorted hashes as they are filed: ``wide`` as a whole, else their upper 32
    bits one after the other and then the next 16 (the shard is known besides)."""
    if wide:
        return keys.view(np.uint8)
    return np.concatenate([(keys >> U64(32)).astype("<u4").view(np.uint8), (keys >> U64(16)).astype("<u2").view(np.uint8)])


def _value_bytes(values: np.ndarray) -> np.ndarray:
    """A byte for each value, 255 for all from there on; then those values'
    places, then the values themselves."""
    large = np.flatnonzero(values >= 255)
    return np.concatenate([np.minimum(values, 255).astype(np.uint8), large.astype("<u8").view(np.uint8), values[large].astype("<u8").view(np.uint8)])


def _load(folder: str, name: str) -> np.ndarray:
    """A shard's file, mapped. One that should be there and is not means that this
    worker does not see the shared folder."""
    path = os.path.join(folder, name)
    if not os.path.exists(path):
        raise FileNotFoundError(f"the language model's file {path} is missing: the shared folder must be mounted on every worker")
    return np.memmap(path, dtype=np.uint8, mode="r").view(np.ndarray) if os.path.getsize(path) else np.zeros(0, np.uint8)


def _find(folder: str, name: str, n: int, wanted: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of the hashes ``wanted`` among a file's ``n``."""
    raw = _load(folder, name)
    if len(raw) != n * (8 if wide else 6):
        raise ValueError(f"the language model's file {folder}/{name} holds {len(raw)} bytes for {n} entries")
    if wide:
        keys = raw.view(U64)
        at = np.minimum(np.searchsorted(keys, wanted), n - 1)
        return at, keys[at] == wanted
    upper, next16 = raw[:4 * n].view("<u4"), raw[4 * n:].view("<u2")
    head, tail = (wanted >> U64(32)).astype(np.uint32), (wanted >> U64(16)).astype(np.uint16)
    at = np.minimum(np.searchsorted(upper, head), n - 1)
    hit = (upper[at] == head) & (next16[at] == tail)
    # a few hashes share their upper bits with others and stand behind them
    more = np.flatnonzero((upper[at] == head) & ~hit)
    while len(more):
        more = more[at[more] + 1 < n]
        at[more] += 1
        more = more[upper[at[more]] == head[more]]
        hit[more] = next16[at[more]] == tail[more]
        more = more[~hit[more]]
    return at, hit


def _values_at(folder: str, name: str, n: int, at: np.ndarray) -> np.ndarray:
    """The values filed at places ``at`` of a file's ``n``."""
    raw = _load(folder, name)
    large, rest = divmod(len(raw) - n, 16)
    if large < 0 or rest:
        raise ValueError(f"the language model's file {os.path.join(folder, name)} is incomplete")
    out = raw[at].astype(np.int64)
    top = np.flatnonzero(out == 255)
    if len(top):
        places, values = np.frombuffer(raw[n:].tobytes(), "<u8").reshape(2, large).astype(np.int64)
        out[top] = values[np.searchsorted(places, at[top])]
    return out


@dataclass
class Model:
    folder: str
    order: int
    shards: int
    hot: np.ndarray
    #: words before each shard of words
    first: np.ndarray
    train_tokens: int = 0
    vocabulary: int = 0
    #: per order: the three discounts, and of the empty context (total, n1, n2, n3+)
    discounts: dict[int, np.ndarray] = field(default_factory=dict)
    unigrams: np.ndarray | None = None
    #: entries of each shard's files, by folder: what a worker must find
    entries: dict[str, np.ndarray] = field(default_factory=dict)


def _lookup(folder: str, entries: np.ndarray, shard: np.ndarray, keys: np.ndarray, names: list[str], wide: bool = False) -> list[np.ndarray]:
    """Values of ``names`` at ``keys`` in the mapped shard files (0 if absent);
    the name ``""`` stands for the place in the file, from 1. Keys are looked up
    once each, in the files' order. A shard without entries has no file; a file that
    is missing or short is an error, never a count of 0."""
    if wide or len(entries) > 65536:
        order = np.argsort(keys)
        order = order[_shard_order(shard[order])]
        s, k = shard[order], keys[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])]) if len(k) else np.zeros(0, bool)
        us, uk = s[new], k[new]
    else:  # shard and the 48 bits that files hold are sorted as one number
        k = (shard.astype(U64) << U64(48)) | (keys >> U64(16))
        order = np.argsort(k)
        k = k[order]
        new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
        us, uk = (k[new] >> U64(48)).astype(np.int64), k[new] << U64(16)
    found = [np.zeros(len(uk), np.int64) for _ in names]
    edges = np.searchsorted(us, np.arange(len(entries) + 1))
    for i in np.flatnonzero((edges[1:] > edges[:-1]) & (entries > 0)).tolist():
        a, b = int(edges[i]), int(edges[i + 1])
        n = int(entries[i])
        at, hit = _find(folder, f"hash-{i:05d}", n, uk[a:b], wide)
        place = a + np.flatnonzero(hit)
        for j, name in enumerate(names):
            found[j][place] = _values_at(folder, f"{name}-{i:05d}", n, at[hit]) if name else at[hit] + 1
    back = np.cumsum(new) - 1
    out = []
    for f in found:
        v = np.empty(len(keys), np.int64)
        v[order] = f[back]
        out.append(v)
    return out


def _local(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"the model's files must be in a shared folder that workers can open as files, not {path}")
    return path


def _count_words(folder: str, shards: int):
    """Map: word counts of the texts by shard. Reduce: sum and write."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, c = _sum_words([x[0] for x in held], [x[1] for x in held])
            return _batch(list(_pack((h % U64(shards)).astype(np.int64), [h, c.astype(np.uint64)], "word")))
        for batch in batches:
            data, offsets = bv.string_buffers(batch.column(0))
            for _, _, d, o in bv.chunks(data, offsets):
                tokens, at, _ = token_stream(d, o, 1)
                u, c = np.unique(tokens, return_counts=True)
                held.append((u, c))
                size += len(u)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def gather(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        h, c = _unpack(table, 2)
        h, c = _sum_words([h], [c.astype(np.int64)])
        _save(f"{folder}/words", f"hash-{shard:05d}", _key_bytes(h, True))
        _save(f"{folder}/words", f"count-{shard:05d}", _value_bytes(c))
        rows = [{"kind": "stat", "shard": shard, "n": len(h), "parts": [np.int64(c.sum()).tobytes()]}]
        rows += [{"kind": "top", "shard": shard, "n": int(c[i]), "parts": [np.int64(i).tobytes()]}
                 for i in np.argsort(-c, kind="stable")[:64]]
        return pa.Table.from_pylist(rows, schema=_BLOB)
    return deal, gather


def _sum_words(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    _, c, h = unique_rows([], np.concatenate(counts), np.concatenate(hashes))
    return h, c


def word_ids(folder: str, first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, count) of each word hash: BEGIN is 0, the words of the training
    texts are 1 to V, shard after shard (``first``: words before each shard),
    and any other is V + 1, with the count 0."""
    shard = (words % U64(len(first) - 1)).astype(np.int64)
    at, count = _lookup(f"{folder}/words", np.diff(first), shard, words, ["", "count"], wide=True)
    ids = np.where(at > 0, first[shard] + at, first[-1] + 1)
    return np.where(words == BEGIN, 0, ids).astype(U64), count


def _deal_grams(folder: str, first: np.ndarray, order: int, hot: np.ndarray, shards: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            skip = np.cumsum([0] + [len(h[0]) for h in held])
            ids, _ = word_ids(folder, first, np.concatenate([h[0] for h in held]))
            words, ids = np.unique(ids, return_inverse=True)  # places are smaller than numbers: n-grams sort as one
            ids = ids.astype(U64)
            grams = [ngrams(ids[h[1] + k], h[2], order) for h, k in zip(held, skip)]
            columns = [np.concatenate([g[k] for g in grams]) for k in range(order)]
            return _batch(_dealt(columns, hot, shards, words))
        for batch in batches:
            data, offsets = bv.string_buffers(batch.column(0))
            for _, _, d, o in bv.chunks(data, offsets):
                tokens, at, _ = token_stream(d, o, order)
                words, where = np.unique(tokens, return_inverse=True)
                held.append((words, where.astype(np.int32), at))
                size += len(at)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return deal


def _keys(columns: list[np.ndarray]) -> tuple[list[np.ndarray], list[int]]:
    """The columns in as few numbers as hold them, for sorting, and their bits."""
    keys: list[np.ndarray] = []
    widths = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    room = 0
    for c, bits in zip(columns, widths):
        if keys and bits <= room:
            keys[-1] = (keys[-1] << U64(bits)) | c
            room -= bits
        else:
            keys.append(c)
            room = 64 - bits
    return keys, widths


def sum_grams(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """N-grams once each, in the order of their words, with summed counts (None: 1 each)."""
    keys, widths = _keys(columns)
    if counts is None and len(keys) == 1:  # nothing to carry along: the numbers alone are sorted
        key = np.sort(keys[0])
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        total, key = np.diff(np.append(at, len(key))), key[at]
        out = []
        for bits in widths[:0:-1]:
            out.append(key & U64((1 << bits) - 1))
            key = key >> U64(bits)
        return [key, *out[::-1]], total
    if counts is None:
        counts = np.ones(len(columns[0]), np.int64)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return [c[order[at]] for c in columns], total


def by_hash(gram: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) in the order of the hashes, of which 48 bits stay. Hash and
    count are sorted as one number, where the count has room in 16 bits."""
    top = U64(0xFFFF)
    key = np.sort((gram & ~top) | np.minimum(counts, 0xFFFF).astype(U64))
    ordered = (key & top).astype(np.int64)
    large = np.flatnonzero(counts >= 0xFFFF)
    ordered[ordered == 0xFFFF] = counts[large[np.argsort(gram[large])]]
    return key & ~top, ordered


def _dealt(columns: list[np.ndarray], hot: np.ndarray, shards: int, words: np.ndarray | None = None) -> list[dict]:
    """Packed n-grams, summed, by shard. ``words``: the numbers in order, of which ``columns`` has the places."""
    columns, counts = sum_grams(columns)
    if words is not None:
        columns = [words[c] for c in columns]
    context = context_hash(columns)
    shard = shard_of(columns, context, gram_hash(context, columns[-1]), hot, shards)
    return list(_pack(shard, [*columns, counts], "gram"))


def _save_contexts(folder: str, shard: int, key: np.ndarray, stats: list[np.ndarray]) -> list[np.ndarray]:
    """Write the statistics of contexts, summed by context, under their hashes
    once more mixed: the hash of a single word is its number."""
    key = bv.mix(key)
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    stats = [np.add.reduceat(x[order], at) if len(at) else x[:0] for x in stats]
    _save(folder, f"hash-{shard:05d}", _key_bytes(key[at], False))
    for name, x in zip(CONTEXT, stats):
        _save(folder, f"{name}-{shard:05d}", _value_bytes(x))
    return stats


def _write_grams(folder: str, k: int, hot: np.ndarray, shards: int):
    """Reduce: sum a shard's k-grams, write them and the statistics of the
    contexts that are here as a whole, and pass on counts of counts, statistics
    of the spread contexts, and the (k-1)-grams they continue."""
    def gather(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        *columns, counts = _unpack(table, k + 1)
        columns, counts = sum_grams(columns, counts.astype(np.int64))
        context = context_hash(columns)
        gram = gram_hash(context, columns[-1])
        hashes, ordered = by_hash(gram, counts)
        _save(f"{folder}/grams{k}", f"hash-{shard:05d}", _key_bytes(hashes, False))
        _save(f"{folder}/grams{k}", f"count-{shard:05d}", _value_bytes(ordered))
        del hashes, ordered
        of = np.bincount(np.minimum(counts, 5), minlength=6).astype(np.int64)
        # sorted by their words, so the n-grams of a context stand together
        at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        stats = [np.add.reduceat(x.astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts >= 3)]
        key, spread = context[at], is_spread([c[at] for c in columns], hot)
        whole = _save_contexts(f"{folder}/contexts{k}", shard, key[~spread], [x[~spread] for x in stats])
        rows = [{"kind": "stat", "shard": shard, "n": len(gram), "parts": [of.tobytes(), np.int64(len(whole[0])).tobytes()]}]
        rows += _pack((bv.mix(key[spread]) % U64(shards)).astype(np.int64), [key[spread], *[x[spread] for x in stats]], "context")
        if k > 1:
            rows += [r | {"kind": "lower"} for r in _dealt(columns[1:], hot, shards)]
        return pa.Table.from_pylist(rows, schema=_BLOB)
    return gather


def _write_contexts(folder: str, k: int):
    def gather(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        key, *stats = _unpack(table, 5)
        stats = _save_contexts(f"{folder}/spread{k}", shard, key, [x.astype(np.int64) for x in stats])
        sums = [int(x.sum()) for x in stats]
        return pa.Table.from_pylist([{"kind": "stat", "shard": shard, "n": len(stats[0]), "parts": [np.array(sums, np.int64).tobytes()]}], schema=_BLOB)
    return gather


def discounts(of: np.ndarray) -> np.ndarray:
    """Three discounts from the numbers of n-grams with count 1, 2, 3 and 4."""
    n1, n2, n3, n4 = (float(x) for x in of)
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    d = [k - (k + 1) * y * b / a if a and b else k * 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([min(max(x, 0.05), k) for k, x in enumerate(d, 1)])


def train(texts: DataFrame, text_col: str = "text", order: int = 2) -> Model:
    """Count the rows' texts and write the model into the shared folder. The
    shuffle files of an order go when it is written."""
    with shuffles_removed(texts.sparkSession):
        return _train(texts, text_col, order)


def _train(texts: DataFrame, text_col: str, order: int) -> Model:
    spark: SparkSession = texts.sparkSession
    ship_code(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = _local(shared_path(spark, "lm"))
    body = texts.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    size = body.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    shards = max(least := shards, -(-size // SHARD_BYTES))
    deal, gather = _count_words(folder, shards)
    counted = stage_table(body.mapInArrow(deal, BLOB).groupBy("shard").applyInArrow(gather, BLOB), "lm-words")
    stats = counted.where("kind = 'stat'").collect()  # a few numbers per shard
    first = np.zeros(shards + 1, np.int64)
    for r in stats:
        first[r["shard"] + 1] = r["n"]
    first = np.cumsum(first)
    model = Model(folder, order, shards, np.zeros(0, U64), first, vocabulary=int(first[-1]))
    model.train_tokens = sum(int(np.frombuffer(r["parts"][0], np.int64)[0]) for r in stats)
    model.shards = shards = max(least, -(-model.train_tokens // SHARD_TOKENS))
    # words with more than a shard's share of all tokens: at most as many as shards
    tops = counted.where((F.col("kind") == "top") & (F.col("n") > model.train_tokens // shards)).collect()
    hot = [first[r["shard"]] + 1 + np.frombuffer(r["parts"][0], np.int64)[0] for r in tops]
    model.hot = np.sort(np.array([*hot, 0], U64))  # 0: BEGIN
    grams = body.mapInArrow(_deal_grams(folder, first, order, model.hot, shards), BLOB)
    for k in range(order, 0, -1):
        done = grams.groupBy("shard").applyInArrow(_write_grams(folder, k, model.hot, shards), BLOB)
        done = stage_table(done, f"lm-order{k}")
        made = done.where("kind = 'stat'").select("shard", "n", "parts").collect()
        of = np.sum([np.frombuffer(r["parts"][0], np.int64) for r in made], axis=0) if made else np.zeros(6, np.int64)
        model.entries[f"grams{k}"] = _by_shard(shards, [(r["shard"], r["n"]) for r in made])
        model.entries[f"contexts{k}"] = _by_shard(shards, [(r["shard"], np.frombuffer(r["parts"][1], np.int64)[0]) for r in made])
        merged = (done.where("kind = 'context'").groupBy("shard").applyInArrow(_write_contexts(folder, k), BLOB)
                  .select("shard", "n", "parts").collect())
        model.entries[f"spread{k}"] = _by_shard(shards, [(r["shard"], r["n"]) for r in merged])
        model.discounts[k] = discounts(of[1:5])
        if k == 1:
            sums = [np.frombuffer(r["parts"][0], np.int64) for r in merged]
            model.unigrams = np.sum(sums, axis=0) if sums else np.zeros(4, np.int64)
        grams = done.where("kind = 'lower'")
    return model


def _by_shard(shards: int, sizes: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(shards, np.int64)
    for shard, n in sizes:
        out[shard] = n
    return out


def grams_once(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """N-grams once each, in the order of their words, and the place of each among them."""
    keys, _ = _keys(columns)
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    at = order[new]
    return [c[at] for c in columns], back


def log_probabilities(model: Model, ids: np.ndarray, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 of the model's probability of the tokens at ``at``. ``ids``: the different
    words' numbers (``word_ids``); ``tokens``: each token's place among them."""
    return np.log10(_probabilities(model, ids, ngrams(tokens.astype(U64), at, model.order)))


def _probabilities(model: Model, ids: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """The probability of each n-gram's last word. An n-gram, a context and the
    shorter n-gram are worked on once each, however often they occur."""
    if not columns:
        return np.full(1, 1.0 / (model.vocabulary + 1))
    k = len(columns)
    columns, back = grams_once(columns)
    shorter = _probabilities(model, ids, columns[1:])
    numbers = [ids[c] for c in columns]
    context = context_hash(numbers)
    gram = gram_hash(context, numbers[-1])
    # in the order of their words, so the n-grams of a context stand together
    new = np.zeros(len(context), bool)
    new[:1] = True
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    of = np.cumsum(new) - 1
    context = context[new]
    spread = is_spread([c[new] for c in numbers], model.hot)
    home = (bv.mix(context) % U64(model.shards)).astype(np.int64)
    shard = np.where(spread[of], (bv.mix(gram) % U64(model.shards)).astype(np.int64), home[of])
    c, = _lookup(f"{model.folder}/grams{k}", model.entries[f"grams{k}"], shard, gram, ["count"])
    d = model.discounts[k]
    taken = np.maximum(c - np.concatenate([[0.0], d])[np.minimum(c, 3)], 0)
    if k == 1:
        total, n1, n2, n3 = (float(x) for x in (model.unigrams if model.unigrams is not None else np.zeros(4)))
        return (taken / total + (d @ np.array([n1, n2, n3])) / total * shorter if total else np.broadcast_to(shorter, taken.shape))[back]
    t, a, b, e = found = [np.zeros(len(context), np.int64) for _ in CONTEXT]
    for name, part in (("contexts", ~spread), ("spread", spread)):
        for x, y in zip(found, _lookup(f"{model.folder}/{name}{k}", model.entries[f"{name}{k}"], home[part], bv.mix(context[part]), list(CONTEXT))):
            x[part] = y
    seen = t > 0
    t = np.maximum(t, 1)
    left = (d[0] * a + d[1] * b + d[2] * e) / t
    return np.where(seen[of], taken / t[of] + left[of] * shorter, shorter)[back]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` and ``perplexity``."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model)  # paths, discounts and at most some frequent words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        rate = m.train_tokens + 0.5 * (m.vocabulary + 1)

        def scored(ids: list, streams: list) -> pa.RecordBatch:
            tokens = np.concatenate([s[0] for s in streams])
            skip = np.cumsum([0] + [len(s[0]) for s in streams])
            at = np.concatenate([s[1] + k for s, k in zip(streams, skip)])
            base_row = np.cumsum([0] + [len(i) for i in ids])
            row = np.concatenate([s[2] + k for s, k in zip(streams, base_row)])
            words, tokens = np.unique(tokens, return_inverse=True)
            numbers, c = word_ids(m.folder, m.first, words)
            c = c[tokens[at]]
            n = int(base_row[-1])
            sums = lambda x: np.bincount(row, weights=x, minlength=n)
            base = sums(np.log10((c + 0.5) / rate))
            model_score = sums(log_probabilities(m, numbers, tokens, at))
            count = np.bincount(row, minlength=n)
            return pa.RecordBatch.from_arrays(
                [pa.chunked_array(ids).combine_chunks() if len(ids) > 1 else ids[0], pa.array(count), pa.array(sums(c > 0).astype(np.int64)),
                 pa.array(np.full(n, m.train_tokens)), pa.array(base), pa.array(model_score), pa.array(10 ** (-model_score / count))],
                names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

        ids, streams, held = [], [], 0
        for batch in batches:
            data, offsets = bv.string_buffers(batch.column(1))
            for a, b, d, o in bv.chunks(data, offsets):
                streams.append(token_stream(d, o, m.order))
                ids.append(batch.column(0).slice(a, b - a))
                held += len(streams[-1][1])
                if held > SCORED_AT_ONCE:
                    yield scored(ids, streams)
                    ids, streams, held = [], [], 0
        if ids:
            yield scored(ids, streams)

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = d.schema["id"].dataType.simpleString()
    out = d.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    return out.select(F.col("id").alias(id_col), *[c for c in out.columns if c != "id"])
