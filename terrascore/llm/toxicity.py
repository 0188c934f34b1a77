"""Toxicity by a chain of linear classifiers (op 7).

The chain predicts its categories one after the other; each model sees the
text features and the probabilities of the earlier categories. For training,
those probabilities are out-of-fold predictions, so a later model learns from
estimates as good as it will get at prediction time, not from fitted values.

Categories: the columns of the labels table, ``quality`` (whether a reader rated
the text good) and then ``toxic``, the last of the chain and its verdict.

Features: log counts of hashed words and of hashed 7-byte pieces of text
(which cover inflected forms of a word), of which the most telling ones are
selected by a two-proportion z score; and the log number of words.

Training uses at most ``sample`` labelled documents of at most ``max_chars``
characters, chosen by a hash of their ids; prediction covers every row and its
whole text. The texts stay on the executors: they count each feature's documents,
Spark sums the counts and ranks the features, and only the chosen columns, at most
``SELECTED`` per category, of the sample's rows go to a task that fits the chain.
The driver gets the chosen features and the weights.

Defined results: null or empty text has no features and gets the probability of
an empty text; a document without one of the labels is not learned from; without
any labelled toxic document nothing is judged toxic; equal texts get equal
results, other columns are ignored, whatever their names; a text of any length is
read whole, in chunks; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrascore.llm import bytesvec as bv
from terrascore.llm.common import ship_code, stage_table

#: The labels table's columns, in the chain's order.
CHAIN = ("quality", "toxic")
SAMPLE = 6000
MAX_CHARS = 20_000
FOLDS = 4
BITS = 20
PIECE = 7
#: Features selected per category.
SELECTED = 400
THRESHOLD = 0.5


def text_features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, words per row) of every word and every PIECE-byte run of
    a chunk of texts. Texts are lower-cased (A-Z) first; white space in a run
    counts as one kind."""
    low = bv.lower_az(data)
    starts, lengths, rows = bv.words(low, offsets)
    mask = np.uint64((1 << bits) - 1)
    letters = np.where((low < 128) & ~(((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57))), 32, low).astype(np.uint8)
    lead, lens = _bare(letters, starts, lengths)
    hw = bv.word_hashes(letters, lead[lens > 0], lens[lens > 0])
    word_rows = rows[lens > 0]
    n = len(letters) - PIECE + 1
    if n <= 0:
        pieces, piece_rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    else:
        acc = np.zeros(n, np.uint64)
        for k in range(PIECE):
            acc = acc * np.uint64(257) + letters[k:k + n]
        at = np.arange(n)
        piece_rows = np.searchsorted(offsets, at, side="right") - 1
        whole = at + PIECE <= offsets[piece_rows + 1]
        pieces, piece_rows = bv.mix(acc[whole] + np.uint64(1)), piece_rows[whole]
    feats = np.concatenate([hw & mask, pieces & mask]).astype(np.int64)
    return (np.concatenate([word_rows, piece_rows]), feats,
            np.bincount(rows, minlength=len(offsets) - 1))


def _bare(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without punctuation at their ends."""
    plain = np.concatenate([[0], np.cumsum(letters != 32)])
    inner = plain[starts + lengths] - plain[starts]
    first = np.flatnonzero(letters != 32)
    if not len(first):
        return starts, np.zeros_like(lengths)
    i = np.minimum(np.searchsorted(first, starts), len(first) - 1)
    j = np.maximum(np.searchsorted(first, starts + lengths) - 1, 0)
    return first[i], np.where(inner > 0, first[j] - first[i] + 1, 0)


@dataclass
class Chain:
    """``slot`` maps a hashed feature to its column (-1: unused); ``models``
    holds one weight vector per category: columns, log words, earlier
    categories, bias."""
    slot: np.ndarray
    n_columns: int
    categories: tuple[str, ...]
    models: list[np.ndarray]

    def matrix(self, column: pa.Array) -> np.ndarray:
        data, offsets = bv.string_buffers(column)
        out = np.zeros((len(offsets) - 1, self.n_columns + 1), dtype=np.float32)
        for a, b, d, o in bv.chunks(data, offsets):
            rows, feats, n_words = text_features(d, o)
            cols = self.slot[feats]
            used = cols >= 0
            size = (b - a) * self.n_columns
            counts = np.bincount(rows[used] * self.n_columns + cols[used], minlength=size)[:size]
            out[a:b, :-1] = np.log1p(counts.reshape(b - a, self.n_columns))
            out[a:b, -1] = np.log1p(n_words)
        return out

    def predict(self, column: pa.Array) -> np.ndarray:
        """Probabilities, one column per category in the chain's order."""
        probs = []
        n = len(column)
        for a in range(0, n, 512):
            x = self.matrix(column[a:a + 512])
            for w in self.models:
                p = _sigmoid(x @ w[:x.shape[1]] + w[-1])
                x = np.column_stack([x, _logit(p)])
            probs.append(_sigmoid(x[:, self.n_columns + 1:].astype(np.float64)))
        return np.concatenate(probs) if probs else np.zeros((0, len(self.models)))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)).astype(np.float32)


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 1e-4, rate: float = 0.08) -> np.ndarray:
    """Logistic regression by full-batch Adam; the last weight is the bias."""
    n, d = x.shape
    w = np.zeros(d + 1)
    w[-1] = float(_logit(np.array([max(y.mean(), 1e-3) if len(y) else 1e-3]))[0])
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for t in range(1, steps + 1):
        err = (_sigmoid(x @ w[:-1].astype(np.float32) + w[-1]) - y) / max(n, 1)
        g = np.append(x.T @ err.astype(np.float32) + decay * w[:-1], err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def feature_counts(sample: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """(feature, n0_0, n0_1, n1_0, ...): how many of the sample's documents with
    each feature have each label, by category; the feature -1 counts all. Counted
    per task, then summed by Spark."""
    sides = [f"n{k}_{side}" for k in range(len(categories)) for side in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sides), (1 << BITS) + 1), dtype=np.int32)
        for batch in batches:
            labels = [np.asarray(batch.column(2 + k).to_numpy(zero_copy_only=False)) > 0 for k in range(len(categories))]
            data, offsets = bv.string_buffers(batch.column(1))
            for a, b, d, o in bv.chunks(data, offsets):
                rows, feats, _ = text_features(d, o)
                seen = np.unique(rows * (1 << BITS) + feats)
                rows, feats = seen >> BITS, seen & ((1 << BITS) - 1)
                for k, y in enumerate(labels):
                    for side in (0, 1):
                        hit = y[a + rows] == side
                        total[2 * k + side, :-1] += np.bincount(feats[hit], minlength=1 << BITS).astype(np.int32)
                        total[2 * k + side, -1] += int((y[a:b] == side).sum())
        at = np.flatnonzero(total[0] + total[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(at == 1 << BITS, -1, at), pa.int32()), *[pa.array(t[at], pa.int64()) for t in total]], ["feature", *sides])

    return (sample.mapInArrow(count, "feature int, " + ", ".join(f"{c} long" for c in sides))
            .groupBy("feature").agg(*[F.sum(c).alias(c) for c in sides]))


def select_features(counts: DataFrame, categories: tuple[str, ...], selected: int = SELECTED) -> np.ndarray:
    """The features whose shares among a category's two sides differ most, at most
    ``selected`` per category, by a two-proportion z score above 3."""
    total = counts.where("feature = -1").first()
    if total is None:
        return np.zeros(0, np.int64)
    keep: set[int] = set()
    for k in range(len(categories)):
        neg, pos = (float(max(total[f"n{k}_{side}"], 1)) for side in (0, 1))
        hits, rest = F.col(f"n{k}_1"), F.col(f"n{k}_0")
        both = (hits + rest) / (pos + neg)
        z = F.abs((hits / pos - rest / neg) / F.sqrt(both * (1 - both) * (1 / pos + 1 / neg) + 1e-12))
        best = counts.where((F.col("feature") >= 0) & (hits + rest >= 3)).select("feature", z.alias("z")).where("z > 3")
        keep.update(r["feature"] for r in best.orderBy(F.desc("z"), "feature").limit(selected).collect())
    return np.array(sorted(keep), dtype=np.int64)


def fit_chain(chain: Chain, x: np.ndarray, labels: list[np.ndarray], folds: int = FOLDS) -> Chain:
    """Fit the categories in order over the feature matrix ``x``."""
    fold = np.arange(len(x)) % folds
    for y in labels:
        y = y.astype(np.float32)
        out_of_fold = np.zeros(len(x), dtype=np.float32)
        for k in range(folds):
            held = fold == k
            w = fit_linear(x[~held], y[~held])
            out_of_fold[held] = _logit(_sigmoid(x[held] @ w[:-1].astype(np.float32) + w[-1]))
        chain.models.append(fit_linear(x, y).astype(np.float32))
        x = np.column_stack([x, out_of_fold])
    return chain


def fit_in_task(rows: DataFrame, chain: Chain) -> Chain:
    """``fit_chain`` in one task over the sample's staged rows (id, body, labels): its
    matrix, ``sample`` rows of a few hundred numbers, never comes to the driver."""
    names, width = [c for c in rows.columns if c not in ("id", "body")], chain.n_columns + 1
    shared = rows.sparkSession.sparkContext.broadcast(chain)

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                x = shared.value.matrix(part.column(1))
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, *part.columns[2:]], ["id", "x", *names])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            table = pa.Table.from_batches(held).sort_by("id")  # the same folds on every run
            x = table["x"].combine_chunks().flatten().to_numpy().reshape(-1, width)
            new = Chain(shared.value.slot, width - 1, shared.value.categories, [])  # a worker keeps the shared one
            models = fit_chain(new, x, [table[n].to_numpy() > 0 for n in names]).models
            yield pa.RecordBatch.from_arrays([pa.array(range(len(models)), pa.int32()), pa.array(models, pa.list_(pa.float32()))], ["k", "w"])

    id_type = rows.schema["id"].dataType.simpleString()
    x = rows.mapInArrow(matrix, f"id {id_type}, x array<float>, " + ", ".join(f"{n} int" for n in names))
    models = x.repartition(1).mapInArrow(fit, "k int, w array<float>").orderBy("k").collect()
    if not models:  # nothing to learn from
        return fit_chain(chain, np.zeros((0, width), np.float32), [np.zeros(0, bool) for _ in names])
    chain.models = [np.array(r["w"], np.float32) for r in models]
    return chain


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          categories: tuple[str, ...] | None = None, sample: int = SAMPLE, max_chars: int = MAX_CHARS) -> Chain:
    """Fit on ``sample`` labelled documents at most: the ids first in the order
    of a hash, found without moving any text. ``categories``: 0/1 columns of
    ``labels``, by default those of ``CHAIN`` that it has; several labels of an id
    count as the largest."""
    spark = docs.sparkSession
    categories = categories or tuple(c for c in CHAIN if c in labels.columns)
    ship_code(spark)
    known = labels.select(F.col(id_col).alias("id"), *[F.col(c).cast("int").alias(f"y{k}") for k, c in enumerate(categories)])
    names = [f"y{k}" for k in range(len(categories))]
    known = known.groupBy("id").agg(*[F.max(n).alias(n) for n in names]).dropna()
    picked = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
            .where(F.col("body").isNotNull() & (F.length("body") <= max_chars))
            .join(F.broadcast(picked), "id").groupBy("id").agg(F.min("body").alias("body"), *[F.first(n).alias(n) for n in names]))
    rows = stage_table(rows.limit(sample), "toxicity-sample")
    counts = stage_table(feature_counts(rows, categories), "toxicity-features")
    cols = select_features(counts, categories)
    slot = np.full(1 << BITS, -1, dtype=np.int32)
    slot[cols] = np.arange(len(cols))
    return fit_in_task(rows, Chain(slot, max(len(cols), 1), categories, []))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, a probability per category, ``toxic``."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # fixed size: 2**BITS slots, a few hundred weights
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.predict(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, k]) for k in range(p.shape[1])]],
                                             names=["id", *names])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    schema = f"id {d.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in names)
    out = d.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), *names, (F.col(names[-1]) >= THRESHOLD).alias("toxic"))


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The input rows whose text is not judged toxic, in the input's columns.
    Each text is judged in its own row: nothing is joined or shuffled."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                yield part.filter(pa.array(shared.value.predict(part.column(at))[:, -1] < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
