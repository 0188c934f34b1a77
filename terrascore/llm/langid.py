"""Language identification by a bidirectional gated recurrent network over
bytes (op 4).

The network reads a text's bytes in both directions, labels every position
with a distribution over the languages, and a document's probabilities are the
mean over its positions. Texts are read whole, in windows of ``WINDOW`` bytes
that are worked on side by side, so memory depends on the block of windows and
not on the length of a text. Training is backpropagation through time in
numpy, on pieces of a bounded sample: at most ``per_lang`` documents of each
language, chosen by a hash of their ids, and of each one piece of ``PIECE``
characters. Prediction uses the text alone.

Defined results: null texts and texts without a letter are ``und`` with score
0; equal texts get equal results; rows without a language are never learned
from; if nothing can be learned from, every row is ``und``; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrascore.llm import bytesvec as bv
from terrascore.llm.common import ship_code

HIDDEN = 8
WINDOW = 128
#: Windows worked on side by side.
BLOCK = 1024
PER_LANG = 400
PIECE = 400
STEPS = 700
BATCH = 256
TRAIN_LENGTH = 48
SEED = 7
PAD = 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Direction:
    """One GRU, features by rows and windows by columns. ``x``: byte table
    (3H, 256); ``u``: recurrent weights (3H, H); ``b``: bias of the recurrent
    part. Rows are the reset gate, the update gate and the candidate."""

    def __init__(self, rng: np.random.Generator, hidden: int = HIDDEN):
        self.h = hidden
        self.x = rng.normal(0, 0.3, (3 * hidden, 256)).astype(np.float32)
        self.u = rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden)).astype(np.float32)
        self.b = np.zeros((3 * hidden, 1), dtype=np.float32)

    def step(self, byte: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        n = self.h
        xs = np.take(self.x, byte, axis=1)
        hs = self.u @ h + self.b
        gates = _sigmoid(xs[:2 * n] + hs[:2 * n])
        r, z = gates[:n], gates[n:]
        c = np.tanh(xs[2 * n:] + r * hs[2 * n:])
        return c + z * (h - c), (h, r, z, c, hs[2 * n:])

    def back(self, dh: np.ndarray, kept: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of one step: (previous state, byte rows, u, b)."""
        h, r, z, c, hc = kept
        dc = dh * (1 - z) * (1 - c * c)
        da = np.concatenate([dc * hc * r * (1 - r), dh * (h - c) * z * (1 - z), dc])
        dx = da.copy()
        da[2 * self.h:] *= r
        return dh * z + self.u.T @ da, dx, da @ h.T, da.sum(axis=1, keepdims=True)


class Network:
    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forward, self.backward = Direction(rng), Direction(rng)
        self.out = rng.normal(0, 0.3, (len(languages), 2 * HIDDEN)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        f, b = self.forward, self.backward
        return [f.x, f.u, f.b, b.x, b.u, b.b, self.out, self.bias]

    def gradients(self, bytes_: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients on windows (length, batch) with one label each,
        which holds at every position."""
        length, batch = bytes_.shape
        states, kept = [], []
        for d, order in ((self.forward, range(length)), (self.backward, range(length - 1, -1, -1))):
            h, hs, ks = np.zeros((HIDDEN, batch), np.float32), [None] * length, [None] * length
            for t in order:
                h, ks[t] = d.step(bytes_[t], h)
                hs[t] = h
            states.append(hs)
            kept.append(ks)
        both = np.concatenate([np.stack(states[0]), np.stack(states[1])], axis=1)  # length, 2H, batch
        logits = np.einsum("ck,tkb->tcb", self.out, both) + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        at = np.arange(batch)
        loss = -float(np.log(p[:, y, at] + 1e-9).mean())
        p[:, y, at] -= 1
        p /= length * batch
        grads = []
        dboth = np.einsum("ck,tcb->tkb", self.out, p)
        for k, (d, order) in enumerate(((self.forward, range(length - 1, -1, -1)), (self.backward, range(length)))):
            dh, dxs = np.zeros((HIDDEN, batch), np.float32), np.empty((length, 3 * HIDDEN, batch), np.float32)
            du, db = np.zeros_like(d.u), np.zeros_like(d.b)
            for t in order:
                dh, dxs[t], gu, gb = d.back(dh + dboth[t, k * HIDDEN:(k + 1) * HIDDEN], kept[k][t])
                du += gu
                db += gb
            flat = dxs.transpose(1, 0, 2).reshape(3 * HIDDEN, -1)
            codes = bytes_.reshape(-1)
            dx = np.stack([np.bincount(codes, weights=row, minlength=256) for row in flat]).astype(np.float32)
            grads += [dx, du, db]
        grads += [np.einsum("tcb,tkb->ck", p, both), p.sum(axis=(0, 2))[:, None]]
        return loss, grads

    def fit(self, pieces: list[bytes], y: np.ndarray, steps: int = STEPS, seed: int = SEED) -> float:
        rng = np.random.default_rng(seed)
        by = [np.flatnonzero(y == k) for k in range(len(self.languages))]
        ps = self.parameters()
        m, v = [np.zeros_like(p) for p in ps], [np.zeros_like(p) for p in ps]
        loss = 0.0
        for t in range(1, steps + 1):
            lang = rng.integers(0, len(by), BATCH)  # languages in equal shares
            rows = [by[k][rng.integers(0, len(by[k]))] for k in lang]
            x = np.full((TRAIN_LENGTH, BATCH), PAD, dtype=np.int64)
            for j, r in enumerate(rows):
                at = rng.integers(0, max(1, len(pieces[r]) - TRAIN_LENGTH + 1))
                piece = pieces[r][at:at + TRAIN_LENGTH]
                x[:len(piece), j] = np.frombuffer(piece, dtype=np.uint8)
            loss, grads = self.gradients(x, lang)
            rate = 0.02 * (1 - 0.9 * t / steps)
            for p, g, a, b in zip(ps, grads, m, v):
                np.clip(g, -1, 1, out=g)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return loss

    def windows(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over each window's positions of the positions' probabilities:
        x (WINDOW, n) bytes, lengths (n) -> (languages, n)."""
        length, n = x.shape
        from_end = np.empty((length, len(self.languages), n), np.float32)
        h = np.zeros((HIDDEN, n), np.float32)
        for t in range(length - 1, -1, -1):
            h, _ = self.backward.step(x[t], h)
            from_end[t] = self.out[:, HIDDEN:] @ h
        total = np.zeros((len(self.languages), n), np.float32)
        h = np.zeros((HIDDEN, n), np.float32)
        for t in range(length):
            h, _ = self.forward.step(x[t], h)
            p = np.exp(np.clip(self.out[:, :HIDDEN] @ h + from_end[t] + self.bias, -30, 30))
            total += p * ((lengths > t) / p.sum(axis=0))
        return total

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(language number or -1, probability) of each text."""
        data, offsets = bv.string_buffers(column)
        sizes = np.diff(offsets)
        counts = -(-sizes // WINDOW)
        doc = np.repeat(np.arange(len(sizes)), counts)
        first = np.cumsum(counts) - counts
        starts = offsets[:-1][doc] + (np.arange(len(doc)) - first[doc]) * WINDOW
        lengths = np.minimum(WINDOW, offsets[1:][doc] - starts)
        sums = np.zeros((len(self.languages), len(sizes)))
        step = np.arange(WINDOW)[:, None]
        for a in range(0, len(doc), BLOCK):
            s, n = starts[a:a + BLOCK], lengths[a:a + BLOCK]
            x = data[np.minimum(s + step, len(data) - 1)]
            x[step >= n] = PAD
            p = self.windows(x, n)
            for k in range(len(self.languages)):
                sums[k] += np.bincount(doc[a:a + BLOCK], weights=p[k], minlength=len(sizes))
        best = sums.argmax(axis=0)
        score = sums[best, np.arange(len(sizes))] / np.maximum(sizes, 1)
        letters = np.zeros(len(data) + 1, np.int64)
        low = data | 32
        np.cumsum((low >= 97) & (low <= 122), out=letters[1:])
        plain = letters[offsets[1:]] > letters[offsets[:-1]]
        for i in np.flatnonzero(~plain):  # texts without an ASCII letter: look closer
            if not any(map(str.isalpha, column[int(i)].as_py() or "")):
                best[i], score[i] = -1, 0.0
        return best, np.clip(score, 0.0, 1.0)


def train(docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_lang: int = PER_LANG, steps: int = STEPS) -> Network | None:
    """Learn from the rows where ``learned`` holds; None if there are none."""
    rows = docs.where(learned & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    picked = rows.distinct().withColumn("rank", rank).where(F.col("rank") <= per_lang).select("id", "lang")
    at = F.pmod(F.xxhash64("id", F.lit("piece")), F.greatest(F.length("body") - PIECE + 1, F.lit(1))) + 1
    body = docs.where(learned).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("body"))
    pieces = (body.join(F.broadcast(picked), ["id", "lang"]).where("length(body) > 0")
              .select("id", "lang", F.substr("body", at.cast("int"), F.lit(PIECE)).alias("piece")))
    got = sorted(pieces.groupBy("id", "lang").agg(F.min("piece").alias("piece")).collect())
    got = [(i, lang, p.encode()) for i, lang, p in got if p]
    if not got:
        return None
    languages = sorted({lang for _, lang, _ in got})
    net = Network(languages)
    net.fit([p for _, _, p in got], np.array([languages.index(lang) for _, lang, _ in got]), steps)
    return net


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                if net is None:
                    best, score = np.full(part.num_rows, -1), np.zeros(part.num_rows)
                else:
                    best, score = net.predict(part.column(1))
                names = [net.languages[k] if k >= 0 else "und" for k in best]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                                 names=["id", "lang_pred", "score"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    out = d.mapInArrow(run, f"id {d.schema['id'].dataType.simpleString()}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32(id as text) mod ``folds`` is ``fold`` (a null id: as '')."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold
