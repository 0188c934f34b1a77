"""Embedding whitening (op 13) by weighted multiplicity covariance.

1. Entries become whole numbers; a vector of them is packed into a short exact
   key (its least entry, then the differences in as few bytes as they need).
   Equal vectors have equal keys, so grouping by the key with partial sums leaves
   each distinct vector once with its count as weight.
2. Sums per dimension are exact integers. The covariance is a weighted product
   of centred blocks, one partial matrix per task, added up by Spark. Only the
   sums and the matrix come to the driver: their size is the dimension's.
3. Each distinct vector is whitened once. The few vectors that are a large share
   of all rows (at most ``HOT_SHARE`` of them, by count) join back by broadcast,
   all others by a shuffle on the key, so no task gets a hot vector's rows.

Defined results: a row goes if its vector is null or has a null, NaN, infinite or
too large entry (1024 times it beyond 2^62: no long). Vectors of another length
than the most frequent one (ties: the longer) cannot be in the same fit list and
go too; vectors without entries have no components and give no rows. Rows with
equal or null ids are rows each. A component without variance (eigenvalue at
most ``FLAT`` of the trace) has a null ``whitened`` and no part in the error. A
``deviation`` beyond a long is null. Other columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrascore.llm.common import ship_code, stage_table

#: The contract's scale and offset, components returned.
SCALE, OFFSET, COMPONENTS = 1024, 100000, 8
#: A vector with more than one in so many rows is joined by broadcast.
HOT_SHARE = 1000
FLAT = 1e-13
LARGEST = 2.0 ** 62 / SCALE
WIDTHS = (1, 2, 4, 8)
HEAD = 9  # bytes before the differences: the least entry and the width

OUT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """A fit: rows, exact sums, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def flat(self) -> np.ndarray:
        return self.values <= FLAT * self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, subtracting the whole part exactly first."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.flat, 1.0, np.sqrt(np.maximum(self.values, 0)))
        return self.centred(x) @ self.vectors / np.where(scale > 0, scale, 1.0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n*x - S)^2: in 64 bits where they surely fit."""
        far = max((abs(self.n * int(v) - s) for v, s in [*zip(x.max(axis=0), self.sums), *zip(x.min(axis=0), self.sums)]), default=0)
        most = max(self.n * int(np.abs(x).max(initial=0)), *(abs(s) for s in self.sums))
        if far * far * x.shape[1] < 2 ** 63 and most < 2 ** 62:
            gap = self.n * x - np.array(self.sums, dtype=np.int64)
            return (gap * gap).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 2 ** 63 else None for v in exact]


def usable(vector: Column) -> Column:
    """Whether a vector is there and every entry is a number of fair size."""
    def fine(e: Column) -> Column:
        return e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) <= LARGEST)
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def pack(x: np.ndarray) -> list[bytes]:
    """An exact key per row of whole numbers; equal rows give equal keys."""
    if not x.shape[1]:
        return [b""] * len(x)
    least = x.min(axis=1)
    above = (x - least[:, None]).view(np.uint64)  # below 2^64, whatever the signs
    widths = np.digitize(above.max(axis=1), [np.uint64(1 << 8 * w) for w in WIDTHS[:-1]])
    keys = np.empty(len(x), dtype=object)
    for k in np.unique(widths).tolist():
        at = np.flatnonzero(widths == k)
        head = np.concatenate([least[at, None].astype("<i8").view(np.uint8), np.full((len(at), 1), WIDTHS[k], np.uint8)], axis=1)
        body = above[at].astype(f"<u{WIDTHS[k]}").view(np.uint8).reshape(len(at), -1)
        keys[at] = [row.tobytes() for row in np.concatenate([head, body], axis=1)]
    return keys.tolist()


def unpack(keys: list[bytes], dim: int) -> np.ndarray:
    """The rows of whole numbers that ``pack`` has packed."""
    x = np.empty((len(keys), dim), dtype=np.int64)
    widths = np.array([k[HEAD - 1] for k in keys])
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        rows = np.frombuffer(b"".join(keys[i] for i in at), np.uint8).reshape(len(at), -1)
        least = rows[:, :HEAD - 1].copy().view("<i8")
        above = rows[:, HEAD:].copy().view(f"<u{w}").astype(np.uint64).view(np.int64)
        x[at] = least + above
    return x


def keyed(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, dim, key) of the usable rows."""
    spark = embeddings.sparkSession
    ship_code(spark)
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64) + OFFSET
            starts = np.concatenate([[0], np.cumsum(sizes)])
            keys = np.empty(len(sizes), dtype=object)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                keys[at] = pack(x[starts[at][:, None] + np.arange(dim)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(keys.tolist(), pa.binary())], ["vec_id", "dim", "key"])

    return rows.where(usable(F.col("v"))).mapInArrow(packed, f"vec_id {id_type}, dim int, key binary")


def distinct(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, with its count."""
    return stage_table(rows.groupBy("dim", "key").agg(F.count(F.lit(1)).alias("weight")), "whitening_distinct")


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield unpack(batch.column("key").to_pylist(), dim), batch.column("weight").to_numpy()


def fit(vectors: DataFrame, weighted: bool = True, components: int = COMPONENTS) -> tuple[Whitening | None, DataFrame]:
    """The fit over distinct ``vectors`` (each counts as often as it occurs, or
    once), and the vectors it is for: those of the most frequent length."""
    weight = F.col("weight") if weighted else F.lit(1).cast("long")
    lengths = (vectors.groupBy("dim").agg(F.sum("weight").alias("rows"), F.sum(weight).alias("n"))
               .orderBy(F.desc("rows"), F.desc("dim")).first())
    if lengths is None or not lengths["dim"]:
        return None, vectors.limit(0)
    dim, n = lengths["dim"], int(lengths["n"])
    vectors = vectors.where(F.col("dim") == dim)
    fitted = vectors.select("key", weight.alias("weight"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for x, w in _blocks(batches, dim):
            small = float(np.abs(x).max()) * float(w.sum()) < 2.0 ** 62
            part = w @ x if small else w.astype(object) @ x.astype(object)
            total = [a + int(b) for a, b in zip(total, part)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([decimal.Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "s"])

    sums = fitted.mapInArrow(summed, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    model = Whitening(n, [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])], np.zeros(0), np.zeros((dim, 0)), 0.0)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for x, w in _blocks(batches, dim):
            c = model.centred(x)
            total += (c * w[:, None]).T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([total[i, i:] for i in range(dim)], pa.list_(pa.float64()))], ["i", "row"])

    cells = (fitted.mapInArrow(products, "i int, row array<double>")
             .select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))).toArrow()
    cov = np.zeros((dim, dim))
    i, j = cells["i"].to_numpy(), cells["j"].to_numpy()
    cov[i, i + j] = cov[i + j, i] = cells["v"].to_numpy() / n
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    basis = basis[:, order]
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])] < 0, -1.0, 1.0)
    model.values, model.vectors, model.trace = values[order], basis, float(np.trace(cov))
    return model, vectors


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(key, weight, deviation, whitened) of each distinct vector."""
    dim, flat = len(model.sums), model.flat

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unpack(batch.column("key").to_pylist(), dim)
                z = pa.array(model.project(x).ravel(), mask=np.tile(flat, len(x)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("weight"), pa.array(model.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(flat), z)],
                    ["key", "weight", "deviation", "whitened"])

    return stage_table(vectors.select("key", "weight").mapInArrow(
        apply, "key binary, weight long, deviation long, whitened array<double>"), "whitening_vectors")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the
    identity, means first and centred by them, over components with variance."""
    live = [k for k in range(len(model.values)) if not model.flat[k]]
    if not live:
        return None
    w, n = F.col("weight"), float(model.n)
    cells = whitened.select("weight", *[F.col("whitened")[k].alias(f"c{k}") for k in live])
    mean = cells.agg(*[(F.sum(w * F.col(f"c{k}")) / n).alias(f"c{k}") for k in live]).first()
    off = {k: F.col(f"c{k}") - F.lit(mean[f"c{k}"]) for k in live}
    pairs = [(a, b) for a in live for b in live if a <= b]
    cov = cells.agg(*[(F.sum(w * off[a] * off[b]) / n).alias(f"p{a}_{b}") for a, b in pairs]).first()
    return max(abs(cov[f"p{a}_{b}"] - (a == b)) for a, b in pairs)


def join_back(rows: DataFrame, whitened: DataFrame, n: int) -> DataFrame:
    """Each row with its vector's result."""
    made = whitened.select("key", "deviation", "whitened")
    frequent = F.broadcast(whitened.where(F.col("weight") * HOT_SHARE > n).select("key"))
    hot = F.broadcast(whitened.where(F.col("weight") * HOT_SHARE > n).select("key", "deviation", "whitened"))
    return rows.join(hot, "key").unionByName(rows.join(frequent, "key", "left_anti").join(made, "key"))


def components(embeddings: DataFrame) -> DataFrame:
    """A row per usable row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    rows = stage_table(keyed(embeddings), "whitening_rows")
    out = OUT.format(id=rows.schema["vec_id"].dataType.simpleString())
    model, vectors = fit(distinct(rows))
    if model is None:
        return embeddings.sparkSession.createDataFrame([], out)
    whitened = whiten(vectors, model)
    error = identity_error(whitened, model)
    shares = [float(v) / model.trace if model.trace > 0 else math.nan for v in model.values]
    return (join_back(rows.where(F.col("dim") == len(model.sums)).select("vec_id", "key"), whitened, model.n)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("k") + 1).alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))
