"""Whitening of embeddings: centred, turned to the directions of largest variance, scaled to variance one.

Vectors are quantised to integers. The fit list, each distinct vector once, is stored; exact integer sums give the
means. Tasks reduce their centred rows block by block with QR, so no covariance is ever formed, and their triangular
factors merge up a tree whose nodes stack at most ``FAN_IN`` of them. One factor of the vectors' length squared is left;
its singular values and vectors (:mod:`sonomart.llm.bidiagonal`) are the square roots of the variances and the
directions. A last pass over the fit list measures how far the whitened vectors are from the identity.

Copies collapse in the distinct step, within each task first. What reaches the driver is the sums and one factor for each
length of vectors: at most ``MAX_LENGTHS`` lengths of at most ``MAX_DIMENSIONS``, more is an error.

Defined results
---------------
* Vectors that are null, empty, hold null or non-finite entries, or an entry beyond a long once scaled, take no part.
* Vectors of different lengths know nothing of each other: each length has its own fit.
* Rows that repeat an id, and rows with a null id, each return their rows.
* Variances that rounding cannot tell from zero: ``whitened`` is null. ``explained`` is null if all variances are zero,
  and ``identity_error`` if no component has one. ``deviation`` is null beyond 38 digits.
* A component's sign is arbitrary, and the same for all rows. Empty tables give an empty result. Other columns are
  not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomart.llm.bidiagonal import EPS, largest
from sonomart.operators.staging import stage

SCALE = 256.0
COMPONENTS = 4
FAN_IN = 16
MAX_DIMENSIONS, MAX_LENGTHS = 2048, 64
BLOCK_BYTES = 4 << 20
_LONG = float(1 << 63)
_SAFE = 1 << 62


@dataclass
class Fit:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    directions: np.ndarray | None = None  # rows
    variances: np.ndarray | None = None  # zero where rounding cannot tell
    trace: float = 0.0
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n`` with the whole part taken off in integers."""
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])
        if len(x) and float(np.abs(x.astype(float)).max()) >= _SAFE // 2:
            return (x.astype(np.longdouble) - np.array(whole, dtype=np.longdouble) - rest).astype(float)
        return (x - np.array(whole, np.int64)) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN in components without variance."""
        scale = np.where(self.variances > 0, np.sqrt(self.variances), np.nan)
        return self.centred(x) @ self.directions.T / scale

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of ``(n * x - sums) ** 2``, exact."""
        most = self.n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in self.sums)
        if x.shape[1] * most * most < _SAFE:
            off = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(38, 0))
        exact = ((x.astype(object) * self.n - np.array(self.sums, dtype=object)) ** 2).sum(axis=1)
        return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, x) of the vectors that take part; ``x`` holds floor(SCALE * entry) as longs."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < _LONG)))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def _by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for every length of the lists."""
    offsets = column.offsets.to_numpy()
    flat, starts, lengths = column.flatten().to_numpy(), offsets[:-1] - offsets[0], np.diff(offsets)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        if length:
            yield length, rows, flat[starts[rows][:, None] + np.arange(length)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of a task's vectors; place -1 has their number."""
    held: dict[int, list[int]] = {}
    for batch in batches:
        for length, rows, x in _by_length(batch.column("x")):
            safe = len(rows) * max(abs(int(x.min())), abs(int(x.max()))) < _SAFE
            found = [len(rows), *(int(s) for s in (x if safe else x.astype(object)).sum(axis=0))]
            held[length] = [p + s for p, s in zip(held[length], found)] if length in held else found
    for length, found in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([length] * len(found), pa.int32()), pa.array(range(-1, length), pa.int32()),
             pa.array([Decimal(s) for s in found], pa.decimal128(38, 0))], names=["dim", "place", "s"])


def _triangle(rows: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))]) if len(r) < r.shape[1] else r


def _factors(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in _by_length(batch.column("x")):
                block = max(2 * length, BLOCK_BYTES // (8 * length))
                for at in range(0, len(x), block):
                    rows = fits[length].centred(x[at:at + block])
                    held[length] = _triangle(np.vstack([held[length], rows]) if length in held else rows)
        node = TaskContext.get().partitionId()
        for length, r in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([node], pa.int64()),
                                              pa.array([r.tobytes()], pa.binary())], names=["dim", "node", "r"])
    return run


_FACTOR = "dim int, node long, r binary"


def _stacked(group: pd.DataFrame) -> pd.DataFrame:
    dim = int(group["dim"].iloc[0])
    rows = np.vstack([np.frombuffer(r).reshape(dim, dim) for r in group["r"]])
    return pd.DataFrame({"dim": [dim], "node": group["node"].iloc[:1].to_numpy(), "r": [_triangle(rows).tobytes()]})


def _moments(fits: dict[int, Fit]):
    """Sums of the whitened vectors and of their products, by length; place 0 has their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, rows, x in _by_length(batch.column("x")):
                w = fits[length].whitened(x)[:, fits[length].variances > 0]
                held[length] = held.get(length, 0) + np.concatenate([[len(rows)], w.sum(axis=0), (w.T @ w).ravel()])
        for length, found in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([length] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()),
                                              pa.array(found)], names=["dim", "place", "s"])
    return run


def _gathered(rows: DataFrame) -> dict[int, list]:
    """Sums by (dim, place), in order of place; at most MAX_LENGTHS times MAX_DIMENSIONS numbers."""
    out: dict[int, list] = {}
    for dim, _, s in rows.groupBy("dim", "place").agg(F.sum("s").alias("s")).orderBy("dim", "place").collect():
        out.setdefault(dim, []).append(s)
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> dict[int, Fit]:
    """The fit of every length of vectors, over each distinct vector once."""
    distinct = stage(quantised(vectors, id_col, vector_col).select("x").distinct(), "whitening-distinct")
    bound = distinct.select(F.size("x").alias("dim")).distinct()
    lengths = [r.dim for r in bound.limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS or max(lengths, default=0) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths, or longer than {MAX_DIMENSIONS}")
    fits = {dim: Fit(int(s[0]), [int(x) for x in s[1:]])
            for dim, s in _gathered(distinct.mapInArrow(_sums, "dim int, place int, s decimal(38,0)")).items()}
    factors = stage(distinct.mapInArrow(_factors(fits), _FACTOR), "whitening-factors")
    nodes = (factors.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        factors = factors.withColumn("node", F.col("node") % nodes).groupBy("dim", "node").applyInPandas(_stacked, _FACTOR)
    for dim, _, r in factors.collect():
        one, matrix = fits[dim], np.frombuffer(r).reshape(dim, dim)
        squares, one.directions = largest(matrix, components)
        real = np.sqrt(squares) > dim * EPS * np.sqrt(squares.max(initial=0))
        one.variances = np.where(real, squares, 0.0) / one.n
        one.trace = float((matrix * matrix).sum()) / one.n
    for dim, found in _gathered(distinct.mapInArrow(_moments(fits), "dim int, place int, s double")).items():
        n, m = found[0], int((fits[dim].variances > 0).sum())
        mean, products = np.array(found[1:m + 1]) / n, np.array(found[m + 1:]).reshape(m, m) / n
        if m:
            fits[dim].identity_error = float(np.abs(products - np.outer(mean, mean) - np.eye(m)).max())
    return fits


_ROWS = ("vec_id {id}, component int, n long, deviation decimal(38,0), whitened double, explained double, variance double, "
         "identity_error double")


def _applied(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in _by_length(batch.column("x")):
                one = fits[length]
                count, m = len(rows), len(one.variances)
                again = pa.array(np.repeat(np.arange(count), m))
                explained = one.variances / one.trace if one.trace > 0 else np.full(m, np.nan)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(rows)).take(again), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * m, one.n)), one.deviations(x).take(again),
                    pa.array(one.whitened(x).ravel(), from_pandas=True), pa.array(np.tile(explained, count), from_pandas=True),
                    pa.array(np.tile(one.variances, count)), pa.array([one.identity_error] * (count * m), pa.float64())],
                    names=[c.split()[0] for c in _ROWS.split(", ")])
    return run


def apply(vectors: DataFrame, fits: dict[int, Fit], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for every vector and component: its whitened coordinate and what the fit knows of the component.

    Vectors must have lengths that ``fits`` knows.
    """
    rows = quantised(vectors, id_col, vector_col)
    return rows.mapInArrow(_applied(fits), _ROWS.format(id=rows.schema["vec_id"].dataType.simpleString()))
