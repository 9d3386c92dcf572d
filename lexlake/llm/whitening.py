"""Embedding whitening by mixed-precision refinement.

The covariance is summed up over all tasks in whole numbers, so it does not depend on
how the rows are dealt. Its eigenvectors are found in single precision and corrected by
Ogita-Aishima iterations, which are matrix products in extended precision; eigenvalues
too close to be told apart there are parted by an eigenproblem of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lexlake.llm.vectors import finite
from lexlake.workspace import materialize

#: Steps a unit of an entry; components returned.
STEPS, COMPONENTS = 256, 4
#: Entries are whole steps; beyond this a double no longer tells neighbours apart.
LARGEST = float(1 << 53)
LEAST_ROUNDS, ROUNDS = 4, 12
WIDE = np.longdouble


# --- eigenvectors -----------------------------------------------------------------------


def clusters(values: np.ndarray, least_gap: float) -> list[np.ndarray]:
    """Runs of positions, by falling value, whose neighbours lie within ``least_gap``."""
    order = np.argsort(-values, kind="stable")
    breaks = np.flatnonzero(-np.diff(values[order]) > least_gap) + 1
    return np.split(order, breaks)


def refine(a: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a``, from approximate vectors.

    Each round takes the residuals R = I - X'X and S = X'AX and turns the vectors by
    E, with E_ij = (S_ij + l_j R_ij) / (l_j - l_i) for values that R and S tell apart.
    Within a cluster of others only R_ij / 2 is known; there a cluster's own small
    matrix, with the common value taken off, is solved and its vectors are turned.
    Rounds end when, after the first few, the residuals no longer fall by half.
    """
    a, x = a.astype(WIDE), start.astype(WIDE)
    eye, norm = np.eye(len(a), dtype=WIDE), float(np.linalg.norm(a.astype(np.float64), 2))
    last = math.inf
    for k in range(ROUNDS if norm else 0):
        r, s = eye - x.T @ x, x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = (s - np.diag(values)).astype(np.float64)
        blur = 2 * (float(np.linalg.norm(off, 2)) + norm * float(np.linalg.norm(r.astype(np.float64), 2)))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > blur
        x = x + x @ np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        for g in clusters(values.astype(np.float64), blur):
            if len(g) > 1:
                part, middle = x[:, g], values[g].mean()
                small = part.T @ (a @ part - middle * part)
                _, turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))
                x[:, g] = part @ turn.astype(WIDE)
        if k >= LEAST_ROUNDS and blur > last / 2:
            break
        last = blur
    for _ in range(2):  # right angles to the last digit, by matrix products again
        x = x + x @ (eye - x.T @ x) / 2
    values = np.diag(x.T @ a @ x) / np.einsum("ij,ij->j", x, x)
    return values, x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors: single precision first, then refined."""
    scale = float(np.abs(a).max()) or 1.0
    _, rough = np.linalg.eigh((a / scale).astype(np.float32))
    values, vectors = refine(a / scale, rough)
    order = np.argsort(-values.astype(np.float64), kind="stable")
    return values[order].astype(np.float64) * scale, vectors[:, order].astype(np.float64)


# --- sums over tasks ---------------------------------------------------------------------


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def whole_product(y: np.ndarray) -> np.ndarray:
    """y'y exactly: by floating point where all sums are whole doubles, else by integers."""
    top = int(np.abs(y).max()) if y.size else 0
    if top * top * len(y) < 1 << 53:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T.dot(y)


def summed(rows: DataFrame, column: str, make: Callable[[], Callable], shape: tuple[int, ...], kind: str) -> np.ndarray:
    """Add up over all rows what ``make()`` returns for the matrix of a batch.

    Each task sends one number for each entry; Spark adds them, and the driver gets an
    array of ``shape``, which depends on the vectors' length only.
    """
    schema = StructType.fromDDL(f"at int, value {kind}")
    arrow, size, exact = to_arrow_schema(schema), math.prod(shape), kind.startswith("decimal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, apply = None, make()
        for batch in batches:
            if batch.num_rows:
                part = apply(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            flat = np.asarray(total).ravel().tolist()
            values = pa.array([Decimal(int(v)) for v in flat] if exact else flat, arrow.field("value").type)
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), values], schema=arrow)

    sent = rows.select(column).mapInArrow(run, schema)
    out = np.zeros(size, dtype=object if exact else np.float64)
    for r in sent.groupBy("at").agg(F.sum(F.col("value")).alias("value")).collect():
        out[r["at"]] = int(r["value"]) if exact else r["value"]
    return out.reshape(shape)


class Whitening:
    """What a fit leaves: number of vectors, their sums, and components with eigenvalues."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        self.n, self.sums = n, sums
        values, vectors = eigen(covariance)
        self.trace = math.fsum(np.diag(covariance))
        self.values, self.vectors = values[:components], vectors[:, :components]
        # below this a value is rounding, and nothing can be scaled to one
        self.usable = self.values > len(values) * np.finfo(float).eps * max(self.trace, 0.0)
        self.identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([float(Fraction(s, self.n)) for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            out = ((x - mean) @ self.vectors) / np.sqrt(self.values)
        return np.where(self.usable, out, np.nan)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n x - S)^2; null where it does not fit 64 bits."""
        s, top = np.array(self.sums, dtype=object), int(np.abs(x).max()) if x.size else 0
        far = self.n * top + max(map(abs, self.sums), default=0)
        if far * far * x.shape[1] < 1 << 63:
            z = self.n * x.astype(np.int64) - s.astype(np.int64)
            return np.einsum("ij,ij->i", z, z).tolist()
        z = self.n * x.astype(object) - s
        return [int(v) if v < 1 << 63 else None for v in (z * z).sum(axis=1)]


def steps(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, x) with x = floor(256 c) for each entry c, and their number."""
    found, dims = finite(rows, id_col, vec_col)
    small = found.where(F.forall("vec", lambda e: F.abs(e.cast("double") * STEPS) < LARGEST))
    return small.select("id", F.transform("vec", lambda e: F.floor(e.cast("double") * STEPS).cast("long")).alias("x")), dims


def fit(x_rows: DataFrame, dims: int, components: int) -> Whitening | None:
    """Fit on each distinct vector of column ``x`` once."""
    distinct = materialize(x_rows.select("x").distinct(), "whiten-fit")
    n = distinct.count()
    if n == 0:
        return None

    def sums():
        return lambda c: matrix(c, dims).astype(object).sum(axis=0) if len(c) else 0

    total = summed(distinct, "x", sums, (dims,), "decimal(38,0)").tolist()
    # centred at the whole number next to the mean, so that all products are whole;
    # what is left of the mean, at most a half, is taken off exactly
    middle = [round(Fraction(s, n)) for s in total]

    def products():
        m = np.array(middle, dtype=np.int64)
        return lambda c: whole_product(matrix(c, dims) - m)

    square = summed(distinct, "x", products, (dims, dims), "decimal(38,0)")
    rest = [s - n * m for s, m in zip(total, middle, strict=True)]
    covariance = np.array([[float(Fraction(n * square[i, j] - rest[i] * rest[j], n * n)) for j in range(dims)] for i in range(dims)])
    found = Whitening(n, total, covariance, components)
    k = int(found.usable.sum())
    if k:

        def means():
            return lambda c: found.project(matrix(c, dims))[:, :k].sum(axis=0)

        mean = summed(distinct, "x", means, (k,), "double") / n

        def squares():
            def apply(c):
                w = found.project(matrix(c, dims))[:, :k] - mean
                return w.T @ w

            return apply

        found.identity_error = float(np.abs(summed(distinct, "x", squares, (k, k), "double") / n - np.eye(k)).max())
    return found


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    Vectors that are null, empty or hold a null or an entry not finite drop out, as do
    those of another length than the commonest and those with an entry beyond 2^53
    steps. Repeated rows each get theirs, but count once in the fit. There are as many
    components as entries, if fewer. A component without any spread has null for
    whitened and does not count in identity_error, which is null if no component has
    spread; explained is null if the trace is 0. deviation is null beyond 64 bits. A
    null id is a value like others; an empty table gives an empty result.
    """
    # the fit and the last step read it: written once
    all_rows, dims = steps(rows, id_col, vec_col)
    stored = materialize(all_rows, "whiten-steps")
    found = fit(stored, dims, components) if dims else None
    kind = stored.schema["id"].dataType.simpleString()
    schema = StructType.fromDDL(f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found is None:
            return
        k = len(found.values)
        explained = [float(v) / found.trace if found.trace > 0 else None for v in found.values]
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            x = matrix(batch.column(1), dims)
            white = found.project(x).ravel()
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                pa.array([found.n] * (size * k), pa.int64()),
                pa.array([d for d in found.deviation(x) for _ in range(k)], pa.int64()),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained * size, pa.float64()),
                pa.array([found.identity_error] * (size * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return stored.mapInArrow(run, schema).withColumnRenamed("id", id_col)
