"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers ``x = floor(scale * c) + shift``. The leading eigenvectors of
their covariance are found without forming it: a block of ``COMPONENTS`` and ``GUARD`` more
columns Q is multiplied by passes over the data, each one Spark job whose tasks sum
``Xc'(Xc Q)`` for their rows, with Xc centred (by whole numbers first) before it is
multiplied. Between Rayleigh-Ritz steps the scaled three-term recurrence of the Chebyshev
polynomials damps the spectrum from 0 to the block's least Ritz value; then QR, and the
small eigenproblem of Q'VQ. The residuals ``|Vq - eq|`` certify the pairs: iteration ends
when each is below ``TOLERANCE`` of the largest eigenvalue and, over the gap to the next
Ritz values, below ``VECTOR_TOLERANCE``, or when rounding keeps them from falling further.

A pass sends one row per dimension to the driver, summed before that by dimension; Q has
dimensions x block entries. Neither grows with the rows. The vectors are stored once, as
numbers less the rounded mean, and passes read that table.

Defined results: a row whose vector is null, or holds a null or non-finite entry, is dropped;
so is one whose length differs from the most common length (of equally common ones, the
longer), as it lacks entries; an empty vector has none. Entries beyond +-``LARGEST`` count as
``LARGEST``, so their sums stay exact. Repeated rows and ids are rows of their own. A component
without variance (fewer than 8 distinct directions, one row) has whitened 0.0 and explained
0.0 and no part in ``identity_error``. An exact ``deviation`` beyond a long is null in the
query, and whole in the operator's decimal ``_deviation``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, LongType, StructField, StructType

from tessera.llm.common import python_tasks, stored, table

SCALE, SHIFT = 1024.0, 100_000
LARGEST = 2.0 ** 30
COMPONENTS, GUARD = 8, 24
#: Degree of the polynomial between two Rayleigh-Ritz steps, and steps at most.
DEGREE, STEPS = 8, 60
TOLERANCE, VECTOR_TOLERANCE = 1e-13, 1e-11


class Whitening(NamedTuple):
    """``n`` rows with ``sums`` by dimension; unit ``vectors`` as columns by falling ``values``; ``trace`` of the covariance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def whole_numbers(rows: DataFrame, vector: str, columns: list[str]) -> tuple[DataFrame, int]:
    """(_row, _x array<bigint>) of the rows whose vector is whole, and its length."""
    v = F.col(vector)
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    found = rows.filter(F.coalesce(sound, F.lit(False)))
    widths = found.groupBy(F.size(v).alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("width").desc()).limit(1).collect()
    width = widths[0]["width"] if widths else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = _matrix(batch.column("_v"), width, np.float64) if width else np.zeros((0, 0))
            x = np.floor(SCALE * np.clip(c, -LARGEST, LARGEST)).astype(np.int64) + SHIFT
            yield pa.RecordBatch.from_arrays([batch.column("_row"), _lists(x, pa.int64())], names=["_row", "_x"])

    picked = found.filter(F.size(v) == width).select(F.struct(*columns).alias("_row"), v.cast("array<double>").alias("_v"))
    return picked.mapInArrow(run, StructType([picked.schema["_row"], StructField("_x", ArrayType(LongType()))])), width


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1), kind))


def _sums(rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], kind: str, names: list[str], column: str = "_x") -> np.ndarray:
    """Sum over all rows of ``part`` (rows' matrix -> one row per dimension): added by dimension before the driver sees it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column(0), width, np.int64 if column == "_x" else np.float64))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), *(pa.array(np.ascontiguousarray(c)) for c in total.T)], names=["at", *names])

    partial = rows.select(column).mapInArrow(run, f"at bigint, {', '.join(f'{c} {kind}' for c in names)}")
    found = partial.groupBy("at").agg(*[F.sum(c).alias(c) for c in names]).collect()
    out = np.zeros((len(found), len(names)), np.int64 if kind == "bigint" else np.float64)
    for r in found:
        out[r["at"]] = r[1:]
    return out


def _span(columns: np.ndarray) -> np.ndarray:
    return np.linalg.qr(columns)[0]


def leading(multiply: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, guard: int = GUARD, degree: int = DEGREE, steps: int = STEPS, seed: int = 7):
    """(vectors, values, residuals, passes) of the ``wanted`` leading eigenpairs of the matrix behind ``multiply``."""
    block = min(width, wanted + guard)
    q, passes, best = _span(np.random.default_rng(seed).standard_normal((width, block))), 0, None
    stalled = 0
    for _ in range(steps):
        y = multiply(q)
        passes += 1
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, y = q @ turn, y @ turn
        residuals = np.linalg.norm(y - q * values, axis=0)
        top = max(values[0], 0.0)
        near = np.abs(values[:wanted, None] - values[None, :])
        np.fill_diagonal(near, np.inf)
        # equal eigenvalues have no vectors of their own; their span is certified by the residual
        gaps = np.maximum(near.min(axis=1), 1e-6 * top) if block > 1 else np.full(wanted, np.inf)
        worst = float(residuals[:wanted].max())
        if best is None or worst < best[0]:
            stalled = 0 if best is None or worst < 0.5 * best[0] else stalled + 1
            best = (worst, q[:, :wanted], values[:wanted], residuals[:wanted])
        else:
            stalled += 1
        if block == width or top == 0.0 or (worst <= TOLERANCE * top and float((residuals[:wanted] / gaps).max()) <= VECTOR_TOLERANCE) or (stalled >= 2 and worst <= 1e-10 * top):
            break
        # scaled Chebyshev recurrence on [0, b]: 1 at the largest Ritz value, so nothing overflows
        b = max(float(values[-1]), 1e-12 * top)
        half = b / 2
        sigma = first = half / (top - half)
        before, now = q, (y - half * q) * (first / half)
        for _ in range(degree - 1):
            nxt = 1 / (2 / first - sigma)
            before, now = now, (multiply(now) - half * now) * (2 * nxt / half) - sigma * nxt * before
            passes += 1
            sigma = nxt
        q = _span(now)
    return best[1], best[2], best[3], passes


def fit(x: DataFrame, width: int, wanted: int = COMPONENTS) -> Whitening:
    """``x``: stored (_x array<bigint>) rows of ``width`` entries."""
    if not width:
        return Whitening(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0), 0)
    first = _sums(x, width, lambda m: np.concatenate([np.column_stack([m.sum(axis=0), np.zeros(width, np.int64)]), [[0, len(m)]]]), "bigint", ["total", "n"])
    n, sums = int(first[width, 1]), first[:width, 0]
    whole, part = np.divmod(sums, n)  # the mean: a whole number and a fraction
    part = part / n

    def centred(m: np.ndarray) -> np.ndarray:
        return (m - whole).astype(np.float64) - part

    def multiply(q: np.ndarray) -> np.ndarray:
        def tasks(m: np.ndarray) -> np.ndarray:
            c = centred(m)
            return c.T @ (c @ q)
        return _sums(x, width, tasks, "double", [f"q{k}" for k in range(q.shape[1])]) / n

    trace = float(_sums(x, width, lambda m: (centred(m) ** 2).sum(axis=0)[:, None], "double", ["square"]).sum()) / n
    vectors, values, residuals, passes = leading(multiply, width, min(wanted, width))
    values = np.where(values > 1e-12 * max(trace, 1e-300), values, 0.0)
    return Whitening(n, sums, vectors, values, trace, residuals, passes)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Exact sums of (n * x - sums)^2 by row: as longs where they fit, else by Python's whole numbers."""
    d = n * (x - sums // n) - sums % n
    rough = (d.astype(np.float64) ** 2).sum(axis=1)
    if len(rough) == 0 or rough.max() < 2.0 ** 62:
        return (d * d).sum(axis=1).tolist()
    return [sum(v * v for v in r) for r in d.tolist()]


def whiten(x: DataFrame, width: int, found: Whitening) -> DataFrame:
    """``_row``, decimal ``_deviation`` and ``_whitened`` (array by component) of the rows of ``x``."""
    n, sums = found.n, found.sums
    whole, part = np.divmod(sums, max(n, 1))
    scaled = found.vectors * np.where(found.values > 0, 1 / np.sqrt(np.where(found.values > 0, found.values, 1.0)), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal
        for batch in batches:
            m = _matrix(batch.column("_x"), width, np.int64) if width else np.zeros((0, 0), np.int64)
            w = ((m - whole).astype(np.float64) - part / max(n, 1)) @ scaled
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([Decimal(v) for v in _deviations(m, n, sums)], pa.decimal128(38, 0)), _lists(w, pa.float64())],
                                             names=["_row", "_deviation", "_whitened"])

    kind = StructType([x.schema["_row"], StructField("_deviation", DecimalType(38, 0)), StructField("_whitened", ArrayType(DoubleType()))])
    return x.mapInArrow(run, kind)


def identity_error(whitened: DataFrame, found: Whitening) -> float:
    """Largest entry of the whitened rows' own covariance less the identity."""
    width = len(found.values)
    if not found.n or not (found.values > 0).any():
        return 0.0
    total = _sums(whitened, width, lambda w: np.concatenate([w.T @ w, w.sum(axis=0)[None, :]]), "double", [f"w{k}" for k in range(width)], "_whitened") / found.n
    mean = total[width]
    left = np.abs(total[:width] - np.outer(mean, mean) - np.eye(width))
    keep = found.values > 0
    return float(left[np.ix_(keep, keep)].max())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    x, width = whole_numbers(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", ["vec_id"])
    x = stored(x)
    found = fit(x, width)
    rows = whiten(x, width, found)
    error = identity_error(rows, found)
    explained = found.values / found.trace if found.trace > 0 else np.zeros(len(found.values))
    each = F.explode(F.arrays_zip(F.sequence(F.lit(1), F.size("_whitened")).alias("k"), F.col("_whitened").alias("w"),
                                  F.array(*[F.lit(float(e)) for e in explained]).cast("array<double>").alias("e"))).alias("c")
    return rows.select("_row", "_deviation", each).select(
        F.col("_row.vec_id").alias("vec_id"), F.col("c.k").cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"),
        F.expr("try_cast(_deviation AS bigint)").alias("deviation"), F.col("c.w").alias("whitened"), F.col("c.e").alias("explained"),
        F.lit(error).alias("identity_error"))
