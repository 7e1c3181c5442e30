"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers (``floor(64 * c) + 1000000``), and the fit list is every distinct vector
once, written to the shared folder. Its number n and sums S are exact, so that a centred entry is
the exact integer n * x - S divided once. The covariance is never formed: a pass over the fit list
gives XᵀX Q / n of the centred rows for a block Q of a fixed number of columns.

1. A few Lanczos passes bound the spectrum from below.
2. Each round filters the block by a Chebyshev polynomial in the covariance, a recurrence of one pass
   a degree, which damps all between that bound and the smallest Ritz value of the block; then QR
   and Rayleigh-Ritz.
3. A block is certified when all wanted pairs have residuals |Vq - eq| below ``TOLERANCE`` * e1, and
   a fresh random block orthogonal to them, filtered likewise, holds nothing above the last of them.
   What it holds above joins the block and rounds go on.
4. One more pass measures the covariance of the whitened fit list against the identity.

The driver holds matrices of dimension x block, whatever the number of rows.

Defined results: rows whose vector is null or empty or holds null or non-finite entries are
dropped. All others must be of one dimension: where lengths differ, the most frequent one counts
(the longest of equally frequent ones) and the rest is dropped as not of this space. Null and
repeated ids are kept, a row each. Components of no variance (below 1e-11 of the largest) are left out, so that one distinct
vector, or none, gives no rows. Other columns are ignored. Integers that pass 64 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strucsift.llm.common import field, prepare
from strucsift.session import cut_lineage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Columns of the block: the wanted ones and as many more, which speed up the damping.
GUARD = 16
DEGREE = 10
LANCZOS_STEPS = 8
TOLERANCE = 2e-14
# Rounds may end above the tolerance when residuals stop falling, but never above this.
CERTIFIED = 1e-10
MOST_ROUNDS = 200
# Variance below this share of the largest is rounding.
NO_VARIANCE = 1e-11
SEED = 20_240_611


def integer_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with x, the integer vector; rows without a finite vector of the common dimension go."""
    entries = F.col(vector).cast("array<double>")
    finite = F.coalesce(F.forall(entries, _finite), F.lit(False)) & (F.size(vector) > 0)
    usable = rows.filter(finite)
    common = usable.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is not None:
        usable = usable.filter(F.size(vector) == common["size"])
    x = F.transform(entries, lambda c: F.floor(F.lit(SCALE) * c).cast("bigint") + SHIFT)
    return usable.withColumn("__x", x)


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The integer vectors of a batch, one a row."""
    column = batch.column("__x")
    return column.flatten().to_numpy().reshape(len(column), -1)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    if float(n) * np.abs(x).max(initial=0) >= 2.0**62:
        raise OverflowError("n * x passes 64 bits")
    return n * x - sums


@dataclass
class Fit:
    """The fit list (column __x), its number and its sums."""

    rows: DataFrame
    n: int
    sums: np.ndarray

    def total(self, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over the fit list of what ``of`` gives for blocks of centred vectors: each task
        adds up its own, and tasks are summed by the place in the matrix."""
        n, sums = self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for batch in batches:
                if batch.num_rows:
                    out += of(_deviations(_matrix(batch), n, sums) / n)
            edges = np.arange(0, out.size + 1, shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(shape[0])), pa.ListArray.from_arrays(pa.array(edges), pa.array(out.ravel()))], ["i", "v"])

        cells = (
            self.rows.mapInArrow(run, "i bigint, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        )
        found = np.zeros(shape)
        for i, j, v in cells:
            found[i, j] = v
        return found

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q`` in one pass."""
        return self.total(q.shape, lambda x: x.T @ (x @ q)) / self.n


def fit_list(vectors: DataFrame) -> Fit:
    """Every distinct integer vector once; equal ones meet in partial aggregates before the shuffle."""
    rows = cut_lineage(vectors.select("__x").distinct(), "fit")
    sums = rows.select(F.posexplode("__x").alias("i", "x")).groupBy("i").agg(
        F.sum("x").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    return Fit(rows, sums[0]["n"] if sums else 0, np.array([r["s"] for r in sums], np.int64))


def lower_bound(times: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int) -> float:
    """A bound below the spectrum by Lanczos: the least Ritz value less the last residual."""
    basis, diagonal, beside = [start / np.linalg.norm(start)], [], []
    for _ in range(min(steps, len(start))):
        w = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):
            for q in basis:
                w = w - (q @ w) * q
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(w / beside[-1])
    tri = np.diag(diagonal) + np.diag(beside[:len(diagonal) - 1], 1) + np.diag(beside[:len(diagonal) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(tri)[0]) - beside[-1])


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """``q`` filtered by the Chebyshev polynomial that is small on [low, high], scaled to 1 at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    scale = half / (top - middle)
    rate = scale
    before, now = q, (times(q) - middle * q) * (rate / half)
    for _ in range(degree - 1):
        after_rate = 1 / (2 / scale - rate)
        before, now = now, (times(now) - middle * now) * (2 * after_rate / half) - before * (rate * after_rate)
        rate = after_rate
    return now


def _ritz(q: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values falling, Ritz vectors in the span of ``q``, and their products with the covariance."""
    small = q.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, product @ turn


def principal(times: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int = COMPONENTS, guard: int = GUARD,
              degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns, certified."""
    wanted = min(wanted, dimension)
    block = min(dimension, wanted + guard)
    draw = np.random.default_rng(SEED)
    low = lower_bound(times, draw.standard_normal(dimension), LANCZOS_STEPS) if block < dimension else 0.0
    q = np.linalg.qr(draw.standard_normal((dimension, block)))[0]
    values, q, product = _ritz(q, times(q))
    best, stalled = np.inf, 0
    for _ in range(MOST_ROUNDS):
        top = values[0]
        if top <= 0:
            break
        residual = float(np.linalg.norm(product - q * values, axis=0)[:wanted].max()) / top
        # Without further progress the residual has reached the rounding of the sums.
        stalled = 0 if residual < best / 2 else stalled + 1
        best = min(best, residual)
        if residual <= TOLERANCE or (stalled >= 2 and residual <= CERTIFIED) or block == dimension:
            missed = _missed(times, q, values[wanted - 1], low, draw, degree, top)
            if missed is None:
                break
            q = np.linalg.qr(np.hstack([q, missed]))[0]
            best, stalled = np.inf, 0
        else:
            high = float(values[block - 1])
            q = np.linalg.qr(chebyshev(times, q, min(low, 0.99 * high), high, top, degree))[0]
        values, q, product = _ritz(q, times(q))
        values, q, product = values[:block], q[:, :block], product[:, :block]
    else:
        raise RuntimeError(f"not certified in {MOST_ROUNDS} rounds")
    return values[:wanted], q[:, :wanted]


def _missed(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, least: float, low: float, draw: np.random.Generator,
            degree: int, top: float) -> np.ndarray | None:
    """Directions outside ``q`` whose Ritz value is above ``least``, sought by a fresh filtered block."""
    outside = q.shape[0] - q.shape[1]
    if outside <= 0 or least <= 0:
        return None
    probe = draw.standard_normal((q.shape[0], min(outside, 4)))
    project = lambda y: y - q @ (q.T @ y)
    probe = np.linalg.qr(project(project(probe)))[0]
    if low < least < top:
        probe = chebyshev(lambda y: project(times(y)), probe, low, least, top, degree)
        probe = np.linalg.qr(project(project(probe)))[0]
    values, vectors, _ = _ritz(probe, project(times(probe)))
    above = values > least * (1 + 1e-9)
    return vectors[:, above] if above.any() else None


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Per row with a finite vector and component: the key, component, n, deviation (the squared
    length of n * x - S, exact), whitened (the projection over the standard deviation), explained
    (its share of the variance) and identity_error (of the whole fit)."""
    prepare(rows.sparkSession)
    found = [field("component", "int"), field("n", "bigint"), field("deviation", "bigint"), field("whitened", "double"),
             field("explained", "double"), field("identity_error", "double")]
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), *found])
    vectors = integer_vectors(rows.select(key, vector), vector).select(key, "__x")
    fit = fit_list(vectors)
    if fit.n < 2:
        return rows.sparkSession.createDataFrame([], schema)
    values, q = principal(fit.times, len(fit.sums), components)
    real = values > NO_VARIANCE * max(float(values[0]), 0.0)
    values, q = values[real], q[:, real]
    if not len(values):
        return rows.sparkSession.createDataFrame([], schema)
    turn = q / np.sqrt(values)
    trace = float(fit.total((1, 1), lambda x: np.array([[np.square(x).sum()]]))[0, 0]) / fit.n
    explained = values / trace
    k = len(values)
    whole = fit.total((k, k), lambda x: (x @ turn).T @ (x @ turn)) / fit.n
    error = float(np.abs(whole - np.eye(k)).max())
    n, sums = fit.n, fit.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            away = _deviations(_matrix(batch), n, sums)
            if np.square(away.astype(np.float64)).sum(axis=1).max() >= 2.0**62:
                raise OverflowError("squared deviations pass 64 bits")
            repeat = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(key).take(pa.array(repeat)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), pa.array(np.square(away).sum(axis=1)[repeat]),
                pa.array((away / n @ turn).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ], schema.names)

    return vectors.mapInArrow(run, schema)
