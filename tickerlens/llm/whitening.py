"""Operator 12: whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, x = floor(scale * c) + offset, and the covariance V is that of the
distinct integer vectors. Its largest eigenpairs are found without ever forming V: a block Q
of columns is filtered by a Chebyshev polynomial of V, which a three-term recurrence builds
from products V Q = Xc' (Xc Q) / n, each one distributed pass over the centred vectors. The
polynomial stays within 1 on the unwanted spectrum, between a lower bound (from Lanczos steps,
which are passes as well) and the block's smallest Ritz value, and grows fast above it. QR and
Rayleigh-Ritz follow; the rounds end when every wanted pair has a residual |V u - e u| near
rounding, the certificate. The last column of the block is drawn anew each round, so that a
direction missed by the start would still show.

A pass sends d x b numbers to each task and takes back d rows, summed per row with partial
aggregation: both are bounded by the dimension, not by the data.

Cases: rows whose vector is null or holds null or non-finite entries leave; vectors of another
length than most have (of equally frequent lengths, the longest) leave as well, and so do empty
ones; repeated ids and vectors stay rows of their own, while equal vectors are fitted once;
integers stop at +-2^52. Components whose variance is not above rounding (1e-13 of the trace)
don't exist: fewer rows come out, none if all vectors are equal. Where a deviation is beyond a
long it is null. An empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.tables import stored
from tickerlens.session import ensure_shipped

LARGEST = float(2**52)
RANK_TOL = 1e-13  # of the trace
LANCZOS_STEPS = 10
MOST_DEGREE = 24
MOST_GAIN = 1e8  # between the block's columns in one filter, so that QR keeps the weaker ones
TIGHT, LOOSE = 1e-14, 1e-9  # residual over the largest eigenvalue: done; fair when it no longer falls
MOST_ROUNDS = 60
ROWS_PER_BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    """A fit: n vectors, integer sums, mean less offset, eigenvectors as columns, eigenvalues."""
    n: int
    sums: tuple[int, ...]
    offset: int
    mean: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float
    passes: int


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, x array<long> less the offset) of the rows that take part."""
    ok = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~F.exists(
        F.col(vector_col), lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    entry = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(c.cast("double") * scale).cast("double"))).cast("long")
    rows = table.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, entry).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "d"))["d"]).first()[0]
    return rows.where(F.size("x") == F.lit(most or 0))


def _blocks(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    for i in range(0, len(flat), ROWS_PER_BLOCK):
        yield flat[i:i + ROWS_PER_BLOCK]


class Passes:
    """Distributed passes over the stored distinct vectors."""

    def __init__(self, fit: DataFrame, d: int, n: int, mean: np.ndarray):
        self.fit, self.d, self.n, self.mean, self.count = fit, d, n, mean, 0
        ensure_shipped(fit.sparkSession)

    def _sum(self, body, width: int) -> np.ndarray:
        """Sum over all blocks of body(centred block), a (rows, width) matrix."""
        d, mean = self.d, self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for x in _blocks(b.column(0), d):
                    part = body(x - mean)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32())] + [pa.array(total[:, j]) for j in range(width)],
                                                 names=["i"] + [f"c{j}" for j in range(width)])
        self.count += 1
        rows = self.fit.mapInArrow(run, "i int, " + ", ".join(f"c{j} double" for j in range(width)))
        got = rows.groupBy("i").agg(*[F.sum(f"c{j}") for j in range(width)]).orderBy("i").collect()  # d rows
        return np.array([r[1:] for r in got], dtype=np.float64).reshape(-1, width)

    def product(self, q: np.ndarray) -> np.ndarray:
        """V Q."""
        return self._sum(lambda x: x.T @ (x @ q), q.shape[1]) / self.n

    def trace(self) -> float:
        return float(self._sum(lambda x: (x * x).sum(axis=0)[:, None], 1).sum()) / self.n

    def covariance_error(self, w: np.ndarray) -> float:
        """Largest entry of the whitened vectors' covariance (centred) less the identity."""
        k = w.shape[1]

        def body(x):
            y = x @ w
            return np.vstack([y.T @ y, y.sum(axis=0)[None]])
        got = self._sum(body, k) / self.n
        return float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max())


def lower_bound(passes: Passes, rng: np.random.Generator) -> float:
    """A bound from below for the spectrum, from Lanczos steps with full reorthogonalisation."""
    d = passes.d
    basis, alphas, betas = [], [], []
    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    for _ in range(min(LANCZOS_STEPS, d)):
        basis.append(v)
        w = passes.product(v[:, None])[:, 0]
        alphas.append(float(v @ w))
        b = np.array(basis)
        for _ in range(2):
            w = w - b.T @ (b @ w)
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * max(map(abs, alphas)):
            break
        v = w / betas[-1]
    t = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    if len(alphas) < min(LANCZOS_STEPS, d):  # an invariant space: other eigenvalues may lie lower
        return 0.0
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - betas[-1])


def chebyshev(passes: Passes, q: np.ndarray, degree: int, low: float, high: float) -> np.ndarray:
    """The Chebyshev polynomial of V, mapped so that [low, high] goes to [-1, 1], on Q."""
    half, middle = (high - low) / 2, (high + low) / 2
    before, now = q, (passes.product(q) - middle * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (passes.product(now) - middle * now) / half - before
        scale = np.abs(now).max(axis=0)
        scale[scale == 0] = 1
        before, now = before / scale, now / scale  # the recurrence is linear in each column
    return now


def _degree(values: np.ndarray, wanted: int, low: float, high: float) -> int:
    """Degree of the next filter: the gain of the first column over the last wanted one is bounded."""
    at = lambda e: math.acosh(max(1.0, (2 * e - high - low) / (high - low)))
    spread = at(values[0]) - at(values[wanted - 1])
    return max(2, min(MOST_DEGREE, int(math.log(MOST_GAIN) / spread) if spread > 0 else MOST_DEGREE))


def eigenpairs(passes: Passes, k: int, trace: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """(values falling, vectors as columns, largest residual over the first value) of the k
    largest eigenpairs whose value is above rounding."""
    d, rng = passes.d, np.random.default_rng(seed)
    block = min(d, 2 * k + 1)
    low = lower_bound(passes, rng) if block < d else 0.0
    q = np.linalg.qr(rng.standard_normal((d, block)))[0]
    last, values, residual = math.inf, np.zeros(0), 0.0
    for round_ in range(MOST_ROUNDS):
        z = passes.product(q)  # Rayleigh-Ritz on the block
        h = q.T @ z
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, z = q @ u, z @ u
        wanted = min(k, int((e > RANK_TOL * trace).sum()))
        if not wanted:
            break
        values, residual = e[:wanted], float(np.linalg.norm(z[:, :wanted] - q[:, :wanted] * e[:wanted], axis=0).max() / e[0])
        # certified: at rounding, or small and no longer falling
        if residual <= TIGHT or round_ > 1 and residual <= LOOSE and residual > last / 2:
            break
        last = residual
        if block < d:
            high = max(float(e[-2]), low + 1e-12 * e[0])  # of the kept columns; the last is a fresh one
            if high >= e[0] * (1 - 1e-14):  # a flat spectrum: every vector is an eigenvector
                high = (low + e[0]) / 2
            q[:, -1] = rng.standard_normal(d)
            q = chebyshev(passes, q, _degree(e, wanted, low, high), low, high)
        q = np.linalg.qr(q / np.linalg.norm(q, axis=0))[0]
    else:
        raise ArithmeticError(f"eigenvectors not certified after {MOST_ROUNDS} rounds: residual {residual:.1e}")
    return values, q[:, :len(values)], residual


def fit(vectors: DataFrame, offset: int, components: int, seed: int = 0) -> Whitening | None:
    """Fit on the distinct ``x`` of ``vectors`` (arrays of one length, less the offset); None
    where nothing varies."""
    distinct = stored(vectors.select("x").distinct(), "whitening-fit")
    first = distinct.first()
    if first is None:
        return None
    d = len(first[0])
    # exact sums, beyond a long if need be
    sums = distinct.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")) for i in range(d)]).alias("s")).first()
    n, s = sums["n"], [int(v) for v in sums["s"]]
    mean = np.array([si / n for si in s])
    passes = Passes(distinct, d, n, mean)
    trace = passes.trace()
    if not trace > 0:
        return None
    values, q, residual = eigenpairs(passes, min(components, d), trace, seed)
    error = passes.covariance_error(q / np.sqrt(values))
    return Whitening(n, tuple(v + n * offset for v in s), offset, mean, q, values, trace, error, residual, passes.count)


def deviations(x: np.ndarray, n: int, s: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - s)^2 of each row, exact; ``x`` and ``s`` less the offset."""
    reach = float(np.abs(x).max()) * n + float(np.abs(np.array(s, dtype=np.float64)).max())
    if reach < 2**52 and reach * reach * x.shape[1] < 2**62:
        y = n * x - np.array(s, dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = [sum((n * int(v) - si) ** 2 for v, si in zip(row, s)) for row in x]
    return [v if v < 2**63 else None for v in exact]


def transform(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    ensure_shipped(vectors.sparkSession)
    d, k, n = len(model.mean), len(model.values), model.n
    s = [v - n * model.offset for v in model.sums]
    mean, w = model.mean, model.vectors / np.sqrt(model.values)
    explained, error = model.values / model.trace, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, at = b.column(0), 0
            for x in _blocks(b.column(1), d):
                m = len(x)
                repeat = np.repeat(np.arange(at, at + m), k)
                dev = pa.array(deviations(x, n, s), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(repeat)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                     dev.take(pa.array(repeat - at)), pa.array(((x - mean) @ w).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
                at += m
    return vectors.select("vec_id", "x").mapInArrow(run, schema)


def whiten(table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000,
           components: int = 16, seed: int = 0) -> DataFrame:
    """``transform`` of the rows of ``table`` that take part, by the fit on them."""
    vectors = stored(integer_vectors(table, id_col, vector_col, scale, offset), "whitening-vectors")
    return transform(vectors, fit(vectors, offset, components, seed))
