"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Each entry c counts as the integer x = floor(64 c) + 1000000, so that sums are
exact. The covariance V is never formed: the only distributed step is the block
product V Q = Xᵀ(X Q) / n over the centred rows X of the fit list (each distinct
vector once), summed over partitions in a second, dealt step of d x block cells.

1. A short Lanczos run bounds the spectrum.
2. Each round filters a block of vectors by the three-term Chebyshev recurrence
   that damps the interval from the lowest eigenvalue to the block's smallest
   Ritz value, makes it orthonormal (QR), and takes its Ritz vectors.
3. Rounds end when each wanted residual |V q - e q| is below ``tolerance`` of the
   largest eigenvalue, or no longer falls and is below ``certified``. Then a
   Lanczos run on what is orthogonal to the wanted vectors, from a fresh start,
   must find nothing above the last wanted eigenvalue; else its vector joins the
   block and the rounds go on.

Only arrays of d x block numbers reach the driver. The fit list is written once
under the shared checkpoint folder.

Edge cases: rows are dropped if the vector is null, empty, holds a null or
non-finite entry, has an entry of 2**45 or more (64 c would not be exact as a
long), or is not of the commonest length. Repeated rows count once in the fit
and each get their results; a null id stays null. Components whose eigenvalue is
below 1e-10 of the largest have no whitened value and are not returned, so
equal vectors alone, one vector, or an empty table give no rows. Equal
eigenvalues (ties) share a space, of which any basis is right. ``deviation`` is
exact up to 38 digits and null beyond. Other columns do not pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_dir
from .vectors import common_dimension, finite, matrix

SHIFT, SCALE = 1_000_000, 64
_LIMIT = float(1 << 45)
_LOW = (1 << 26) - 1
RANK = 1e-10


def _usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    return vectors.where(finite(vec_col)).where(F.forall(vec_col, lambda c: F.abs(c) < F.lit(_LIMIT)))


def integers(vec_col: str) -> Column:
    return F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))


@dataclass
class Centred:
    """The fit list, read again for each product."""

    rows: DataFrame  # one column x: array<bigint>
    n: int
    sums: list[int]  # exact sum of each dimension

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([(s - int(b) * self.n) / self.n for s, b in zip(self.sums, self.base)])
        self.passes = 0

    def summed(self, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all rows of ``of(centred rows)``, an array of ``shape``."""
        base, rest = self.base, self.rest

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    part = of((matrix(batch.column(0), np.int64) - base).astype(np.float64) - rest)
                    total = part if total is None else total + part
            if total is not None:
                cells = np.arange(total.size)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total.ravel(), pa.float64())], ["cell", "v"])

        self.passes += 1
        got = self.rows.mapInArrow(parts, "cell bigint, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(shape[0] * shape[1])
        out[got.column("cell").to_numpy()] = got.column("v").to_numpy()
        return out.reshape(shape)

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q."""
        return self.summed(q.shape, lambda c: c.T @ (c @ q)) / self.n


def fit_list(vectors: DataFrame, vec_col: str) -> Centred | None:
    """Each distinct integer vector once, its number of rows and exact sums; None without vectors."""
    usable = _usable(vectors, vec_col).select(vec_col)
    d = common_dimension(usable, vec_col)
    if not d:
        return None
    path = scratch_dir(vectors.sparkSession, "fitlist")
    usable.where(F.size(vec_col) == d).select(integers(vec_col).alias("x")).distinct().write.parquet(path)
    rows = vectors.sparkSession.read.parquet(path)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for batch in batches:
            x = matrix(batch.column(0), np.int64).reshape(-1, d)
            high, low, n = high + (x >> 26).sum(0), low + (x & _LOW).sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array([*high.tolist(), n]), pa.array([*low.tolist(), 0])],
                                         ["i", "high", "low"])

    total = {r["i"]: (r["high"], r["low"]) for r in rows.mapInArrow(sums, "i bigint, high bigint, low bigint")
             .groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    return Centred(rows, total[d][0], [(total[i][0] << 26) + total[i][1] for i in range(d)])


def lanczos(times: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int) -> tuple[float, float, np.ndarray]:
    """Lower and upper estimate of the spectrum (outer Ritz values and their residuals), and the top Ritz vector."""
    basis, alpha, beta = [start / np.linalg.norm(start)], [], []
    for _ in range(steps):
        w = times(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):  # whole orthogonalisation, twice
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-13 * max(alpha) or len(basis) == len(start):
            break
        basis.append(w / beta[-1])
    m = len(alpha)
    ritz, z = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:m - 1], 1) + np.diag(beta[:m - 1], -1))
    miss = beta[m - 1] * np.abs(z[-1])
    return float(ritz[0] - miss[0]), float(ritz[-1] + miss[-1]), np.array(basis[:m]).T @ z[:, -1]


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """Chebyshev polynomial of ``degree`` on [low, cut], scaled to 1 at ``top``, applied to the block."""
    half, centre = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (times(q) - centre * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def _ritz(times, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues (falling), vectors and residuals within the space of q."""
    q = np.linalg.qr(np.linalg.qr(q)[0])[0]
    vq = times(q)
    small = q.T @ vq
    e, u = np.linalg.eigh((small + small.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    q, vq = q @ u, vq @ u
    return e, q, np.linalg.norm(vq - q * e, axis=0)


@dataclass
class Whitening:
    """n, exact sums, unit eigenvectors (columns), eigenvalues, trace, largest fault of the whitened covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    residual: float  # largest residual over the largest eigenvalue
    passes: int  # over the fit list


def fit(vectors: DataFrame, vec_col: str = "embedding", k: int = 16, guard: int = 16, degree: int = 8, max_rounds: int = 60,
        tolerance: float = 2e-15, certified: float = 1e-11, seed: int = 7) -> Whitening | None:
    """The first ``k`` components; ``guard`` more vectors make the block. None without vectors or without spread."""
    data = fit_list(vectors, vec_col)
    if data is None:
        return None
    d = len(data.sums)
    trace = float(data.summed((1, d), lambda c: (c * c).sum(0)[None]).sum()) / data.n
    if trace <= 0:
        return None
    k, block = min(k, d), min(d, k + guard)
    rng = np.random.default_rng(seed)
    low, top, _ = lanczos(data.times, rng.standard_normal(d), 10)
    e, q, miss = _ritz(data.times, rng.standard_normal((d, block)))
    best, stalled = math.inf, 0
    for _ in range(max_rounds):
        top = max(top, e[0])
        if block < d:
            cut = max(float(e[-1]), trace * 1e-14)
            floor = min(max(0.0, low), cut / 2 if low >= cut else low)
            e, q, miss = _ritz(data.times, chebyshev(data.times, q, degree, max(0.0, floor), cut, max(top, 2 * cut - floor if top <= cut else top)))
        # a component without spread has no whitened value
        wanted = max(1, int((e[:k] > RANK * e[0]).sum()))
        worst = float(miss[:wanted].max() / e[0])
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if block == d or worst <= tolerance or (stalled >= 2 and worst <= certified):
            if block == d:
                break
            mine = q[:, :wanted]
            away = lambda x: x - mine @ (mine.T @ x)
            _, above, vector = lanczos(lambda x: away(data.times(away(x))), away(rng.standard_normal((d, 1)))[:, 0], 8)
            rayleigh = float(vector @ data.times(vector[:, None])[:, 0])
            if rayleigh <= e[wanted - 1] * (1 + 1e-9):
                break
            q, best, stalled = np.column_stack([q[:, :-1], vector]), math.inf, 0
    else:
        raise RuntimeError(f"the {k} components are not certified after {max_rounds} rounds: residual {worst:.1e}")
    e, q = e[:wanted], q[:, :wanted]
    scaled = q / np.sqrt(e)

    def moments(c: np.ndarray) -> np.ndarray:
        w = c @ scaled
        return np.vstack([w.T @ w, w.sum(0)])

    m = data.summed((wanted + 1, wanted), moments) / data.n
    error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(wanted)).max())
    return Whitening(data.n, data.sums, q, e, trace, error, float(miss[:wanted].max() / e[0]), data.passes)


SCHEMA = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained and identity_error of each usable row and component."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {SCHEMA}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    d, k, n = len(model.sums), len(model.eigenvalues), model.n
    base = np.array([s // n for s in model.sums], dtype=np.int64)
    over = np.array([s - int(b) * n for s, b in zip(model.sums, base)], dtype=np.int64)  # S = base * n + over
    scaled = model.components / np.sqrt(model.eigenvalues)
    explained, error = model.eigenvalues / model.trace, model.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = matrix(batch.column(1), np.int64) - base
            m = len(away)
            if (float(np.abs(away).max()) + 1) * n < math.sqrt((1 << 62) / d):
                z = away * n - over
                deviation = pa.array((z * z).sum(1), pa.int64()).cast(pa.decimal128(38, 0))
            else:  # beyond a long
                z = away.astype(object) * n - over.astype(object)
                exact = [(sum(v * v for v in row)) for row in z.tolist()]
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            white = (away.astype(np.float64) - over / n) @ scaled
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), deviation.take(at), pa.array(white.ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = _usable(vectors, vec_col).where(F.size(vec_col) == d)
    return rows.select(F.col(id_col), integers(vec_col).alias("_x")).mapInArrow(project, schema)
