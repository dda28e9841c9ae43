"""Embedding whitening: principal components by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed.  Every step multiplies it with a thin
block of vectors: tasks centre their rows and return XᵀXQ of their share, and
the shares are summed by an aggregate.  A Chebyshev polynomial of the matrix,
built by its three-term recurrence, damps the unwanted low end of the spectrum;
QR and a Rayleigh-Ritz step follow.  Rounds go on until the residuals certify
the wanted pairs and no longer fall.  What the driver holds is a block of
``dimensions x (3 * components)`` numbers, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm._shared import cut, map_arrow

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: Entries beyond this (after scaling) count as this: integers that a double still holds exactly.
LIMIT = 1 << 52
DEGREE, MAX_DEGREE, MAX_ROUNDS, LANCZOS = 6, 80, 60, 8
#: Residuals, against the largest eigenvalue, that certify a pair and that leave nothing to gain; smaller
#: eigenvalues than RANK of the largest are noise.
CERTIFIED, EXACT, RANK = 1e-12, 1e-14, 1e-12
FAN_IN = 64
_HALF = 26                                                # sums of x are kept in two halves, each safe in 64 bits


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` distinct vectors with exact sums, unit components as columns, eigenvalues, trace."""
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def base(self) -> np.ndarray:
        """Whole part of the means."""
        return np.array([s // self.n for s in self.sums], np.int64) if self.n else np.zeros(0, np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Sums less n times the whole part of the means."""
        return np.array([s % self.n for s in self.sums], np.int64) if self.n else np.zeros(0, np.int64)


def integer_vectors(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows with a usable vector, and ``x``: floor(64 * entry) + 1,000,000 as longs.

    A null vector and one with a null, NaN or infinite entry is dropped, and so
    are empty vectors and those of another length than most have (ties: the
    longest).  ``x`` takes the place of a column of that name."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    usual = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    scaled = F.transform(v, lambda c: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(
        F.lit(float(LIMIT)), F.lit(float(SCALE)) * c.cast("double")))) + F.lit(SHIFT))
    return rows.where(F.size(v) == (usual[0].d if usual else 0)).withColumn("x", scaled)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64, copy=False)


def _shares(share, batches):
    """The summed ``share`` of a task's batches, as one row."""
    total = None
    for batch in batches:
        if batch.num_rows:
            part = share(_matrix(batch.column(0)))
            total = part if total is None else total + part
    if total is not None:
        yield _row(np.ravel(total))


def _row(flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat))], ["v"])


def _added(batches):
    total = None
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.column(0)[i].values.to_numpy()
            total = part.copy() if total is None else total + part
    if total is not None:
        yield _row(total)


def _summed(fit: DataFrame, share, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over the tasks of ``share(rows)``, an array of ``shape``: one distributed pass.

    A task sends one array; every ``FAN_IN`` arrays are added by a task, until so few are left."""
    schema = f"v array<{kind}>"
    rows = map_arrow(fit.select("x"), partial(_shares, share), schema)
    parts = fit.rdd.getNumPartitions()
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        rows = map_arrow(rows.repartition(parts), _added, schema)
    out = np.zeros(int(np.prod(shape)), np.int64 if kind == "long" else np.float64)
    for part in rows.toArrow().column("v"):
        out += part.values.to_numpy()
    return out.reshape(shape)


def _halves(x: np.ndarray) -> np.ndarray:
    return np.stack([(x >> _HALF).sum(axis=0), (x & ((1 << _HALF) - 1)).sum(axis=0)])


def _centred(base: np.ndarray, rest: np.ndarray, n: int, x: np.ndarray) -> np.ndarray:
    """x less its mean; the whole part leaves in integers, so no digit is lost."""
    return (x - base) - rest / n


def _squares(centre, x: np.ndarray) -> np.ndarray:
    return (centre(x) ** 2).sum(axis=0)


def _times(centre, block: np.ndarray, x: np.ndarray) -> np.ndarray:
    c = centre(x)
    return c.T @ (c @ block)


def _gram(centre, maps: np.ndarray, x: np.ndarray) -> np.ndarray:
    w = centre(x) @ maps
    return w.T @ w


def _filter(apply, block: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """Chebyshev polynomial of the covariance times ``block``: bounded on [low, high], growing fast above it.

    Scaled so that the component at ``top`` keeps its size."""
    middle, half = (low + high) / 2, (high - low) / 2
    sigma = half / (top - middle)
    tau = 2 / sigma
    before, now = block, (apply(block) - middle * block) * (sigma / half)
    for _ in range(2, degree + 1):
        after = 1 / (tau - sigma)
        before, now = now, (apply(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def lowest(apply, dimensions: int, steps: int, rng) -> float:
    """A lower bound of the spectrum, nearly: the smallest Lanczos value less its residual, zero at least."""
    basis, image = [], []
    v = rng.standard_normal(dimensions)
    for _ in range(min(steps, dimensions)):
        v = v / np.linalg.norm(v)
        basis.append(v)
        image.append(apply(v[:, None])[:, 0])
        q = np.array(basis)
        v = image[-1] - q.T @ (q @ image[-1])
        v = v - q.T @ (q @ v)                              # twice, so that the basis stays orthogonal
        if np.linalg.norm(v) <= 1e-12 * np.linalg.norm(image[-1]):
            break
    q, w = np.array(basis), np.array(image)
    values, turn = np.linalg.eigh((q @ w.T + w @ q.T) / 2)
    residual = np.linalg.norm(w.T @ turn[:, 0] - values[0] * (q.T @ turn[:, 0]))
    return max(0.0, values[0] - residual)


def subspace_iteration(apply, dimensions: int, wanted: int, seed: int = 1):
    """Leading eigenpairs of the symmetric positive matrix behind ``apply(block)``: (values, vectors).

    The block has three times the wanted columns, so convergence hangs on the gap
    to the first eigenvalue outside it.  The polynomial damps what lies between a
    lower bound of the spectrum (from some Lanczos steps) and the block's smallest
    value.  Rounds end when every wanted residual is under ``CERTIFIED`` times the
    largest eigenvalue and has stopped falling by a tenth; slow rounds raise the
    polynomial's degree.  Raises if never certified."""
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.standard_normal((dimensions, min(dimensions, 3 * wanted))))[0]
    degree, best, low = DEGREE, None, None
    for _ in range(MAX_ROUNDS):
        image = apply(block)
        small, turn = np.linalg.eigh((block.T @ image + image.T @ block) / 2)
        small, turn = small[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = max(small[0], 0.0)
        residual = np.linalg.norm(image - block * small, axis=0)[:wanted].max()
        if block.shape[1] == dimensions or top == 0.0:     # the block spans everything: one exact step
            return small[:wanted], block[:, :wanted]
        last = best[0] if best else np.inf
        if residual < last:
            best = residual, small[:wanted], block[:, :wanted]
        if best[0] <= EXACT * top or (best[0] <= CERTIFIED * top and residual > last / 10):
            return best[1], best[2]
        if last / 100 < residual < np.inf and best[0] > CERTIFIED * top and last < np.inf:
            degree = min(MAX_DEGREE, 2 * degree)
        if low is None:
            low = lowest(apply, dimensions, LANCZOS, rng)
        high = min(max(small[-1], 1e-9 * top), 0.999 * top)
        block = np.linalg.qr(_filter(apply, block, degree, min(low, 0.99 * high), high, top))[0]
    raise RuntimeError(f"eigenpairs not certified: residual {best[0]:.3g} of {top:.3g}")


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct ``x`` of ``rows`` once: a vector that many rows repeat weighs as one.

    Components that explain less than 1e-12 of the first (so all, where only one
    vector is left) are not part of the model; no rows give a model of none."""
    fit = cut(rows.select("x").distinct(), "whitening_fit")
    head = fit.select(F.size("x").alias("d")).limit(1).collect()
    if not head:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    n, d = fit.count(), head[0].d
    high, low = _summed(fit, _halves, "long", (2, d))
    sums = tuple((int(h) << _HALF) + int(lo) for h, lo in zip(high, low))
    start = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0.0)
    centre = partial(_centred, start.base, start.rest, n)
    trace = float(_summed(fit, partial(_squares, centre), "double", (d,)).sum()) / n
    values, vectors = subspace_iteration(
        lambda block: _summed(fit, partial(_times, centre, block), "double", block.shape) / n, d, min(components, d))
    real = values > RANK * max(values[0], 0.0)
    values, vectors = values[real], vectors[:, real]
    error = 0.0
    if len(values):
        gram = _summed(fit, partial(_gram, centre, vectors / np.sqrt(values)), "double", (len(values),) * 2) / n
        error = float(np.abs(gram - np.eye(len(values))).max())
    return Whitening(n, sums, vectors, values, trace, error)


def _deviation(model: Whitening, x: np.ndarray) -> list:
    """Sum over dimensions of (n * x - S)^2, exact; null beyond 64 bits."""
    reach = int(np.abs(x - model.base).max()) + 1
    if (reach * model.n) ** 2 * x.shape[1] < 1 << 63:
        return ((model.n * (x - model.base) - model.rest) ** 2).sum(axis=1).tolist()
    exact = (((x - model.base).astype(object) * model.n - model.rest.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _whitened(model: Whitening, batches):
    k = len(model.values)
    if not k:
        return
    maps, explained = model.vectors / np.sqrt(model.values), model.values / model.trace
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(1))
        white = _centred(model.base, model.rest, model.n, x) @ maps
        rows = np.repeat(np.arange(len(x)), k)
        m = len(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
             pa.array(np.full(m, model.n)), pa.array(_deviation(model, x), pa.int64()).take(pa.array(rows)),
             pa.array(white.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, model.identity_error))],
            ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Every usable vector projected on the leading components, scaled to unit variance.

    Returns ``id_col``, component (from 1), n, deviation, whitened, explained,
    identity_error: one row a vector and component.  Unusable vectors: see
    ``integer_vectors``; their rows are absent.  Rows that repeat an id or a
    vector, or have a null id, are all returned.  Equal eigenvalues leave their
    components' directions open, alike for all rows.  Further columns are
    ignored; an empty table gives an empty result."""
    rows = integer_vectors(df, vector_col)
    model = fit_whitening(rows, components)
    kind = df.schema[id_col].dataType.simpleString()
    out = map_arrow(rows.select(F.col(id_col).alias("id"), "x"), partial(_whitened, model),
                    f"id {kind}, component int, n long, deviation long, whitened double, explained double, "
                    "identity_error double")
    return out.withColumnRenamed("id", id_col)
