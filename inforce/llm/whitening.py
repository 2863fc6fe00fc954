"""Embedding whitening by Jacobi-Davidson (operator 13).

The covariance is never formed. Its product with a block of directions is one
distributed pass: every task centres its vectors, projects them on the
directions and sums the centred vectors weighted by the projections; Spark adds
the partial sums of the tasks, of which one row per matrix entry reaches the
driver (dimensions x directions, whatever the number of vectors).

On the driver the search runs in small matrices: Rayleigh-Ritz in a subspace,
and for each wanted pair that has not converged the correction equation
``(I - UU')(V - theta I)(I - UU') t = -r``, solved by a few MINRES steps. All
pairs take their step together, so one step is one pass. Converged pairs are
locked in falling order and projected out of everything that follows; the
search ends when every residual is at double precision.

Vectors travel as blocks of 64-bit integers in one written table, so a pass
reads flat arrays. No shuffle holds a vector; rows never meet on a key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, bound_batches, one_blas_thread, written

#: Entries become ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 1024, 100_000
#: Components of the contract, steps of an inner solution, and vectors in a block.
COMPONENTS, INNER_STEPS, BLOCK_ROWS = 8, 8, 4096
#: Residuals count as converged below this share of the largest eigenvalue, and
#: eigenvalues as zero below it.
TOLERANCE = 2.0**-45
#: Largest entry whose integer is still exact as a double.
_LARGEST = 2.0**52 / SCALE

_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("x", pa.binary())])


@dataclass(frozen=True)
class Prepared:
    """The fit list: a written table of blocks (ids, x as little-endian 64-bit
    integers), the number of vectors, dimensions, and sums per dimension."""

    blocks: DataFrame
    n: int
    dims: int
    sums: tuple[int, ...]


@dataclass(frozen=True)
class Whitening:
    """Eigenvalues in falling order, unit eigenvectors in columns, the trace of
    the covariance, and how the search went."""

    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int


def prepare(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Prepared:
    """Integer vectors of all usable rows. Left out: null vectors, vectors with a
    null or non-finite entry, empty ones, and ones with an entry beyond 2^42,
    whose integer a double cannot hold. Where lengths differ, the most frequent
    one (the longest of equally frequent ones) is the table's and rows of another
    length are left out too. Null and repeated ids are kept, row by row."""
    bound_batches(embeddings.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    usable = F.size(vector) > 0
    usable &= F.forall(vector, lambda c: F.coalesce(F.abs(c) <= F.lit(_LARGEST), F.lit(False)) & ~F.isnan(c))
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).filter(F.col("v").isNotNull() & F.coalesce(usable, F.lit(False)).alias("ok"))
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return Prepared(written(embeddings.sparkSession.createDataFrame([], "ids array<long>, x binary"), "whitening-blocks"), 0, 0, ())
    dims = int(lengths[0]["dims"])

    def block(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                c = part.column(1).flatten().to_numpy(zero_copy_only=False)
                x = np.floor(SCALE * c).astype("<i8") + SHIFT
                yield batch_of(_BLOCK, ids=[part.column(0).to_pylist()], x=[x.tobytes()])

    blocks = written(rows.filter(F.size("v") == dims).mapInArrow(block, "ids array<long>, x binary"), "whitening-blocks")
    # sums of whole numbers, exact whatever the order
    total = _sums(blocks, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), dims, whole=True)
    return Prepared(blocks, total[0], dims, tuple(total[1:]))


def _sums(blocks: DataFrame, part, dims: int, whole: bool = False) -> list:
    """Sum over all blocks of ``part(x)``, a flat array of fixed length. A task
    adds up its blocks first; the driver gets one number per place."""
    kind = "decimal(38,0)" if whole else "double"

    def add(batches):
        one_blas_thread()
        total = None
        for b in batches:
            for raw in b.column(0):
                x = np.frombuffer(raw.as_buffer(), dtype="<i8").reshape(-1, dims)
                got = part(x)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total, pa.int64() if whole else pa.float64())], names=["place", "value"])

    rows = blocks.select("x").mapInArrow(add, f"place int, value {'long' if whole else 'double'}").groupBy("place").agg(F.sum(F.col("value").cast(kind)).alias("value")).collect()
    out: list = [0] * len(rows)
    for r in rows:
        out[r["place"]] = int(r["value"]) if whole else float(r["value"])
    return out


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``x - sums / n``: the whole part of the mean is taken off exactly."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _product(fit: Prepared, directions: np.ndarray) -> np.ndarray:
    """The covariance times ``directions`` (dims x k): one pass over the blocks."""
    n, sums, dims = fit.n, fit.sums, fit.dims

    def part(x):
        c = centred(x, n, sums)
        return (c.T @ (c @ directions)).ravel()

    return np.array(_sums(fit.blocks, part, dims)).reshape(directions.shape) / n


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The part of ``block`` outside all of ``against``, as orthonormal columns;
    columns that vanish are left out."""
    for _ in range(2):  # twice is enough for full precision
        for q in against:
            block = block - q @ (q.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 1e-300] / size[size > 1e-300]
        if block.shape[1]:
            u, s, _ = np.linalg.svd(block, full_matrices=False)
            block = u[:, s > 1e-8]
    return block


def _minres(product, theta: np.ndarray, u: np.ndarray, r: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on ``(I - UU')(V - theta_j I)(I - UU') t_j = -r_j`` for all columns j
    at once, each with its own recurrence; ``steps`` passes."""

    def project(y):
        y = y - u @ (u.T @ y)
        return y - u @ (u.T @ y)

    def unit(y, size):
        return y / np.where(size > 0, size, 1.0)

    v = project(-r)
    beta = np.linalg.norm(v, axis=0)
    v, v_old = unit(v, beta), np.zeros_like(v)
    w, w_old, t = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, least = beta, beta * 1e-14
    for _ in range(steps):
        av = project(product(v) - theta * v)
        alpha = (v * av).sum(axis=0)
        av = av - alpha * v - beta * v_old
        beta_new = np.linalg.norm(av, axis=0)
        # Givens rotations of the tridiagonal matrix
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_new)
        rho2 = s * alpha + c_old * c * beta
        rho3 = s_old * beta
        live = (rho1 > 0) & (np.abs(eta) > least)
        safe = np.where(live, rho1, 1.0)
        c_old, s_old = c, s
        c, s = np.where(live, delta / safe, 1.0), np.where(live, beta_new / safe, 0.0)
        w, w_old = np.where(live, (v - rho3 * w_old - rho2 * w) / safe, 0.0), w
        t = t + np.where(live, c * eta * w, 0.0)
        eta = np.where(live, -s * eta, 0.0)
        v_old, v, beta = v, unit(av, beta_new), beta_new
        if not np.any(np.abs(eta) > least):
            break
    return project(t)


def jacobi_davidson(product, dims: int, wanted: int, inner_steps: int = INNER_STEPS, seed: int = 7, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, largest residual relative to the largest eigenvalue) of
    the ``wanted`` largest eigenpairs of a symmetric, positive semi-definite matrix
    that is known only through ``product(block)``."""
    wanted = min(wanted, dims)
    most, least = min(dims, 6 * wanted), min(dims, 2 * wanted)
    q = _orthonormal(np.random.default_rng(seed).standard_normal((dims, least)))
    aq = product(q)
    locked, locked_a, values = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros(0)
    best, stalled, worst = np.inf, 0, 0.0
    for _ in range(rounds):
        # Rayleigh-Ritz outside the locked pairs
        h = q.T @ aq
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        q, aq = q @ s, aq @ s
        todo = wanted - values.size
        u, at = q[:, :todo], theta[:todo]
        r = aq[:, :todo] - u * at
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        scale = max(abs(float(theta[0])) if not values.size else float(values[0]), 1e-300)
        done = size <= TOLERANCE * scale
        now = float(size.max(initial=0.0)) / scale
        # rounding of the sums may stand above the tolerance: stop where nothing improves
        stalled = stalled + 1 if now > best / 2 else 0
        best = min(best, now)
        if stalled >= 3 and best < 1e-11:
            done[:] = True
        k = int(np.argmin(done)) if not done.all() else todo  # locked in falling order
        if k:
            worst = max(worst, float(size[:k].max()) / scale)
            locked, locked_a, values = np.hstack([locked, u[:, :k]]), np.hstack([locked_a, aq[:, :k]]), np.concatenate([values, at[:k]])
            q, aq, best, stalled = q[:, k:], aq[:, k:], np.inf, 0
        if values.size == wanted:
            # one last Rayleigh-Ritz among the locked pairs puts ties in order
            h = locked.T @ locked_a
            theta, s = np.linalg.eigh((h + h.T) / 2)
            return theta[::-1], np.linalg.qr(locked @ s[:, ::-1])[0], worst
        u, at, r = q[:, : wanted - values.size], theta[k:todo], r[:, k:]
        if q.shape[1] + todo > most:
            q, aq = q[:, :least], aq[:, :least]
        t = _minres(product, at, np.hstack([locked, u]), r, inner_steps)
        t = _orthonormal(t, locked, q)
        if not t.shape[1] and q.shape[1] + values.size < dims:  # no correction left: a new direction
            t = _orthonormal(np.random.default_rng(seed + values.size).standard_normal((dims, 1)), locked, q)
        if t.shape[1]:
            q, aq = np.hstack([q, t]), np.hstack([aq, product(t)])
    raise ArithmeticError(f"no convergence: residual {best:.1e} after {rounds} rounds")


def fit_whitening(fit: Prepared, components: int = COMPONENTS, inner_steps: int = INNER_STEPS) -> Whitening:
    """The leading eigenpairs of the covariance (divisor: number of vectors)."""
    if not fit.n:
        return Whitening(np.zeros(0), np.zeros((0, 0)), 0.0, 0.0, 0)
    n, sums = fit.n, fit.sums
    trace = float(np.sum(_sums(fit.blocks, lambda x: (centred(x, n, sums) ** 2).sum(axis=0), fit.dims))) / n
    if trace == 0:  # all vectors equal
        k = min(components, fit.dims)
        return Whitening(np.zeros(k), np.eye(fit.dims)[:, :k], 0.0, 0.0, 0)
    passes = [0]

    def product(block):
        passes[0] += 1
        return _product(fit, block)

    values, vectors, residual = jacobi_davidson(product, fit.dims, components, inner_steps)
    return Whitening(values, vectors, trace, residual, passes[0])


def _projection(model: Whitening) -> np.ndarray:
    """Eigenvectors over the roots of their eigenvalues; NaN where that is zero."""
    positive = model.values > 64 * np.finfo(float).eps * max(model.trace, 1e-300)
    return model.vectors / np.sqrt(np.where(positive, model.values, np.nan))


def identity_error(fit: Prepared, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened values' covariance minus the
    identity, over components with variance (None if there are none): a pass for
    their mean, a pass for the centred products."""
    p = _projection(model)
    p = p[:, ~np.isnan(p[0])] if p.size else p
    if not p.size:
        return None
    n, sums, k = fit.n, fit.sums, p.shape[1]
    mean = np.array(_sums(fit.blocks, lambda x: (centred(x, n, sums) @ p).sum(axis=0), fit.dims)) / n

    def part(x):
        w = centred(x, n, sums) @ p - mean
        return (w.T @ w).ravel()

    return float(np.abs(np.array(_sums(fit.blocks, part, fit.dims)).reshape(k, k) / n - np.eye(k)).max())


def exact_deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list:
    """Sum over dimensions of ``(n x - sums)^2``, exact; None where it passes 64 bits."""
    span = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, sums), default=0)
    if span * span * max(len(sums), 1) < 2**63:
        d = n * x - np.array(sums, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    at_most = 2**63 - 1
    low = np.array([s // n for s in sums], dtype=np.int64)
    # n x - sums = n (x - whole mean) - rest; the first factor is small
    rest = [s % n for s in sums]
    d = x - low
    if (int(np.abs(d).max(initial=0)) + 1) ** 2 * n * n * len(sums) < 2**63:
        d = n * d - np.array(rest, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    out = [sum((n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in d.tolist()]
    return [v if v <= at_most else None for v in out]


def whitened(fit: Prepared, model: Whitening) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n,
    deviation (exact; null beyond 64 bits), whitened, explained, and the
    residual and identity error of the fit, the same in every row. A component
    without variance (fewer independent vectors than components) has a null
    ``whitened`` and, where nothing varies at all, a null ``explained``. Vectors
    shorter than the number of components have as many as they have entries. An
    empty table, or one without a usable vector, gives an empty result."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    n, sums, dims, k = fit.n, fit.sums, fit.dims, model.values.size
    p = _projection(model)
    explained = (model.values / model.trace).tolist() if model.trace else [None] * k
    error = identity_error(fit, model)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.float64()]

    def project(batches):
        one_blas_thread()
        for b in batches:
            for ids, raw in zip(b.column(0), b.column(1), strict=True):
                x = np.frombuffer(raw.as_buffer(), dtype="<i8").reshape(-1, dims)
                m = len(x)
                w = centred(x, n, sums) @ p
                rows = np.repeat(np.arange(m), k)
                columns = [ids.values.take(pa.array(rows)), np.tile(np.arange(1, k + 1), m), np.full(m * k, n), pa.array(exact_deviation(x, n, sums), pa.int64()).take(pa.array(rows)), pa.array(w.ravel(), from_pandas=True), explained * m, [error] * (m * k), np.full(m * k, model.residual)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return fit.blocks.select("ids", "x").mapInArrow(project, schema)


def whitened_embeddings(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fits on all usable vectors and projects them; see ``prepare`` and
    ``whitened``. The fit runs Spark jobs when this is called."""
    fit = prepare(embeddings, id_col, vector_col)
    return whitened(fit, fit_whitening(fit, components))
