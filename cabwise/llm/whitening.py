"""Embedding whitening by Jacobi-Davidson on distributed covariance products.

1. Entries become whole numbers x = floor(256 c). The fit list holds every
   distinct x vector once (a group of copies is one row a task before it
   shuffles) and is written; its count n and sums S are exact integers.
2. The covariance is never formed. A *product* is one pass of the fit list:
   each task multiplies its rows, centred by S/n, with a block of at most
   ``WANTED`` vectors and back, and sends a block of the same size. The tasks'
   blocks are added in a fixed order; many of them are added in between.
3. Jacobi-Davidson: Rayleigh-Ritz in a small subspace gives the leading pairs;
   for each that isn't done, the correction equation, projected against the
   pair and all locked ones, is solved by a few steps of MINRES (all pairs in
   step: one product serves the whole block); the corrections extend the
   subspace. A pair whose residual is at rounding level is locked and projected
   out. The end is reached when all are locked and nothing left in the subspace
   exceeds them.
4. Rows are projected where they are: no row shuffles for it.

What is on the driver: a few vectors of the embedding's width.

Defined results: rows whose vector is null, empty, shorter than the longest one
(its missing entries count as null) or has a null or non-finite entry, or one
of 2^53 / 256 and more, are dropped. A null id stays null; rows that repeat
are reported one by one. Directions without variance (up to rounding) have no
whitened value and aren't components: a table of one distinct vector gives no
rows, as does an empty one. ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.common import arrow_map, column, staged

WANTED = 4
SCALE = 256
#: Entries are exact as doubles and as longs below this.
LARGEST = float(1 << 53)
#: Relative to the largest eigenvalue: the size of a residual that is rounding only.
PRECISE, ROUNDING = 2e-14, 1e-11
SUBSPACE, INNER_STEPS, OUTER_STEPS = 40, 6, 300
#: Partial results that one task (or the driver) adds up.
FAN_IN = 512
LIMB = 1 << 26


# ---------------------------------------------------------------- rows

def whole_rows(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have ``width`` finite entries, and their x vectors."""
    kind = vectors.type.value_type if hasattr(vectors.type, "value_type") else pa.float64()
    vectors = vectors.cast(pa.large_list(kind))
    size = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(size == width) if width else np.zeros(0, np.int64)
    flat = pc.list_flatten(vectors.take(pa.array(fits))).cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(fits), width)  # null entries: NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * values)
        good = (np.abs(x) < LARGEST).all(axis=1)
    return fits[good], x[good].astype(np.int64)


def as_matrix(rows: pa.Array, width: int) -> np.ndarray:
    """x vectors of a binary column."""
    return np.frombuffer(b"".join(rows.to_pylist()), np.int64).reshape(-1, width)


def fit_list(table: DataFrame, vector: str, width: int) -> DataFrame:
    """(x): every distinct x vector once, as bytes of longs."""
    def run(batches):
        for batch in batches:
            _, x = whole_rows(column(batch, "v"), width)
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], names=["x"])

    return arrow_map(table.select(F.col(f"`{vector}`").alias("v")), run, "x binary").distinct()


# ---------------------------------------------------------------- sums over the fit list

def added(partials: DataFrame, tasks: int) -> np.ndarray:
    """The sum of one array a task, in the order of the tasks."""
    def add(batches):
        rows = sorted((r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]]), pa.array([_sum(rows).tobytes()])], names=["task", "block"])

    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        partials = arrow_map(partials.repartition(tasks), add, "task long, block binary")
    return _sum(sorted((r.task, r.block) for r in partials.collect()))  # FAN_IN rows of a few vectors


def _sum(rows: list[tuple[int, bytes]]) -> np.ndarray:
    return np.sum([np.frombuffer(b, np.float64) for _, b in rows], axis=0) if rows else np.zeros(0)


@dataclass
class FitList:
    """The written fit list with its exact count and sums."""

    rows: DataFrame
    tasks: int
    width: int
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # correctly rounded

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum of ``of(centred rows)`` over all batches."""
        width, mean = self.width, self.mean

        def run(batches):
            own = None
            for batch in batches:
                if batch.num_rows:
                    part = of(as_matrix(column(batch, "x"), width) - mean)
                    own = part if own is None else own + part
            if own is not None:
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([own.tobytes()])],
                                                 names=["task", "block"])

        return added(arrow_map(self.rows, run, "task long, block binary"), self.tasks)

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times a (width, m) block."""
        return self.total(lambda x: x.T @ (x @ block)).reshape(block.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.array([np.square(x).sum()]))[0]) / self.n


def fitted(table: DataFrame, vector: str) -> FitList:
    width = table.agg(F.max(F.size(F.col(f"`{vector}`")))).first()[0]
    width = max(0, width or 0)
    rows = staged(fit_list(table, vector, width), "fit-list")

    def limbs(batches):  # two limbs a sum: exact for 2^36 rows a task
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = as_matrix(column(batch, "x"), width) if batch.num_rows else np.zeros((0, width), np.int64)
            n, low, high = n + len(x), low + (x % LIMB).sum(axis=0), high + (x // LIMB).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n] + [0] * width), pa.array(range(width + 1)), pa.array([0, *low.tolist()]), pa.array([0, *high.tolist()])],
            names=["n", "place", "low", "high"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    parts = arrow_map(rows, limbs, "n long, place long, low long, high long").groupBy("place").agg(exact("n"), exact("low"), exact("high"))
    found = sorted((r.place, int(r.n), int(r.low) + LIMB * int(r.high)) for r in parts.collect())  # width + 1 rows
    n = found[0][1] if found else 0
    return FitList(rows, rows.rdd.getNumPartitions(), width, n, [s for _, _, s in found[1:]])


# ---------------------------------------------------------------- Jacobi-Davidson

def minres(apply: Callable, right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, a column each, all in step.

    ``apply`` takes the block of all columns' vectors. Lanczos vectors v span
    the Krylov space; plane rotations keep its tridiagonal matrix triangular
    (diagonal gamma, then delta and eps above it), and d are the directions
    that the solution moves along."""
    beta = start = np.linalg.norm(right, axis=0)
    safe = lambda x: np.where(x > 0, x, 1.0)
    v, v_before = right / safe(beta), np.zeros_like(right)
    out, d, d_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    cos, sin = -np.ones_like(beta), np.zeros_like(beta)
    delta_next, eps, left = np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    coupling = np.zeros_like(beta)
    for _ in range(steps):
        w = apply(v) - coupling * v_before
        alpha = (v * w).sum(axis=0)
        w -= alpha * v
        coupling = np.linalg.norm(w, axis=0)
        eps_before, delta = eps, cos * delta_next + sin * alpha
        gamma_bar = sin * delta_next - cos * alpha
        eps, delta_next = sin * coupling, -cos * coupling
        gamma = safe(np.hypot(gamma_bar, coupling))
        cos, sin = gamma_bar / gamma, coupling / gamma
        step, left = cos * left, sin * left
        d, d_before = (v - eps_before * d_before - delta * d) / gamma, d
        out = out + step * d
        v, v_before = np.where(coupling > 1e-14 * start, w / safe(coupling), 0.0), v
        if (np.abs(left) <= tolerance * start).all():
            break
    return out


def against(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """``block`` without its part in the span of ``basis`` (orthonormal), twice for rounding's sake."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    return block


def extended(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Orthonormal vectors that add the columns of ``block`` to ``basis``."""
    new = np.zeros((len(basis), 0))
    for k in range(block.shape[1]):
        column_, size = block[:, k:k + 1], np.linalg.norm(block[:, k])
        left = against(np.hstack([basis, new]), column_)
        if size and np.linalg.norm(left) > 1e-10 * size:
            new = np.hstack([new, left / np.linalg.norm(left)])
    return new


def leading_pairs(product: Callable, width: int, wanted: int, floor: float = 0.0, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling, above ``floor``) and unit eigenvectors of a symmetric
    positive matrix that is given by its products with blocks of vectors."""
    wanted = min(wanted, width)
    locked, values = np.zeros((width, 0)), []
    space = images = np.zeros((width, 0))
    random = np.random.default_rng(seed)
    new = extended(space, random.standard_normal((width, wanted)))
    best, stalled = np.inf, 0
    for _ in range(OUTER_STEPS):
        space, images = np.hstack([space, new]), np.hstack([images, product(new)])
        h = space.T @ images
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        space, images = space @ s, images @ s                      # Ritz vectors, best first
        scale = max([*values, *theta[:1], 1e-300])
        residual = images - theta * space
        residual = against(locked, residual)
        size = np.linalg.norm(residual, axis=0) / scale
        missing = wanted - len(values)
        front = float(size[:missing].max()) if missing and len(size) else 0.0
        stalled = 0 if front < best / 2 else stalled + 1
        best = min(best, front)
        done = PRECISE if stalled < 4 else ROUNDING
        lock = np.zeros(space.shape[1], bool)
        lock[:missing] = size[:missing] <= done
        # a Ritz value behind an unfinished one isn't locked: the order is kept
        lock &= np.cumsum(~lock) == 0
        if lock.any():
            locked = np.hstack([locked, against(locked, space[:, lock])])
            locked[:, -lock.sum():] /= np.linalg.norm(locked[:, -lock.sum():], axis=0)
            values += theta[lock].tolist()
            best, stalled = np.inf, 0
        space, images, theta, residual = space[:, ~lock], images[:, ~lock], theta[~lock], residual[:, ~lock]
        if len(values) >= wanted:
            if not len(theta) or theta[0] <= min(values) * (1 + 1e-12):
                break
            # something larger has come up: the smallest locked pair goes back
            k = int(np.argmin(values))
            space = np.hstack([locked[:, k:k + 1], space])
            locked, values = np.delete(locked, k, axis=1), values[:k] + values[k + 1:]
            images = product(space)
            new = np.zeros((width, 0))
            continue
        front = residual[:, :wanted - len(values)]
        if space.shape[1] + front.shape[1] > SUBSPACE:
            keep = 2 * wanted
            space, images = space[:, :keep], images[:, :keep]
        if not front.shape[1]:
            new = extended(np.hstack([locked, space]), random.standard_normal((width, 1)))
            if not new.shape[1]:
                break
            continue
        ritz, at = space[:, :front.shape[1]], theta[:front.shape[1]]

        def corrected(v, ritz=ritz, at=at):
            """(I - QQ')(V - theta)(I - QQ') with Q: the locked vectors and the own Ritz vector."""
            inside = against(locked, v)
            inside = inside - ritz * (ritz * inside).sum(axis=0)
            out = product(inside) - at * inside
            out = against(locked, out)
            return out - ritz * (ritz * out).sum(axis=0)

        if locked.shape[1] + space.shape[1] < width:
            steps = minres(corrected, -front, INNER_STEPS, 1e-3)
            new = extended(np.hstack([locked, space]), steps)
            if not new.shape[1]:
                new = extended(np.hstack([locked, space]), random.standard_normal((width, 1)))
        else:  # the subspace is the whole space: Rayleigh-Ritz is exact up to rounding
            images, new = product(space), np.zeros((width, 0))
    else:
        raise ArithmeticError("the eigenvectors didn't reach double precision")
    order = np.argsort(values)[::-1]
    order = order[np.array(values)[order] > floor] if len(values) else order
    vectors = locked[:, order]
    top = np.abs(vectors).argmax(axis=0)
    return np.array(values)[order], vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])


# ---------------------------------------------------------------- the operator

@dataclass
class Whitening:
    fit: FitList
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # (width, components)
    explained: np.ndarray
    identity_error: float


def whitening(table: DataFrame, vector: str = "embedding", wanted: int = WANTED) -> Whitening:
    fit = fitted(table, vector)
    if not fit.n:
        return Whitening(fit, np.zeros(0), np.zeros((fit.width, 0)), np.zeros(0), 0.0)
    trace = fit.trace()
    values, vectors = leading_pairs(fit.product, fit.width, wanted, floor=1e-13 * trace) if trace else (np.zeros(0), np.zeros((fit.width, 0)))
    k = len(values)
    if not k:
        return Whitening(fit, values, vectors, values, 0.0)
    down = vectors / np.sqrt(values)

    def moments(x):
        z = x @ down
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = fit.total(moments)
    mean = sums[:k] / fit.n
    error = np.abs(sums[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max()
    return Whitening(fit, values, vectors, values / trace, float(error))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; None beyond a long."""
    reach = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if reach * reach * max(1, len(sums)) < 1 << 63:
        return np.square(n * x - np.array(sums, np.int64)).sum(axis=1).tolist()
    out = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whitened(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = WANTED) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a
    row for each row that isn't dropped and each component."""
    model = whitening(table, vector, wanted)
    fit, k = model.fit, len(model.values)
    width, n, sums, mean = fit.width, fit.n, fit.sums, fit.mean if fit.n else np.zeros(fit.width)
    down = model.vectors / np.sqrt(model.values)
    explained, error = model.explained.tolist(), model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = whole_rows(column(batch, "v"), width)
            if not len(rows) or not k:
                continue
            m = len(rows)
            ids = column(batch, "vec_id").take(pa.array(np.repeat(rows, k)))
            far = deviations(x, n, sums)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                pa.array([d for d in far for _ in range(k)], pa.int64()), pa.array(((x - mean) @ down).ravel()),
                pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return arrow_map(table.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v")), run,
                     "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
