"""Embedding whitening by Jacobi-Davidson (operator 12).

The covariance is never built. A product of it with a block of vectors is one pass over the
fit list, each task centring its rows before it multiplies; what comes back is a matrix of
dimension by block. The subspace, its Rayleigh-Ritz step and the inner MINRES recurrences
are that small too and stay on the driver. All correction equations of a round run side by
side, so that a step of theirs is one pass for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shared_table

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
# Entries from here on count as non-finite: beyond it doubles have no floor of their own.
LARGEST = float(2**52)
# A residual counts as converged at this part of the largest eigenvalue.
TOLERANCE = 1e-13
# Directions with less than this part of the largest variance have none in double precision.
LEAST_VARIANCE = 1e-12
GUARD = 4  # Ritz vectors looked after beyond the wanted ones
INNER_STEPS = 8
INNER_TOLERANCE = 0.02
ROUNDS = 100
_BLOCK_ROWS = 4096

Product = Callable[[np.ndarray], np.ndarray]


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, _x)`` of the usable rows, entries as the long ``floor(64 c) + 1000000``."""
    rows = vectors.select(vectors[id_col], vectors[vector_col].alias("_v"))
    size = lambda c: F.abs(c.cast("double") * SCALE)
    fine: Column = F.forall("_v", lambda c: F.coalesce((size(c) < LARGEST) & ~F.isnan(c), F.lit(False)))
    rows = rows.filter(F.col("_v").isNotNull()).filter(fine)
    entry = lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + OFFSET
    return rows.select(id_col, F.transform("_v", entry).alias("_x"))


def _blocks(batch: pa.RecordBatch, column: str, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a batch as matrices of integers, with the number of the first row."""
    flat = batch[column].flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    for start in range(0, len(flat), _BLOCK_ROWS):
        yield start, flat[start : start + _BLOCK_ROWS]


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension, as whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, [0] * d
        for batch in batches:
            for _, x in _blocks(batch, "_x", d):
                count += len(x)
                high, low = (x >> 26).sum(axis=0), (x & (2**26 - 1)).sum(axis=0)
                sums = [s + (int(h) << 26) + int(w) for s, h, w in zip(sums, high, low)]
        totals = pa.array([*map(_decimal, sums), _decimal(count)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_pydict({"_at": pa.array(range(d + 1), pa.int32()), "_sum": totals})

    parts = fit.select("_x").mapInArrow(run, "_at int, _sum decimal(38,0)")
    rows = {r["_at"]: int(r["_sum"]) for r in parts.groupBy("_at").agg(F.sum("_sum").alias("_sum")).collect()}
    return rows[d], [rows[i] for i in range(d)]


def _decimal(value: int):
    from decimal import Decimal

    return Decimal(value)


@dataclass(frozen=True)
class Fit:
    """The fit list with its exact mean, split into a whole number and the rest of it."""

    rows: DataFrame
    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """Subtracts the mean: whole numbers first, so that nothing is cancelled."""
        whole, rest = self.whole, self.rest
        return lambda x: (x - whole) - rest

    def summed(self, function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``function`` of the centred rows, a matrix a block of rows.

        Tasks add up their own blocks, and groups of tasks theirs: about the square root of
        the number of tasks meets in one place, here too, and always in the same order.
        """
        d, centre = len(self.sums), self.centre()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            total = None
            for batch in batches:
                for _, x in _blocks(batch, "_x", d):
                    part = function(centre(x))
                    total = part if total is None else total + part
            if total is not None:
                yield _matrix_row(TaskContext.get().partitionId(), total)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {}
            for batch in batches:
                held |= {at: _matrix(*row) for at, *row in zip(*(batch[c].to_pylist() for c in _MATRIX))}
            if held:
                yield _matrix_row(min(held), sum(held[at] for at in sorted(held)))

        parts = self.rows.mapInArrow(add, _MATRIX_SCHEMA)
        groups = max(1, isqrt(self.rows.rdd.getNumPartitions()))
        met = parts.repartition(groups, F.pmod("_part", F.lit(groups))).mapInArrow(merge, _MATRIX_SCHEMA)
        rows = sorted(met.collect(), key=lambda r: r["_part"])
        return sum(_matrix(r["_width"], r["_data"]) for r in rows)

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``."""
        return self.summed(lambda c: c.T @ (c @ block)) / self.n


_MATRIX = ["_part", "_width", "_data"]
_MATRIX_SCHEMA = "_part int, _width int, _data binary"


def _matrix_row(part: int, matrix: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([part], pa.int32()), pa.array([matrix.shape[1]], pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([matrix.tobytes()], pa.binary())], _MATRIX)


def _matrix(width: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data).reshape(-1, width)


def minres(product: Product, rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions of ``product(x) = rhs``, one for each column, side by side.

    ``product`` is symmetric and may be indefinite. A column that is done goes on with zeros.
    """
    x, w0, w1, v0 = (np.zeros_like(rhs) for _ in range(4))
    beta = np.linalg.norm(rhs, axis=0)
    start, eta = beta, beta.copy()
    live = beta > 0
    v = rhs / np.where(live, beta, 1)
    c0 = c1 = np.ones_like(beta)
    s0 = s1 = np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        new = product(v)
        alpha = (v * new).sum(axis=0)
        new = new - alpha * v - beta * v0
        after = np.linalg.norm(new, axis=0)
        delta = c1 * alpha - c0 * s1 * beta
        r1 = np.hypot(delta, after)
        r2, r3 = s1 * alpha + c0 * c1 * beta, s0 * beta
        live = live & (r1 > 1e-300)
        safe = np.where(live, r1, 1)
        c0, c1, s0, s1 = c1, np.where(live, delta / safe, 1), s1, np.where(live, after / safe, 0)
        w0, w1 = w1, np.where(live, (v - r3 * w0 - r2 * w1) / safe, 0)
        x = x + np.where(live, c1 * eta, 0) * w1
        eta = -s1 * eta
        live = live & (np.abs(eta) > tolerance * start) & (after > 1e-14 * np.abs(alpha))
        v0, v = v, np.where(live, new / np.where(live, after, 1), 0)
        beta = np.where(live, after, 0)
    return x


def orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """A basis of what ``block`` adds to the orthonormal ``against``."""
    made: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for held in (*against, *([np.array(made).T] if made else [])):
                column = column - held @ (held.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-12:
                break
            column = column / left
        else:
            made.append(column)
    return np.array(made).T if made else np.zeros((len(block), 0))


def jacobi_davidson(product: Product, d: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their vectors as columns.

    Ritz vectors are locked, largest first, once their residual is at most ``TOLERANCE`` of
    the largest eigenvalue; the search space is kept orthogonal to them.
    """
    count = min(count, d)
    active = min(d, count + GUARD)
    largest_space = 4 * active
    rng = np.random.default_rng(12)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis = orthonormal(rng.standard_normal((d, active)))
    image = product(basis)
    for _ in range(ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        top = max([*np.abs(theta), *np.abs(values)], default=0.0)
        wanted = min(active, basis.shape[1])
        residual = image[:, :wanted] - basis[:, :wanted] * theta[:wanted]
        residual = residual - locked @ (locked.T @ residual)
        fine = np.linalg.norm(residual, axis=0) <= TOLERANCE * top
        done = int(np.argmin([*fine[: count - len(values)], False]))
        locked = np.hstack([locked, basis[:, :done]])
        values = np.concatenate([values, theta[:done]])
        if len(values) >= count:
            return values, locked
        basis, image, theta = basis[:, done:], image[:, done:], theta[done:]
        residual, fine = residual[:, done:], fine[done:]
        if basis.shape[1] > largest_space - active:
            basis, image, theta = basis[:, :active], image[:, :active], theta[:active]

        chosen = np.flatnonzero(~fine)
        ritz = np.hstack([locked, basis[:, : residual.shape[1]]])

        def outside(block: np.ndarray, held: np.ndarray = ritz) -> np.ndarray:
            return block - held @ (held.T @ block)

        shifts = theta[chosen]
        corrections = minres(
            lambda block: outside(product(outside(block)) - outside(block) * shifts),
            -outside(residual[:, chosen]),
            INNER_STEPS,
            INNER_TOLERANCE,
        )
        fresh = orthonormal(np.hstack([corrections, residual[:, chosen]]), locked, basis)
        if not fresh.shape[1]:
            fresh = orthonormal(rng.standard_normal((d, active)), locked, basis)
        if fresh.shape[1]:
            fresh = fresh[:, :active]
            basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError(f"{len(values)} of {count} eigenvectors after {ROUNDS} rounds")


def components_of(fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors with variance, each vector's largest entry positive."""
    values, vectors = jacobi_davidson(fit.product, len(fit.sums), COMPONENTS)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    real = values > LEAST_VARIANCE * max(values[0], 0)
    values, vectors = values[real], vectors[:, real]
    lead = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[lead, np.arange(len(values))])


_FIELDS = (
    "component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double, eigenvalue double"
)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error, eigenvalue)``:
    a row for each usable row of ``vectors`` and each of the first ``COMPONENTS``.

    Rows whose vector is null or holds null, non-finite or larger entries than ``LARGEST``
    take no part, nor do rows of another length than the most frequent one (of equally
    frequent ones, the longest). Repeated rows and ids, and null ids, each give rows of
    their own, while equal vectors are fitted once. There are fewer components where the
    dimension is less or a direction has no variance; an empty table, empty vectors or
    equal ones give no rows. ``deviation`` is null where it is larger than a long. Other
    columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vector_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, {_FIELDS}"
    length = F.size("_x").alias("_d")
    common = rows.groupBy(length).count().orderBy(F.desc("count"), F.desc("_d")).first()
    d = common["_d"] if common else 0
    rows = rows.filter(F.size("_x") == d)
    if not d:
        return spark.createDataFrame([], schema)
    distinct = shared_table(rows.select("_x").distinct(), "fit")
    fit = Fit(distinct, *exact_sums(distinct, d))
    trace = float(fit.summed(lambda c: (c * c).sum(keepdims=True))[0, 0]) / fit.n
    if trace == 0:
        return spark.createDataFrame([], schema)
    values, axes = components_of(fit)
    turn = axes / np.sqrt(values)

    def moments(c: np.ndarray) -> np.ndarray:
        z = c @ turn
        return np.vstack([z.sum(axis=0), z.T @ z])

    sums = fit.summed(moments) / fit.n
    covariance = sums[1:] - np.outer(sums[0], sums[0])
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return _whitened(rows, schema, id_col, fit, values, turn, trace, error)


def _whitened(rows, schema, id_col, fit, values, turn, trace, error) -> DataFrame:
    n, k, d, centre, whole = fit.n, len(values), len(fit.sums), fit.centre(), fit.whole
    # n * x - S, over whole parts: small numbers, where the mean is large.
    shift = [s - n * int(w) for s, w in zip(fit.sums, whole)]

    def deviations(x: np.ndarray) -> list[int | None]:
        apart = x - whole
        bound = n * int(np.abs(apart).max(initial=0)) + max(map(abs, shift))
        kind = np.int64 if d * bound * bound < 2**63 else object
        off = apart.astype(kind) * n - np.array(shift, dtype=kind)
        return [int(v) if v < 2**63 else None for v in (off * off).sum(axis=1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, x in _blocks(batch, "_x", d):
                at = np.repeat(np.arange(start, start + len(x)), k)
                exact = deviations(x)
                columns = {
                    id_col: batch[id_col].take(pa.array(at)),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    "n": pa.array(np.full(len(at), n), pa.int64()),
                    "deviation": pa.array([v for v in exact for _ in range(k)], pa.int64()),
                    "whitened": pa.array((centre(x) @ turn).ravel()),
                    "explained": pa.array(np.tile(values / trace, len(x))),
                    "identity_error": pa.array(np.full(len(at), error)),
                    "eigenvalue": pa.array(np.tile(values, len(x))),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(run, schema)
