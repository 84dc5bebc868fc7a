"""Whitened leading components of embeddings, by Chebyshev-filtered subspace iteration.

A block of trial vectors is multiplied by the covariance again and again without ever forming it: one pass over the
staged rows adds up X'XQ of the centred rows, task by task and then in Spark. A Chebyshev polynomial in the covariance
damps the part of the spectrum that is not wanted, QR makes the block orthonormal again, and Rayleigh-Ritz reads off
values and vectors, until the residuals certify them.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablework.llm.common import prepare, stage

SCALE = 256
COMPONENTS = 4
# Trial vectors beside the wanted ones: the further away the first vector left out, the fewer passes.
GUARD = 28
MOST_DEGREE = 12
# A filter may favour the strongest direction over the weakest by so much: more would drown the weak ones in rounding.
MOST_GAIN = 1e8
# Tasks that add up the matrices of all others: the driver gets one from each of them.
ADDERS = 16
# Residuals, as a share of the largest value: wanted, and still accepted when rounding allows no less.
WANTED, ACCEPTED = 1e-14, 1e-11
MOST_ROUNDS = 200
# A variance below this share of the largest one is rounding: such a component has no scale to whiten with.
NO_VARIANCE = 1e-12

_LONG = 1 << 62
_log = logging.getLogger(__name__)


def scaled(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): entries times 256, rounded down, of the vectors whose entries are all finite numbers."""
    vectors = embeddings.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = vectors.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    return finite.select("vec_id", F.transform("v", lambda c: (F.floor(c * SCALE) + 0).cast("long")).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension."""

    def task(batches):
        rows, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            rows += len(x)
            # two halves, so that the sums of a task cannot overflow
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([rows] * dim, pa.int64()), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    parts = fit.mapInArrow(task, "i int, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]
    found = {r["i"]: r for r in parts.groupBy("i").agg(*exact).collect()}
    return int(found[0]["n"]), [(int(found[i]["high"]) << 32) + int(found[i]["low"]) for i in range(dim)]


class _Centred:
    """n * x - S and x - S / n of a batch; exact whole numbers before the division where a long can hold them."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.dim = n, sums, len(sums)
        self.top = max(map(abs, sums))

    def _fits(self, x: np.ndarray) -> bool:
        return not len(x) or self.n * max(int(x.max()), -int(x.min())) + self.top < _LONG

    def double(self, x: np.ndarray) -> np.ndarray:
        if self._fits(x):
            return (self.n * x - np.array(self.sums, np.int64)) / self.n
        return np.array([[(self.n * int(v) - s) / self.n for v, s in zip(row, self.sums)] for row in x])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        if self._fits(x):
            whole = self.n * x - np.array(self.sums, np.int64)
            if self.dim * float(np.abs(whole).max(initial=0)) ** 2 < _LONG:
                return (whole * whole).sum(1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return [v if v < 1 << 63 else None for v in exact]


def _summed(fit: DataFrame, adders: int, centred: _Centred, shape: tuple[int, int], of_batch) -> np.ndarray:
    """Sum over all rows of ``of_batch(centred batch)``: one matrix per task, added up by ``adders`` tasks, if any."""

    def task(batches):
        total = np.zeros(shape)
        for batch in batches:
            total += of_batch(centred.double(_matrix(batch.column(0), centred.dim)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def add(batches):
        total = np.zeros(shape)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_py()).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = fit.mapInArrow(task, "part binary")
    if adders:
        parts = parts.repartition(adders).mapInArrow(add, "part binary")
    return sum((np.frombuffer(row["part"]).reshape(shape) for row in parts.collect()), np.zeros(shape))


def _filtered(product, q: np.ndarray, image: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A Chebyshev polynomial in the covariance, applied to the block: small on [0, smallest Ritz value], large above."""
    half = max(values[-1], 1e-6 * values[0]) / 2
    growth = math.acosh(max(values[0] / half - 1, 1 + 1e-9))
    degree = min(MOST_DEGREE, max(2, int(math.log(MOST_GAIN) / growth)))
    before, now = q, (image - half * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (product(now) - half * now) / half - before
    return now


def leading(product, dim: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and unit eigenvectors of a symmetric matrix without negative eigenvalues.

    ``product`` multiplies a block by the matrix. Ends when the residual of every wanted pair is below ``WANTED`` times
    the largest value, or no longer falls and is below ``ACCEPTED``.
    """
    width, wanted = min(dim, wanted + GUARD), min(dim, wanted)
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((dim, width)))[0]
    least, stuck = math.inf, 0
    for _ in range(MOST_ROUNDS):
        image = product(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        if values[0] <= 0:
            return values[:wanted], q[:, :wanted]
        residual = np.linalg.norm(image - q * values, axis=0)[:wanted].max() / values[0]
        stuck = stuck + 1 if residual > least / 2 else 0
        least = min(least, residual)
        if residual <= WANTED or residual <= ACCEPTED and stuck >= 2:
            _log.info("residual %.1e of the largest value", residual)
            return values[:wanted], q[:, :wanted]
        # strongest first: QR then takes the strong directions out of the weak columns
        q = np.linalg.qr(_filtered(product, q, image, values))[0]
    raise ArithmeticError(f"residual {least:.1e} after {MOST_ROUNDS} filters")


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row per kept row and component.

    Rows whose vector is null or holds null, NaN or infinite entries are left out; a vector shorter than the longest
    counts as zero beyond its end, also an empty one. Repeated rows and null ids stay rows of their own, but each distinct
    scaled vector counts once in means and covariance. Components without variance, which cannot be scaled to one, are
    not returned: none for an empty table or one with a single distinct vector. A deviation that no long holds is null,
    and entries beyond a long are taken as the nearest one. Other columns are not looked at.

    The driver sees one block of dimension x (components + ``GUARD``) numbers per pass, whatever the number of rows.
    """
    spark = prepare(embeddings.sparkSession)
    rows = scaled(embeddings, id_col, vector_col)
    schema = rows.select("vec_id").schema.add("component", "integer").add("n", "long").add("deviation", "long")
    schema = schema.add("whitened", "double").add("explained", "double").add("identity_error", "double")
    dim = rows.agg(F.max(F.size("x"))).first()[0]
    if not dim:
        return spark.createDataFrame([], schema)
    rows = rows.select("vec_id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))).alias("x"))
    fit = stage(rows.select("x").distinct(), "fit")
    adders = ADDERS if fit.rdd.getNumPartitions() > ADDERS else 0
    n, sums = _sums(fit, dim)
    centred = _Centred(n, sums)
    trace = _summed(fit, adders, centred, (1, 1), lambda x: (x * x).sum().reshape(1, 1))[0, 0] / n
    if trace == 0:
        return spark.createDataFrame([], schema)

    def product(block: np.ndarray) -> np.ndarray:
        return _summed(fit, adders, centred, block.shape, lambda x: x.T @ (x @ block)) / n

    values, vectors = leading(product, dim, components)
    some = values > NO_VARIANCE * values[0]
    values, vectors = values[some], vectors[:, some]
    wanted = len(values)
    turned = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = x @ turned
        return np.vstack([z.T @ z, z.sum(0)])

    second = _summed(fit, adders, centred, (wanted + 1, wanted), moments) / n
    error = float(np.abs(second[:-1] - np.outer(second[-1], second[-1]) - np.eye(wanted)).max())
    explained = (values / trace).tolist()
    names = schema.names

    def project(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            if not len(x):
                continue
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), wanted)))
            deviations = pa.array(centred.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), wanted)))
            size = len(ids)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), len(x))), pa.array(np.full(size, n)), deviations,
                pa.array((centred.double(x) @ turned).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(size, error)),
            ], names)

    return rows.mapInArrow(project, schema)
