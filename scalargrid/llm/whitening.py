"""Operator 11: whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, ``x = floor(SCALE * c) + OFFSET``. The covariance V of x is never
formed. A block of ``COMPONENTS + GUARD`` directions Q goes through passes over all vectors, each
a sum of ``Z'(ZQ)`` with Z centred, which Spark adds up by task:

* a polynomial in V of growing degree, by the three-term Chebyshev recurrence with one pass a step,
  damps the unwanted end of the spectrum, [a, b]. b is the smallest Ritz value of the block; a
  comes from a Lanczos vector that rides along in the same passes, and is 0 until it has a few steps;
* QR and Rayleigh-Ritz then turn the block, whose one pass is also the first of the next filter;
* the wanted directions are certified by their residuals ``|Vq - eq|``, at most ``TOLERANCE``
  times the largest eigenvalue and no longer falling. The last two guard directions are drawn afresh
  in each round, so a direction that the start missed is found.

The degree is kept so low that the filter lifts the first wanted direction over the last by no more than
``SPREAD`` a round; otherwise rounding would swallow the last.

Whole-number sums make the mean exact: with ``S = n * c0 + r``, the centred entry is
``(x - c0) - r / n``. Vectors are staged once as blocks of small integers. A pass sends the block
(dimensions x directions) to each task and gets one of that size back; above ``FAN`` tasks these are first
added up in groups, about the square root of the tasks of them. The driver holds matrices of dimensions x directions only.

Defined results: vectors that are NULL or hold a NULL, NaN, infinite or huge entry (``2**46``
and more) are dropped, as are those without the dimension that most vectors have (ties: the
larger). Repeated rows count each. Components with an eigenvalue of at most ``RANK`` times the largest have no
scale and are left out, so fewer than 32 may come back; of tied eigenvalues any basis. ``deviation`` is NULL
where it exceeds a long. An empty table, and one of equal vectors only, give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import acosh, isqrt, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scalargrid.llm.common import stage, table

COMPONENTS = 32
GUARD = 16
DEGREE = 10
SPREAD = 1e6
TOLERANCE = 1e-13
RANK = 1e-10
SCALE, OFFSET = 64, 1_000_000
FAN = 1024  # partial sums that go to the driver directly
_ROUNDS = 60
_BLOCK = 4096  # vectors
_HUGE = float(2**46)
_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Vectors:
    """Staged blocks (``ids, kind, x``) of n vectors; ``x - OFFSET`` sums to ``sums`` per dimension."""

    blocks: DataFrame
    n: int
    sums: tuple[int, ...]

    def whole_centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Per dimension the mean's floor and what is left of the sum."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64), np.array([s % self.n for s in self.sums], dtype=np.int64)

    def total(self, part: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "<f8") -> np.ndarray:
        """Sum over all blocks of ``part(x)``, an array of ``size`` numbers."""
        return _summed(self.blocks.select("kind", "x"), part, len(self.sums), size, kind)


def _arrays(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, x in zip(batch.column("kind"), batch.column("x"), strict=True):
            yield np.frombuffer(x.as_buffer(), f"<i{kind.as_py()}").reshape(-1, d).astype(np.int64)


def _summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], d: int, size: int, kind: str) -> np.ndarray:
    tasks = max(1, blocks.rdd.getNumPartitions())
    groups = isqrt(tasks) + 1

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=kind)
        for x in _arrays(batches, d):
            total += part(x)
        at = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"task": pa.array([at], pa.int64()), "grp": pa.array([at % groups], pa.int64()), "part": [total.tobytes()]})

    def of_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("task")
        total = np.sum([np.frombuffer(b.as_buffer(), kind) for b in rows.column("part")], axis=0)
        return pa.table({"task": rows.column("task")[:1], "grp": rows.column("grp")[:1], "part": [total.tobytes()]})

    schema = "task long, grp long, part binary"
    parts = blocks.mapInArrow(of_task, schema)
    if tasks > FAN:
        parts = parts.groupBy("grp").applyInArrow(of_group, schema)
    found = sorted((r["task"], bytes(r["part"])) for r in parts.collect())
    return np.sum([np.zeros(size, dtype=kind), *(np.frombuffer(b, kind) for _, b in found)], axis=0)


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> Vectors | None:
    """The vectors that can be used, as whole numbers; None if there are none."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(_HUGE / scale)))
    usable = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & ~bad)
    first = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if first is None or not first["d"]:
        return None
    d = first["d"]

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                x = np.floor(scale * part.column(1).flatten().to_numpy(zero_copy_only=False)).astype(np.int64)
                size = next(s for s in (2, 4, 8) if s == 8 or np.abs(x).max() < 1 << (8 * s - 1))
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([size], pa.int32()), pa.array([x.astype(f"<i{size}").tobytes()], pa.binary())], names=["ids", "kind", "x"])

    rows = usable.where(F.size("v") == d)
    blocks = stage(rows.mapInArrow(blocked, "ids array<long>, kind int, x binary"), "vectors")
    # Sums in two halves: each stays whole in a double-width accumulator however many vectors there are.
    low = _summed(blocks.select("kind", "x"), lambda x: np.concatenate([(x & 0xFFFF).sum(axis=0), (x >> 16).sum(axis=0), [len(x)]]), d, 2 * d + 1, "<i8").tolist()
    return Vectors(blocks, low[-1], tuple(a + (b << 16) for a, b in zip(low[:d], low[d : 2 * d], strict=True)))


class Covariance:
    """V as a map on directions; every call is one pass over all vectors."""

    def __init__(self, vectors: Vectors) -> None:
        self.vectors, self.d, self.passes, self.trace = vectors, len(vectors.sums), 0, 0.0
        self.whole, self.rest = vectors.whole_centre()

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        whole, share = self.whole, self.rest / self.vectors.n
        return lambda x: (x - whole) - share

    def times(self, q: np.ndarray) -> np.ndarray:
        centred, (d, k) = self.centred(), q.shape

        def part(x: np.ndarray) -> np.ndarray:
            z = centred(x)
            return np.append((z.T @ (z @ q)).ravel(), np.square(z).sum())

        total = self.vectors.total(part, d * k + 1) / self.vectors.n
        self.passes, self.trace = self.passes + 1, float(total[-1])
        return total[:-1].reshape(d, k)


class Lowest:
    """Lower end of the spectrum, by a Lanczos vector that rides along in other passes."""

    STEPS = 24

    def __init__(self, d: int, rng: np.random.Generator) -> None:
        start = rng.standard_normal(d)
        self.basis, self.alpha, self.beta, self.bound = [start / np.linalg.norm(start)], [], [], 0.0

    def vector(self) -> np.ndarray | None:
        return self.basis[-1] if len(self.alpha) < min(self.STEPS, len(self.basis[0])) and len(self.basis) > len(self.alpha) else None

    def step(self, image: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ image))
        rest = image
        for _ in range(2):
            rest = rest - np.array(self.basis).T @ (np.array(self.basis) @ rest)
        norm = float(np.linalg.norm(rest))
        values, turned = np.linalg.eigh(np.diag(self.alpha) + np.diag(self.beta, 1) + np.diag(self.beta, -1))
        if len(self.alpha) > 3:
            self.bound = max(0.0, float(values[0] - norm * abs(turned[-1, 0])))
        if norm > 1e-10 * abs(values).max():
            self.basis.append(rest / norm)
            self.beta.append(norm)


@dataclass(frozen=True)
class Components:
    values: np.ndarray  # falling
    directions: np.ndarray  # one column each
    residual: float  # largest |Vq - eq|
    trace: float
    passes: int


def components(cov: Covariance, count: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE) -> Components:
    """The ``count`` first eigenvectors of V, or as many as have a scale."""
    rng = np.random.default_rng(11)
    size = min(cov.d, count + guard)
    wanted = min(count, size)
    lowest = Lowest(cov.d, rng)

    def times(q: np.ndarray) -> np.ndarray:
        rider = lowest.vector()
        if rider is None:
            return cov.times(q)
        image = cov.times(np.column_stack([q, rider]))
        lowest.step(image[:, -1])
        return image[:, :-1]

    q = np.linalg.qr(rng.standard_normal((cov.d, size)))[0]
    before = np.inf
    for _ in range(_ROUNDS):
        image = times(q)
        small = q.T @ image
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, image = q @ turned, image @ turned
        top = max(float(values[0]), 0.0)
        if top == 0:
            return Components(np.empty(0), np.empty((cov.d, 0)), 0.0, cov.trace, cov.passes)
        residual = float(np.linalg.norm(image - q * values, axis=0)[:wanted].max())
        if residual <= tolerance * top and (size == cov.d or residual > before / 4):
            kept = values[:wanted] > RANK * top
            return Components(values[:wanted][kept], q[:, :wanted][:, kept], residual, cov.trace, cov.passes)
        before = residual
        # The scaled recurrence: at the first Ritz value the polynomial is 1.
        high = max(float(values[-1]), 1e-9 * top)
        low = min(lowest.bound, 0.9 * high)
        half, middle = (high - low) / 2, (high + low) / 2
        lift = [acosh(max(1.0, (max(v, high) - middle) / half)) for v in (top, float(values[wanted - 1]))]
        steps = max(1, min(degree, int(log(SPREAD) / max(lift[0] - lift[1], 1e-9))))
        scale = half / (top - middle)
        last, q, factor = q, (image - middle * q) * (scale / half), scale
        for _ in range(steps - 1):
            new = 1 / (2 / scale - factor)
            last, q = q, (times(q) - middle * q) * (2 * new / half) - last * (factor * new)
            factor = new
        if size < cov.d:
            q[:, -2:] = rng.standard_normal((cov.d, 2)) * np.linalg.norm(q[:, -3])
        # Columns of one length each before QR: those the filter lifts less are not rounded away.
        q = np.linalg.qr(q / np.maximum(np.linalg.norm(q, axis=0), 1e-300))[0]
    raise RuntimeError(f"no certificate after {cov.passes} passes: residual {before:.3g} of {top:.3g}")


def projected(cov: Covariance, found: Components, error: float) -> DataFrame:
    """A row per vector and component."""
    centred, n, d = cov.centred(), cov.vectors.n, cov.d
    whole, rest = cov.whole, cov.rest
    scaled = found.directions / np.sqrt(found.values)
    explained, k = found.values / found.trace, len(found.values)

    def deviations(x: np.ndarray) -> list[int | None]:
        z = x - whole
        if int(np.abs(z).max()) * n + n < isqrt((2**63 - 1) // d):
            return np.square(z * n - rest).sum(axis=1).tolist()
        exact = [sum((n * int(a) - int(r)) ** 2 for a, r in zip(row, rest, strict=True)) for row in z]
        return [v if v < 2**63 else None for v in exact]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, ids in zip(_arrays(iter([batch]), d), batch.column("ids"), strict=True):
                rows = len(x)
                place = np.repeat(np.arange(rows), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n)),
                     pa.array(deviations(x), pa.int64()).take(pa.array(place)), pa.array((centred(x) @ scaled).ravel()),
                     pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return cov.vectors.blocks.mapInArrow(each, _SCHEMA)


def identity_error(cov: Covariance, found: Components) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity: one more pass, over the results themselves."""
    centred, scaled = cov.centred(), found.directions / np.sqrt(found.values)
    k = scaled.shape[1]

    def part(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ scaled
        return (w.T @ w).ravel()

    return float(np.abs(cov.vectors.total(part, k * k).reshape(k, k) / cov.vectors.n - np.eye(k)).max())


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector."""
    usable = whole_vectors(vectors, vec_id, vector)
    if usable is not None:
        cov = Covariance(usable)
        found = components(cov, count)
        if len(found.values):
            return projected(cov, found, identity_error(cov, found))
    return vectors.sparkSession.createDataFrame([], _SCHEMA)


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
