"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 13).

The wanted components are those of the largest eigenvalues of the covariance.
A block of a few more columns than wanted is multiplied by a Chebyshev
polynomial of the covariance: on the unwanted part of the spectrum, from 0 to
the least Ritz value of the block, the polynomial stays within 1, above it
grows fast. The covariance itself is never built: a step of the recurrence is
one pass over the data, each task adding up (x - mean)' ((x - mean) Q) of its
blocks. Then QR, Rayleigh-Ritz, and again until the residuals certify the
components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_rows, stage_mapped

COMPONENTS = 8
#: columns of the block besides the wanted ones; the gap to the first eigenvalue outside the block sets the speed
GUARD = 24
#: degree of the polynomial of one sweep
DEGREE = 10
#: certified when every wanted residual |Vq - eq| is at most this times the largest eigenvalue
TOLERANCE = 1e-12
SWEEPS = 200
SCALE, SHIFT = 1024, 100_000
#: entries beyond this have no exact double of their scaled value
LARGEST = float(1 << 40)
#: vectors of a block
ROWS = 1024


def scaled(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """The fit list as blocks ``(ids, x, lo, hi)``, and its dimension.

    A block holds up to ROWS vectors as little-endian longs, floor(SCALE * c) +
    SHIFT for every entry c, and the least and largest of them. Vectors that are
    null or hold null, non-finite entries or such of LARGEST and more are left
    out, so are empty ones and those of another length than the most frequent
    (the longer of equally frequent lengths).
    """
    usable = F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False))), F.lit(False))
    fit = embeddings.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(usable).where(F.size("v") > 0)
    top = fit.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = top["d"] if top else 0

    def pack(batches):
        for b in batches:
            for part in (b.slice(i, ROWS) for i in range(0, b.num_rows, ROWS)):
                c = part.column(1).flatten().to_numpy(zero_copy_only=False)
                x = np.floor(SCALE * c).astype("<i8") + SHIFT
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
                     pa.array([int(x.min())]), pa.array([int(x.max())])], names=["ids", "x", "lo", "hi"])

    blocks = fit.where(F.size("v") == dims).mapInArrow(pack, "ids array<bigint>, x binary, lo bigint, hi bigint")
    return stage_mapped(blocks, "vectors"), dims


def sums(blocks: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum in every dimension."""
    def work(batches):
        for (xs,) in batches:
            for b in xs:
                x = np.frombuffer(b, "<i8").reshape(-1, dims)
                yield [list(range(-1, dims)), [len(x), *x.sum(axis=0).tolist()]]  # |x| < 2**51: exact

    out = map_rows(blocks.select("x"), "dim int, s bigint", work).groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r["dim"]: int(r["s"]) for r in out.collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(dims)]


def _row_sums(df: DataFrame, schema_rows: int, columns: int, work) -> np.ndarray:
    """Sum over all batches of the ``schema_rows`` x ``columns`` matrices that ``work`` gives; summed by Spark."""
    names = [f"c{j}" for j in range(columns)]

    def run(batches):
        total = np.zeros((schema_rows, columns))
        for (xs,) in batches:
            for b in xs:
                total += work(b)
        yield [list(range(schema_rows)), *total.T.tolist()]

    got = map_rows(df, "r int, " + ", ".join(f"{n} double" for n in names), run).groupBy("r").agg(*[F.sum(n).alias(n) for n in names]).collect()
    out = np.zeros((schema_rows, columns))
    for r in got:
        out[r["r"]] = r[1:]
    return out


class Covariance:
    """The covariance of the blocks, as an operator: a product is one pass over them."""

    def __init__(self, blocks: DataFrame, dims: int):
        self.blocks, self.dims = blocks, dims
        self.n, self.total = sums(blocks, dims)
        self.mean = np.array([s / self.n if self.n else 0.0 for s in self.total])  # exact integers, divided once

    def times(self, q: np.ndarray) -> np.ndarray:
        dims, mean = self.dims, self.mean

        def work(b):
            z = np.frombuffer(b, "<i8").reshape(-1, dims) - mean
            return z.T @ (z @ q)
        return _row_sums(self.blocks.select("x"), dims, q.shape[1], work) / self.n

    def trace(self) -> float:
        dims, mean = self.dims, self.mean

        def work(b):
            z = np.frombuffer(b, "<i8").reshape(-1, dims) - mean
            return (z * z).sum(axis=0)[:, None]
        return float(_row_sums(self.blocks.select("x"), dims, 1, work).sum()) / self.n


def filtered(times, q: np.ndarray, vq: np.ndarray, edge: float, top: float, degree: int) -> np.ndarray:
    """T(V) q for the Chebyshev polynomial T of ``degree`` that maps [0, edge] to [-1, 1], scaled to 1 at ``top``.

    ``times(q)`` is Vq; the first product, ``vq``, is known already.
    """
    half = edge / 2
    grow = top / half - 1  # where the recurrence takes ``top``; sigma keeps the columns from overflowing
    sigma = first = 1 / grow
    before, here = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, here = here, (times(here) - half * here) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return here


def components(times, dims: int, wanted: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE,
               scale: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and unit eigenvectors (columns) of a positive semidefinite operator.

    ``times(q)`` multiplies ``dims`` x k matrices; each call may be a pass over
    the data. The result is certified: every residual is within ``tolerance``
    of the largest eigenvalue, and sweeps go on while they still fall to less
    than a half. Eigenvalues within rounding of 0 (relative to ``scale``, the
    trace) are left out. Raises if SWEEPS don't suffice.
    """
    width = min(dims, wanted + guard)
    wanted = min(wanted, width)
    q = np.linalg.qr(np.random.default_rng(13).standard_normal((dims, width)))[0]
    last = np.inf
    best = None
    for _ in range(SWEEPS):
        vq = times(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        if values[0] <= scale * 1e-14:
            return np.zeros(0), np.zeros((dims, 0))
        worst = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max()) / values[0]
        if best is None or worst < best[0]:
            best = worst, values[:wanted], q[:, :wanted]
        if best[0] <= tolerance and worst > last / 2 or width == dims and best[0] <= tolerance:
            keep = best[1] > scale * 1e-14
            return best[1][keep], best[2][:, keep]
        last = worst
        edge = max(float(values[-1]), float(values[0]) * 1e-12)
        # columns at or below the edge aren't amplified; q is replaced by an orthonormal basis of what the filter leaves
        q = np.linalg.qr(filtered(times, q, vq, edge, float(values[0]), degree) if width < dims else vq + q * edge)[0]
    raise RuntimeError(f"components not certified in {SWEEPS} sweeps: residual {best[0]:.3g}")


def deviations(x: np.ndarray, n: int, total: list[int], lo: int, hi: int) -> list[int | None]:
    """Exact sum of (n*x - S)**2 of every row; None where it doesn't fit a long."""
    dims = x.shape[1]
    far = max([max(abs(n * lo - s), abs(n * hi - s)) for s in total], default=0)
    if dims * far * far < 1 << 63 and n * max(abs(lo), abs(hi)) < 1 << 62:
        away = n * x - np.array(total, np.int64)
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, total)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component.

    The fit list (``scaled``) is every vector that is usable; others give no
    rows. Repeated rows count as often as they come, null ids are kept, further
    columns are ignored. Components with an eigenvalue of 0 can't be whitened
    and give no rows, so equal vectors, a single one or an empty table give an
    empty result, and d dimensions at most d components. Equal eigenvalues have
    no order of their own: their components are some orthonormal basis, the
    same for all rows. A deviation beyond a long is null. The driver holds
    matrices of dimension x block columns, whatever the number of vectors.
    """
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"
    blocks, dims = scaled(embeddings, vector, key)
    cov = Covariance(blocks, dims)
    trace = cov.trace() if cov.n else 0.0
    values, vectors = components(cov.times, dims, wanted, scale=trace) if trace > 0 else (np.zeros(0), np.zeros((0, 0)))
    if not len(values):
        return embeddings.sparkSession.createDataFrame([], schema + ", identity_error double")
    turn, share = vectors / np.sqrt(values), (values / trace).tolist()
    mean, n, total, k = cov.mean, cov.n, cov.total, len(values)

    def project(b):
        return (np.frombuffer(b, "<i8").reshape(-1, dims) - mean) @ turn

    def moments(b):
        w = project(b)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    second = _row_sums(blocks.select("x"), k + 1, k, moments) / n
    error = float(np.abs(second[:k] - np.outer(second[k], second[k]) - np.eye(k)).max())

    def work(batches):
        for ids, xs, los, his in batches:
            for i, b, lo, hi in zip(ids, xs, los, his):
                w = project(b)
                far = deviations(np.frombuffer(b, "<i8").reshape(-1, dims), n, total, lo, hi)
                rows = len(i)
                yield [np.repeat(np.array(i, object), k).tolist(), list(range(1, k + 1)) * rows, [n] * (rows * k),
                       np.repeat(np.array(far, object), k).tolist(), w.ravel().tolist(), share * rows]

    return map_rows(blocks.select("ids", "x", "lo", "hi"), schema, work).withColumn("identity_error", F.lit(error))
