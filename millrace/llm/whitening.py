"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the vectors' covariance V are found without V: a pass over the rows gives VQ for a thin
block Q (rows are centred, multiplied with Q and multiplied back, and the tasks' sums are added by Spark). A
polynomial of V is applied to the block by such passes: V has no negative eigenvalue, so the Chebyshev polynomial
that is small between zero and the block's smallest Ritz value damps all that is not wanted, and grows fast above.
Then the block is made orthonormal (QR), rotated to its Ritz vectors (Rayleigh-Ritz), and the residuals
|Vq - eq| of the wanted ones are looked at. It ends when they are as small as double precision allows; a
residual bounds the distance of a Ritz value to an eigenvalue, and over the gap to the next one the angle to its vector.
Where a spectrum is too flat for that in ``ROUNDS`` rounds, the block is widened, at the most to the whole space.

Entries are taken as whole numbers x = floor(scale * c) + shift, so that sums, means and deviations are exact. Rows
are packed into blocks of some MB in a stored table that every pass reads; only sums of (dimension x block width)
numbers, which do not grow with the rows, come to the driver.

Defined results: a row is dropped if its vector is null or empty, holds null, NaN or an infinite entry or one that no
64-bit integer can take, or has another length than most vectors have (the shorter of equally frequent lengths).
Rows with equal or null ids are rows like any other; other columns play no part. Directions without variance (an
eigenvalue below ``FLAT`` times the largest) give no component, so an empty table, one row or equal rows give no rows.
Components of equal eigenvalues are any basis of their space, the same for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.chunks import stored

#: Bytes of numbers in a block of rows.
BLOCK_BYTES = 2 << 20
#: Columns of the iterated block beyond four times the wanted ones: a wide block puts the filter's bound far below them.
GUARD = 8
#: Degree of the polynomial between two Rayleigh-Ritz steps.
DEGREE = 8
#: Residual, as a share of the largest eigenvalue, at which rounding decides; and the one that must be reached.
ROUNDING, CERTIFIED = 2e-15, 1e-10
#: Share of the largest eigenvalue below which a direction counts as flat.
FLAT = 1e-11
#: Rounds after which the block is made twice as wide, if the spectrum is so flat that it is not certified by then.
ROUNDS = 24


@dataclass(frozen=True)
class Fit:
    """Whitening learnt from rows: ``components`` has a unit eigenvector a column, by falling ``eigenvalues``.
    ``sums`` are exact; ``residuals`` are |Vq - eq|; ``passes`` counts the passes over the rows."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    residuals: np.ndarray
    trace: float
    passes: int


def numbers(blob: pa.BinaryScalar, dim: int) -> np.ndarray:
    """The rows of a block."""
    return np.frombuffer(blob.as_py(), np.int64).reshape(-1, dim)


class Vectors:
    """The usable rows of a table as blocks of whole numbers."""

    def __init__(self, rows: DataFrame, vector: str, id_column: str, scale: int = 1, shift: int = 0, block_bytes: int = BLOCK_BYTES):
        self.spark = rows.sparkSession
        slim = rows.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v"))
        # NaN and infinite entries, and those beyond 64 bits, fail the comparison.
        limit = float((1 << 62) // max(scale, 1))
        slim = slim.where(F.coalesce(F.forall("v", lambda c: F.coalesce(F.abs(c) < limit, F.lit(False))), F.lit(False)))
        lengths = slim.groupBy(F.size("v").alias("k")).agg(F.count("*").alias("n")).where("k > 0")
        most = lengths.orderBy(F.desc("n"), "k").first()
        self.dim, self.n = (most["k"], most["n"]) if most else (0, 0)
        slim = slim.where(F.size("v") == self.dim)
        self.id_type = slim.schema["id"].dataType
        dim, step = self.dim, max(1, block_bytes // (8 * max(self.dim, 1)))

        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    values = part.column("v").flatten().to_numpy().reshape(-1, dim)
                    x = np.floor(values * float(scale)).astype(np.int64) + shift
                    ids = part.column("id")
                    listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                    yield pa.RecordBatch.from_arrays([listed, pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

        shape = T.StructType([T.StructField("ids", T.ArrayType(self.id_type)), T.StructField("x", T.BinaryType())])
        self.blocks = stored(slim.mapInArrow(pack, shape), "vectors")
        self.passes = 0

    def summed(self, fn: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum of ``fn(x)``, an array of ``size`` doubles, over all blocks of rows."""
        if not self.n:
            return np.zeros(size)
        self.passes += 1
        dim = self.dim

        def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(size), False
            for batch in batches:
                for blob in batch.column("x"):
                    total += fn(numbers(blob, dim)).ravel()
                    seen = True
            if seen:
                yield pa.RecordBatch.from_pydict({"total": pa.array([total], pa.list_(pa.float64()))})

        tasks = max(2 * self.spark.sparkContext.defaultParallelism, 1)
        parts = self.blocks.select("x").coalesce(tasks).mapInArrow(part, "total array<double>")
        found = parts.select(F.posexplode("total").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(size)
        out[[r["at"] for r in found]] = [r["value"] for r in found]
        return out

    def sums(self) -> list[int]:
        """Exact sums of every dimension: halves of the numbers are added apart, so that nothing overflows."""
        if not self.n:
            return []
        self.passes += 1
        dim = self.dim

        def part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            high, low = np.zeros(dim, object), np.zeros(dim, object)
            for batch in batches:
                for blob in batch.column("x"):
                    x = numbers(blob, dim)
                    high += (x >> 32).sum(axis=0).astype(object)
                    low += (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            total = [str((int(h) << 32) + int(v)) for h, v in zip(high, low)]
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(dim), pa.int32()), "total": pa.array(total, pa.string())})

        parts = self.blocks.select("x").mapInArrow(part, "at int, total string")
        rows = parts.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        found = {r["at"]: int(r["total"]) for r in rows}
        return [found[i] for i in range(dim)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off exactly first."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(float) - rest


def fit(vectors: Vectors, components: int, seed: int = 1) -> Fit:
    """The leading ``components`` eigenvectors of the covariance (divisor n)."""
    n, dim, sums = vectors.n, vectors.dim, vectors.sums()
    none = Fit(n, sums, np.zeros(0), np.zeros((dim, 0)), np.zeros(0), 0.0, vectors.passes)
    if not n:
        return none
    width = min(dim, 4 * components + GUARD)

    def product(q: np.ndarray) -> np.ndarray:
        """VQ by one pass over the rows."""

        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x, n, sums)
            return y.T @ (y @ q)

        return vectors.summed(part, q.size).reshape(q.shape) / n

    trace = vectors.summed(lambda x: np.array([(centred(x, n, sums) ** 2).sum()]), 1)[0] / n
    if trace == 0:
        return none
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((dim, width)))
    wanted, before = min(components, width), np.inf
    for step in count(1):
        z = product(q)
        h = q.T @ z
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        residuals = np.linalg.norm(z - q * values, axis=0)[:wanted]
        worst = residuals.max() / values[0]
        # A block as wide as the space holds every eigenvector.
        if worst <= ROUNDING * dim or (worst <= CERTIFIED and worst > before / 2) or q.shape[1] == dim:
            break
        before = worst
        if step % ROUNDS:
            q = filtered(product, q, z, values)
        else:
            more = rng.standard_normal((dim, min(dim, 2 * q.shape[1]) - q.shape[1]))
            q, _ = np.linalg.qr(np.concatenate((q, more), axis=1))
    real = int((values[:wanted] > FLAT * values[0]).sum())
    return Fit(n, sums, values[:real], q[:, :real], residuals[:real], trace, vectors.passes)


def filtered(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, z: np.ndarray, values: np.ndarray) -> np.ndarray:
    """An orthonormal basis of p(V)q for the Chebyshev polynomial p that is at most 1 between 0 and the smallest Ritz
    value. ``z`` is Vq. The recurrence is scaled so that p is 1 at the largest Ritz value and nothing overflows."""
    half = max(values[-1], FLAT * values[0]) / 2
    first = half / (values[0] - half) if values[0] > half else 1.0
    ratio = first
    old, new = q, (z - half * q) * (ratio / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - ratio)
        old, new = new, (product(new) - half * new) * (2 * following / half) - (ratio * following) * old
        ratio = following
    return np.linalg.qr(new)[0]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over the dimensions of (n * x - S)**2, in 64 bits where they suffice and in Python's integers else."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    near = x - whole
    most = (int(np.abs(near).max()) + 1) * n if x.size else 0
    if most * most * len(sums) < 1 << 63:
        return ((near * n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    return [sum((int(v) * n - r) ** 2 for v, r in zip(row, rest)) for row in near]


def identity_error(vectors: Vectors, fitted: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, by one pass."""
    k = len(fitted.eigenvalues)
    if not k:
        return 0.0
    matrix = fitted.components / np.sqrt(fitted.eigenvalues)

    def part(x: np.ndarray) -> np.ndarray:
        w = centred(x, fitted.n, fitted.sums) @ matrix
        return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

    found = vectors.summed(part, k + k * k) / fitted.n
    mean, square = found[:k], found[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def transform(vectors: Vectors, fitted: Fit) -> DataFrame:
    """(id, whitened array, deviation decimal) of every usable row."""
    k, dim = len(fitted.eigenvalues), vectors.dim
    matrix = fitted.components / np.sqrt(fitted.eigenvalues)
    n, sums = fitted.n, fitted.sums

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, blob in zip(batch.column("ids"), batch.column("x")):
                x = numbers(blob, dim)
                w = centred(x, n, sums) @ matrix
                flat = pa.array(w.ravel())
                offsets = pa.array(np.arange(0, w.size + 1, max(k, 1), dtype=np.int32)[: len(x) + 1])
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.ListArray.from_arrays(offsets, flat), pa.array([str(d) for d in deviations(x, n, sums)])],
                    ["id", "whitened", "deviation"],
                )

    shape = T.StructType(
        [
            T.StructField("id", vectors.id_type),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
            T.StructField("deviation", T.StringType()),
        ]
    )
    rows = (vectors.blocks if k else vectors.blocks.limit(0)).mapInArrow(each, shape)
    return rows.withColumn("deviation", F.expr("try_cast(deviation as decimal(38,0))"))


def digest(rows: DataFrame, components: int, id_column: str = "vec_id", vector: str = "embedding", scale: int = 1024, shift: int = 100000) -> DataFrame:
    """One row per usable row and component, with the eigenvalue's share of the variance and the fit's own check.
    ``deviation`` is null where it does not fit 64 bits."""
    vectors = Vectors(rows, vector, id_column, scale, shift)
    fitted = fit(vectors, components)
    error = identity_error(vectors, fitted)
    shares = [float(e / fitted.trace) for e in fitted.eigenvalues]
    explained = F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("component")) if shares else F.lit(0.0)
    return (
        transform(vectors, fitted)
        .select("id", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
        .withColumn("component", F.col("at") + 1)
        .select(
            F.col("id").alias(id_column),
            "component",
            F.lit(fitted.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            explained.alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
