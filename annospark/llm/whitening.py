"""Whitening of embeddings by shifted CholeskyQR: Gram passes over all rows, small triangular factors on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annospark.llm.common import stored

#: An entry c becomes the integer floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Gram passes: one with a shift, and two that take what the first left to orthogonality.
PASSES = 3
#: Eigenvalues below this share of the largest are no direction of the data.
LEAST_SHARE = 1e-13
#: Partial sums that the driver gets at most.
_ARMS = 16
#: Entries beyond this size would not leave room for exact sums; they count as that size.
_LARGEST = 1 << 52
_EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learned: rows ``n`` and sums per dimension of the integer vectors, unit directions as rows, by falling eigenvalue
    of the covariance, the eigenvalues, and the covariance's trace."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def integer_vectors(batch: pa.RecordBatch, dimensions: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the batch that have a usable vector, their entries as integers). Usable: not null, not empty, without null, NaN or
    infinite entries, and of this many dimensions."""
    lists = batch.column("vector")
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.values.slice(lists.offsets[0].as_py(), int(lengths.sum()))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    starts = np.cumsum(lengths) - lengths
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (bad[starts + lengths] == bad[starts]) & (lengths > 0) & lists.is_valid().to_numpy(zero_copy_only=False)
    if dimensions is None:
        return np.flatnonzero(good), lengths
    rows = np.flatnonzero(good & (lengths == dimensions))
    found = np.floor(SCALE * values[starts[rows][:, None] + np.arange(dimensions)])
    return rows, np.clip(found, -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _column_sums(x: np.ndarray) -> list[int]:
    """Exact sums per column: the high and the low 26 bits apart, so that no sum leaves 64 bits."""
    return [int(h) * (1 << 26) + int(low) for h, low in zip((x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0))]


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit integers where all fit, else Python's."""
    top = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums), default=0)
    kind = np.int64 if top < 1 << 62 else object
    return n * x.astype(kind) - np.array(sums, dtype=kind)


def squared_lengths(dev: np.ndarray) -> list[int | None]:
    """Exact sums of squares of each row; None where that leaves a long."""
    top = int(np.abs(dev).max(initial=0))
    if top * top * max(1, dev.shape[1]) >= 1 << 63:
        dev = dev.astype(object)
    return [int(v) if int(v) < 1 << 63 else None for v in (dev * dev).sum(axis=1)]


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(T.ArrayType(T.DoubleType())).alias("vector"))


def _dimensions(vectors: DataFrame) -> int:
    """The most common length of usable vectors, of equal ones the largest; 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths = integer_vectors(batch)
            size, count = np.unique(lengths[rows], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int64)), pa.array(count.astype(np.int64))], ["size", "n"])

    sizes = vectors.select("vector").mapInArrow(run, "size long, n long").groupBy("size").agg(F.sum("n").alias("n"))
    best = sizes.agg(F.max_by("size", F.struct("n", "size")).alias("size")).first()
    return best["size"] or 0


def _summed(vectors: DataFrame, dimensions: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum over all tasks of what ``add`` makes of each batch of integer rows. Each task sends one array; these meet in ``_ARMS``
    tasks before the driver gets one from each, so it holds as many however large the input is. Sums are float64."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows, x = integer_vectors(batch, dimensions)
            if len(rows):
                found = add(x)
                held = found if held is None else held + found
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["part"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for raw in batch.column("part").to_pylist():
                found = np.frombuffer(raw)
                held = found if held is None else held + found
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["part"])

    parts = vectors.select("vector").mapInArrow(partial, "part binary").repartition(_ARMS).mapInArrow(total, "part binary").collect()
    return sum(np.frombuffer(r["part"]) for r in parts) if parts else None


def _counted(vectors: DataFrame, dimensions: int) -> tuple[int, tuple[int, ...]]:
    """Rows and exact sums per dimension; sums travel as two halves, so that no long overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dimensions
        for batch in batches:
            rows, x = integer_vectors(batch, dimensions)
            n += len(rows)
            sums = [a + b for a, b in zip(sums, _column_sums(x))]
        columns = [range(-1, dimensions), [0, *(s >> 32 for s in sums)], [n, *(s & 0xFFFFFFFF for s in sums)]]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["k", "high", "low"])

    halves = vectors.select("vector").mapInArrow(run, "k long, high long, low long").groupBy("k").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    found = {r["k"]: (r["high"] << 32) + r["low"] for r in halves.collect()}  # a row per dimension
    return found.get(-1, 0), tuple(found.get(k, 0) for k in range(dimensions))


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of upper triangular factors, each by forward substitution over the columns; none is inverted."""
    for r in factors:
        q = np.empty_like(rows)
        for j in range(r.shape[0]):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def _factor(gram: np.ndarray, shift: float) -> np.ndarray | None:
    """The upper Cholesky factor of a shifted Gram matrix, or None where it is not positive definite."""
    try:
        r = np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
    except np.linalg.LinAlgError:
        return None
    return r if (np.diag(r) > 0).all() and np.isfinite(r).all() else None


def _root(gram: np.ndarray) -> np.ndarray:
    """A factor R with RᵀR = gram where the data don't fill all dimensions, so that it has no Cholesky factor."""
    values, vectors = np.linalg.eigh(gram)
    return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def fit(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", passes: int = PASSES) -> Whitening:
    """Directions and variances of all usable vectors.

    Centred rows A are never stored. Each pass sums the Gram matrix of A R1⁻¹ ... Rk⁻¹ over all rows, with triangular solves in the
    tasks, and the driver factors it: the first one shifted by 11 (n d + d (d + 1)) u ‖A‖², which makes the factor exist however
    ill-conditioned A is, the following ones only where they need it. The last Gram matrix is close to the identity, or to a
    projection where A has no full rank; its square root then takes the place of its Cholesky factor. The product of the factors is
    R with RᵀR = AᵀA, and R's singular vectors and values are the directions and the roots of n times the variances.

    Vectors of another length than the most common one don't count, as those with null, NaN or infinite entries. Without rows, or
    where all are equal, there is no direction. Entries beyond 2^52 / SCALE count as that. The driver holds d x d numbers.
    """
    vectors = stored(_vectors(table, id_col, vector_col), "vectors")
    d = _dimensions(vectors)
    n, sums = _counted(vectors, d) if d else (0, ())
    nothing = Whitening(n, sums, np.zeros((0, d)), np.zeros(0), 0.0)
    if not n:
        return nothing
    factors: list[np.ndarray] = []
    last = None
    for k in range(passes):
        inverse = tuple(factors)

        def gram(x: np.ndarray) -> np.ndarray:
            q = solved(deviations(x, n, sums).astype(np.float64) / n, list(inverse))
            return q.T @ q

        g = _summed(vectors, d, lambda x: gram(x).ravel()).reshape(d, d)
        size = float(np.linalg.norm(g, 2))
        if size == 0:
            return nothing
        shift = 11 * (n * d + d * (d + 1)) * _EPS / 2 * size
        if k == passes - 1:
            r = _factor(g, 0.0)
            last = _root(g) if r is None else r
        else:
            r = None if k == 0 else _factor(g, 0.0)
            while r is None:
                r, shift = _factor(g, shift), 10 * shift
            factors.append(r)
    whole = last
    for r in reversed(factors):
        whole = whole @ r
    _, values, directions = np.linalg.svd(whole)
    variances = values**2 / n
    keep = variances > LEAST_SHARE * variances[0] if variances[0] > 0 else np.zeros(d, bool)
    return Whitening(n, sums, directions[keep], variances[keep], float(variances.sum()))


def projected(x: np.ndarray, model: Whitening, components: int) -> np.ndarray:
    """Whitened coordinates of integer rows along the first directions."""
    centred = deviations(x, model.n, model.sums).astype(np.float64) / model.n
    return centred @ (model.directions[:components] / np.sqrt(model.eigenvalues[:components])[:, None]).T


def identity_error(table: DataFrame, model: Whitening, components: int, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened coordinates' covariance minus the identity, measured in two passes over all rows."""
    k = min(components, len(model.eigenvalues))
    if not k:
        return 0.0
    vectors = _vectors(table, id_col, vector_col)
    mean = _summed(vectors, len(model.sums), lambda x: projected(x, model, k).sum(axis=0)) / model.n

    def outer(x: np.ndarray) -> np.ndarray:
        z = projected(x, model, k) - mean
        return (z.T @ z).ravel()

    return float(np.abs(_summed(vectors, len(model.sums), outer).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(table: DataFrame, model: Whitening, components: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened) of each usable row: the exact sum over dimensions of (n x - sums)^2, null where that leaves a long,
    and an array of coordinates. Rows whose id repeats or is null stay apart; other columns are never read."""
    d, k = len(model.sums), len(model.eigenvalues) if components is None else min(components, len(model.eigenvalues))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = integer_vectors(batch, d)
            z = projected(x, model, k) if k else np.zeros((len(rows), 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(z.ravel()))
            far = pa.array(squared_lengths(deviations(x, model.n, model.sums)) if len(rows) else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), far, lists], ["vec_id", "deviation", "whitened"])

    return _vectors(table, id_col, vector_col).mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str, components: int = 8) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit(rows)
    error = identity_error(rows, model, components)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:components]]).cast("array<double>")
    return whiten(rows, model, components).select("vec_id", F.posexplode("whitened").alias("k", "whitened"), "deviation").select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
