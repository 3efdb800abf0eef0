"""Whitening of embeddings by pivoted Cholesky of their scatter and one-sided Jacobi.

Entries become whole numbers, so counts, sums and the scatter are exact whatever the
order in which tasks add them up: values are centred by a whole number near the mean
before they are multiplied, and the rest of the mean is taken off in whole numbers on
the driver, which holds a row per pair of dimensions.

The scatter A is factored with pivoting, P'AP = LL'. Jacobi rotations of the columns of
L from the right make them orthogonal, L J = U S: since A is then (PU) S S (PU)', the
squared norms of the rotated columns are the eigenvalues and the normalised columns,
put back in order, the components. A itself is never rotated or squared, so small
eigenvalues keep their digits.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond do not become a long with room for differences.
LARGEST = 2**61
SWEEPS = 60
EPS = float(np.finfo(float).eps)
LIMB = 64


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (rows in pivot order, one column per rank) and the order, with a[order][:, order] = L L'.

    Ends where the largest diagonal entry left is rounding error of the first.
    """
    n = len(a)
    order, left, factor = np.arange(n), a.diagonal().astype(float), np.zeros((n, n))
    floor = n * EPS * left.max(initial=0.0)
    for k in range(n):
        p = k + int(np.argmax(left[k:]))
        if not left[p] > floor:
            return factor[:, :k], order
        for x in (order, left, factor):
            x[[k, p]] = x[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        below = slice(k + 1, n)
        factor[below, k] = (a[order[below], order[k]] - factor[below, :k] @ factor[k, :k]) / factor[k, k]
        left[below] -= factor[below, k] ** 2
    return factor, order


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns in rounds of disjoint pairs."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(i, j) for i, j in zip(ring[: len(ring) // 2], reversed(ring)) if max(i, j) < n]
        out.append(tuple(np.array(side, np.int64) for side in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2)
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated among each other until all pairs are orthogonal to working precision."""
    x = factor.copy()
    for _ in range(SWEEPS):
        turned = False
        for i, j in rounds(x.shape[1]):
            one, other = x[:, i], x[:, j]
            a, b, g = (one**2).sum(0), (other**2).sum(0), (one * other).sum(0)
            turn = np.abs(g) > 4 * EPS * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            i, j, one, other, a, b, g = i[turn], j[turn], one[:, turn], other[:, turn], a[turn], b[turn], g[turn]
            zeta = (b - a) / (2 * g)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            x[:, i], x[:, j] = c * one - c * t * other, c * t * one + c * other
        if not turned:
            break
    return x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding error, falling, and their unit vectors as columns, each with its largest entry positive."""
    factor, order = pivoted_cholesky(a)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned**2).sum(0))
    rank = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned[:, rank] / norms[rank]
    if vectors.size:
        vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return norms[rank] ** 2, vectors


def whole(vectors: pa.Array, size: int, scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``size`` finite entries, and their entries c as floor(scale * c) + shift."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy()
    rows = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False) & (np.diff(offsets) == size))
    entries = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    picked = entries[offsets[rows][:, None] + np.arange(size)]
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(picked * scale)
        usable = (np.isfinite(scaled) & (np.abs(scaled) < LARGEST)).all(axis=1)
    return rows[usable], scaled[usable].astype(np.int64) + shift


def exact_product(y: np.ndarray) -> np.ndarray:
    """y'y of whole numbers, as Python integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 2**53:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    z = y.astype(object)
    return z.T @ z


def exact_sum(y: np.ndarray) -> np.ndarray:
    most = int(np.abs(y).max(initial=0))
    return (y if most * len(y) < 2**62 else y.astype(object)).sum(axis=0).astype(object)


def decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


@dataclass
class Whitening:
    """n usable vectors with sums S; ``near`` + rest / n is the mean; components as columns, their eigenvalues and the trace of the covariance."""

    n: int
    sums: list[int]
    near: np.ndarray
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Entries less their means on the components, in deviations of each."""
        mean = np.array([r / self.n for r in self.rest])
        return ((x - self.near) - mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2; none if it is no long."""
        y = x - self.near
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * max(1, y.shape[1]) < 2**63:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        z = self.n * y.astype(object) - np.array(self.rest, object)
        return [v if v < 2**63 else None for v in (z**2).sum(axis=1).tolist()]


def usual_size(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have, the larger one of two."""
    sizes = rows.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    first = sizes.agg(F.max(F.struct("n", "size")).alias("m")).first()["m"]
    return first["size"] if first else 0


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Mean, components and eigenvalues of all usable vectors, none if no component has a variance."""
    ship(rows.sparkSession)
    rows = rows.select(vector)
    size = usual_size(rows, vector)
    if not size:
        return None

    def sums(batches):
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            _, x = whole(batch.column(0), size, scale, shift)
            n += len(x)
            total = total + exact_sum(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, size), pa.int32()), decimals([n, *total])], names=["i", "s"])

    added = rows.mapInArrow(sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    found = {r["i"]: int(r["s"]) for r in added.collect()}
    n = found.pop(-1, 0)
    if not n:
        return None
    total = [found[i] for i in range(size)]
    near = [s // n for s in total]
    rest = [s - n * m for s, m in zip(total, near)]
    centre, upper = np.array(near, np.int64), np.triu_indices(size)

    def scatter(batches):
        total = np.zeros((size, size), object)
        for batch in batches:
            _, x = whole(batch.column(0), size, scale, shift)
            if len(x):
                total = total + exact_product(x - centre)
        parts = total[upper]
        columns = [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), decimals(v >> LIMB for v in parts), decimals(v & (2**LIMB - 1) for v in parts)]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "high", "low"])

    products = rows.mapInArrow(scatter, "i int, j int, high decimal(38,0), low decimal(38,0)")
    products = products.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    covariance = np.zeros((size, size))
    for r in products.collect():
        i, j = r["i"], r["j"]
        exact = n * ((int(r["high"]) << LIMB) + int(r["low"])) - rest[i] * rest[j]
        covariance[i, j] = covariance[j, i] = exact / (n * n)
    values, vectors = eigen(covariance)
    k = min(components, len(values))
    if not k:
        return None
    return Whitening(n, total, centre, rest, values[:k], np.ascontiguousarray(vectors[:, :k]), float(np.trace(covariance)))


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity; the mean is taken off before products are."""
    size, k = len(model.sums), len(model.values)

    def summed(product, shape: str):
        def run(batches):
            total = 0
            for batch in batches:
                _, x = whole(batch.column(0), size, scale, shift)
                total = total + product(model.project(x))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], names=["i", "s"])

        added = rows.select(vector).mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
        return np.array([r["s"] for r in added.orderBy("i").collect()])

    mean = summed(lambda w: w.sum(axis=0), "k") / model.n
    covariance = summed(lambda w: (w - mean).T @ (w - mean), "kk").reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def whitened(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """For each usable vector and component: ``key``, component, n, deviation, whitened, explained and identity_error.

    Left out are null vectors, those with null or non-finite entries, those of another
    length than most have (of two lengths as frequent, the larger counts), and entries that
    are no long with room for differences. Rows that repeat count and are returned as
    often as they occur, and so are null keys. There are fewer components if fewer have a variance, so none
    for one vector, for equal ones and for an empty table. A deviation that is no long is null.
    """
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[key]
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = rows.select(key, vector)
    model = fit(rows, vector, components, scale, shift)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, model, vector, scale, shift)
    size, k = len(model.sums), len(model.values)
    explained = model.values / model.trace

    def run(batches):
        for batch in batches:
            at, x = whole(batch.column(1), size, scale, shift)
            each = np.repeat(np.arange(len(at)), k)
            columns = [
                batch.column(0).take(pa.array(at[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(each), model.n, np.int64)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array(model.project(x).reshape(-1)),
                pa.array(np.tile(explained, len(at))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
