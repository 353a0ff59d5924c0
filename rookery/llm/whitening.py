"""Whitening of embeddings along the leading components of their covariance, found by contour integration (FEAST).

Each entry becomes the integer floor(scale * c). The fit list holds every distinct integer vector once, whatever the number of its
copies. Its sums and its products, centred on the rounded mean, are added up exactly as integers by the tasks and by Spark, and the
rest of the centring is exact too, so the covariance is right to the last bit of a double and does not depend on the order of rows.

The covariance is dims x dims and goes to the driver; nothing there grows with the rows. An inertia count (signs of the pivots of the
factorised shifted matrix, after a reduction to three diagonals) says how many eigenvalues lie above any number, so bisection finds intervals that hold
the wanted ones. In each, the solutions of complex shifted systems at the nodes of a Gauss quadrature on a half circle, summed, project
a random block onto the eigenvectors inside; Rayleigh-Ritz on that block extracts them. An interval is done when as many Ritz values
lie in it as the inertia counts say and their residuals no longer shrink; otherwise the result would miss a component and it is an error.

Rows whose vector is null, empty, of an unusual length (see ``vectors.sound``) or holds null or non-finite entries take no part. Rows
with a null or repeated id stay, one by one. Components whose eigenvalue is zero, up to the rounding of the largest, do not exist: one
distinct vector, or none, gives an empty result. Columns other than the id and the vector are not read. ``deviation`` is null where a
long cannot hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.vectors import TOTALS, as_longs, integers, matrix, sound, summed, totals_batch
from rookery.workspace import stage

NODES = 8
ROUNDS = 40
STALLED = 3
FADED = 1e-8
HALVINGS = 60
SEED = 11
EXACT = 2**53
COINCIDE = 1e-13


@dataclass(frozen=True)
class Fit:
    """What the fit list says: its length, sums, exact covariance, and the leading components as rows."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray


def tridiagonal(v: np.ndarray) -> tuple[list[float], list[float]]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix of the same eigenvalues, by Householder reflections."""
    a = v.copy()
    for i in range(len(a) - 2):
        x = a[i + 1 :, i].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        if not (length := np.linalg.norm(x)):
            continue
        x /= length
        rest = a[i + 1 :, i + 1 :]
        w = rest @ x
        w -= x * (x @ w)
        a[i + 1 :, i + 1 :] = rest - 2 * np.outer(x, w) - 2 * np.outer(w, x)
        a[i + 1 :, i] -= 2 * x * (x @ a[i + 1 :, i])
    return np.diagonal(a).tolist(), (np.diagonal(a, -1) ** 2).tolist()


def count_above(bands: tuple[list[float], list[float]], shift: float) -> int:
    """Inertia: eigenvalues above the shift, by the signs of the pivots of the shifted matrix's factorisation."""
    diagonal, off = bands
    least = np.finfo(float).tiny * max(1.0, *off, 1.0)
    above, pivot = 0, 1.0
    for d, e in zip(diagonal, [0.0, *off]):
        pivot = d - shift - e / pivot
        if abs(pivot) < least:
            pivot = -least
        above += pivot > 0
    return above


def _place(bands, rank: int, low: float, high: float) -> float:
    """The eigenvalue of a rank (from 1, falling), by bisection; -inf beyond the last."""
    if rank > len(bands[0]):
        return -np.inf
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        if count_above(bands, middle) >= rank:
            low = middle
        else:
            high = middle
    return low


def intervals(v: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of disjoint intervals around the k largest, with none between them.

    An interval holds one eigenvalue, or several that are too near to be told apart, and ends half-way to the next one.
    Its upper end is as far, so that all other eigenvalues are at least two radii away from its centre.
    """
    bands, size = tridiagonal(v), len(v)
    bound = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-6)
    apart = COINCIDE * size * bound
    out, ceiling, done = [], bound, 0
    while done < k:
        first = last = _place(bands, done + 1, -bound, ceiling)
        after = _place(bands, done + 2, -bound, ceiling)
        while last - after <= apart:
            last, after = after, _place(bands, count_above(bands, after - apart) + 1, -bound, ceiling)
        margin = min((last - after) / 2, (ceiling - first) / 2, bound)
        low, high = last - margin, first + margin
        above = count_above(bands, low)
        if count_above(bands, high) != done:
            raise ArithmeticError("eigenvalues lie between two intervals")
        out.append((low, high, above - done))
        ceiling, done = low, above
    return out


def project(v: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block times the spectral projector of the interval, by quadrature of shifted solves over a half circle."""
    middle, radius = (low + high) / 2, (high - low) / 2
    total = np.zeros_like(block)
    for t, weight in zip(*np.polynomial.legendre.leggauss(NODES)):
        arm = radius * np.exp(1j * np.pi / 2 * (1 + t))
        total += weight / 2 * np.real(arm * np.linalg.solve((middle + arm) * np.eye(len(v)) - v, block.astype(complex)))
    return total


def inside(v: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in the interval, falling, and their unit eigenvectors as columns; an error if one is missed."""
    size, scale = len(v), float(np.abs(v).max())
    block = np.random.default_rng(SEED).standard_normal((size, min(size, 2 * count + 8)))
    best, stalled = None, 0
    for _ in range(ROUNDS):
        basis, kept, _ = np.linalg.svd(project(v, block, low, high), full_matrices=False)
        basis = basis[:, kept > FADED * kept[0]]  # what the projector has taken away would come back as spurious Ritz values
        values, turn = np.linalg.eigh(basis.T @ v @ basis)
        block = basis @ turn
        held = (values > low) & (values <= high)
        if held.sum() != count:
            continue
        residual = float(np.linalg.norm(v @ block[:, held] - block[:, held] * values[held], axis=0).max())
        stalled = stalled + 1 if best is not None and residual >= best[0] / 2 else 0
        if best is None or residual < best[0]:
            best = residual, values[held][::-1], block[:, held][:, ::-1]
        if residual <= np.finfo(float).eps * scale or stalled == STALLED:
            break
    if best is None or best[0] > 1e-9 * scale * size:
        raise ArithmeticError(f"the interval holds {count} eigenvalues by inertia, but the projection did not settle on them")
    return best[1], best[2]


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues that are not zero, falling, and unit eigenvectors as rows, largest entry positive."""
    scale = float(np.abs(v).max()) if v.size else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((0, len(v)))
    k = min(k, count_above(tridiagonal(v), scale * len(v) * len(v) * np.finfo(float).eps))
    found = [inside(v, *interval) for interval in intervals(v, k)]
    basis, _ = np.linalg.qr(np.concatenate([vectors for _, vectors in found], axis=1))
    values, turn = np.linalg.eigh(basis.T @ v @ basis)  # makes the vectors of neighbouring intervals orthogonal too
    rows = (basis @ turn).T[::-1][:k]
    rows = rows * np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)])[:, None]
    return values[::-1][:k], rows


def products(y: np.ndarray) -> np.ndarray:
    """y transposed times y as exact integers: in doubles, in runs of rows whose sums stay below 2^53, else one by one."""
    most = max(1, int(np.abs(y).max(initial=0))) if y.dtype != object else EXACT
    if most >= 2**26:
        y = y.astype(object)
        return y.T @ y
    rows, total = max(1, EXACT // (most * most)), np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _added(batches: Iterator[pa.RecordBatch], of: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            part = of(matrix(batch, "ints"))
            total = part if total is None else total + part
    if total is not None:
        yield from totals_batch(total)


def fit(distinct: DataFrame, k: int) -> Fit | None:
    """Exact moments of the distinct integer vectors (column ``ints``) and their k leading components."""
    head = distinct.select(F.size("ints").alias("dims")).first()
    if head is None:
        return None
    dims = head["dims"]

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(batches, lambda x: np.array([[len(x), *x.astype(object).sum(axis=0)]], object))

    counted = summed(distinct.mapInArrow(sums_of, TOTALS), (1, dims + 1))[0]
    n, sums = int(counted[0]), counted[1:]
    shift = (2 * sums + n) // (2 * n)  # the rounded mean

    def products_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _added(batches, lambda x: products(_minus(x, shift)))

    squares = summed(distinct.mapInArrow(products_of, TOTALS), (dims, dims))
    rest = sums - n * shift
    v = ((n * squares - np.outer(rest, rest)) / (n * n)).astype(np.float64)
    values, components = leading(v, k)
    return Fit(n, sums, v, values, components)


def _minus(x: np.ndarray, shift: np.ndarray, times: int = 1) -> np.ndarray:
    """times * x - shift without overflow."""
    reach = times * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, shift.tolist()))
    if reach < 2**62:
        return x * times - shift.astype(np.int64)
    return x.astype(object) * times - shift


def whitened(rows: DataFrame, found: Fit) -> DataFrame:
    """The rows (with ``id`` and ``ints``) as (id, deviation, w): exact squared distance to the sums, and the projections."""
    turn = (found.components / np.sqrt(found.values)[:, None]).T
    n, sums = found.n, found.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = _minus(matrix(batch, "ints"), sums, n)
            reach = int(np.abs(away).max(initial=0))
            exact = away if reach * reach * away.shape[1] < 2**63 else away.astype(object)
            w = away.astype(np.float64) / n @ turn
            lists = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), as_longs((exact * exact).sum(axis=1)), lists], ["id", "deviation", "w"]
            )

    return rows.select("id", "ints").mapInArrow(run, "id long, deviation long, w array<double>")


def identity_error(distinct: DataFrame, found: Fit) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, both centred before multiplying."""
    k = len(found.values)
    w = whitened(distinct.withColumn("id", F.lit(None).cast("long")), found).select(
        *[F.col("w")[i].alias(f"w{i}") for i in range(k)]
    )
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    entries = w.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(entry - (i == j)) for entry, (i, j) in zip(entries, pairs))


def report(vectors: DataFrame, *, k: int = 4, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each kept row and component."""
    rows = stage(sound(vectors, key, vector).select("id", integers(scale).alias("ints")), "whitening-rows")
    distinct = stage(rows.select("ints").distinct(), "whitening-fit")
    found = fit(distinct, k)
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame(
            [], f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    off = identity_error(distinct, found)
    trace = float(np.trace(found.covariance))
    explained = F.array(*[F.lit(float(e) / trace) for e in found.values])
    return whitened(rows, found).select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("id").alias(key),
        (F.col("at") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(off).alias("identity_error"),
    )
