"""Whitening of embeddings with components by FEAST contour integration.

Spark counts the distinct vectors, their sums and their covariance. Inertia
counts (how many eigenvalues lie above a shift, from the signs of the pivots)
then cut the spectrum into slices whose ends lie in gaps. Each slice is a task
of its own: a quadrature over a circle around it, one complex shifted solve per
node, projects a random block onto the slice's eigenspace; Rayleigh-Ritz
extracts values and vectors; and the slice is done when as many values lie in
it as inertia counts, with small residuals. Nothing that grows
with the rows reaches the driver, only matrices of the vectors' width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm.common import store
from vialflow.llm.vafile import finite

#: Quadrature nodes on the upper half of a contour.
NODES = 12
#: Eigenvalues that a slice may hold before it is cut, if a gap allows.
SLICE = 8
#: Residual, relative to the largest eigenvalue, at which a slice is done, and the most rounds it may take.
RESIDUAL, ROUNDS = 1e-14, 30
#: Rows that are multiplied at once.
_ROWS = 4096


def inertia(a: np.ndarray) -> Callable[[float], int]:
    """A function that says how many eigenvalues of the symmetric ``a`` lie above a shift.

    ``a`` is made tridiagonal by reflections, once. The signs of the pivots of
    the shifted matrix are then those of the eigenvalues less the shift.
    """
    m = np.array(a, float)
    for k in range(len(m) - 2):
        v = m[k + 1 :, k].copy()
        length = float(np.linalg.norm(v))
        if not np.abs(v[1:]).max():
            continue
        lead = -np.copysign(length, v[0])
        v[0] -= lead
        v /= np.linalg.norm(v)
        rest = m[k + 1 :, k + 1 :]
        p = rest @ v
        p -= v * (v @ p)
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        m[k + 1, k] = lead
    main, side = np.diag(m).tolist(), (np.diag(m, -1) ** 2).tolist()
    least = np.finfo(float).tiny

    def above(shift: float) -> int:
        count, pivot = 0, 1.0
        for i, d in enumerate(main):
            pivot = d - shift - (side[i - 1] / pivot if i else 0.0)
            pivot = pivot or -least
            count += bool(pivot > 0)
        return count

    return above


@dataclass
class Slice:
    low: float
    high: float
    count: int


def _gap(above: Callable[[float], int], width: int, low: float, high: float, near: float) -> tuple[float, int]:
    """A shift in (low, high) that lies in the middle of a gap, near ``near``, and the count above it.

    Of one more windows than there are eigenvalues one at least is free of them.
    """
    windows = np.linspace(low, high, width + 2)
    counts = [above(w) for w in windows]
    mids = (windows[1:] + windows[:-1]) / 2
    free = [k for k in range(width + 1) if counts[k] == counts[k + 1]]
    best = min(free, key=lambda k: abs(mids[k] - near))
    return float(mids[best]), counts[best]


def slices(a: np.ndarray, wanted: int, most: int = SLICE) -> list[Slice]:
    """Slices of the spectrum of ``a`` that hold its ``wanted`` largest eigenvalues, and those that no gap parts from them."""
    bound = float(np.abs(a).sum(axis=1).max(initial=0))
    if not bound or not wanted:
        return []
    above = inertia(a)
    end = 1.01 * _bisect(above, 0, 0.0, bound, 1e-3)
    low = _bisect(above, wanted, -1e-3 * end, end, 1e-12)
    floor, count = _gap(above, len(a), low - (end - low) * 0.05, low, low)
    todo, done = [Slice(floor, end, count)], []
    while todo:
        part = todo.pop()
        if part.count <= most or part.high - part.low < 1e-6 * end:
            done += [part] if part.count else []
            continue
        outside = above(part.high)
        half = _bisect(above, outside + part.count // 2, part.low, part.high, 1e-9)
        step = (part.high - part.low) * 0.02
        cut, more = _gap(above, len(a), part.low + step, part.high - step, half)
        todo += [Slice(part.low, cut, part.count - (more - outside)), Slice(cut, part.high, more - outside)]
    return sorted(done, key=lambda s: s.low)


def _bisect(above: Callable[[float], int], count: int, low: float, high: float, share: float) -> float:
    """About the greatest shift with ``count`` eigenvalues above it; for a count of zero, the least."""
    least = (high - low) * share
    while high - low > least:
        mid = (low + high) / 2
        low, high = (mid, high) if above(mid) >= max(count, 1) else (low, mid)
    return low if count else high


def feast(a: np.ndarray, part: Slice, nodes: int = NODES, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (columns) of ``a`` in ``part``; as many as inertia counted, or an error."""
    d, scale = len(a), float(np.abs(a).sum(axis=1).max())
    centre, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    x, w = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    rng = np.random.default_rng(seed)
    size = min(d, part.count + part.count // 2 + 4)
    y = rng.standard_normal((d, size))
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for t, weight in zip(turn, w):
            z = centre + radius * t
            q += weight / 2 * (radius * t * np.linalg.solve(z * np.eye(d) - a, y.astype(complex))).real
        u, s, _ = np.linalg.svd(q, full_matrices=False)
        u = u[:, s > s[0] * 1e-15]
        values, inner = np.linalg.eigh(u.T @ a @ u)
        vectors = u @ inner
        inside = (values > part.low) & (values < part.high)
        found, kept = values[inside], vectors[:, inside]
        if inside.sum() == part.count:
            if not part.count or np.abs(a @ kept - kept * found).max() <= RESIDUAL * scale * d:
                return found, kept
        elif size < d and inside.sum() > part.count or u.shape[1] == part.count:
            size = min(d, 2 * size)  # the block is too small to part inside from outside
        y = np.concatenate([vectors, rng.standard_normal((d, max(0, size - vectors.shape[1])))], axis=1)
    raise ArithmeticError(f"{int(inside.sum())} eigenvalues found between {part.low} and {part.high}, inertia counts {part.count}")


def components(spark: SparkSession, a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest positive eigenvalues of the covariance ``a``, falling, and their unit vectors (columns).

    Slices are solved in tasks; a last Rayleigh-Ritz step over all of them
    makes vectors of neighbouring slices orthogonal to the last digit.
    """
    parts = slices(a, min(wanted, len(a))) if len(a) else []
    if not parts:
        return np.zeros(0), np.zeros((len(a), 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = feast(a, Slice(low, high, count))
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["e", "v"])

    todo = spark.createDataFrame([(p.low, p.high, p.count) for p in parts], "low double, high double, count int").repartition(len(parts), "low")
    found = todo.mapInArrow(solve, "e double, v array<double>").orderBy("e").collect()
    basis, _ = np.linalg.qr(np.array([r.v for r in found]).T)
    values, inner = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(values)[::-1][:wanted]
    order = order[values[order] > len(a) * np.finfo(float).eps * values.max()]
    vectors = basis @ inner[:, order]
    vectors /= np.linalg.norm(vectors, axis=0)
    lead = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.sign(vectors[lead, np.arange(len(order))])


def _stack(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _totals(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, object)
        for batch in batches:
            n, sums = n + batch.num_rows, sums + _stack(batch.column(0), width).sum(axis=0).astype(object)
        cols = [np.arange(width), np.full(width, n), sums]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["d", "n", "s"])

    found = rows.select("x").mapInArrow(run, "d long, n long, s long").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d").collect()
    return (int(found[0].n), np.array([r.s for r in found], np.int64)) if found else (0, np.zeros(0, np.int64))


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n x - S, exact, and its n-th part."""
    if max(np.abs(x).max(initial=0), 1) * n >= 1 << 62:
        exact = x.astype(object) * n - sums.astype(object)
        return exact, (exact / n).astype(float)
    exact = x * n - sums
    return exact, exact / n


def _product(rows: DataFrame, n: int, sums: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """The covariance of the vectors, or of what ``turn`` makes of them; divisor n, centred before multiplying."""
    width = len(sums)
    size = width if turn is None else turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = _stack(batch.column(0), width)
            for at in range(0, len(x), _ROWS):
                c = _centred(x[at : at + _ROWS], n, sums)[1]
                c = c if turn is None else c @ turn
                total += c.T @ c
        i, j = np.divmod(np.arange(size * size), size)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    out = np.zeros((size, size))
    for i, j, v in rows.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = v / n
    return (out + out.T) / 2


def whitened(vectors: DataFrame, top: int = 16, scale: int = 64, offset: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every vector on the ``top`` leading components of the distinct vectors, with unit variance.

    A component c becomes x = floor(scale c) + offset. Counts, sums S and the
    covariance are over each distinct x vector once (n of them). Returns for
    each row and component (from 1, by falling eigenvalue e): vec_id,
    component, n, deviation (sum of (n x - S)**2, exact), whitened ((x - S/n)
    on the component over sqrt(e)), explained (e over the trace) and
    identity_error (the largest entry of the whitened covariance less the
    identity, one value, from a pass over the distinct vectors).

    Null vectors and vectors with null or non-finite entries are left out;
    vectors shorter than the longest count as c = 0 at their end. Components
    whose eigenvalue is zero to rounding have no rows: equal vectors, one
    vector, empty vectors or an empty table give none at all. Repeated rows
    and null ids come back as they came; other columns are not read. A
    deviation beyond 64 bits is an error.
    """
    spark = vectors.sparkSession
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(offset).cast("long"))
    rows = vectors.where(finite(F.col(vector_col))).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(offset).cast("long"), F.lit(width) - F.size("x"))))
    fit = store(rows.select("x").distinct(), "whitening-fit")
    n, sums = _totals(fit, width) if width else (0, np.zeros(0, np.int64))
    covariance = _product(fit, n, sums) if n else np.zeros((0, 0))
    values, axes = components(spark, covariance, top)
    turn, explained = axes / np.sqrt(values), values / np.trace(covariance) if len(values) else values
    error = float(np.abs(_product(fit, n, sums, turn) - np.eye(len(values))).max()) if len(values) else 0.0

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, _ROWS):
                part = batch.slice(at, _ROWS)
                exact, centred = _centred(_stack(part.column(1), width), n, sums)
                if np.abs(exact).max(initial=0) >= 2.0**31 / np.sqrt(width):
                    exact = exact.astype(object)
                size = len(exact) * k
                cols = [
                    part.column(0).take(pa.array(np.repeat(np.arange(len(exact)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(exact))), pa.array(np.full(size, n)),
                    pa.array(np.repeat((exact * exact).sum(axis=1), k), pa.int64()), pa.array((centred @ turn).ravel()), pa.array(np.tile(explained, len(exact))), pa.array(np.full(size, error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
