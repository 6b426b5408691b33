"""Whitening of vectors: FEAST contour integration over intervals of the covariance's spectrum, checked by inertia counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geohealth.llm.common import discard, materialize, unused

#: A component becomes the whole number floor(SCALE * c) + SHIFT. Components beyond LARGEST have none in 64 bits.
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**56
#: Quadrature points on the upper half of a contour, rounds of refinement at most, eigenvalues that one interval should hold.
POINTS, ROUNDS, PER_INTERVAL = 16, 30, 6
#: Eigenvalues under this share of the largest are noise of the arithmetic: the data have no such direction.
RANK = 1e-10
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x (array of longs) of the rows that take part: no null or non-finite component, and of the commonest length."""
    v = unused(vectors, "_v")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)) & (F.size(v) > 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias(v)).where(F.col(v).isNotNull()).where(good)
    lengths = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    whole: Column = F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    return rows.where(F.size(v) == (lengths[0][0] if lengths else -1)).select("vec_id", whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(df: DataFrame, shape: tuple[int, ...], part) -> np.ndarray:
    """The sum over all batches of part(x), added up in each task, then in about the root of the tasks, then here."""
    size = int(np.prod(shape))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape), False
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                total += part(_matrix(b.column(0).slice(at, 4096)))
                some = True
        if some:
            yield pa.record_batch([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["m"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += _matrix(b.column(0)).sum(axis=0) if b.num_rows else 0.0
        yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], names=["m"])

    some = df.select("x").mapInArrow(first, "m array<double>")
    tasks = max(1, int(df.rdd.getNumPartitions() ** 0.5))
    rows = some.repartition(tasks).mapInArrow(again, "m array<double>").collect()  # the root of the number of tasks
    return np.sum([np.asarray(r[0]) for r in rows], axis=0).reshape(shape)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections: it keeps all eigenvalues."""
    a = np.array(a, dtype="f8")
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            continue
        u = x.copy()
        u[0] += np.copysign(norm, x[0])
        u /= np.linalg.norm(u)
        a[k + 1 :, :] -= 2 * np.outer(u, u @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ u, u)
    return a.diagonal().copy(), a.diagonal(1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues below each shift: the negative pivots of the LDL' factors of the shifted tridiagonal matrix."""
    shifts = np.asarray(shifts, dtype="f8")
    tiny = np.finfo(float).tiny ** 0.5 + np.finfo(float).eps * 1e-3 * (np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0))
    below, pivot = np.zeros(shifts.shape, dtype=int), np.ones(shifts.shape)
    for k, d in enumerate(diagonal):
        pivot = d - shifts - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def spectrum(diagonal: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the eigenvalues lie, falling, by bisection on inertia counts."""
    n = len(diagonal)
    edge = np.concatenate([[0.0], np.abs(off), [0.0]])
    high = np.full(n, (np.abs(diagonal) + edge[:-1] + edge[1:]).max())
    low, want = -high, np.arange(n - 1, -1, -1)
    for _ in range(60):
        middle = (low + high) / 2
        above = inertia(diagonal, off, middle) > want
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return (low + high) / 2


def intervals(matrix: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """(low, high, count) of intervals that hold the largest eigenvalues: `components`, as many as the rank allows, or more if
    a cluster without a gap goes on beyond them.

    Their ends lie in the middle of gaps of the spectrum, wide ones rather than narrow, so that no cluster is split and both
    sides of an end are well apart from it. Counts are differences of inertia.
    """
    d, o = tridiagonal(matrix)
    values = spectrum(d, o)
    if not len(values) or values[0] <= 0:
        return []
    rank = int((values > RANK * values[0]).sum())
    after = np.append(values, min(values[-1], 0.0) - 0.1 * values[0])
    wide = lambda k: after[k - 1] - after[k] > 1e-9 * values[0]
    last = next(k for k in range(min(components, rank), len(values) + 1) if wide(k) or k == rank)
    cuts = [0]
    while cuts[-1] < last:
        at = cuts[-1]
        near = [k for k in range(at + 1, min(at + PER_INTERVAL, last) + 1) if wide(k) or k == last]
        # a cluster stays together, however many it has
        cuts.append(max(near, key=lambda k: (after[k - 1] - after[k]) * (1 + (k - at) / PER_INTERVAL)) if near else next(k for k in range(at + 1, last + 1) if wide(k) or k == last))
    ends = [1.1 * values[0]] + [max((after[k - 1] + after[k]) / 2, RANK / 2 * values[0]) for k in cuts[1:]]
    counts = inertia(d, o, np.array(ends))
    return [(float(low), float(high), int(a - b)) for high, low, a, b in zip(ends, ends[1:], counts, counts[1:])]


def feast(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenvalues of (low, high), falling, and their unit eigenvectors (columns).

    A quadrature of (z I - matrix)^-1 Y over a circle through low and high projects Y on the wanted space; Rayleigh-Ritz
    takes the eigenpairs out of it, and these are projected again until their residuals are at rounding level. Complex
    conjugate points need no solve of their own, as the matrix is real. The space is wider than the count, so neighbours
    outside of the interval fade faster. Raises ArithmeticError if other than `count` eigenvalues turn out to be inside.
    """
    n = len(matrix)
    width = min(n, count + max(4, count // 2))  # neighbours outside fade faster if they have room
    at, weight = np.polynomial.legendre.leggauss(POINTS)
    angle = np.pi / 2 * (at + 1)
    middle, radius = (low + high) / 2, (high - low) / 2
    points, weights = middle + radius * np.exp(1j * angle), weight * radius * np.exp(1j * angle) / 2
    eye, norm = np.eye(n), np.abs(matrix).sum(axis=1).max()
    basis = np.random.default_rng(seed).normal(size=(n, width))
    for _ in range(ROUNDS):
        projected = np.zeros((n, basis.shape[1]))
        for z, w in zip(points, weights):
            projected += (w * np.linalg.solve(z * eye - matrix, basis)).real
        frame, sizes, _ = np.linalg.svd(projected, full_matrices=False)
        frame = frame[:, sizes > 1e-14 * sizes[0]] if frame.shape[1] > count else frame
        ritz, turn = np.linalg.eigh(frame.T @ matrix @ frame)
        vectors = frame @ turn
        inside = (ritz > low) & (ritz < high)
        rest = np.linalg.norm(matrix @ vectors - vectors * ritz, axis=0)
        basis = vectors
        if inside.sum() == count and (not count or rest[inside].max() <= 1e-14 * norm * n**0.5):
            break
    if inside.sum() != count:
        raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues found in ({low}, {high})")
    found = vectors[:, inside][:, ::-1]
    return ritz[inside][::-1], found / np.linalg.norm(found, axis=0)


def components(spark: SparkSession, matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their eigenvectors (columns). Every interval is a task of its own."""
    parts = intervals(matrix, most)
    d = len(matrix)
    if not parts:
        return np.zeros(0), np.zeros((d, 0))
    shared = spark.sparkContext.broadcast(matrix)  # dimensions squared

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, count in zip(*[c.to_pylist() for c in b.columns]):
                e, u = feast(shared.value, low, high, count)
                yield pa.record_batch([pa.array(e), pa.array(list(u.T), pa.list_(pa.float64()))], names=["e", "u"])

    spread = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts))
    got = sorted(spread.mapInArrow(work, "e double, u array<double>").collect(), key=lambda r: -r[0])[:most]
    return np.array([r[0] for r in got]), np.array([r[1] for r in got]).T.reshape(d, len(got))


def whiten(vectors: DataFrame, most: int = 16, vector: str = "embedding") -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors become whole numbers; each distinct one is in the fit list once. Sums are exact, and the covariance adds up
    products of n x - S, which are whole before they are rounded. Its eigenvectors come from FEAST over intervals of the
    spectrum; inertia counts tell how many each holds, so none is missed. Components whose variance is under RANK of the
    largest have no direction in the data: fewer than `most` may come out, and none where all vectors are alike.
    identity_error is measured over the fit list.

    Null vectors, vectors with null or non-finite components (or beyond LARGEST) and those of another than the commonest
    length take no part. Null ids and repeated rows come out like others. deviation is NULL beyond 64 bits. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vector)
    fit = materialize(rows.select("x").distinct(), "fit")
    first = fit.select(F.size("x").alias("d")).limit(1).collect()
    if not first:
        discard(fit)
        return spark.createDataFrame([], OUT)
    d = first[0][0]
    n = fit.count()
    # exact: partial sums are added up as whole numbers
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum((F.col("v") - SHIFT).cast("decimal(38,0)")).alias("s")).collect()  # a row a dimension
    shifted = np.zeros(d, dtype=object)
    for r in sums:
        shifted[r[0]] = int(r[1])

    def centred(x: np.ndarray) -> np.ndarray:
        """n x - S, exactly: as longs, or as Python's integers where these would overflow."""
        small = x - SHIFT
        if (abs(int(small.max(initial=0))) + abs(int(small.min(initial=0)))) * n + max(map(abs, shifted)) < 2**62:
            return small * n - shifted.astype("i8")
        return small.astype(object) * n - shifted

    def product(x: np.ndarray) -> np.ndarray:
        y = centred(x).astype("f8") / n
        return y.T @ y

    matrix = _summed(fit, (d, d), product) / n
    matrix = (matrix + matrix.T) / 2
    e, u = components(spark, matrix, most)
    scale = u / np.sqrt(e)

    def second(x: np.ndarray) -> np.ndarray:
        w = (centred(x).astype("f8") / n) @ scale
        return np.hstack([w.T @ w, w.sum(axis=0)[:, None]])

    error = 0.0
    if len(e):
        both = _summed(fit, (len(e), len(e) + 1), second) / n
        error = float(np.abs(both[:, :-1] - np.outer(both[:, -1], both[:, -1]) - np.eye(len(e))).max())
    discard(fit)
    share = e / np.trace(matrix) if len(e) else e

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(e)
        for b in batches:
            for at in range(0, b.num_rows if k else 0, 4096):
                part = b.slice(at, 4096)
                y = centred(_matrix(part.column(1)))
                reach = max(abs(int(y.max())), abs(int(y.min())))
                far = (y * y).sum(axis=1) if reach * reach * d < 2**63 else [v if v < 2**63 else None for v in (y.astype(object) ** 2).sum(axis=1)]
                w = (y.astype("f8") / n) @ scale
                m = part.num_rows
                yield pa.record_batch([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                    pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ], names=[c.split()[0] for c in OUT.split(", ")])

    return rows.mapInArrow(project, OUT)


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    return whiten(table(spark, sf_dir, "embeddings"))
