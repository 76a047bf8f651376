"""Embedding whitening by incremental eigendecomposition (operator 13).

The covariance's spectrum is never formed from the whole table at once.  Each
partition starts from the empty spectrum and takes its vectors one by one: a
centred rank-one update, whose eigenvalues are the roots of a secular equation
and whose directions that cannot change are deflated.  The spectra of two
partitions are combined by further rank-one updates (one for each eigenvector
of the second, one for the distance of the means), in a tree of tasks.  A
distributed Rayleigh-Ritz pass over all vectors then refines the basis to
double precision.

The fit list is each distinct integer vector once, however many rows hold it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm.common import broadcast, table, written

#: Quantisation of an entry: floor(SCALE * c) + SHIFT; entries beyond WIDEST (scaled) take no part.
SCALE, SHIFT, WIDEST = 64, 1_000_000, float(1 << 52)
#: Vectors a task updates its spectrum by, and spectra that one task combines.
ROWS, FAN_IN = 4096, 16
EPS = float(np.finfo(np.float64).eps)


# -- the spectrum of a scatter matrix under rank-one updates

def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z_j^2 / (d_j - r) for ascending distinct d and nonzero z.

    Returns (the pole that each root is measured from, the root's distance to
    it): differences to poles stay accurate however near a root lies.  Every
    root is kept in its bracket; a step that leaves it becomes a bisection.
    """
    n, w = len(d), z * z
    right = np.append(d[1:], d[-1] + w.sum() * (1 + 4 * EPS))
    middle = (d + right) / 2
    at_middle = 1 + (w / (d - middle[:, None])).sum(axis=1)
    origin = np.arange(n)
    origin[:-1] += at_middle[:-1] < 0  # the root lies in the right half: measure it from there
    pole = d[origin]
    delta = d - pole[:, None]
    left_end, right_end = d - pole, right - pole
    low = np.where(at_middle < 0, middle - pole, left_end)
    high = np.where(at_middle < 0, right_end, middle - pole)
    x = (low + high) / 2
    first, second = np.arange(n), np.minimum(np.arange(n) + 1, n - 1)
    below = np.tri(n, dtype=bool)  # poles up to the root's left one
    for _ in range(80):
        gap = delta - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            part = w / gap
            f = 1 + part.sum(axis=1)
            slope = part / gap
            low, high = np.where(f < 0, x, low), np.where(f >= 0, x, high)
            done = np.abs(f) <= 4 * EPS * n * (1 + np.abs(part).sum(axis=1))
            done |= high - low <= 2 * EPS * np.abs(x)
            if done.all():
                break
            # match f by c + s / (left pole - x) + t / (right pole - x)
            psi, phi = np.where(below, slope, 0).sum(axis=1), np.where(below, 0, slope).sum(axis=1)
            g1 = gap[first, first]
            g2 = np.where(first < n - 1, gap[first, second], right_end - x)
            a = (g1 + g2) * f - g1 * g2 * (psi + phi)
            b = g1 * g2 * f
            c = f - g1 * psi - g2 * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of Q diag(values) Q' + u u'; values ascend, the columns of Q are orthonormal."""
    z = vectors.T @ u
    size = max(float(np.abs(values).max()), float(z @ z))
    if size == 0:
        return values, vectors
    tiny = 8 * EPS * size
    vectors = vectors.copy()
    # deflate equal values: turn their directions so that one of them holds all of z
    live: list[int] = []
    for i in np.flatnonzero(np.abs(z) * np.sqrt(size) > tiny):
        if live and values[i] - values[live[-1]] <= tiny:
            j = live.pop()
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            vectors[:, i], vectors[:, j] = s * vectors[:, j] + c * vectors[:, i], c * vectors[:, j] - s * vectors[:, i]
            z[i], z[j] = r, 0.0
        live.append(int(i))
    if not live:
        return values, vectors
    k = np.array(live)
    d, zk = values[k], z[k]
    origin, x = secular_roots(d, zk)
    gap = (d - d[origin][:, None]) - x[:, None]  # d_j - root_i
    # the z for which these roots are exact, so that eigenvectors stay orthogonal
    apart = d[:, None] - d
    np.fill_diagonal(apart, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = gap / apart.T
        own = np.diag(gap).copy()
        np.fill_diagonal(ratio, 1.0)
        exact = np.sqrt(np.abs(np.prod(ratio, axis=0) * own))
        turn = (np.copysign(exact, zk) / gap).T
    bad = ~np.isfinite(turn).all(axis=0)
    if bad.any():
        turn[:, bad] = np.eye(len(k))[:, bad]
    turn /= np.linalg.norm(turn, axis=0)
    out = values.copy()
    out[k] = d[origin] + x
    vectors[:, k] = vectors[:, k] @ turn
    order = np.argsort(out, kind="stable")
    return out[order], vectors[:, order]


@dataclass
class Spectrum:
    """Number, mean and spectrum of the scatter matrix of some vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, v: np.ndarray) -> None:
        away = v - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector * np.sqrt(value))
        n, away = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.n * other.n / n))
        self.mean, self.n = self.mean + away * (other.n / n), n

    def row(self, p: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "p": pa.array([p], pa.int64()), "n": pa.array([self.n], pa.int64()),
            "mean": pa.array([self.mean.tolist()], pa.list_(pa.float64())),
            "eigenvalues": pa.array([self.values.tolist()], pa.list_(pa.float64())),
            "vectors": pa.array([self.vectors.ravel().tolist()], pa.list_(pa.float64()))})


SPECTRUM = "p long, n long, mean array<double>, eigenvalues array<double>, vectors array<double>"


def _spectra(batches, d: int):
    for b in batches:
        for n, mean, values, vectors in zip(*(b.column(c).to_pylist() for c in ("n", "mean", "eigenvalues", "vectors"))):
            yield Spectrum(n, np.array(mean), np.array(values), np.array(vectors).reshape(d, d))


def matrix(b: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    return b.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


# -- fit and transform

def integers(column: str) -> Column:
    """The vector's entries as longs."""
    return F.transform(column, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))


def usable(column: str) -> Column:
    """A vector without null, non-finite or unrepresentably large entries, and not empty."""
    def fine(c):
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < WIDEST)

    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(column, fine), F.lit(False))


@dataclass
class Whitener:
    """Mean and leading eigenvectors of the distinct vectors, ready to apply.

    ``sums`` are exact; ``basis`` holds a unit eigenvector a column, by falling
    eigenvalue.  ``n`` is 0 when no vector is usable.
    """

    d: int
    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    basis: np.ndarray
    identity_error: float | None

    @property
    def positive(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.eigenvalues > self.d * EPS * self.trace


def _summed(parts: DataFrame, d: int) -> np.ndarray:
    """Sum over tasks of (entries) arrays of d * d doubles, added up by position in Spark."""
    rows = parts.select(F.posexplode("entries").alias("pos", "x")).groupBy("pos").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(d * d)
    for r in rows:
        out[r["pos"]] = r["x"]
    return out.reshape(d, d)


def fit(df: DataFrame, column: str = "embedding", components: int = 16) -> Whitener:
    """Whitening of the distinct usable vectors of ``df``.

    All vectors have the most frequent length (ties: the longer); rows of
    another length take no part.  The driver gets sums by dimension and d by d
    matrices only.
    """
    spark = df.sparkSession
    good = df.where(usable(column))
    lengths = good.groupBy(F.size(column).alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return Whitener(0, 0, np.zeros(0, np.int64), np.zeros(0), 0.0, np.zeros((0, 0)), None)
    d = most["d"]
    # equal vectors meet in the tasks first, so a very common one costs one row a task
    x = written(good.where(F.size(column) == d).select(integers(column).alias("x")).distinct(), "whitening-distinct")
    totals = x.select(F.posexplode("x").alias("pos", "x")).groupBy("pos").agg(F.sum("x").alias("s"), F.count("x").alias("n")).collect()
    n, sums = totals[0]["n"], np.zeros(d, np.int64)
    for r in totals:
        sums[r["pos"]] = r["s"]
    origin = np.array([round(int(s) / n) for s in sums])
    tasks = max(1, -(-n // ROWS))
    fitted = written(x.repartition(tasks), "whitening-fit") if tasks > 1 else x

    def update(batches):
        mine = Spectrum.empty(d)
        for b in batches:
            for v in (matrix(b, "x", d) - origin).astype(np.float64):
                mine.add(v)
        yield mine.row(TaskContext.get().partitionId())

    def combine(batches):
        all_of = Spectrum.empty(d)
        for s in _spectra(batches, d):
            all_of.merge(s)
        yield all_of.row(TaskContext.get().partitionId())

    spectra = written(fitted.mapInArrow(update, SPECTRUM), "whitening-spectra")
    left = spectra.count()
    while left > 1:
        left = -(-left // FAN_IN)
        spectra = written(spectra.repartitionById(left, F.pmod("p", F.lit(left)).cast("int")).mapInArrow(combine, SPECTRUM),
                          "whitening-spectra")
    last = spectra.toArrow().to_batches()
    whole = next(_spectra(last, d))
    basis, _ = np.linalg.qr(whole.vectors[:, ::-1])

    def projected(by: np.ndarray):
        shared = broadcast(spark, (n, sums, by))

        def run(batches):
            n, sums, by = shared.value["data"]
            total = np.zeros((by.shape[1], by.shape[1]))
            for b in batches:
                y = centred(matrix(b, "x", d), n, sums) @ by
                total += y.T @ y
            full = np.zeros((d, d))
            full[:by.shape[1], :by.shape[1]] = total / n
            yield pa.RecordBatch.from_pydict({"entries": pa.array([full.ravel().tolist()], pa.list_(pa.float64()))})

        return _summed(fitted.mapInArrow(run, "entries array<double>"), d)[:by.shape[1], :by.shape[1]]

    # Rayleigh-Ritz: the covariance in the basis found, its exact small spectrum, the basis turned by it
    ritz, turn = np.linalg.eigh(projected(basis))
    order = np.argsort(-ritz, kind="stable")
    ritz, basis = np.maximum(ritz[order], 0), basis @ turn[:, order]
    k = min(components, d)
    model = Whitener(d, n, sums, ritz[:k], float(ritz.sum()), basis[:, :k], None)
    keep = np.flatnonzero(model.positive)
    if len(keep):
        white = projected(model.basis[:, keep] / np.sqrt(model.eigenvalues[keep]))
        model.identity_error = float(np.abs(white - np.eye(len(keep))).max())
    return model


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n as doubles; the whole part of the mean is taken off in integers first."""
    whole = sums // n
    return (x - whole).astype(np.float64) - (sums - whole * n) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Exact sums of (n * x - sums)^2; null where a bigint cannot hold it."""
    rough = (((x - sums / n) * float(n)) ** 2).sum(axis=1)
    if len(rough) == 0 or rough.max() < 2.0 ** 60:
        away = n * x - sums
        return (away * away).sum(axis=1).tolist()
    out = []
    for row in x.tolist():
        s = sum((n * v - int(t)) ** 2 for v, t in zip(row, sums))
        out.append(s if s < 1 << 63 else None)
    return out


WHITE = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def transform(df: DataFrame, model: Whitener, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row for each usable row of ``df`` and component.

    Rows whose vector is null, empty, of another length or holds null or
    non-finite entries are left out; every other row, repeated ones and null
    ids included, gives its rows.  A component without variance has null
    ``whitened``.
    """
    rows = df.where(usable(column)).where(F.size(column) == model.d)
    rows = rows.select(F.col(id_column).cast("long").alias("id"), integers(column).alias("x"))
    shared = broadcast(df.sparkSession, model)

    def run(batches):
        m = shared.value["data"]
        k, ok = m.basis.shape[1], m.positive
        scale = np.where(ok, np.sqrt(np.where(ok, m.eigenvalues, 1)), 1)
        explained = [float(e) / m.trace if m.trace else None for e in m.eigenvalues]
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                s = b.slice(at, 4096)
                x = matrix(s, "x", m.d)
                w = centred(x, m.n, m.sums) @ (m.basis / scale)
                ids = np.repeat(np.arange(s.num_rows), k)
                yield pa.RecordBatch.from_pydict({
                    "id": s.column("id").take(pa.array(ids)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), s.num_rows)),
                    "n": pa.array(np.full(len(ids), m.n, np.int64)),
                    "deviation": pa.array(deviations(x, m.n, m.sums), pa.int64()).take(pa.array(ids)),
                    "whitened": pa.array(w.ravel(), pa.float64(), mask=np.tile(~ok, s.num_rows)),
                    "explained": pa.array(explained * s.num_rows, pa.float64()),
                    "identity_error": pa.array([m.identity_error] * len(ids), pa.float64())})

    return rows.mapInArrow(run, WHITE).withColumnRenamed("id", id_column)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable row of ``embeddings``."""
    vectors = table(spark, sf_dir, "embeddings")
    return transform(vectors, fit(vectors))
