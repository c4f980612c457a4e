"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

1. Integers. A vector's entry c becomes x = floor(scale * c) + shift, a long, so that sums are exact. Rows whose vector is null
   or holds null or non-finite entries are left out. The fit list has each distinct x vector once; it is written.
2. Count n and sums S of the fit list are exact; each x is centred as (n * x - S) / n, in integers up to the division.
3. Spectra. Every partition of the fit list keeps the eigenvalues and eigenvectors of its scatter matrix. A vector updates them
   by a rank-one term, centred on the mean so far: k / (k + 1) * d d' for the (k+1)-th vector at distance d from the mean
   of the k before. The eigenvalues of a diagonal matrix plus a rank-one term are the roots of the secular equation
   1 + rho * sum(z_i^2 / (d_i - x)) = 0, one between every two neighbouring d_i; they are found all at once by
   rational interpolation between the two poles, kept inside shrinking brackets. Entries with z_i = 0 are deflated, and so are those with equal
   d_i, after a rotation that makes one z_i zero. Eigenvectors come from the z that fits the computed roots
   exactly, which keeps them orthogonal.
4. Combining. The spectrum of one partition enters that of another as successive rank-one updates, one per eigenvalue, and one more for
   the difference of the means; ``fan`` spectra at a time, in rounds, until one is left.
5. Rayleigh-Ritz. The fit list is projected on the basis found, the covariance of the projections is summed over all partitions
   (d x d numbers a partition), and its eigenvectors turn the basis. As the basis is nearly right,
   that matrix is nearly diagonal, and the result has the precision of a decomposition of the exact covariance.

Every intermediate is bounded by d x d numbers a partition. The driver holds the basis, n, S and the final d x d matrix;
they are broadcast, and their size does not grow with the rows. Equal vectors meet in a map-side combine, so a very common
one is one row a task before the shuffle.

Defined results: rows of another length than the most frequent one (of several, the longest) are left out like those
with null entries; components stop at the rank (an eigenvalue below d * 1e-14 of the greatest counts as zero), so one
distinct vector, or none, gives no rows; equal eigenvalues have any orthonormal vectors of their space, the
same for all rows; repeated rows and ids are returned as often as they are there; a null vec_id stays null; other columns
are left out. ``deviation`` is exact while it fits a long; beyond that the query fails rather than give a wrong number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import ship_package, written


@dataclass(frozen=True)
class WhiteningOptions:
    components: int = 16
    scale: int = 64
    shift: int = 1_000_000
    #: fit vectors per partition at least, so that small inputs are not spread over many spectra
    rows: int = 2000
    #: spectra that one task combines
    fan: int = 8


EPS = np.finfo(np.float64).eps


# --- rank-one updates of an eigendecomposition

def _roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) for ascending d and positive z2, each as (index of its nearest pole, distance from it)."""
    m = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    row = np.arange(m)
    middle = (d + upper) / 2
    # the sign at the middle tells which pole is nearer; the last root has only the one below it
    f = 1 + (z2 / (d - middle[:, None])).sum(axis=1)
    right = (f < 0) & (row < m - 1)
    origin = row + right
    poles = d - d[origin][:, None]  # poles[i] as seen from the origin of root i
    half = (upper - d) / 2
    low = np.where(right, -half, 0.0)
    high = np.where(right, 0.0, half)
    low[-1], high[-1] = (half[-1], 2 * half[-1]) if f[-1] < 0 else (0.0, half[-1])
    x = (low + high) / 2
    left, beyond = poles[row, row], np.append(poles[row[:-1], row[1:]], 2 * half[-1])
    below = row[None, :] <= row[:, None]
    for _ in range(60):
        away = poles - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            terms = z2 / away
            slopes = terms / away
            f = 1 + terms.sum(axis=1)
            size = 1 + np.abs(terms).sum(axis=1)
            psi = (slopes * below).sum(axis=1)
            phi = slopes.sum(axis=1) - psi
            # f grows between the poles: a positive value is beyond the root
            high, low = np.where(f > 0, x, high), np.where(f < 0, x, low)
            a_, b_ = left - x, beyond - x
            c = f - a_ * psi - b_ * phi
            a = (a_ + b_) * f - a_ * b_ * (psi + phi)
            b = a_ * b_ * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            guess = x + step
        inside = np.isfinite(guess) & (guess > low) & (guess < high)
        guess = np.where(inside, guess, (low + high) / 2)
        done = (np.abs(f) <= 4 * EPS * size) | (np.abs(guess - x) <= 2 * EPS * np.abs(x)) | (f == 0)
        if done.all():
            break
        x = np.where(done, x, guess)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of V diag(values) V' + rho u u', for rho >= 0 and a whole basis V."""
    z = vectors.T @ u * np.sqrt(rho)
    scale = max(abs(values[-1]), abs(values[0]), z @ z)
    tiny = 8 * EPS * scale
    live = np.flatnonzero(np.abs(z) * np.sqrt(z @ z) > tiny)
    if not len(live):
        return values, vectors
    d, vectors = values.copy(), vectors.copy()
    # equal values: turn the two vectors so that one of them is not met by the update
    before = None
    for i in live[np.append(False, np.diff(d[live]) <= tiny) | np.append(np.diff(d[live]) <= tiny, False)].tolist():
        if before is not None and d[i] - d[before] <= tiny:
            r = np.hypot(z[before], z[i])
            c, s = z[i] / r, z[before] / r
            vectors[:, [before, i]] = np.stack([c * vectors[:, before] - s * vectors[:, i],
                                                s * vectors[:, before] + c * vectors[:, i]], axis=1)
            z[before], z[i] = 0.0, r
        before = i
    live = live[z[live] != 0]
    dl, zl = d[live], z[live]
    origin, x = _roots(dl, zl * zl)
    away = (dl - dl[origin][:, None]) - x[:, None]  # away[i, j] = d_j - root_i, without cancellation
    # the z whose secular equation has exactly these roots
    between = dl[:, None] - dl
    np.fill_diagonal(between, 1.0)
    ratio = away / -between  # [i, j] = (root_i - d_j) / (d_i - d_j), up to the diagonal
    np.fill_diagonal(ratio, -np.diagonal(away))
    fit = np.sign(zl) * np.sqrt(np.abs(np.prod(ratio, axis=0)))
    turn = fit / away
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    vectors[:, live] = vectors[:, live] @ turn.T
    d[live] = dl[origin] + x
    order = np.argsort(d, kind="stable")
    return d[order], vectors[:, order]


class Spectrum:
    """Eigenvalues and eigenvectors of the scatter matrix of the vectors met so far, with their number and mean."""

    def __init__(self, d: int):
        self.n, self.mean = 0, np.zeros(d)
        self.values, self.vectors = np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        off, n = other.mean - self.mean, self.n + other.n
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        self.n, self.mean = n, self.mean + off * (other.n / n)

    def table(self, number: int) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.float64())] * 3]
        data = [number, self.n, self.mean, self.values, self.vectors.ravel()]
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(data, kinds)], names=["number", "n", "mean", "values", "vectors"])

    @classmethod
    def row(cls, n: int, mean, values, vectors) -> Spectrum:
        out = cls(len(mean))
        out.n, out.mean, out.values = n, np.array(mean), np.array(values)
        out.vectors = np.array(vectors).reshape(len(mean), -1)
        return out


SPECTRUM = "number long, n long, mean array<double>, values array<double>, vectors array<double>"


# --- the fit list

def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def as_integers(embeddings: DataFrame, o: WhiteningOptions) -> DataFrame:
    """(vec_id, x): the usable rows, with their vectors as longs."""
    whole = F.expr("embedding IS NOT NULL AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(o.scale)) * c.cast("double")).cast("long") + o.shift)
    return embeddings.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _width(rows: DataFrame) -> int:
    """The most frequent length, of several the longest; 0 without rows."""
    best = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return best.d if best else 0


def _summed(parts: DataFrame, kind: str) -> list:
    """The sums by place of an array column ``v`` with one row per partition."""
    places = parts.select(F.posexplode("v").alias("place", "v")).groupBy("place").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    return [r.v for r in places.orderBy("place").collect()]


def _sums(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    def scan(batches):
        total, n = np.zeros(d, np.int64), 0
        for batch in batches:
            total += _matrix(batch.column(0), d).sum(axis=0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([[n, *total]], pa.list_(pa.int64()))], names=["v"])

    n, *total = _summed(fit.select("x").mapInArrow(scan, "v array<long>"), "long") or [0]
    return n, np.array(total, np.int64)


def _spectra(fit: DataFrame, d: int, shift: int) -> DataFrame:
    """One spectrum per partition. The shift, common to all entries, is taken off in integers."""
    def scan(batches):
        own = Spectrum(d)
        for batch in batches:
            for x in (_matrix(batch.column(1), d) - shift).astype(np.float64):
                own.add(x)
        if own.n:
            from pyspark import TaskContext

            yield own.table(TaskContext.get().partitionId())

    return fit.select("vec_hash", "x").mapInArrow(scan, SPECTRUM)


def _combined(spectra: DataFrame, fan: int) -> Spectrum:
    """All spectra as one, ``fan`` at a time."""
    fields = ("n", "mean", "values", "vectors")

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["number"])
        own = Spectrum.row(*(rows[0][f] for f in fields))
        for r in rows[1:]:
            own.merge(Spectrum.row(*(r[f] for f in fields)))
        return pa.Table.from_batches([own.table(rows[0]["number"] // fan)])

    spectra = written(spectra, "spectra")
    while (left := spectra.agg(F.max("number").alias("m")).first().m) is not None and left > 0:
        spectra = written(spectra.groupBy(F.expr(f"number div {fan}").alias("_lot")).applyInArrow(merge, SPECTRUM), "spectra")
    r = spectra.first()
    return Spectrum.row(*(r[f] for f in fields))


def _refined(fit: DataFrame, basis: np.ndarray, n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: eigenvalues and vectors (falling) of the exact covariance, from its projection on the basis."""
    d = len(total)

    def scan(batches):
        gram = np.zeros((d, d))
        for batch in batches:
            y = (n * _matrix(batch.column(0), d) - total) / n @ basis
            gram += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.ravel()], pa.list_(pa.float64()))], names=["v"])

    gram = np.array(_summed(fit.select("x").mapInArrow(scan, "v array<double>"), "double")).reshape(d, d) / n
    values, turn = np.linalg.eigh((gram + gram.T) / 2)
    vectors = np.linalg.qr(basis @ turn)[0]  # the same vectors up to sign, orthogonal to the last digit
    return values[::-1], vectors[:, ::-1]


@dataclass
class Whitening:
    """What whitens a vector: component k of x is ((n x - S) / n) . vectors[:, k] / sqrt(values[k])."""

    n: int
    total: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.total) / self.n @ self.vectors / np.sqrt(self.values)


def fit_list(rows: DataFrame, o: WhiteningOptions) -> DataFrame:
    """Each distinct vector once, dealt by hash over partitions of about ``o.rows`` rows (at most 4096 of them)."""
    parts = max(1, min(rows.count() // o.rows, 4096))
    once = rows.groupBy("x").agg(F.xxhash64("x").alias("vec_hash"))  # combined in each task before it is sent
    return written(once.repartition(parts, "vec_hash"), "fit-list")


def fit(vectors: DataFrame, d: int, o: WhiteningOptions = WhiteningOptions()) -> Whitening:
    """The whitening of a fit list (x of length d, vec_hash)."""
    n, total = _sums(vectors, d)
    if n < 2:
        return Whitening(n, total, np.empty(0), np.empty((d, 0)), 0.0)
    basis = _combined(_spectra(vectors, d, o.shift), o.fan).vectors
    values, axes = _refined(vectors, basis, n, total)
    rank = int((values > d * 1e-14 * max(values[0], 0)).sum())
    keep = min(o.components, rank)
    return Whitening(n, total, values[:keep], axes[:, :keep], float(values.sum()))


def whiten(rows: DataFrame, w: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened array) of every row (vec_id, x)."""
    d, sent = len(w.total), rows.sparkSession.sparkContext.broadcast(w)

    def scan(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            off = sent.value.n * x - sent.value.total
            if len(off) and (np.square(off.astype(np.float64)).sum(axis=1) >= 2.0 ** 63).any():
                raise OverflowError("a deviation is beyond a long")
            y = sent.value.project(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array((off * off).sum(axis=1)), pa.array(list(y), pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(scan, "vec_id long, deviation long, whitened array<double>")


def _identity_error(vectors: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, sent = len(w.values), vectors.sparkSession.sparkContext.broadcast(w)

    def scan(batches):
        sums, gram = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = sent.value.project(_matrix(batch.column(0), len(sent.value.total)))
            sums += y.sum(axis=0)
            gram += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([[*sums, *gram.ravel()]], pa.list_(pa.float64()))], names=["v"])

    total = np.array(_summed(vectors.select("x").mapInArrow(scan, "v array<double>"), "double"))
    mean = total[:k] / w.n
    return float(np.abs(total[k:].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


REPORT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitening_report(embeddings: DataFrame, o: WhiteningOptions = WhiteningOptions()) -> DataFrame:
    """One row per usable row and component."""
    spark = embeddings.sparkSession
    ship_package(spark)
    rows = as_integers(embeddings, o)
    d = _width(rows)
    rows = rows.where(F.size("x") == d)
    w, vectors = None, None
    if d:
        vectors = fit_list(rows, o)
        w = fit(vectors, d, o)
    if w is None or not len(w.values):
        return spark.createDataFrame([], REPORT)
    shares = F.array(*[F.lit(float(v / w.trace)) for v in w.values])
    error = _identity_error(vectors, w)
    return (whiten(rows, w).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
