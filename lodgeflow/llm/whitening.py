"""Embedding whitening by an incremental eigendecomposition.

Each partition keeps the spectrum of what it has read: the number of vectors, their sums, and the
eigenvalues and eigenvectors of the centred scatter matrix.  A further vector changes that
matrix by a rank-one term along its difference from the mean: the new eigenvalues are
the roots of a secular equation, after deflation of the directions that the term does not
reach and of eigenvalues that coincide.  Two spectra are combined by such updates too,
one for each eigenvector of the second and one for the difference of the means, in a tree over the
partitions.  A Rayleigh-Ritz step over all vectors, spread over the partitions, then
refines the combined basis: it is exact up to rounding, as the basis spans the whole space.

Vectors are whole numbers (``vectors.whole_vectors``), so counts and sums are exact.  A spectrum
takes dims**2 doubles, whatever the number of rows.

Defined results: vectors that are null or hold null or non-finite entries are dropped; a
null vec_id stays; zeros follow a vector shorter than the longest, before equal vectors are merged
for the fit; repeated rows each give their rows; a component without variance has a null
``whitened``, and does not count for ``identity_error``; with no variance at all ``explained``
and ``identity_error`` are null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, written
from .vectors import matrix, padded, whole_vectors, width

EPS = np.finfo(float).eps
#: Vectors whose spectrum one task makes, and spectra that one task combines in one round.
TASK_VECTORS = 2048
FAN_IN = 8
COMPONENTS = 4

SPECTRUM = "part long, n long, sums array<long>, eigenvalues array<double>, basis array<double>"
PARTIAL = "part long, n long, total array<double>, moments array<double>"
WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double"


# --- one rank-one update --------------------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """Differences d[j] - root[i] (row j, column i) for the roots of 1 + sum z2[j] / (d[j] - x),
    where ``d`` ascends strictly and ``z2`` is positive.

    Root i lies between d[i] and d[i+1], the last one at most sum(z2) above.  Each is sought as a
    distance from its nearest pole, by interpolation with two poles (their weights match
    the slopes of the sums on either side), kept inside a shrinking bracket.
    """
    n = len(d)
    gaps = np.append(np.diff(d), z2.sum())
    middle = d + gaps / 2
    at_middle = 1 + (z2[:, None] / (d[:, None] - middle[None, :])).sum(axis=0)
    right = (at_middle < 0) & (np.arange(n) < n - 1)      # the nearest pole is the upper one
    origin = np.where(right, np.append(d[1:], 0.0), d)
    delta = d[:, None] - origin[None, :]
    low = np.where(right, -gaps / 2, np.where(at_middle < 0, gaps / 2, 0.0))
    high = np.where(right, 0.0, np.where(at_middle < 0, gaps, gaps / 2))
    own, upper = np.diagonal(delta).copy(), np.append(np.diagonal(delta, -1), 0.0)
    below = np.tril(np.ones((n, n), bool)).T              # poles j <= i
    t = (low + high) / 2
    open_ = np.ones(n, bool)
    for _ in range(80):
        away = delta - t[None, :]
        away = np.where(away == 0, np.finfo(float).tiny, away)
        terms = z2[:, None] / away
        f = 1 + terms.sum(axis=0)
        slopes = terms / away
        open_ &= np.abs(f) > 2 * EPS * n * (1 + np.abs(terms).sum(axis=0))
        high = np.where(f >= 0, np.minimum(high, t), high)
        low = np.where(f < 0, np.maximum(low, t), low)
        open_ &= high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high))
        if not open_.any():
            break
        lower_slope = np.where(below, slopes, 0).sum(axis=0)
        a = lower_slope * (own - t) ** 2
        b = (slopes.sum(axis=0) - lower_slope) * (upper - t) ** 2
        b[-1] = 0
        with np.errstate(all="ignore"):
            c = f - a / (own - t) - np.where(b == 0, 0, b / (upper - t))
            linear = c * (own + upper) + a + b
            constant = c * own * upper + a * upper + b * own
            root = np.sqrt(np.maximum(linear ** 2 - 4 * c * constant, 0))
            q = (linear + np.where(linear >= 0, root, -root)) / 2
            first, second = q / c, constant / q
            new = np.where((first > low) & (first < high), first, second)
            new[-1] = own[-1] + a[-1] / c[-1]
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
        t = np.where(open_, new, t)
    away = delta - t[None, :]
    return np.where(away == 0, np.where(delta >= t[None, :], 1, -1) * np.finfo(float).tiny, away)


def updated(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors (columns) of diag(d) + z z', ``d`` ascending."""
    n = len(d)
    z, turn = z.copy(), np.eye(n)
    size = max(d[-1], float(z @ z))
    tiny = 8 * EPS * size
    # Deflation: eigenvalues that coincide are turned so that one of them alone is reached.
    reached = [j for j in range(n) if np.sqrt(size) * abs(z[j]) > tiny]
    kept: list[int] = []
    for j in reached:
        if kept:
            i = kept[-1]
            r = np.hypot(z[i], z[j])
            cos, sin = z[j] / r, z[i] / r
            if abs(cos * sin * (d[j] - d[i])) <= tiny:
                z[j], z[i] = r, 0.0
                turn[:, [i, j]] = turn[:, [i, j]] @ np.array([[cos, sin], [-sin, cos]])
                d = d.copy()
                d[i], d[j] = d[i] * cos ** 2 + d[j] * sin ** 2, d[i] * sin ** 2 + d[j] * cos ** 2
                kept.pop()
        kept.append(j)
    if not kept:
        return d, turn
    order = np.array(sorted(kept, key=lambda j: d[j]))
    own, values = d[order], d.copy()
    away = secular_roots(own, z[order] ** 2)
    # Weights for which these roots are exact: the vectors are then orthogonal to rounding.
    with np.errstate(all="ignore"):
        ratio = away / (own[:, None] - own[None, :])
    np.fill_diagonal(ratio, -np.diagonal(away))
    weights = np.sign(z[order]) * np.sqrt(np.maximum(np.prod(ratio, axis=1), 0))
    vectors = weights[:, None] / away
    vectors /= np.linalg.norm(vectors, axis=0)
    values[order] = own - np.diagonal(away)
    turn[:, order] = turn[:, order] @ vectors
    sort = np.argsort(values, kind="stable")
    return values[sort], turn[:, sort]


@dataclass
class Spectrum:
    """n vectors with their sums; scatter = basis' diag(eigenvalues) basis, rows orthonormal."""
    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims, np.int64), np.empty(0), np.empty((0, dims)))

    def add_term(self, v: np.ndarray) -> None:
        """scatter + v v'; the part of ``v`` outside the basis becomes a direction of eigenvalue 0."""
        norm = np.linalg.norm(v)
        if norm == 0:
            return
        z = self.basis @ v
        rest = v - z @ self.basis
        again = self.basis @ rest
        z, rest = z + again, rest - again @ self.basis
        left = np.linalg.norm(rest)
        if len(self.basis) < len(v) and left > 64 * EPS * norm:
            self.basis = np.vstack([rest / left, self.basis])
            self.eigenvalues = np.append(0.0, self.eigenvalues)
            z = np.append(left, z)
        self.eigenvalues, turn = updated(self.eigenvalues, z)
        self.basis = turn.T @ self.basis

    def add(self, x: np.ndarray) -> None:
        if self.n:
            self.add_term(np.sqrt(self.n / (self.n + 1)) * (self.n * x - self.sums) / self.n)
        self.n, self.sums = self.n + 1, self.sums + x

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.__dict__.update(other.__dict__)
            return
        for value, direction in zip(other.eigenvalues, other.basis):
            if value > 0:
                self.add_term(np.sqrt(value) * direction)
        between = self.sums / self.n - other.sums / other.n
        self.add_term(np.sqrt(self.n / (self.n + other.n) * other.n) * between)
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": self.sums.tolist(),
                "eigenvalues": self.eigenvalues.tolist(), "basis": self.basis.ravel().tolist()}


def spectrum_of(row: dict) -> Spectrum:
    sums = np.array(row["sums"], np.int64)
    return Spectrum(row["n"], sums, np.array(row["eigenvalues"], float),
                    np.array(row["basis"], float).reshape(-1, max(1, len(sums))))


# --- in Spark -------------------------------------------------------------

def partition_spectra(dims: int):
    schema = arrow_schema(SPECTRUM)

    def run(batches):
        from pyspark import TaskContext

        spectrum = Spectrum.empty(dims)
        for batch in batches:
            for x in matrix(batch.column("x")):
                spectrum.add(x)
        if spectrum.n:
            yield pa.RecordBatch.from_pylist([spectrum.row(TaskContext.get().partitionId())], schema)
    return run


def folded(parts: DataFrame, merge, schema: str, rows: int) -> DataFrame:
    """The parts, numbered up to ``rows``, merged ``FAN_IN`` at a time until one is left."""
    arrow = arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["part"])
        return pa.Table.from_pylist([merge(found) | {"part": found[0]["part"] // FAN_IN}], arrow)

    while rows > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("_to")).applyInArrow(run, schema)
        rows = -(-rows // FAN_IN)
    return parts


def merged_spectra(found: list[dict]) -> dict:
    whole = spectrum_of(found[0])
    for row in found[1:]:
        whole.combine(spectrum_of(row))
    return whole.row(0)


def incremental_spectrum(fit: DataFrame, dims: int) -> Spectrum:
    """The spectrum of all rows of ``fit``: one row reaches the driver, of dims**2 doubles."""
    tasks = max(1, -(-fit.count() // TASK_VECTORS))
    parts = written(fit.repartition(tasks).mapInArrow(partition_spectra(dims), SPECTRUM), "whitening-spectra")
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return Spectrum.empty(dims)
    return spectrum_of(folded(parts, merged_spectra, SPECTRUM, most + 1).first().asDict())


def moments_of(project):
    """Per task: number, sums and centred second moments of what ``project`` makes of its rows."""
    schema = arrow_schema(PARTIAL)

    def run(batches):
        from pyspark import TaskContext

        whole = None
        for batch in batches:
            if batch.num_rows:
                b = project(matrix(batch.column("x")))
                centred = b - b.mean(axis=0)
                part = {"n": len(b), "total": b.sum(axis=0).tolist(), "moments": (centred.T @ centred).ravel().tolist()}
                whole = part if whole is None else merged_moments([whole, part])
        if whole:
            yield pa.RecordBatch.from_pylist([whole | {"part": TaskContext.get().partitionId()}], schema)
    return run


def merged_moments(found: list[dict]) -> dict:
    n, total = found[0]["n"], np.array(found[0]["total"])
    moments = np.array(found[0]["moments"]).reshape(len(total), -1)
    for row in found[1:]:
        more = np.array(row["total"])
        between = total / n - more / row["n"]
        moments = (moments + np.array(row["moments"]).reshape(len(total), -1)
                   + n * (row["n"] / (n + row["n"])) * np.outer(between, between))
        n, total = n + row["n"], total + more
    return {"n": n, "total": total.tolist(), "moments": moments.ravel().tolist()}


def covariance(fit: DataFrame, project) -> np.ndarray:
    """Covariance, divisor n, of ``project`` over all rows of ``fit``."""
    parts = written(fit.mapInArrow(moments_of(project), PARTIAL), "whitening-moments")
    most = parts.agg(F.max("part")).first()[0]
    whole = folded(parts, merged_moments, PARTIAL, most + 1).first()
    return np.array(whole["moments"]).reshape(len(whole["total"]), -1) / whole["n"]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, from the exact n * x - sums."""
    return (n * x - sums) / n


@dataclass
class Whitening:
    """Unit eigenvectors (rows, by falling eigenvalue) of the fit list's covariance."""
    n: int
    sums: np.ndarray
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return centred(x, self.n, self.sums) @ self.vectors.T / np.sqrt(self.eigenvalues)

    def first(self, components: int) -> Whitening:
        return Whitening(self.n, self.sums, self.eigenvalues[:components], self.vectors[:components], self.trace)

    def varied(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.eigenvalues > 64 * EPS * len(self.sums) * self.trace


def refined(fit: DataFrame, spectrum: Spectrum) -> Whitening:
    """Rayleigh-Ritz: the covariance in the combined basis, completed to the whole space."""
    n, sums, dims = spectrum.n, spectrum.sums, len(spectrum.sums)
    complete, _ = np.linalg.qr(np.vstack([spectrum.basis[::-1], np.eye(dims)]).T)
    small = covariance(fit, lambda x: centred(x, n, sums) @ complete)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = (complete @ turn[:, ::-1]).T
    return Whitening(n, sums, np.maximum(values[::-1], 0), vectors / np.linalg.norm(vectors, axis=1)[:, None],
                     float(np.trace(small)))


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct vector once, as a written table."""
    return written(vectors.select("x").distinct(), "whitening-fit")


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum over dimensions of (n * x - sums) squared, exact."""
    most = n * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0))
    d = (n * x - sums) if most < 2.0 ** 62 else n * x.astype(object) - sums
    if most ** 2 * max(1, len(sums)) >= 2.0 ** 62:
        d = d.astype(object)
    return (d * d).sum(axis=1).tolist()


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained and
    identity_error for each remaining row and each of the first ``components`` components."""
    from decimal import Decimal

    vectors = whole_vectors(embeddings)
    dims = max(1, width(vectors))
    vectors = padded(vectors, dims)
    fit = fit_list(vectors)
    spectrum = incremental_spectrum(fit, dims)
    if not spectrum.n:
        none = embeddings.sparkSession.createDataFrame([], WHITENED)
        return none.withColumns({"explained": F.lit(None).cast("double"), "identity_error": F.lit(None).cast("double")})
    model = refined(fit, spectrum).first(components)
    varied = model.varied()
    error = None
    if varied.any():
        spread = covariance(fit, lambda x: model(x)[:, varied])
        error = float(np.abs(spread - np.eye(len(spread))).max())
    schema = arrow_schema(WHITENED)
    kept = len(model.eigenvalues)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            far = pa.array([Decimal(v) for v in deviations(x, model.n, model.sums)], schema.field("deviation").type)
            rows = np.repeat(np.arange(len(x)), kept)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), model.n, np.int64)), far.take(pa.array(rows)),
                pa.array(model(x).ravel(), mask=np.tile(~varied, len(x)))], schema=schema)

    shares = [float(v / model.trace) if model.trace > 0 else None for v in model.eigenvalues]
    explained = F.get(F.array(*[F.lit(s).cast("double") for s in shares]), F.col("component") - 1)
    return (vectors.mapInArrow(run, WHITENED).withColumn("explained", explained)
            .withColumn("identity_error", F.lit(error).cast("double")))
