"""Whitened embeddings by an incremental eigendecomposition (operator 13).

Every partition keeps the spectrum of the scatter of the rows it has seen: their
number, mean, eigenvalues and eigenvectors.  A batch of rows is centred and, where
it has more rows than dimensions, brought by QR to as many terms as there are
dimensions; each term and the shift of the mean are then rank-one updates, whose
eigenvalues are the roots of a secular equation, after deflation.  The spectra of
partitions are combined in the same way, some at a time, in a tree.  As every
update leaves a little error, a last pass over all rows takes the covariance in
the basis found (Rayleigh-Ritz), which gives components to double precision.

All that reaches the driver is of the size of a few matrices of dimensions by
dimensions, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgrove.llm.common import folded, partition_states, session_of

COMPONENTS = 32
#: A component x becomes the integer floor(SCALE * x) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows that are brought to rank-one terms together.
BATCH_ROWS = 4096
#: Vectors with larger entries have no exact integers in double precision.
MOST = float(1 << 52)
#: Relative size below which the secular equation is deflated; halvings of the intervals of its roots.
DEFLATION, HALVINGS = 1e-14, 64
_EPS = np.finfo(np.float64).eps


@dataclass
class Spectrum:
    """Scatter of ``n`` rows about their mean as eigenvalues, ascending, and eigenvectors in columns."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def to_bytes(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, dim: int) -> Spectrum:
        held = np.frombuffer(raw)
        return cls(int(held[0]), held[1 : 1 + dim].copy(), held[1 + dim : 1 + 2 * dim].copy(), held[1 + 2 * dim :].reshape(dim, dim).copy())

    def add_term(self, term: np.ndarray) -> None:
        """The rank-one update: the scatter plus the product of a vector with itself."""
        self.values, self.vectors = rank_one(self.values, self.vectors, term)

    def add(self, n: int, mean: np.ndarray, terms: np.ndarray) -> None:
        """Takes in ``n`` more rows, given by their mean and by terms that make up their scatter."""
        if not n:
            return
        for term in terms:
            self.add_term(term)
        if self.n:
            self.add_term((mean - self.mean) * np.sqrt(self.n * n / (self.n + n)))
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add_rows(self, rows: np.ndarray) -> None:
        mean = rows.mean(axis=0)
        centred = rows - mean
        self.add(len(rows), mean, np.linalg.qr(centred, mode="r") if len(rows) > rows.shape[1] else centred)

    def add_spectrum(self, other: Spectrum) -> None:
        self.add(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0.0))).T)


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - root)) = 0 for ascending distinct poles and positive weights.

    Each root lies above its pole and below the next.  They come as the index of the
    nearer pole and the distance from it, which keeps differences to poles exact.
    """
    k = len(poles)
    above = np.append(poles[1:], poles[-1] + weights.sum())
    half = (above - poles) / 2
    gaps = poles[None, :] - poles[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        middle = 1 + (weights[None, :] / (gaps - half[:, None])).sum(axis=1)
    # the sum rises from minus infinity to plus infinity between two poles
    left = (middle >= 0) | (np.arange(k) == k - 1)
    origin = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    low, high = np.where(left, 0.0, -half), np.where(left, half, 0.0)
    if middle[-1] < 0:
        low[-1], high[-1] = half[-1], 2 * half[-1]
    to_poles = poles[None, :] - poles[origin][:, None]
    for _ in range(HALVINGS):
        tried = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            rising = 1 + (weights[None, :] / (to_poles - tried[:, None])).sum(axis=1) < 0
        low, high = np.where(rising, tried, low), np.where(rising, high, tried)
    return origin, np.where(left, high, low)


def _merge_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, near: float) -> None:
    """Turns the eigenvectors of each run of equal eigenvalues so that one of them takes all of its part of ``z``."""
    starts = np.flatnonzero(np.diff(values, prepend=-np.inf) > near)
    ends = np.append(starts[1:], len(values))
    for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
        length = np.linalg.norm(z[a:b])
        if length == 0:
            continue
        mirror = z[a:b] / length
        mirror[0] += np.copysign(1.0, mirror[0])
        mirror /= np.linalg.norm(mirror)
        sign = -np.copysign(1.0, z[a])
        vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ mirror, mirror)
        z[a:b] = 0
        z[a] = sign * length


def rank_one(values: np.ndarray, vectors: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors of a symmetric matrix, given by its own, plus the product of a vector with itself."""
    z = vectors.T @ term
    size = max(float(np.abs(values).max()), float(z @ z))
    if size == 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    _merge_equal(values, vectors, z, DEFLATION * size)
    active = np.flatnonzero(z * z > DEFLATION * DEFLATION * size)
    if not len(active):
        return values, vectors
    poles, part = values[active], z[active]
    origin, tau = secular_roots(poles, part * part)
    roots = poles[origin] + tau
    # differences of poles (columns) and roots (rows), and the vector of which the roots are the exact ones (Gu and Eisenstat)
    away = (poles[None, :] - poles[origin][:, None]) - tau[:, None]
    away = np.where(away == 0, _EPS * size * 1e-16, away)
    k = len(active)
    between = poles[:, None] - poles[None, :]
    np.fill_diagonal(between, 1.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = -away / -between.T
        ratio[np.arange(k), np.arange(k)] = -away[np.arange(k), np.arange(k)]
    refined = np.sqrt(np.abs(np.prod(np.abs(ratio), axis=0))) * np.where(part < 0, -1.0, 1.0)
    turn = (refined[None, :] / away).T
    turn /= np.linalg.norm(turn, axis=0)
    if np.isfinite(turn).all():
        vectors[:, active] = vectors[:, active] @ turn
        values[active] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


# --- rows of integers ------------------------------------------------------------------------------------------------


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``v``, the vectors as arrays of doubles without nulls, non-finite or very large entries."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST / SCALE))
    return df.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ok)


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(SCALE * flat).astype(np.int64) + SHIFT).reshape(-1, dim)


def _sum_of(kind: type) -> Callable[[list[bytes]], bytes]:
    return lambda states: sum(np.frombuffer(s, kind) for s in states if s).astype(kind).tobytes() if any(states) else b""


@dataclass(frozen=True)
class Whitening:
    """What was learnt: rows, exact sums of their integers, and components in columns with their shares of the variance."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def base(self) -> np.ndarray:
        """An integer vector next to the mean, so that differences are small and exact."""
        return self.sums // max(self.n, 1)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - (self.sums - self.n * self.base) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def _length(rows: DataFrame) -> int:
    """The length that most vectors have; of two the larger."""
    counted = rows.groupBy(F.size("v").alias("dim")).count().where("dim > 0").orderBy(F.desc("count"), F.desc("dim")).first()
    return counted["dim"] if counted else 0


def _partition_spectra(batches: Iterator[pa.RecordBatch], dim: int, base: np.ndarray) -> bytes:
    spectrum = Spectrum.empty(dim)
    for batch in batches:
        x = (_integers(batch.column(0), dim) - base).astype(np.float64)
        for at in range(0, len(x), BATCH_ROWS):
            spectrum.add_rows(x[at : at + BATCH_ROWS])
    return spectrum.to_bytes()


def _combined(states: list[bytes], dim: int) -> bytes:
    spectra = [Spectrum.from_bytes(s, dim) for s in states]
    first, *others = sorted(spectra, key=lambda s: -s.n)
    for other in others:
        first.add_spectrum(other)
    return first.to_bytes()


def fit(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learns the whitening of all usable vectors; none where there are no vectors or they don't differ."""
    session_of(df)
    usable = _usable(df, id_col, vector_col)
    dim = _length(usable)
    if not dim:
        return None
    rows = usable.where(F.size("v") == dim).select("v")

    def count(batches: Iterator[pa.RecordBatch]) -> bytes:
        total = np.zeros(dim + 1, np.int64)
        for batch in batches:
            x = _integers(batch.column(0), dim)
            total[0] += len(x)
            total[1:] += x.sum(axis=0)
        return total.tobytes()

    total = np.frombuffer(folded(partition_states(rows, count), _sum_of(np.int64)), np.int64)
    n, sums = int(total[0]), total[1:].copy()
    base = sums // n
    raw = folded(partition_states(rows, lambda batches: _partition_spectra(batches, dim, base)), lambda states: _combined(states, dim))
    basis = np.linalg.qr(Spectrum.from_bytes(raw, dim).vectors[:, ::-1])[0]
    learnt = Whitening(n, sums, basis, np.ones(dim), 1.0)

    def project(batches: Iterator[pa.RecordBatch]) -> bytes:
        found = np.zeros((dim, dim))
        for batch in batches:
            y = learnt.centred(_integers(batch.column(0), dim)) @ basis
            found += y.T @ y
        return found.tobytes()

    ritz = np.frombuffer(folded(partition_states(rows, project), _sum_of(np.float64))).reshape(dim, dim) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    kept = int((values[:components] > max(values[0], 0) * dim * _EPS).sum())
    if not kept:
        return None
    vectors = vectors[:, :kept] * np.sign(vectors[np.abs(vectors[:, :kept]).argmax(axis=0), np.arange(kept)])
    return Whitening(n, sums, vectors, values[:kept].copy(), float(np.trace(ritz)))


def identity_error(df: DataFrame, learnt: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """How far the covariance of the whitened vectors, centred, is from the identity, as it is in the rows."""
    dim, k = learnt.vectors.shape
    rows = _usable(df, id_col, vector_col).where(F.size("v") == dim).select("v")

    def measure(batches: Iterator[pa.RecordBatch]) -> bytes:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = learnt.whiten(_integers(batch.column(0), dim))
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        return total.tobytes()

    total = np.frombuffer(folded(partition_states(rows, measure), _sum_of(np.float64))).reshape(k + 1, k) / learnt.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The exact sum over dimensions of (n * x - sums) squared, null beyond the range of a long."""
    away = n * x - sums
    largest = int(np.abs(away).max(initial=0))
    if largest * largest * x.shape[1] < 1 << 63:
        return (away * away).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in away]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(df: DataFrame, learnt: Whitening | None, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened`` and ``explained`` of every usable vector and component.

    Vectors that are null, empty, or hold null, non-finite or very large entries take
    no part, nor do those of another length than most.  Equal rows and rows with equal
    or null ids each give rows of their own; other columns are ignored.  Components
    without variance are left out; with none at all the frame is empty.
    """
    session_of(df)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double"
    usable = _usable(df, id_col, vector_col)
    if learnt is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, k = learnt.vectors.shape
    shares = learnt.values / learnt.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                x = _integers(part.column(1), dim)
                away = np.repeat(np.array(deviations(x, learnt.n, learnt.sums), dtype=object), k)
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, learnt.n, np.int64)),
                    pa.array(away, pa.int64()),
                    pa.array(learnt.whiten(x).ravel()),
                    pa.array(np.tile(shares, len(x))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return usable.where(F.size("v") == dim).select(F.col("vec_id").cast("long").alias("vec_id"), "v").mapInArrow(run, schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings whitened, with the error that the whitened covariance really has."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    learnt = fit(df)
    error = identity_error(df, learnt) if learnt else None
    return whiten(df, learnt).withColumn("identity_error", F.lit(error).cast("double"))
