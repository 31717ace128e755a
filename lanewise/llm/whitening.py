"""Whitening of vectors: their covariance diagonalised by rank-one updates.

1. Every partition keeps the eigenvalues and eigenvectors of the scatter of its rows. A
   row, centred on the mean so far, is a rank-one update: its secular equation gives the
   new values, and Loewner's formula the new vectors. Directions it does not touch, and
   values too close to tell apart, are deflated.
2. Two spectra are combined by one rank-one update for each eigenvector of the second and
   one for the difference of the means, in a tree over the partitions.
3. The rows are projected on the basis found, their covariance there is summed over all
   partitions, and its eigenvectors turn the basis (Rayleigh-Ritz).

Entries become integers first, so that sums and deviations from the mean are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import written
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

EPS = np.finfo(np.float64).eps
#: Rows of a block in the passes over the vectors, and spectra combined by one task.
BLOCK, FAN = 2048, 16
#: Steps of the secular equation at most; each at least halves the bracket of a root when others fail.
STEPS = 100


@dataclass(frozen=True)
class Whitening:
    components: int = 32
    scale: float = 64.0  # an entry c becomes floor(scale * c) + offset
    offset: int = 1_000_000
    largest: int = 1 << 52  # of a scaled entry; larger ones are cut to it
    least: float = 1e-12  # share of the trace below which a component has no variance to divide by


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)), one above each of the ascending ``d``.

    Returned as the nearer pole's index and the distance from it, which keeps the
    difference of a root and any pole exact.
    """
    n = len(d)
    up = np.append(d[1:], d[-1] + rho * z2.sum())
    width = up - d
    # the sign in the middle tells which pole is nearer; the last root has one pole only
    middle = d + width / 2
    gap = d[None, :] - middle[:, None]
    side = 1.0 / rho + (z2[None, :] / gap).sum(axis=1)
    origin = np.arange(n)
    right = side < 0
    right[-1] = False
    origin[right] += 1
    delta = d[None, :] - d[origin][:, None]
    low = np.where(right, -width / 2, 0.0)
    high = np.where(right, 0.0, width / 2)
    if side[-1] < 0:
        low[-1], high[-1] = width[-1] / 2, width[-1]
    tau = (low + high) / 2
    below = np.tri(n)  # poles at or left of the root
    first, second = delta[np.arange(n), np.arange(n)], np.append(delta[np.arange(n - 1), np.arange(1, n)], width[-1])
    apart, terms, slopes = np.empty((3, n, n))
    with np.errstate(all="ignore"):
        for _ in range(STEPS):
            np.subtract(delta, tau[:, None], out=apart)
            np.divide(z2, apart, out=terms)
            np.divide(terms, apart, out=slopes)
            # terms are negative left of the root and positive right of it
            total, lower = terms.sum(axis=1), np.einsum("ij,ij->i", terms, below)
            value = 1.0 / rho + total
            low = np.where(value < 0, tau, low)
            high = np.where(value < 0, high, tau)
            done = np.abs(value) <= EPS * n * (1.0 / rho + total - 2 * lower)
            done |= high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
            if done.all():
                break
            # a model with the two neighbouring poles ("the middle way")
            psi = np.einsum("ij,ij->i", slopes, below)
            phi = slopes.sum(axis=1) - psi
            a1, a2 = first - tau, second - tau
            c = value - a1 * psi - a2 * phi
            a = (a1 + a2) * value - a1 * a2 * (psi + phi)
            b = a1 * a2 * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            new = tau + np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            inside = np.isfinite(new) & (new > low) & (new < high)
            tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return origin, tau


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of Q diag(values) Q' + rho v v' for rho > 0, values ascending."""
    z = vectors.T @ v
    size = float(z @ z)
    if rho * size <= 0.0:
        return values, vectors
    tol = 8 * EPS * max(abs(values[-1]), rho * size)
    # equal values: a reflection leaves one vector of them that v touches
    same = np.flatnonzero(np.diff(values) <= tol)
    if len(same):
        vectors = vectors.copy()
        for cluster in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1):
            at = np.arange(cluster[0], cluster[-1] + 2)
            length = np.sqrt(z[at] @ z[at])
            if length == 0.0:
                continue
            w = z[at].copy()
            sign = 1.0 if w[-1] >= 0 else -1.0
            w[-1] += sign * length
            w /= np.sqrt(w @ w)
            vectors[:, at] -= 2 * np.outer(vectors[:, at] @ w, w)
            z[at], z[at[-1]] = 0.0, -sign * length
    live = rho * z * z > tol * EPS
    live &= rho * np.abs(z) * np.sqrt(size) > tol
    if not live.any():
        return values, vectors
    d, z = values[live], z[live]
    origin, tau = secular_roots(d, z * z, rho)
    # roots minus poles, exactly; from them the z for which these are the exact roots
    apart = (d[origin][:, None] - d[None, :]) + tau[:, None]
    poles = d[None, :] - d[:, None]
    n = len(d)
    upper = np.triu(np.ones((n, n), bool), 1)
    # for pole j: the roots left of it pair with the poles left of it, the others with the next pole
    left = np.where(upper, apart / np.where(poles == 0, 1.0, -poles.T), 1.0)
    shifted = np.vstack([poles.T[1:], np.ones(n)])  # d[i + 1] - d[j]
    keeps = ~upper
    keeps[-1] = False
    right = np.where(keeps, apart / np.where(shifted == 0, 1.0, shifted), 1.0)
    z_hat = np.copysign(np.sqrt(np.abs(left.prod(axis=0) * right.prod(axis=0) * apart[-1]) / rho), z)
    turn = -z_hat[:, None] / apart.T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[live] = d[origin] + tau
    new_vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


class Spectrum:
    """n rows summed up by their mean and the eigenvalues and eigenvectors of their scatter."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, row: np.ndarray) -> None:
        gap = row - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, gap, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + gap / self.n

    def join(self, other: Spectrum) -> None:
        """Take in the rows of another spectrum."""
        if not other.n:
            return
        values, vectors = self.values, self.vectors
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                values, vectors = rank_one(values, vectors, vector, value)
        total, gap = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(values, vectors, gap, self.n * other.n / total)
        self.mean = self.mean + gap * (other.n / total)
        self.n = total

    def to_bytes(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def of_bytes(cls, data: bytes, dims: int) -> Spectrum:
        flat = np.frombuffer(data)
        n, mean, values, vectors = np.split(flat, [1, 1 + dims, 1 + 2 * dims])
        return cls(int(n[0]), mean, values, vectors.reshape(dims, dims))


def _combined(partials: DataFrame, merge: Callable[[list[bytes]], bytes], name: str) -> bytes | None:
    """One state of the states ``slot, state``, merged in a tree of FAN at a time; its size is that of one."""
    level = written(partials, name)
    top = level.agg(F.max("slot")).first()[0]
    while top:

        def run(key: tuple, group: pa.Table) -> pa.Table:
            held = group.sort_by("slot").column("state").to_pylist()
            return pa.table({"slot": pa.array([key[0].as_py()], pa.int64()), "state": pa.array([merge(held)], pa.binary())})

        up = level.withColumn("slot", F.expr(f"slot div {FAN}"))
        level, top = written(up.groupBy("slot").applyInArrow(run, "slot long, state binary"), name), top // FAN
    held = level.select("state").collect()
    return bytes(held[0][0]) if held else None


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def _per_partition(rows: DataFrame, start: Callable, take: Callable, finish: Callable) -> DataFrame:
    """One state of every partition that has rows: slot, state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                state = take(start() if state is None else state, batch.slice(at, BLOCK))
        if state is not None:
            slot = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int64()), pa.array([finish(state)], pa.binary())], names=["slot", "state"]
            )

    return rows.select("x").mapInArrow(run, "slot long, state binary")


def scaled(table: DataFrame, whitening: Whitening, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id and x (long entries) of the rows whose vector has known, finite entries only."""
    v = F.col("v")
    rows = table.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bound = float(whitening.largest)

    def entry(c):
        whole = F.floor(F.greatest(F.least(c * whitening.scale, F.lit(bound)), F.lit(-bound)))
        return whole.cast("long") + whitening.offset

    return rows.where(v.isNotNull() & (F.size(v) > 0) & sound).select("id", F.transform(v, entry).alias("x"))


@dataclass
class Fitted:
    """n rows with sums S, and their components: eigenvalues falling, unit eigenvectors as columns."""

    n: int
    sums: np.ndarray  # Python integers
    values: np.ndarray
    vectors: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.values)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S exactly: as long, or as Python integers where that could overflow."""
    far = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(abs(int(s)) for s in sums)
    if far < 1 << 62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def exact_sums(rows: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Number of the rows and the sums of their entries, as Python integers."""

    def take(state, batch):
        x = _matrix(batch, dims)
        half = 1 << 31  # high and low parts: neither sum overflows in a block
        high, low = x // half, x % half
        return [state[0] + len(x), state[1] + high.sum(axis=0).astype(object) * half + low.sum(axis=0).astype(object)]

    def pack(state):
        return ",".join(map(str, [state[0], *state[1]])).encode()

    def merge(states):
        return pack(list(_totals(states)))

    def _totals(states):
        held = [np.array([int(v) for v in s.decode().split(",")], object) for s in states]
        total = sum(held)
        return total[0], total[1:]

    found = _combined(
        _per_partition(rows, lambda: [0, np.zeros(dims, object)], take, pack), merge, "sums"
    )
    n, *sums = [int(v) for v in found.decode().split(",")]
    return n, np.array(sums, object)


def spectrum(rows: DataFrame, dims: int, offset: int) -> Spectrum:
    """The spectrum of all rows less ``offset``, by rank-one updates within and across partitions."""

    def take(state, batch):
        for row in (_matrix(batch, dims) - offset).astype(np.float64):
            state.add(row)
        return state

    def merge(states):
        first = Spectrum.of_bytes(states[0], dims)
        for other in states[1:]:
            first.join(Spectrum.of_bytes(other, dims))
        return first.to_bytes()

    parts = _per_partition(rows, lambda: Spectrum.empty(dims), take, lambda s: s.to_bytes())
    return Spectrum.of_bytes(_combined(parts, merge, "spectra"), dims)


def covariance(rows: DataFrame, n: int, sums: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the rows, centred and then projected on the columns of ``basis``."""
    dims, size = basis.shape

    def take(state, batch):
        y = (deviations(_matrix(batch, dims), n, sums) / n).astype(np.float64) @ basis
        state += y.T @ y
        return state

    def merge(states):
        return sum(np.frombuffer(s) for s in states).tobytes()

    parts = _per_partition(rows, lambda: np.zeros((size, size)), take, lambda s: s.tobytes())
    return np.frombuffer(_combined(parts, merge, "covariance")).reshape(size, size) / n


def fit(rows: DataFrame, dims: int, offset: int = 0) -> Fitted:
    """Components of all rows of x; taking off ``offset`` first keeps digits and changes nothing else."""
    n, sums = exact_sums(rows, dims)
    basis, _ = np.linalg.qr(spectrum(rows, dims, offset).vectors)
    values, turn = np.linalg.eigh(covariance(rows, n, sums, basis))
    return Fitted(n, sums, values[::-1].copy(), (basis @ turn)[:, ::-1].copy())


_OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    table: DataFrame, whitening: Whitening = Whitening(), id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per row and component: the id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped, and
    so are those of another length than most (of the longest, if lengths tie). Repeated
    rows and null ids are rows like others. Components whose variance is below ``least``
    of the total have no whitened value and are left out, so equal rows alone give
    no row, and so does an empty table. ``deviation`` is null where it exceeds a long.
    Entries beyond ``largest`` are cut to it. Other columns are ignored.
    """
    spark = table.sparkSession
    kind = table.schema[id].dataType.simpleString()
    schema = f"id {kind}, {_OUT}"
    sound = written(scaled(table, whitening, id, vector), "entries")
    lengths = sound.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    dims = lengths[0]["dims"]
    rows = sound.where(F.size("x") == dims)
    found = fit(rows, dims, whitening.offset)
    trace = float(found.values.sum())
    kept = int((found.values[: whitening.components] > whitening.least * trace).sum()) if trace > 0 else 0
    if not kept:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    scaling = found.vectors[:, :kept] / np.sqrt(found.values[:kept])
    error = float(np.abs(covariance(rows, found.n, found.sums, scaling) - np.eye(kept)).max())
    explained = found.values[:kept] / trace
    n, sums = found.n, found.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                away = deviations(_matrix(part, dims), n, sums)
                values = (away / n).astype(np.float64) @ scaling
                m = len(values)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(np.repeat(np.arange(m), kept))),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * kept, n)),
                        pa.array(_squares(away)).take(pa.array(np.repeat(np.arange(m), kept))),
                        pa.array(values.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * kept, error)),
                    ],
                    names=["id", *[c.split()[0] for c in _OUT.split(", ")]],
                )

    return rows.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id)


def _squares(away: np.ndarray) -> pa.Array:
    """Sums of squares by row, exactly; null where one does not fit a long."""
    largest = max(abs(int(away.max(initial=0))), abs(int(away.min(initial=0))))
    if away.dtype != object and largest * largest * away.shape[1] < 1 << 63:
        return pa.array((away * away).sum(axis=1), pa.int64())
    sums = (away.astype(object) ** 2).sum(axis=1).tolist()
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())
