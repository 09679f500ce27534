"""Whitening by incremental eigendecomposition.

1. Every task keeps the mean and the eigenvectors of its scatter.  A row is a
   centred rank-one update: with the row in the eigenbasis as z, the new
   eigenvalues are the roots of the secular equation
   1 + rho * sum(z_i^2 / (d_i - t)) = 0, one between each two old ones, found
   after deflation (places with no weight, and equal eigenvalues rotated so that one
   carries all their weight); the eigenvectors follow from weights worked
   out anew from the roots, which keeps them orthogonal.
2. The spectra of tasks are joined, some at a time, by one such update for each
   eigenvector of the other and one for the difference of the means.
3. Rayleigh-Ritz: one pass gathers the covariance of all rows in the joined basis, row
   by row from whole numbers; its small eigenproblem turns the basis to the
   eigenvectors in double precision.

Counts, sums and squared deviations are whole numbers throughout.  A task holds
one batch of rows and width x width numbers; the driver holds one such matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.common import batch, parallelism, stored

SCALE, SHIFT = 64, 1_000_000
#: Rows with an entry beyond this are left out as non-finite ones are: whole numbers above are not doubles.
LARGEST = 2.0 ** 52
#: Spectra that one task joins.
JOINED = 16
#: An eigenvalue under this share of the largest counts as zero.
FLAT = 1e-13
EPS = np.finfo(float).eps
REFRESH = 1024

SPECTRUM = pa.schema([("slot", pa.int64()), ("n", pa.int64()), ("width", pa.int32()), ("sums", pa.list_(pa.string())),
                      ("mean", pa.binary()), ("values", pa.binary()), ("vectors", pa.binary())])
SPECTRUM_DDL = "slot long, n long, width int, sums array<string>, mean binary, values binary, vectors binary"


# ---- rank-one updates --------------------------------------------------------------
def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z^2 / (d - t)) for ascending distinct d, z without
    zeros and rho > 0, as (index of the nearest pole, distance from it): their
    differences from all poles are exact where it counts.

    All roots are found at once: a rational step that fits the poles on either
    side, kept inside a shrinking bracket, else its middle."""
    n = len(d)
    w = rho * z * z
    right = np.append(d[1:], d[-1] + w.sum())
    width = right - d
    middle = d + 0.5 * width
    with np.errstate(divide="ignore", invalid="ignore"):
        at_middle = 1.0 + (w / (d[None, :] - middle[:, None])).sum(axis=1)
    near = np.arange(n)
    upper = (at_middle < 0) & (near < n - 1)       # the root lies in the right half
    pole = near + upper
    gap = d[None, :] - d[pole][:, None]            # poles seen from the root's own
    low = np.where(upper, -0.5 * width, 0.0)
    high = np.where(upper, 0.0, np.where(at_middle < 0, width, 0.5 * width))
    low = np.where((at_middle < 0) & ~upper, 0.5 * width, low)
    t = 0.5 * (low + high)
    left_side = np.arange(n)[None, :] <= near[:, None]
    here = np.arange(n)
    done = np.zeros(n, bool)
    for _ in range(100):
        with np.errstate(divide="ignore", invalid="ignore"):
            q = w / (gap - t[:, None])
            f = 1.0 + q.sum(axis=1)
            slope = q / (gap - t[:, None])
        size = 1.0 + np.abs(q).sum(axis=1)
        done |= ~(np.abs(f) > 4 * EPS * size) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        low = np.where(f < 0, t, low)
        high = np.where(f > 0, t, high)
        # f is matched by c + a / (gap_left - t) + b / (gap_right - t), with the slopes of either side
        p = np.where(left_side, slope, 0).sum(axis=1)
        r = slope.sum(axis=1) - p
        dl, dr = gap[here, near] - t, np.where(near < n - 1, gap[here, np.minimum(near + 1, n - 1)], np.inf) - t
        a, last = p * dl * dl, near == n - 1
        b = np.where(last, 0.0, r * np.where(last, 1.0, dr) ** 2)
        c = f - p * dl - np.where(last, 0.0, r * np.where(last, 1.0, dr))
        # (c)(dl - s)(dr - s) + a (dr - s) + b (dl - s) = 0, s the step
        with np.errstate(all="ignore"):
            q2, q1 = c, -(c * (dl + dr) + a + b)
            q0 = c * dl * dr + a * dr + b * dl
            root = np.sqrt(np.maximum(q1 * q1 - 4 * q2 * q0, 0.0))
            big = -0.5 * (q1 + np.where(q1 >= 0, root, -root))
            one, two = big / q2, q0 / big
            step = np.where(np.abs(one) < np.abs(two), one, two)
            step = np.where(last, dl + a / c, step)
            new = t + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        t = np.where(done, t, np.where(inside, new, 0.5 * (low + high)))
    return pole, t


def rank_one(d: np.ndarray, v: np.ndarray, x: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of v diag(d) v' + rho x x'."""
    z = v.T @ x
    norm = np.sqrt(z @ z)
    if rho <= 0 or not norm > 0:
        return d, v
    rho, z = rho * norm * norm, z / norm
    tol = 8 * EPS * max(abs(d[-1]), abs(d[0]), rho)
    # equal eigenvalues: a reflection puts all their weight on the last of them
    close = np.diff(d) <= tol
    if close.any():
        v, begin = v.copy(), 0
        for end in np.append(np.flatnonzero(~close) + 1, len(d)):
            part = z[begin:end]
            if end - begin > 1 and (part[:-1] != 0).any():
                length = np.sqrt(part @ part)
                u = part.copy()
                u[-1] += length if u[-1] >= 0 else -length
                u /= np.sqrt(u @ u)
                v[:, begin:end] -= 2.0 * np.outer(v[:, begin:end] @ u, u)
                z = z.copy()
                sign = -1.0 if part[-1] >= 0 else 1.0
                z[begin:end] = 0.0
                z[end - 1] = sign * length
            begin = end
    live = np.flatnonzero(rho * np.abs(z) > tol)
    if not len(live):
        return d, v
    dl, zl = d[live], z[live]
    # eigenvalues that are still too close to tell apart among the live ones get no update of their own
    keep = np.append(np.diff(dl) > 0, True)
    live, dl, zl = live[keep], dl[keep], zl[keep]
    pole, t = secular_roots(dl, zl, rho)
    diff = (dl[:, None] - dl[pole][None, :]) - t[None, :]          # pole i minus root j
    # the weights for which these roots are exact
    k = len(dl)
    ratio = -diff
    base = dl[None, :] - dl[:, None]
    np.fill_diagonal(base, 1.0)
    # base[i, j] pairs pole j with root j left of i, and pole j + 1 with root j from i on
    low = np.tril(np.ones((k, k), bool), -1)
    factors = np.where(low, ratio / base, 1.0)
    up = np.ones((k, k))
    up[:, :-1] = np.where(np.triu(np.ones((k, k - 1), bool)), ratio[:, :-1] / np.where(np.triu(np.ones((k, k - 1), bool)), base[:, 1:], 1.0), 1.0)
    weight = np.abs(factors.prod(axis=1) * up.prod(axis=1) * ratio[:, -1])
    zhat = np.where(zl < 0, -1.0, 1.0) * np.sqrt(weight)
    q = zhat[:, None] / diff
    q /= np.sqrt((q * q).sum(axis=0))
    values, vectors = d.copy(), v.copy()
    values[live] = dl[pole] + t
    vectors[:, live] = v[:, live] @ q
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Rows so far: count, exact sums, mean, and the eigensystem of their scatter."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, width: int) -> "Spectrum":
        return cls(0, [0] * width, np.zeros(width), np.zeros(width), np.eye(width))

    def widen(self, width: int) -> None:
        """Rows so far as if they had ``width`` entries, the new ones zero."""
        more = width - len(self.sums)
        if more > 0:
            old, self.mean = len(self.sums), np.append(self.mean, np.zeros(more))
            self.sums = self.sums + [0] * more
            vectors = np.eye(width)
            vectors[:old, more:], vectors[old:, more:] = self.vectors, 0.0
            vectors[:, :more] = 0.0
            vectors[old:, :more] = np.eye(more)
            self.vectors, self.values = vectors, np.append(np.zeros(more), self.values)

    def add(self, x: np.ndarray, times: int) -> None:
        """``times`` equal rows, as one update."""
        away = x - self.mean
        rho = self.n * times / (self.n + times)
        self.n += times
        self.mean = self.mean + away * (times / self.n)
        self.values, self.vectors = rank_one(self.values, self.vectors, away, rho)

    def join(self, other: "Spectrum") -> None:
        width = max(len(self.sums), len(other.sums))
        self.widen(width)
        other.widen(width)
        if other.n:
            for e, u in zip(other.values, other.vectors.T):
                if e > 0:
                    self.values, self.vectors = rank_one(self.values, self.vectors, u, float(e))
            away = other.mean - self.mean
            rho = self.n * other.n / (self.n + other.n)
            self.mean = self.mean + away * (other.n / (self.n + other.n))
            self.values, self.vectors = rank_one(self.values, self.vectors, away, rho)
            self.n += other.n
            self.sums = [a + b for a, b in zip(self.sums, other.sums)]
            self.refresh()

    def refresh(self) -> None:
        """The basis made orthonormal again to the last digits."""
        q, r = np.linalg.qr(self.vectors)
        self.vectors = q * np.where(np.diag(r) < 0, -1.0, 1.0)

    def row(self, slot: int) -> tuple:
        return (slot, self.n, len(self.sums), [str(s) for s in self.sums], self.mean.tobytes(), self.values.tobytes(),
                self.vectors.tobytes())

    @classmethod
    def of(cls, row: dict) -> "Spectrum":
        w = row["width"]
        return cls(row["n"], [int(s) for s in row["sums"]], np.frombuffer(row["mean"]), np.frombuffer(row["values"]),
                   np.frombuffer(row["vectors"]).reshape(w, w))


# ---- rows --------------------------------------------------------------------------
def whole_numbers(rb: pa.RecordBatch, width: int | None = None) -> np.ndarray:
    """The batch's vectors minus the shift, floor(64 c), as whole numbers in doubles;
    short vectors get zeros."""
    column = rb.column(rb.num_columns - 1)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(int(lengths.max(initial=0)), width or 0)
    if (lengths == width).all():
        return np.floor(SCALE * flat.reshape(len(lengths), width))
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = np.floor(SCALE * flat)
    return out


def usable_rows(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): rows whose vector is there and has only finite entries."""
    v = F.col(vector_column).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LARGEST))
    return vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).filter(fine)


def spectra(rows: DataFrame) -> DataFrame:
    """One SPECTRUM row a task."""

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        s, updates = Spectrum.empty(0), 0
        for rb in batches:
            if not rb.num_rows:
                continue
            x = whole_numbers(rb, len(s.sums))
            s.widen(x.shape[1])
            distinct, times = np.unique(x, axis=0, return_counts=True) if x.shape[1] else (x[:1], np.array([len(x)]))
            s.sums = [a + sum(map(int, c)) for a, c in zip(s.sums, x.T.tolist())]
            for row, k in zip(distinct, times):
                s.add(row, int(k))
                updates += 1
                if updates % REFRESH == 0:
                    s.refresh()
        if s.n:
            yield batch(SPECTRUM, [[c] for c in s.row(TaskContext.get().partitionId())])

    return rows.mapInArrow(run, SPECTRUM_DDL)


def joined(parts: DataFrame) -> Spectrum | None:
    """All spectra joined into one, ``JOINED`` in a task, by rounds."""

    def join(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["slot"])
        s = Spectrum.of(rows[0])
        for row in rows[1:]:
            s.join(Spectrum.of(row))
        return pa.Table.from_batches([batch(SPECTRUM, [[c] for c in s.row(key[0].as_py())])])

    while parts.count() > 1:
        parts = stored(parts.groupBy(F.expr(f"slot div {JOINED}").alias("group")).applyInArrow(join, SPECTRUM_DDL), "whitening_spectra")
    row = parts.first()
    return Spectrum.of(row.asDict()) if row else None


def moments(rows: DataFrame, width: int, transform) -> tuple[np.ndarray, np.ndarray]:
    """Sum and sum of outer products of ``transform(x)`` over all rows.  Tasks add up
    their own; those sums, of a fixed size, are added in rounds."""

    def run(batches):
        from pyspark import TaskContext

        total = outer = None
        for rb in batches:
            if rb.num_rows:
                y = transform(whole_numbers(rb, width))
                total, outer = (y.sum(axis=0), y.T @ y) if total is None else (total + y.sum(axis=0), outer + y.T @ y)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary()),
                                              pa.array([outer.tobytes()], pa.binary())], names=["slot", "total", "outer"])

    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows_ = sorted(group.to_pylist(), key=lambda r: r["slot"])
        total, outer = (sum(np.frombuffer(r[c]) for r in rows_) for c in ("total", "outer"))
        return pa.table({"slot": [key[0].as_py()], "total": [total.tobytes()], "outer": [outer.tobytes()]})

    ddl = "slot long, total binary, outer binary"
    parts = stored(rows.mapInArrow(run, ddl), "whitening_moments")
    while parts.count() > 1:
        parts = stored(parts.groupBy(F.expr(f"slot div {JOINED}").alias("group")).applyInArrow(add, ddl), "whitening_moments")
    row = parts.first()
    total = np.frombuffer(row["total"])
    return total, np.frombuffer(row["outer"]).reshape(len(total), len(total))


# ---- the model ---------------------------------------------------------------------
@dataclass(frozen=True)
class Whitening:
    """``values`` fall; ``vectors`` has a component in each column."""

    n: int
    sums: list[int]           # of floor(64 c)
    values: np.ndarray
    vectors: np.ndarray
    components: int

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean, from whole numbers: quotient first, then remainder."""
        q = np.array([s // self.n for s in self.sums], float)
        r = np.array([s % self.n / self.n for s in self.sums])
        return (x - q) - r

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        q = np.array([s // self.n for s in self.sums], float)
        r = [s % self.n for s in self.sums]
        away = (x - q).astype(np.int64)
        most = int(np.abs(away).max(initial=0)) + 1
        if self.n * most < 2 ** 31 and (self.n * most) ** 2 * max(1, self.width) < 2 ** 63:
            return ((self.n * away - np.array(r, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * a - b) ** 2 for a, b in zip(row, r)) for row in away.tolist()]

    @property
    def flat(self) -> np.ndarray:
        """Which components the rows have no spread along."""
        e = self.values[: self.components]
        return e <= FLAT * max(self.values.max(initial=0.0), 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        e = np.where(self.flat, 1.0, self.values[: self.components])
        return (self.centred(x) @ self.vectors[:, : self.components]) / np.sqrt(e)


def fit_whitening(rows: DataFrame, components: int) -> Whitening | None:
    s = joined(stored(spectra(rows), "whitening_spectra"))
    if s is None or not s.sums:
        return None
    s.refresh()
    start = Whitening(s.n, s.sums, s.values[::-1], s.vectors[:, ::-1], len(s.sums))
    basis = start.vectors
    total, outer = moments(rows, start.width, lambda x: start.centred(x) @ basis)
    e, turn = np.linalg.eigh(outer / s.n - np.outer(total, total) / s.n / s.n)
    return Whitening(s.n, s.sums, np.maximum(e[::-1], 0.0), basis @ turn[:, ::-1], min(components, start.width))


WHITE_DDL = "id long, n long, deviation decimal(38,0), whitened array<double>"


def whiten(vectors: DataFrame, components: int = 32, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, n, deviation, whitened (array, one entry a component), explained
    (array) and identity_error for each row whose vector is not null and has
    finite entries only.

    Entries c count as x = floor(64 c) + 1,000,000.  Rows with an entry of
    2**46 or more are left out like those with non-finite ones.  A null id
    stays; equal rows are rows of their own.  Short vectors count as having zeros at the
    end.  Components along which the rows have no spread (an eigenvalue under 1e-13 of the
    largest) can't be scaled: whitened is null there, explained their share (null if
    nothing has spread), and identity_error covers the others (0 if none).  An
    empty table, or one of empty vectors, gives no rows.  Sums and squared
    deviations are exact up to 38 digits.
    """
    rows = usable_rows(vectors, id_column, vector_column)
    rows = rows.repartition(parallelism(rows.sparkSession))
    rows = stored(rows, "whitening_rows")
    model = fit_whitening(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], f"{WHITE_DDL}, explained array<double>, identity_error double")
    sum_, outer = moments(rows, model.width, model.whitened)
    error = np.abs(outer / model.n - np.outer(sum_, sum_) / model.n / model.n - np.eye(len(sum_)))
    live = ~model.flat
    error = float(error[np.ix_(live, live)].max(initial=0.0))
    trace = model.values.sum()
    explained = [float(x / trace) if trace > 0 else None for x in model.values[: model.components]]

    def run(batches):
        import decimal

        for rb in batches:
            if not rb.num_rows:
                continue
            x = whole_numbers(rb, model.width)
            y = model.whitened(x)
            dead = np.broadcast_to(model.flat, y.shape).ravel()
            values = pa.array(y.ravel(), pa.float64(), mask=dead)
            white = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32()), values)
            deviation = pa.array([decimal.Decimal(d) for d in model.deviations(x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(np.full(len(x), model.n), pa.int64()), deviation, white],
                                             names=["id", "n", "deviation", "whitened"])

    out = rows.mapInArrow(run, WHITE_DDL)
    shares = F.array(*[F.lit(x).cast("double") for x in explained])
    return out.withColumn("explained", shares).withColumn("identity_error", F.lit(error))
