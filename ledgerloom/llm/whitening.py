"""Embedding whitening by incremental eigendecomposition.

Vectors become whole numbers ``x = floor(64 c) + 1000000``; the statistics are
those of the distinct ones (the fit list).  Their number and sums are exact, so
every vector is centred before anything is multiplied.

Each partition of the fit list keeps the spectrum of its own centred vectors
and updates it vector by vector: the rank-one change ``D + z z'`` of a diagonal
matrix has its eigenvalues at the roots of a secular equation, one between each
two old ones.  Entries of ``z`` that vanish, and equal eigenvalues (turned until
one entry of ``z`` is left), are deflated.  Roots are found as distances from
the nearer old eigenvalue, and ``z`` is recomputed from them, so the new
eigenvectors are orthogonal.  Spectra of partitions are combined by the same
updates, with the scaled eigenvectors of one applied to the other, in a tree.

The combined basis is then refined by one distributed Rayleigh-Ritz step: the
fit list's covariance in that basis is summed over all partitions and solved.
What reaches the driver is one spectrum, or one such matrix: a square of the
vectors' length, whatever their number.

Defined cases: vectors that are null, empty, or hold null or non-finite entries
(or entries whose x is beyond 2**62) take no part; neither do vectors of
another length than the most frequent one (of these, the least); repeated rows
count once in the fit and are returned each; a null id is returned as such.
Components are those whose eigenvalue exceeds 1e-12 of the largest, so a table
of equal vectors, or of none, gives no rows.  ``deviation`` is null where it
exceeds a long.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, cut, partitions, prepare, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows of a matrix combined in one step of the tree.
FAN = 8
#: Eigenvalues below this part of the largest are none.
RANK = 1e-12
_EPS = np.finfo(float).eps
_FITS = float(1 << 62)


# ------------------------------------------------------- rank-one updates
def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum(weights / (poles - r)) = 0`` as their distances
    from the nearer pole, and that pole's number.  Poles ascend and differ,
    weights are positive: a root lies behind each pole."""
    k = len(poles)
    right = np.append(poles[1:], poles[-1] + 1.25 * weights.sum())  # the last root lies below
    at = np.arange(k)
    middle = 0.5 * (poles + right)
    f = 1 + weights @ (1 / (poles[:, None] - middle))
    near = np.where((f >= 0) | (at == k - 1), at, at + 1)
    gaps = poles[:, None] - poles[near]  # pole j seen from root i's origin
    own, end, half = poles - poles[near], right - poles[near], middle - poles[near]
    lo, hi = np.where(f >= 0, own, half), np.where(f >= 0, half, end)
    left = (at[:, None] <= at) * weights[:, None]  # the poles left of a root
    with np.errstate(all="ignore"):
        t = 0.5 * (lo + hi)
        for k in range(12):  # as a rule five rounds do
            new, open_ = _closer(weights, left, gaps, own, end, t, k > 2)
            if open_ is not None and not open_.any():
                return t, near
            inside = (new > lo) & (new < hi)
            t = new if inside.all() else np.where(inside, new, 0.5 * (t + np.where(new >= hi, hi, lo)))
        for _ in range(80):  # else within brackets
            f = 1 + weights @ (1 / (gaps - t))
            lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
            new, open_ = _closer(weights, left, gaps, own, end, t, True)
            open_ &= hi - lo > 2 * _EPS * np.minimum(np.abs(lo), np.abs(hi))
            if not open_.any():
                break
            t = np.where(open_, np.where((new > lo) & (new < hi), new, 0.5 * (lo + hi)), t)
    return t, near


def _closer(weights, left, gaps, own, end, t, judge: bool):
    """The next guess of every root: the sums left and right of it as one
    pole and a constant each that agree in value and slope.  With ``judge``
    also which guesses were not roots yet; roots stay."""
    inverse = 1 / (gaps - t)
    f = 1 + weights @ inverse
    open_ = None
    if judge:
        open_ = ~(np.abs(f) <= 32 * _EPS * (f - 2 * np.einsum("ij,ij->j", left, inverse)))
        if not open_.any():
            return t, open_
    inverse *= inverse
    sl = np.einsum("ij,ij->j", left, inverse)
    sr = weights @ inverse - sl
    dl, dr = own - t, end - t
    a, b = sl * dl, sr * dr
    c = f - a - b
    # c + a dl / (dl - s) + b dr / (dr - s) = 0 for the step s.
    a *= dl
    b *= dr
    p, q = c * (dl + dr) + a + b, c * dl * dr + a * dr + b * dl
    root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
    step = np.where(p >= 0, 2 * q / (p + root), (p - root) / (2 * c))
    return (t + step if open_ is None else np.where(open_, t + step, t)), open_


class Spectrum:
    """``vectors @ diag(values) @ vectors.T``, kept under rank-one updates;
    the values ascend."""

    def __init__(self, size: int):
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        """Add ``x x'``."""
        z = x @ self.vectors
        norm = float(z @ z)
        if norm == 0:
            return
        tiny = 8 * _EPS * max(float(self.values[-1]), norm)
        self._turn(z, tiny)
        live = np.flatnonzero(np.abs(z) * np.sqrt(norm) > tiny)
        if not len(live):
            return
        poles, zs = self.values[live], z[live]
        t, near = secular_roots(poles, zs * zs)
        gaps = poles[:, None] - poles[near] - t  # pole j less root i
        # The z whose roots these are exactly: row by row, roots less pole over
        # the other poles less pole.
        k = len(live)
        others = (poles - poles[:, None]).ravel()[:-1].reshape(k - 1, k + 1)[:, 1:].reshape(k, k - 1)
        z_hat = np.copysign(np.sqrt(np.abs((gaps[:, :-1] / others).prod(1) * gaps[:, -1])), zs)
        turn = z_hat[:, None] / gaps
        turn /= np.sqrt((turn * turn).sum(0))
        if k == len(self.values):
            self.values, self.vectors = poles[near] + t, self.vectors @ turn
            return
        self.vectors[:, live] = self.vectors[:, live] @ turn
        self.values[live] = poles[near] + t
        if (np.diff(self.values) < 0).any():
            order = np.argsort(self.values, kind="stable")
            self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _turn(self, z: np.ndarray, tiny: float) -> None:
        """Within equal values, turn the vectors until one entry of z is left."""
        close = np.diff(self.values) <= tiny
        if not close.any():
            return
        edge = np.flatnonzero(np.diff(np.concatenate([[0], close.view(np.int8), [0]])))
        for a, b in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist()):
            v = z[a:b].copy()
            length = np.sqrt(v @ v)
            if length <= _EPS * np.sqrt(max(tiny, 0)) or not length:
                continue
            v[-1] += np.copysign(length, v[-1])
            v /= np.sqrt(v @ v)
            part = self.vectors[:, a:b]
            self.vectors[:, a:b] = part - 2 * np.outer(part @ v, v)
            last = -np.copysign(length, z[b - 1])
            z[a:b] = 0
            z[b - 1] = last

    def merge(self, values: np.ndarray, vectors: np.ndarray) -> None:
        """Add another spectrum, one eigenvector after the other."""
        for value, x in zip(values.tolist(), vectors.T):
            if value > 0:
                self.add(np.sqrt(value) * x)


# ---------------------------------------------------------------- vectors
def coded(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, d, x`` of the vectors that take part: their length, and
    ``x - SHIFT`` in as few bytes as hold it (their number comes first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("vec")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            begins = lists.offsets.to_numpy()[:-1]
            numbers = pc.fill_null(lists.values.cast(pa.float64()), float("nan")).to_numpy()
            for d in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == d)
                c = np.floor(SCALE * numbers[begins[at][:, None] + np.arange(d)])
                with np.errstate(invalid="ignore"):
                    good = (np.abs(c) < _FITS).all(1)
                at, c = at[good], c[good].astype(np.int64)
                most = np.abs(c).max(1, initial=0)
                for size, least, limit in ((2, -1, 1 << 15), (4, 1 << 15, 1 << 31), (8, 1 << 31, 1 << 62)):
                    on = np.flatnonzero((most >= least) & (most < limit))
                    for k in range(0, len(on), 4096):
                        own = on[k:k + 4096]
                        raw = np.concatenate([np.full((len(own), 1), size, np.uint8), c[own].astype(f"<i{size}").view(np.uint8).reshape(len(own), -1)], axis=1)
                        x = pa.array([r.tobytes() for r in raw], pa.binary())
                        yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at[own])), pa.array(np.full(len(own), d, np.int32)), x], ["vec_id", "d", "x"])

    rows = columns_of(df, {"vec_id": id_col, "vec": vec_col}).withColumn("vec_id", F.col("vec_id").cast("long"))
    return rows.withColumn("vec", F.col("vec").cast("array<double>")).mapInArrow(run, "vec_id long, d int, x binary")


def whole_numbers(x: pa.Array, d: int) -> np.ndarray:
    """Rows of ``coded`` as a matrix of longs (x - SHIFT)."""
    out = np.empty((len(x), d), np.int64)
    rows = x.to_pylist()
    for size in (2, 4, 8):
        on = [k for k, r in enumerate(rows) if r[0] == size]
        if on:
            out[on] = np.frombuffer(b"".join([rows[k][1:] for k in on]), f"<i{size}").reshape(len(on), d)
    return out


class Centre:
    """The number and exact sums of the fit list."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n x - S)**2``, exact; None beyond a long."""
        most = max(map(abs, self.sums)) + self.n * float(np.abs(x).max(initial=0))
        if most * most * len(self.sums) < 9e18:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(1).tolist()
        made = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [m if m < 1 << 63 else None for m in made]


def exact_sums(fit: DataFrame, d: int) -> Centre | None:
    """Counted and summed in each task, then by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = whole_numbers(b.column("x"), d)
            n += len(x)
            high += (x >> 31).sum(0)
            low += (x & ((1 << 31) - 1)).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array([n] * d, pa.int64()), pa.array(high), pa.array(low)], ["k", "n", "high", "low"])

    each = fit.mapInArrow(run, "k int, n long, high long, low long")
    wide = "decimal(38,0)"
    rows = sorted(each.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect())
    return Centre(rows[0]["n"], [(int(r["high"]) << 31) + int(r["low"]) for r in rows]) if rows else None


# ------------------------------------------------------------------ tree
def combined(parts: DataFrame, merge) -> bytes | None:
    """``part, m`` (a matrix a task) to one matrix: ``FAN`` neighbours are
    merged at a time, in the order of their parts, until one is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([held], pa.binary())], ["part", "m"])

        for b in batches:
            for p, m in zip(b.column("part").to_pylist(), b.column("m")):
                if p // FAN != part:
                    if held is not None:
                        yield out()
                    part, held = p // FAN, m.as_py()
                else:
                    held = merge(held, m.as_py())
        if held is not None:
            yield out()

    parts = cut(parts)
    while (last := parts.agg(F.max("part")).first()[0]) is not None and last > 0:
        n = min(partitions(parts.sparkSession), last // FAN + 1)
        near = parts.repartition(n, F.expr(f"part div {FAN}")).sortWithinPartitions("part")
        parts = cut(near.mapInArrow(run, "part long, m binary"))
    row = parts.first()
    return bytes(row["m"]) if row else None


def _matrix(raw: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(-1, columns)


def spectrum(fit: DataFrame, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the sum of squares of the centred fit
    list, by rank-one updates in each partition and between them."""
    d = len(centre.sums)

    def packed(s: Spectrum) -> bytes:
        return np.vstack([s.values, s.vectors]).astype("<f8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Spectrum(d), False
        for b in batches:
            for y in centre.centred(whole_numbers(b.column("x"), d)):
                own.add(y)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([packed(own)], pa.binary())], ["part", "m"])

    def merge(left: bytes, right: bytes) -> bytes:
        out, x, y = Spectrum(d), _matrix(left, d), _matrix(right, d)
        out.values, out.vectors = x[0].copy(), x[1:].copy()
        out.merge(y[0], y[1:])
        return packed(out)

    m = _matrix(combined(fit.mapInArrow(run, "part long, m binary"), merge), d)
    return m[0], m[1:]


def cross(fit: DataFrame, centre: Centre, basis: np.ndarray) -> np.ndarray:
    """The covariance of the fit list, projected on the columns of a basis."""
    d, k = basis.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((k, k)), False
        for b in batches:
            p = centre.centred(whole_numbers(b.column("x"), d)) @ basis
            total += p.T @ p
            seen = seen or len(p) > 0
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.astype("<f8").tobytes()], pa.binary())], ["part", "m"])

    raw = combined(fit.mapInArrow(run, "part long, m binary"), lambda a, b: (_matrix(a, k) + _matrix(b, k)).tobytes())
    return _matrix(raw, k) / centre.n


class Whitening:
    """The fitted transformation: ``basis`` (a column a component), the
    eigenvalues, each one's part of the trace, and the identity error."""

    def __init__(self, fit: DataFrame, centre: Centre, components: int = COMPONENTS):
        self.centre = centre
        _, basis = spectrum(fit, centre)
        basis = np.linalg.qr(basis[:, ::-1])[0]
        v = cross(fit, centre, basis)  # Rayleigh-Ritz
        values, turn = np.linalg.eigh((v + v.T) / 2)
        values, basis = values[::-1], basis @ turn[:, ::-1]
        k = int((values[:components] > RANK * max(values[0], 0)).sum())
        self.values, self.basis = values[:k], np.ascontiguousarray(basis[:, :k])
        self.explained = self.values / np.trace(v) if k else self.values
        self.error = 0.0
        if k:
            self.error = float(np.abs(cross(fit, centre, self.basis / np.sqrt(self.values)) - np.eye(k)).max())


def fitted(df: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The rows of ``coded`` that take part, and their whitening."""
    most = df.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return df, None
    d = most["d"]
    rows = df.where(F.col("d") == d)
    fit = cut(rows.select("x").distinct())
    return rows, Whitening(fit, exact_sums(fit, d), components)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row a vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    prepare(df.sparkSession)
    rows, fit = fitted(coded(df, id_col, vec_col), components)
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None or not len(fit.values):
        return df.sparkSession.createDataFrame([], kind)
    centre, scaled, explained, error = fit.centre, fit.basis / np.sqrt(fit.values), fit.explained, fit.error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, k = scaled.shape
        for b in batches:
            x = whole_numbers(b.column("x"), d)
            w, m = centre.centred(x) @ scaled, len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            columns = [b.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, centre.n, np.int64)),
                       pa.array(centre.deviations(x), pa.int64()).take(each), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, kind)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(prepare(spark), sf_dir, "embeddings"))
