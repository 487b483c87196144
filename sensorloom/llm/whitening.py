"""Embedding whitening from a covariance spectrum that grows by rank-one updates, refined by Rayleigh-Ritz."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, staged

EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z' for rising d without equals and z without zeros: (roots, gaps[i, j] = d[i] - root j).

    Root j lies between d[j] and d[j + 1], the last one below d[-1] + |z|^2. All roots are iterated at once, each as its distance
    from the nearer pole so that gaps keep their relative accuracy. A step fits both sides' sums of poles by
    one pole each and solves the quadratic; a step that leaves the bracket is a bisection.
    """
    k, squares = len(d), z * z
    upper = np.append(d[1:], d[-1] + squares.sum())
    middle = (upper - d) / 2
    at_middle = 1 + (squares[:, None] / (d[:, None] - (d + middle))).sum(0)
    right = (at_middle < 0) & (np.arange(k) < k - 1)
    origin = np.where(right, upper, d)
    low, high = np.where(right, -middle, 0.0), np.where(right, 0.0, upper - d)
    high = np.where(~right & (at_middle >= 0), middle, high)
    low = np.where(~right & (at_middle < 0), middle, low)
    delta = d[:, None] - origin  # poles seen from each root's origin
    left = np.tri(k, dtype=bool).T  # poles at or below root j
    own = delta[np.arange(k), np.arange(k)]
    following = np.append(own[:-1] + (upper - d)[:-1], np.inf)
    mu = (low + high) / 2
    for _ in range(80):
        gap = delta - mu
        term = squares[:, None] / gap
        slope = term / gap
        psi, phi = np.where(left, term, 0).sum(0), np.where(left, 0, term).sum(0)
        dpsi, dphi = np.where(left, slope, 0).sum(0), np.where(left, 0, slope).sum(0)
        f = 1 + psi + phi
        low, high = np.where(f < 0, mu, low), np.where(f < 0, high, mu)
        done = (np.abs(f) <= EPS * k * (1 + np.abs(psi) + np.abs(phi))) | (high - low <= EPS * np.abs(mu))
        if done.all():
            break
        # psi ~ a + s / (own - x), phi ~ b + t / (following - x) with equal values and slopes at mu.
        g, h = own - mu, np.where(np.isinf(following), 1.0, following - mu)
        s, t = dpsi * g * g, np.where(np.isinf(following), 0.0, dphi * h * h)
        c = 1 + psi - dpsi * g + np.where(np.isinf(following), phi, phi - dphi * h)
        with np.errstate(all="ignore"):
            # c + s / (g - e) + t / (h - e) = 0 for the step e
            p, q = c * (g + h) + s + t, c * g * h + s * h + t * g
            root = np.sqrt(np.maximum(p * p - 4 * c * q, 0))
            step = np.where(p > 0, 2 * q / (p + root), (p - root) / (2 * c))
            step = np.where(np.isinf(following), g + s / c, step)
            new = mu + step
        new = np.where(np.isfinite(new) & (new > low) & (new < high), new, (low + high) / 2)
        mu = np.where(done, mu, new)
    return origin + mu, delta - mu


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (rising values, vectors in columns) of A + weight * x x' from that of A, weight >= 0.

    Deflation: coordinates that x hardly touches keep their pair; of equal values a reflection leaves one coordinate that x
    touches. The rest is a secular equation, and coordinates of x are computed anew from its roots so that vectors stay orthogonal.
    """
    z = math.sqrt(weight) * (vectors.T @ x)
    scale = max(abs(values[0]), abs(values[-1]), float(z @ z))
    if scale == 0:
        return values, vectors
    tiny = 8 * EPS * scale
    # Runs of equal values: a reflection turns each run's part of z into its last coordinate.
    if (np.diff(values) <= tiny).any():
        vectors = vectors.copy()
        starts = np.flatnonzero(np.append(True, np.diff(values) > tiny))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True):
            length = math.sqrt(z[a:b] @ z[a:b])
            if b - a > 1 and length > 0:
                mirror = z[a:b].copy()
                mirror[-1] += math.copysign(length, mirror[-1])
                mirror /= math.sqrt(mirror @ mirror)
                vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ mirror, mirror)
                last = -math.copysign(length, z[b - 1])
                z[a:b] = 0
                z[b - 1] = last
    live = np.flatnonzero(np.abs(z) * math.sqrt(scale) > tiny)
    if not len(live):
        return values, vectors
    d = values[live]
    roots, gaps = secular_roots(d, z[live])
    # Coordinates for which these roots are exact.
    k = len(d)
    ratio = np.empty((k, k))
    ratio[:, -1] = -gaps[:, -1]
    spread = d[None, :] - d[:, None]
    for_before = np.tri(k, k - 1, -1, dtype=bool)  # j < i: (root j - d i) / (d j - d i), after it (root j - d i) / (d j+1 - d i)
    ratio[:, :-1] = -gaps[:, :-1] / np.where(for_before, spread[:, :-1], spread[:, 1:])
    exact = np.sqrt(np.abs(ratio.prod(1))) * np.sign(z[live])
    turn = exact[:, None] / gaps
    turn /= np.sqrt((turn * turn).sum(0))
    out = vectors.copy()
    out[:, live] = vectors[:, live] @ turn
    values = values.copy()
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], out[:, order]


class Spectrum:
    """Count, mean and scatter of rows; the scatter as eigenvalues and vectors."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        """One more row: a centred rank-one update."""
        off = x - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def join(self, other: Spectrum) -> None:
        """The rows of another spectrum: an update for each of its vectors, and one for the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values.tolist(), other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, value)
        total, off = self.n + other.n, other.mean - self.mean
        self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / total)
        self.mean = self.mean + off * (other.n / total)
        self.n = total

    def row(self) -> list:
        return [self.n, *(v.astype("<f8").tobytes() for v in (self.mean, self.values, self.vectors))]

    @staticmethod
    def of(row: list, size: int) -> Spectrum:
        out = Spectrum(size)
        out.n = int(row[0])
        out.mean, out.values, vectors = (np.frombuffer(v, "<f8") for v in row[1:])
        out.vectors = vectors.reshape(size, size)
        return out


FIELDS = ["part", "n", "mean", "eigenvalues", "eigenvectors"]
SPECTRUM = "part int, n long, mean binary, eigenvalues binary, eigenvectors binary"


def whole_numbers(vectors: DataFrame, vec_id: str | Column = "vec_id", embedding: str | Column = "embedding", scale: int = 64,
                  shift: int = 1_000_000) -> DataFrame:
    """(id, x ARRAY<BIGINT>) of the rows that take part, x = floor(scale * entry) + shift.

    Left out: null ids stay, but rows go whose vector is null, empty, or holds null or non-finite entries. An entry whose number does not fit a
    long is an error.
    """
    v = (F.col(embedding) if isinstance(embedding, str) else embedding).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    key = F.col(vec_id) if isinstance(vec_id, str) else vec_id
    return vectors.where(v.isNotNull()).where(fine & (F.size(v) > 0)).select(
        key.alias("id"), F.transform(v, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")).alias("x"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, size)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors, and exact sums of each entry as whole numbers of any length."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, -1)
                n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)  # neither overflows
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(high), dtype=np.int32)), pa.array([n] * len(high), pa.int64()), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    rows = fit.select("x").mapInArrow(add, "i int, n long, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(28,0)")).alias("high"), F.sum(F.col("low").cast("decimal(28,0)")).alias("low")).orderBy("i").collect()
    return (rows[0].n if rows else 0), [(int(r.high) << 32) + int(r.low) for r in rows]


def centred(x: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray | list]:
    """(x - S / n with one rounding, n x - S exact) of whole-number rows."""
    if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, total)) < 2**62:
        exact = x * n - np.array(total, np.int64)
        if np.abs(exact).max(initial=0) < 2**53:
            return exact / n, exact
    else:
        exact = x.astype(object) * n - np.array(total, object)
    return np.array([[int(v) / n for v in row] for row in exact], np.float64).reshape(x.shape), exact


def squared_length(exact: np.ndarray) -> np.ndarray:
    """Sums of squares of exact whole numbers, which must fit a long."""
    if exact.dtype == object or float(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] >= 2.0**62:
        return np.array([sum(int(v) * int(v) for v in row) for row in exact], np.int64)
    return (exact * exact).sum(1)


def summed(parts: DataFrame, fan: int = 32) -> DataFrame:
    """Square matrices (part, m BINARY) added up by groups of `fan`."""
    def add(key, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"part": key[0], "m": sum(np.frombuffer(m, "<f8") for m in group["m"]).tobytes()}])

    return parts.withColumn("part", F.pmod("part", F.lit(fan))).groupBy("part").applyInPandas(add, "part int, m binary")


def gram(fit: DataFrame, n: int, total: list[int], basis: np.ndarray) -> np.ndarray:
    """Covariance of the fit list's centred rows in a basis; one matrix per task, added up before it reaches the driver."""
    size, k = basis.shape

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, seen = np.zeros((k, k)), False
        for batch in batches:
            if batch.num_rows:
                y = centred(matrix(batch.column(0), size), n, total)[0] @ basis
                out, seen = out + y.T @ y, True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["part", "m"])

    parts = summed(fit.select("x").mapInArrow(project, "part int, m binary")).orderBy("part").collect()
    return sum((np.frombuffer(r.m, "<f8") for r in parts), np.zeros(k * k)).reshape(k, k) / n


def spectrum_of(fit: DataFrame, size: int, fan: int = 8) -> Spectrum:
    """Spectrum of all rows of the fit list: every partition folds its own rows, then groups of `fan` spectra are joined till one is left."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = Spectrum(size)
        for batch in batches:
            for x in matrix(batch.column(0), size).astype(np.float64):
                out.add(x)
        if out.n:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in [np.int32(TaskContext.get().partitionId()), *out.row()]], FIELDS)

    def join(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        first, *others = group[FIELDS[1:]].to_numpy().tolist()
        out = Spectrum.of(first, size)
        for other in others:
            out.join(Spectrum.of(other, size))
        return pd.DataFrame([dict(zip(FIELDS, [key[0], *out.row()], strict=True))])

    level = staged(fit.select("x").mapInArrow(fold, SPECTRUM))
    while level.count() > 1:
        before, level = level, staged(level.groupBy(F.expr(f"cast(part div {fan} as int)").alias("g")).applyInPandas(join, SPECTRUM))
        discard(before)
    row = level.first()
    discard(level)
    return Spectrum.of(list(row[1:]), size)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 16, scale: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """Whitened embeddings: (id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    The fit list is every distinct vector of `whole_numbers` once. Its spectrum comes from rank-one updates in the partitions and is
    joined by more of them; the vectors, made orthogonal, are the basis of a Rayleigh-Ritz step over all rows of the
    list with exact centring, which gives the components to double precision. Sums are exact. `identity_error` is measured on the
    whole list with the finished components. Only matrices of vector length reach the driver.

    Vectors whose length is not the most frequent one in the table (of ties the larger) take no part. There are as many components
    as entries at most; one without variance has a null `whitened` and does not count in `identity_error`, which is null if none
    has. Rows that repeat are all returned. Ids may be null or of any type; other columns are not looked at. An empty table gives
    an empty result. A deviation that does not fit a long is an error.
    """
    rows = staged(whole_numbers(vectors, vec_id, embedding, scale, shift))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    size = sizes[0]["size"]
    rows = rows.where(F.size("x") == size)
    fit = staged(rows.select("x").distinct())
    n, total = sums(fit)
    basis, _ = np.linalg.qr(spectrum_of(fit, size).vectors[:, ::-1])
    ritz, turn = np.linalg.eigh(gram(fit, n, total, basis))
    variance, vectors_ = ritz[::-1], basis @ turn[:, ::-1]
    k = min(components, size)
    floor = 64 * EPS * size * max(variance[0], 0)
    kept = variance[:k] > floor
    factor = np.where(kept, 1 / np.sqrt(np.where(kept, variance[:k], 1)), 0)
    transform = vectors_[:, :k] * factor
    error = float(np.abs(gram(fit, n, total, transform[:, kept]) - np.eye(kept.sum())).max()) if kept.any() else None
    spread = float(ritz.sum())
    explained = [float(v) / spread if spread > 0 else None for v in np.maximum(variance[:k], 0)]
    discard(fit)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                x = np.asarray(part.column("x").flatten()).reshape(-1, size)
                y, exact = centred(x, n, total)
                out, m = y @ transform, len(x)
                ids = part.column("id").take(pa.array(np.repeat(np.arange(m), k)))
                tile = lambda values, t: pa.array(values * m, t)
                yield pa.RecordBatch.from_arrays([
                    ids, tile(list(range(1, k + 1)), pa.int32()), pa.array(np.full(m * k, n)), pa.array(np.repeat(squared_length(exact), k)),
                    pa.array(out.reshape(-1), mask=np.tile(~kept, m)), tile(explained, pa.float64()), pa.array([error] * (m * k), pa.float64())], names)

    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.select("id", "x").mapInArrow(apply, schema)
