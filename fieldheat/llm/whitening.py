"""Embedding whitening: blockwise QR, a bidiagonal matrix, its singular values by dqds, directions by twisted factorisations."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, prepare_workers, stage
from fieldheat.llm.vectors import common_length, finite_rows, scaled

EPS = float(np.finfo(float).eps)
LIMIT = 1 << 53  # of an integer entry before the shift: a double holds it exactly
MERGED = 64  # triangles that one task merges
CLOSE = 1e-3  # relative distance of eigenvalues below which their vectors are kept apart explicitly


class Fit(NamedTuple):
    """What all rows share: their number, sums per dimension, directions (columns) and eigenvalues, trace of the covariance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float


# --- a small dense matrix: its right singular vectors -----------------------------------------------------------------


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and the factor b for which (I - b v v') x has zeros below its first component."""
    scale = np.abs(x).max()
    v = x / scale if scale else x.copy()
    norm = np.sqrt(v @ v)
    if not norm:
        return v, 0.0
    v[0] += norm if v[0] >= 0 else -norm
    return v, 2.0 / (v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections from both sides: diagonal, superdiagonal, and W with r = U B W'."""
    a, size = r.copy(), r.shape[1]
    w = np.eye(size)
    for k in range(size):
        v, b = reflector(a[k:, k])
        a[k:, k:] -= b * np.outer(v, v @ a[k:, k:])
        if k + 2 < size:
            v, b = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= b * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= b * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def dqds_sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transformation with a shift; None if the shift is beyond the least eigenvalue."""
    d, new_q, new_e = q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        if top <= 0:
            return None
        t = q[k + 1] / top
        new_q.append(top)
        new_e.append(e[k] * t)
        d = d * t - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def least_of_last_two(q: list[float], e: list[float]) -> float:
    """The lesser eigenvalue of the last two rows of the qd array: an estimate of the least one of all."""
    a, b, c = q[-2], q[-1], e[-1]
    total = a + b + c
    return 2 * (a * b / total) / (1 + np.sqrt(max(0.0, 1 - 4 * (a / total) * (b / total))))


def dqds(diagonal: np.ndarray, above: np.ndarray) -> list[float]:
    """Squared singular values of a bidiagonal matrix, each to high relative accuracy, in falling order.

    Shifts that go too far are taken back and made smaller; a sweep without shift always succeeds.
    """
    found: list[float] = []
    waiting = [([x * x for x in diagonal.tolist()], [x * x for x in above.tolist()], 0.0)]
    while waiting:
        q, e, lifted = waiting.pop()
        while q:
            if len(q) == 1:
                found.append(q.pop() + lifted)
                break
            if e[-1] <= EPS * EPS * (lifted + q[-1]) or e[-1] <= 1e-300:
                found.append(q.pop() + lifted)
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1) if e[k] <= EPS * EPS * (lifted + min(q[k], q[k + 1]))), None)
            if cut is not None:
                waiting.append((q[: cut + 1], e[:cut], lifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < 0.5 * q[-1]:  # so that small values are found first, at the end
                q, e = q[::-1], e[::-1]
            shift = least_of_last_two(q, e) * (1 - 4 * EPS)
            for shift in (shift, 0.9 * shift, 0.5 * shift, 0.1 * shift, 0.0):
                swept = dqds_sweep(q, e, shift)
                if swept is not None:
                    break
            if swept is None:  # a pivot of zero: the matrix is singular to working precision
                q = [max(x, 1e-290) for x in q]
                continue
            q, e = swept
            lifted += shift
    return sorted(found, reverse=True)


class Representation:
    """B'B of a bidiagonal block as L D L', and vectors of B'B - x I from factorisations twisted where they nearly vanish."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray):
        self.d = (diagonal * diagonal).tolist()
        self.l = (above / diagonal[:-1]).tolist()
        self.tiny = EPS * EPS * max(self.d)

    def _pivot(self, x: float) -> float:
        return x if abs(x) > self.tiny else -self.tiny

    def downward(self, at: float) -> tuple[list[float], list[float], list[float]]:
        """Pivots and multipliers of the factorisation from the top, and the auxiliary sums."""
        s, sums, pivots, lower = -at, [], [], []
        for k, d in enumerate(self.d):
            sums.append(s)
            pivots.append(self._pivot(s + d))
            if k < len(self.l):
                lower.append(d * self.l[k] / pivots[k])
                s = lower[k] * self.l[k] * s - at
        return pivots, lower, sums

    def upward(self, at: float) -> tuple[list[float], list[float]]:
        """Multipliers of the factorisation from the bottom, and the auxiliary sums."""
        p = self.d[-1] - at
        sums, upper = [p], []
        for k in range(len(self.l) - 1, -1, -1):
            t = self.d[k] / self._pivot(self.d[k] * self.l[k] ** 2 + p)
            upper.append(self.l[k] * t)
            p = p * t - at
            sums.append(p)
        return upper[::-1], sums[::-1]

    def vector(self, at: float) -> np.ndarray:
        """The eigenvector for an eigenvalue, of length one; refined once by its own residual."""
        for _ in range(2):
            _, lower, down = self.downward(at)
            upper, up = self.upward(at)
            gammas = [s + p + at for s, p in zip(down, up)]
            twist = min(range(len(gammas)), key=lambda k: abs(gammas[k]))
            z = np.zeros(len(self.d))
            z[twist] = 1.0
            for k in range(twist - 1, -1, -1):
                z[k] = -lower[k] * z[k + 1]
            for k in range(twist, len(self.l)):
                z[k + 1] = -upper[k] * z[k]
            length = z @ z
            step = gammas[twist] / length
            if abs(step) > 1e-8 * abs(at):
                break
            at += step
        return z / np.sqrt(length)

    def solved(self, at: float, right: np.ndarray) -> np.ndarray:
        """A step of inverse iteration."""
        pivots, lower, _ = self.downward(at)
        y = right.copy()
        for k in range(1, len(y)):
            y[k] -= lower[k - 1] * y[k - 1]
        y /= np.array(pivots)
        for k in range(len(y) - 2, -1, -1):
            y[k] -= lower[k] * y[k + 1]
        return y / np.sqrt(y @ y)

    def apart(self, at: float, others: list[np.ndarray]) -> np.ndarray:
        """An eigenvector orthogonal to those of close eigenvalues."""
        basis = np.array(others)

        def projected_out(z: np.ndarray) -> np.ndarray:
            for _ in range(2):
                z = z - basis.T @ (basis @ z)
            return z

        z = projected_out(self.vector(at))
        for attempt in range(8):
            length = np.sqrt(z @ z)
            if length < 1e-3:  # the same vector again: start from another one
                z = projected_out(np.random.default_rng([len(z), len(others), attempt]).standard_normal(len(z)))
                length = np.sqrt(z @ z)
            z = projected_out(self.solved(at, z / length))
            if attempt and z @ z > 0.9:
                break
        return z / np.sqrt(z @ z)


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix in falling order, and its right singular vectors as columns.

    Values at the level of rounding (against the largest) come out as zero. A vector's largest component is positive.
    """
    size = r.shape[1]
    varied = np.flatnonzero(np.abs(r).max(axis=0, initial=0.0) > 0)
    pairs = [(0.0, vector) for k, vector in enumerate(np.eye(size)) if k not in set(varied.tolist())]
    if len(varied):
        small = np.linalg.qr(r[:, varied], mode="r")
        diagonal, above, w = bidiagonal(small)
        scale = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
        floor = EPS * scale
        diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal) / scale
        above = np.where(np.abs(above) < floor, 0.0, above) / scale
        ends = [0, *(np.flatnonzero(above == 0) + 1).tolist(), len(diagonal)]
        for begin, end in zip(ends, ends[1:]):
            block = Representation(diagonal[begin:end], above[begin : end - 1])
            close: list[np.ndarray] = []
            last = np.inf
            for value in dqds(diagonal[begin:end], above[begin : end - 1]):
                close = close if last - value < CLOSE * last else []
                z = block.apart(value, close) if close else block.vector(value)
                close.append(z)
                last = value
                vector = np.zeros(size)
                vector[varied] = w[:, begin:end] @ z
                pairs.append((value * scale * scale, vector))
    pairs.sort(key=lambda p: -p[0])
    values = np.array([p[0] for p in pairs])
    values[values <= (size * EPS) ** 2 * values.max(initial=0.0)] = 0.0
    vectors = np.array([p[1] for p in pairs]).T.reshape(size, size)
    signs = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None, :], axis=0)) if size else 1.0
    return values, vectors * signs


# --- passes over all rows ---------------------------------------------------------------------------------------------


def integers(column: pa.Array, size: int, factor: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    rows, found = finite_rows(column, size)
    return rows, scaled(found, factor, LIMIT) + shift


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n with one rounding: the whole part of the mean is taken off in integers."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole) - np.array([(s % n) / n for s in sums])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of (n x - S)^2, exact; None where that does not fit a long."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    off = x - whole
    most = n * (int(np.abs(off).max(initial=0)) + 1)
    if most * most * max(1, len(sums)) < 1 << 63:
        return ((n * off - rest) ** 2).sum(axis=1).tolist()
    exact = ((off.astype(object) * n - rest.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def totals(vectors: DataFrame, size: int, factor: int, shift: int) -> tuple[int, list[int]]:
    """Number of usable rows and exact sums per dimension. A task adds up its own; sums travel as two halves."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, sums = 0, [0] * size
        for batch in stream:
            _, x = integers(batch.column("vector"), size, factor, shift)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            sums = [s + (h << 32) + l for s, h, l in zip(sums, high.tolist(), low.tolist())]
            n += len(x)
        if n:
            yield {
                "place": np.arange(size, dtype=np.int32),
                "n": np.full(size, n),
                "high": np.array([s >> 32 for s in sums]),
                "low": np.array([s & 0xFFFFFFFF for s in sums]),
            }

    parts = arrow_map(vectors, rows, "place int, n long, high long, low long")
    found = parts.groupBy("place").agg(F.sum("n"), F.sum("high"), F.sum("low")).collect()
    by_place = {place: (n, (high << 32) + low) for place, n, high, low in found}
    return (by_place[0][0], [by_place[k][1] for k in range(size)]) if found else (0, [0] * size)


def triangle(block: np.ndarray, above: np.ndarray | None) -> np.ndarray:
    """R of the rows of a block below those of an earlier R."""
    whole = block if above is None else np.vstack([above, block])
    return np.linalg.qr(whole, mode="r")


def reduced(vectors: DataFrame, size: int, factor: int, shift: int, n: int, sums: list[int]) -> np.ndarray:
    """R of all centred rows: each task's own, batch by batch, then merged by sixty-four until one is left."""
    prepare_workers(vectors.sparkSession)

    def own(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        r = None
        for batch in stream:
            _, x = integers(batch.column("vector"), size, factor, shift)
            if len(x):
                r = triangle(centred(x, n, sums), r)
        if r is not None:
            task = TaskContext.get()
            yield {"task": [task.partitionId() if task else 0], "r": [r.reshape(-1).tolist()]}

    def merged(group: pa.Table) -> pa.Table:
        r = None
        for row in group.sort_by("task").column("r").to_pylist():
            r = triangle(np.array(row).reshape(-1, size), r)
        first = min(group.column("task").to_pylist())
        return pa.table({"task": pa.array([first // MERGED]), "r": pa.array([r.reshape(-1).tolist()])})

    # Stored at each level, since it is counted and then read; a level has a row per task of the one before.
    found = stage(arrow_map(vectors, own, "task long, r array<double>"), "triangles")
    while found.count() > 1:
        groups = found.groupBy(F.floor(F.col("task") / MERGED).alias("group"))
        found = stage(groups.applyInArrow(merged, "task long, r array<double>"), "triangles")
    r = np.array(found.first()["r"]).reshape(-1, size)
    return np.vstack([r, np.zeros((size - len(r), size))]) if len(r) < size else r


def projected(x: np.ndarray, fit: Fit) -> np.ndarray:
    """Whitened components; NaN along directions without variance."""
    scale = np.where(fit.eigenvalues > 0, np.sqrt(np.where(fit.eigenvalues > 0, fit.eigenvalues, 1.0)), np.nan)
    return (centred(x, fit.n, fit.sums) @ fit.directions) / scale


def identity_error(vectors: DataFrame, size: int, factor: int, shift: int, fit: Fit) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over directions with variance."""
    k = int((fit.eigenvalues > 0).sum())
    if not k:
        return None

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((k, k + 1))
        for batch in stream:
            _, x = integers(batch.column("vector"), size, factor, shift)
            w = projected(x, fit)[:, :k]
            total[:, :k] += w.T @ w
            total[:, k] += w.sum(axis=0)
        yield {"place": np.arange(k * (k + 1), dtype=np.int32), "total": total.reshape(-1)}

    summed = arrow_map(vectors, rows, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    found = np.zeros(k * (k + 1))
    for place, total in summed.collect():
        found[place] = total
    found = found.reshape(k, k + 1) / fit.n
    return float(np.abs(found[:, :k] - np.outer(found[:, k], found[:, k]) - np.eye(k)).max())


def fit_whitening(vectors: DataFrame, size: int, components: int, factor: int, shift: int) -> Fit | None:
    """Directions of greatest variance over all usable rows of `vector`; None without any."""
    n, sums = totals(vectors, size, factor, shift)
    if not n:
        return None
    r = reduced(vectors, size, factor, shift, n, sums)
    values, directions = right_singular(r)
    return Fit(n, sums, directions[:, :components], values[:components] / n, float((r * r).sum()) / n)


def whiten(
    vectors: DataFrame,
    components: int = 32,
    factor: int = 64,
    shift: int = 1_000_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Whitened components of every vector, a row each: `id`, `component` (from 1, by falling variance), `n`,
    `deviation`, `whitened`, `explained`, `identity_error`.

    An entry c counts as the integer x = floor(factor * c) + shift, with floor(factor * c) limited to plus and minus 2^53. The fit
    takes all usable rows: sums are exact, rows are centred before anything is multiplied, and no covariance matrix is
    formed. Blocks of rows are reduced to triangles by QR, these are merged in a tree, and the driver gets one
    triangle, as large as a vector is long: it is made bidiagonal, dqds gives its singular values, and twisted
    factorisations give the directions. Close eigenvalues get vectors that are kept orthogonal.

    `deviation` is the sum of (n x - S)^2, null where that does not fit a long. A direction without variance
    (to rounding, against the largest) has `whitened` null and `explained` zero, and is left out of `identity_error`,
    which is null if there is no other; `explained` is null if nothing varies at all.

    Rows whose vector is null, empty, holds null or non-finite entries, or is not as long as most, give no rows.
    Null ids stay null; repeated rows count each; an empty table gives no rows; other columns are not read. The table
    is read five times: give a stored one.
    """
    picked = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = picked.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    only = picked.select("vector")
    size = common_length(only, "vector")
    fit = fit_whitening(only, size, components, factor, shift) if size else None
    if fit is None:
        return arrow_map(picked.limit(0), lambda stream: iter(()), schema)
    error = identity_error(only, size, factor, shift, fit)
    shares = (fit.eigenvalues / fit.trace).tolist() if fit.trace else [None] * len(fit.eigenvalues)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        k = len(fit.eigenvalues)
        for batch in stream:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                kept, x = integers(part.column("vector"), size, factor, shift)
                if not len(kept):
                    continue
                whitened = projected(x, fit).reshape(-1)
                repeated = np.repeat(np.arange(len(kept)), k)
                yield {
                    "id": part.column("id").take(pa.array(kept[repeated])),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept)),
                    "n": np.full(len(whitened), fit.n),
                    "deviation": pa.array(deviations(x, fit.n, fit.sums), pa.int64()).take(pa.array(repeated)),
                    "whitened": pa.array(whitened, mask=np.isnan(whitened)),
                    "explained": pa.array(shares * len(kept), pa.float64()),
                    "identity_error": pa.array([error], pa.float64()).take(pa.array(np.zeros(len(whitened), int))),
                }

    return arrow_map(picked, rows, schema)
