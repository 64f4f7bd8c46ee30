"""Whitening embeddings by singular values of the centred rows, found by a qd solver.

The distinct centred rows are reduced to one triangle R by blockwise QR: each task folds its rows, the
triangles are folded in groups of ``FAN_IN``. R, of the vectors' width, is made bidiagonal by Householder
reflections on the driver. The differential qd algorithm with shifts (dqds) finds the squared singular
values; its shifts are Newton bounds from the sum of 1/d, which cannot pass the smallest value. From the
twisted factorisation at each value, begun where its pivot is smallest, comes the direction; directions of
close values are made orthogonal. These are the covariance's eigenvectors, without it being formed.

Cases: rows whose vector is null or has null, NaN or infinite components are left out. Vectors of
different widths are whitened apart, each width with its own fit list. Repeated rows are fitted once and
returned each. Directions without variance (all rows equal in them, or fewer rows than dimensions) are no
components, so a single distinct row or an empty table gives no rows. Equal eigenvalues get orthogonal
directions of their common space. Components that do not fit a long after scaling are an error. Only the
two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.centroids import components, whole_vectors
from tideline.scale import cut

FAN_IN = 32  # triangles folded into one
RANK = 1e-11  # of the largest singular value: smaller ones are rounding
EPS = np.finfo(np.float64).eps
MAX_COMPONENT = 1 << 52


# Small dense work, on matrices of the vectors' width


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right vectors V of B = U' R V, by Householder reflections."""
    b = np.array(r, dtype=np.float64)
    d = b.shape[1]
    v = np.eye(d)
    for k in range(d):
        _reflect(b[k:, k:], None)
        if k < d - 2:
            _reflect(b[k:, k + 1 :].T, v[:, k + 1 :].T)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def _reflect(block: np.ndarray, also: np.ndarray | None) -> None:
    """Make the block's first column a multiple of the first unit vector; reflect ``also`` as well."""
    x = block[:, 0]
    size = np.linalg.norm(x)
    if size == 0 or len(x) == 1:
        return
    w = x.copy()
    w[0] += math.copysign(size, x[0])
    w /= np.linalg.norm(w)
    block -= 2 * np.outer(w, w @ block)
    if also is not None:
        also -= 2 * np.outer(w, w @ also)


def _dqds_pass(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float] | None:
    """One transform with shift ``tau``, and the sum of 1/d; None if the shift was too large."""
    d, newq, newe, inverse = q[0] - tau, [], [], 0.0
    for i in range(len(e)):
        if not d > 0:
            return None
        inverse += 1 / d
        top = d + e[i]
        ratio = q[i + 1] / top
        newq.append(top)
        newe.append(e[i] * ratio)
        d = d * ratio - tau
    if d < 0 or not math.isfinite(d):
        return None
    newq.append(d)
    return newq, newe, math.inf if d == 0 else inverse + 1 / d


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, largest first."""
    scale = max(np.abs(diagonal).max(), np.abs(above).max() if len(above) else 0.0)
    if scale == 0:
        return np.zeros(len(diagonal))
    least = EPS**4  # a zero on the diagonal would end the recurrence; far below what counts as rank
    q0 = [max((a / scale) ** 2, least) for a in diagonal]
    e0 = [(a / scale) ** 2 for a in above]
    found, blocks = [], [(q0, e0, 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        inverse = None
        while len(q) > 1:
            small = [i for i in range(len(e)) if e[i] <= (EPS / 8) ** 2 * (sigma + min(q[i], q[i + 1])) or e[i] < 1e-290]
            if small:
                i = small[-1]
                if i < len(q) - 2:
                    blocks.append((q[: i + 1], e[:i], sigma))
                    q, e, inverse = q[i + 1 :], e[i + 1 :], None
                else:
                    found.append(sigma + q[-1])
                    q, e, inverse = q[:-1], e[:-1], None
                continue
            if q[0] < q[-1] / 2 and inverse is None:  # the other way round, the small end last
                q, e = _flipped(q, e)
            tau = 0.0 if inverse is None else min(1 / inverse, min(q)) * (1 - 4 * EPS)
            done = _dqds_pass(q, e, tau)
            for _ in range(4):
                if done is None:
                    tau *= 0.5
                    done = _dqds_pass(q, e, tau)
            if done is None:
                tau, done = 0.0, _dqds_pass(q, e, 0.0)
            q, e, inverse = done
            sigma += tau
            if inverse == math.inf:
                found.append(sigma)
                q, e, inverse = q[:-1], e[:-1], None
        if q:
            found.append(sigma + q[0])
    return np.sort(np.array(found))[::-1] * scale**2


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same singular values, with the matrix reversed along both diagonals."""
    return q[::-1], e[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B at ``value``, orthogonal to the vectors ``near``."""
    n = len(diagonal)
    a = np.where(np.abs(diagonal) < EPS**2 * np.abs(diagonal).max(), EPS**2 * np.abs(diagonal).max(), diagonal)
    pivot, ratio = a**2, above / a[:-1]
    tiny = EPS**3 * pivot.max()
    down, s, lower = np.empty(n), -value, np.empty(n - 1)
    gamma = np.empty(n)
    for i in range(n):
        gamma[i] = s
        plus = s + pivot[i]
        plus = plus if abs(plus) > tiny else tiny
        if i < n - 1:
            lower[i] = pivot[i] * ratio[i] / plus
            s = lower[i] * ratio[i] * s - value
    p, upper = pivot[-1] - value, np.empty(n - 1)
    gamma[-1] += p + value
    for i in range(n - 2, -1, -1):
        minus = pivot[i] * ratio[i] ** 2 + p
        minus = minus if abs(minus) > tiny else tiny
        t = pivot[i] / minus
        upper[i] = ratio[i] * t
        p = p * t - value
        gamma[i] += p + value
    best = None
    for twist in np.argsort(np.abs(gamma), kind="stable"):
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -upper[i] * z[i]
        z /= np.linalg.norm(z)
        left = z
        for _ in range(2):
            for other in near:
                left = left - (other @ left) * other
        size = np.linalg.norm(left)
        if best is None or size > best[0]:
            best = (size, left / size if size > 0 else z)
        if size > 0.1 or not near:
            break
    return best[1]


def right_directions(r: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values above rounding, at most ``limit``, and their right vectors as columns."""
    diagonal, above, v = bidiagonal(r)
    values = dqds(diagonal, above)
    keep = values > RANK**2 * max(values[0], 0)
    values = values[keep][:limit]
    cutoff = EPS * (np.abs(diagonal).max() + (np.abs(above).max() if len(above) else 0))
    bounds = [0, *(i + 1 for i in range(len(above)) if abs(above[i]) <= cutoff), len(diagonal)]
    # each value belongs to one of the blocks between the zeros above the diagonal
    owned = [(w, lo, hi) for lo, hi in zip(bounds, bounds[1:]) for w in dqds(diagonal[lo:hi], above[lo : hi - 1])]
    owned = sorted(owned, key=lambda o: -o[0])[: len(values)]
    found: list[tuple[float, int, np.ndarray]] = []
    for value, lo, hi in owned:
        near = [z for other, start, z in found if start == lo and abs(other - value) <= 1e-3 * other]
        z = twisted(diagonal[lo:hi], above[lo : hi - 1], value, near) if hi - lo > 1 else np.ones(1)
        found.append((value, lo, z))
    w = np.zeros((len(diagonal), len(found)))
    for j, (_, lo, z) in enumerate(found):
        w[lo : lo + len(z), j] = z
    return np.array([value for value, _, _ in found]), v @ w


# Distributed work


def _fold(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    stacked = rows if triangle is None else np.vstack([triangle, rows])
    return np.linalg.qr(stacked, mode="r")


def _lists(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, rounded once: n*x - S is taken in whole numbers."""
    return deviations(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, exact: in longs where they suffice, else in Python integers."""
    largest = int(np.abs(x).max()) if x.size else 0
    if n * largest + int(max(map(abs, sums), default=0)) < 2**62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squared_norms(y: np.ndarray) -> list[int]:
    """Exact sums of squares of each row."""
    largest = int(abs(y).max()) if y.size else 0
    if y.dtype == object or largest**2 * y.shape[1] >= 2**62:
        return [sum(v * v for v in map(int, row)) for row in y]
    return (y**2).sum(axis=1).tolist()


def quantised_rows(rows: DataFrame, id_: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(id, x) of every whole vector: x = floor(scale * component) + offset."""

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = whole_vectors(batch.column(vector)) & (batch.column(vector).value_lengths().fill_null(0).to_numpy(zero_copy_only=False) > 0)
            mine = batch.filter(pa.array(keep))
            flat = mine.column(vector).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            scaled = np.floor(flat * scale)
            if scaled.size and np.abs(scaled).max() >= MAX_COMPONENT:
                raise ValueError(f"a component times {scale} does not fit a long")
            lengths = mine.column(vector).value_lengths().to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(scaled.astype(np.int64) + offset))
            yield pa.RecordBatch.from_arrays([mine.column(id_), lists], names=["id", "x"])

    kind = rows.schema[id_].dataType.simpleString()
    return rows.select(id_, vector).mapInArrow(integers, f"id {kind}, x array<bigint>")


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit rows; a triangle a task is shuffled, then ``FAN_IN`` of them a group."""
    width = len(sums)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for low in range(0, batch.num_rows, 8192):
                r = _fold(r, _centred(_lists(batch.slice(low, 8192), "x"), n, sums))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float64).tobytes()], pa.binary())], names=["r"])

    def folded(table: pa.Table) -> pa.Table:
        r = None
        for blob in table.column("r").to_pylist():
            r = _fold(r, np.frombuffer(blob).reshape(-1, width))
        return pa.table({"r": pa.array([r.tobytes()], pa.binary())})

    parts = cut(fit.mapInArrow(local, "r binary").withColumn("place", F.spark_partition_id()))
    count = parts.count()
    while count > FAN_IN:
        groups = count // FAN_IN + 1
        dealt = parts.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups)))
        parts = cut(dealt.groupBy("group").applyInArrow(folded, "r binary").withColumn("place", F.spark_partition_id()))
        smaller = parts.count()
        if smaller == count:
            break
        count = smaller
    r = None
    for row in sorted(parts.select("r").collect()):  # FAN_IN triangles
        r = _fold(r, np.frombuffer(row["r"]).reshape(-1, width))
    return r if len(r) == width else np.vstack([r, np.zeros((width - len(r), width))])


def whitening_map(fit: DataFrame, n: int, sums: list[int], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns that take a centred row to its whitened values, and each component's share of the variance."""
    r = triangle(fit, n, sums)
    values, directions = right_directions(r, limit)
    total = (r**2).sum()
    return directions / np.sqrt(values / n), values / total if len(values) else values


def identity_error(fit: DataFrame, n: int, sums: list[int], columns: np.ndarray) -> float:
    """Largest absolute entry of the fit rows' whitened covariance less the identity."""
    m = columns.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, means = np.zeros((m, m)), np.zeros(m)
        for batch in batches:
            w = _centred(_lists(batch, "x"), n, sums).astype(np.float64) @ columns
            products += w.T @ w
            means += w.sum(axis=0)
        flat = np.concatenate([products.reshape(-1), means])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], names=["at", "v"])

    parts = fit.mapInArrow(partial, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.array([r["v"] for r in sorted(parts)]) / n
    covariance = flat[: m * m].reshape(m, m) - np.outer(flat[m * m :], flat[m * m :])
    return float(np.abs(covariance - np.eye(m)).max())


def whiten(rows: DataFrame, id_: str, vector: str, limit: int = 16, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for every row and component.

    ``n`` counts the fit list, the distinct integer vectors; ``deviation`` is decimal.
    """
    quantised = quantised_rows(rows, id_, vector, scale, offset)
    fit = cut(quantised.select("x").distinct())
    widths = [(r["width"], r["n"]) for r in fit.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy("width").collect()]
    kind = rows.schema[id_].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    maps, worst = {}, 0.0
    for width, n in widths:
        mine = fit.filter(F.size("x") == width)
        total = mine.agg(*[F.sum(F.col("x")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]).first()
        sums = [int(v) for v in total]
        columns, explained = whitening_map(mine, n, sums, limit)
        if columns.shape[1]:
            worst = max(worst, identity_error(mine, n, sums, columns))
        maps[width] = (n, sums, columns, explained)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 4096):
                batch = whole.slice(low, 4096)
                lengths = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
                for width in np.unique(lengths):
                    n, sums, columns, explained = maps[int(width)]
                    m = columns.shape[1]
                    if not m:
                        continue
                    mine = batch.filter(pa.array(lengths == width))
                    y = deviations(_lists(mine, "x"), n, sums)
                    w = (y.astype(np.float64) / n) @ columns
                    at = pa.array(np.repeat(np.arange(mine.num_rows), m))
                    norms = pa.array([Decimal(v) for v in squared_norms(y)], pa.decimal128(38, 0))
                    size = mine.num_rows * m
                    yield pa.RecordBatch.from_arrays(
                        [mine.column("id").take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), mine.num_rows)),
                         pa.array(np.full(size, n)), norms.take(at), pa.array(w.reshape(-1)),
                         pa.array(np.tile(explained, mine.num_rows)), pa.array(np.full(size, worst))],
                        names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return quantised.mapInArrow(apply, schema).withColumnRenamed("id", id_)
