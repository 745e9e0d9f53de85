"""Whitening of embeddings by their singular values: blockwise QR, Householder bidiagonalisation, dqds, twisted factorisations.

1. Entries become integers, so that count and sums are exact and every row is centred before anything is multiplied: an integer difference less
   a fraction below one.
2. Each task reduces its centred rows, block by block, to one triangle R (d by d) with the same inner products; triangles are stacked ``FAN`` at a
   time in tasks and reduced again. No covariance matrix is formed, so small variances keep their digits.
3. The last triangle comes to the driver: d squared numbers, whatever the table. Householder reflections make it bidiagonal, the differential
   quotient-difference algorithm with shifts (dqds) gives the squares of its singular values to high relative accuracy, and the twisted
   factorisation of each shifted matrix gives its vector. The reflections, applied in reverse, turn vectors into whitening directions.
4. Rows are projected, the covariance of what comes out is measured, and its distance from the identity is part of the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stage, with_rows

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Integers beyond this are held at it, so that differences stay 64-bit integers.
LARGEST = 1 << 61
#: Triangles that one task stacks, and numbers of a block of rows.
FAN, BLOCK = 8, 1 << 20
#: A component whose singular value is below this share of the largest has no direction but rounding, and is left out.
LEAST = 1e-10
EPS = float(np.finfo(float).eps)


def matrices(column: pa.ListArray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integers) of blocks of a column of full vectors."""
    step = max(2 * width, BLOCK // width)
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        values = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), width)
        yield at, np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def add_up(width: int):
    """Per task and dimension: rows, and the sums of the high and the low half of the integers, which can't overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            for _, x in matrices(batch.column("vector"), width):
                n += len(x)
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(width, dtype=np.int32)), "n": pa.array([n] * width, pa.int64()), "high": pa.array(high), "low": pa.array(low)})

    return run


class Centre:
    """The mean as a whole part and a remainder: n * whole + rest is the sum."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        parts = [divmod(s, n) for s in sums] if n else [(0, 0)] * len(sums)
        self.whole, self.rest = np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Of each row the sum of (n * x - sum) squared, exactly; None beyond 64 bits."""
        apart = x - self.whole
        most = (float(np.abs(apart).max(initial=0)) + 1) * self.n
        if most * most * len(self.sums) < 2.0**62:
            return ((apart * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = apart.astype(object) * self.n - self.rest.astype(object)
        return [s if s < 2**63 else None for s in (exact * exact).sum(axis=1).tolist()]


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def reduce_rows(centre: Centre):
    """One triangle per task: each block of centred rows is stacked under the triangle so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        width, so_far = len(centre.sums), None
        for batch in batches:
            for _, x in matrices(batch.column("vector"), width):
                rows = centre.centred(x)
                so_far = triangle(rows if so_far is None else np.vstack([so_far, rows]))
        if so_far is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "r": pa.array([so_far.tobytes()], pa.binary())})

    return run


def stacked(values: list[bytes], width: int) -> np.ndarray:
    return triangle(np.vstack([np.frombuffer(v, np.float64).reshape(-1, width) for v in values]))


def merge_triangles(width: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        part = table.column("part")[0].as_py() // FAN
        return pa.table({"part": pa.array([part], pa.int64()), "r": pa.array([stacked(table.column("r").to_pylist(), width).tobytes()], pa.binary())})

    return run


def total_triangle(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """The triangle of all rows. At most ``FAN`` triangles meet in a task, or in the driver at the end."""
    width = len(centre.sums)
    parts = stage(vectors.select("vector").mapInArrow(reduce_rows(centre), "part bigint, r binary"), "whitening-triangles")
    last = parts.agg(F.max("part")).first()[0]
    while last >= FAN:
        parts = stage(parts.groupBy((F.col("part") / FAN).cast("bigint")).applyInArrow(merge_triangles(width), "part bigint, r binary"), "whitening-triangles")
        last //= FAN
    return stacked([row["r"] for row in parts.orderBy("part").collect()], width)


def reflection(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The unit vector v for which x - 2 v (v.x) has only its first entry, and that entry."""
    size = float(np.linalg.norm(x))
    if size == 0:
        return np.zeros_like(x), 0.0
    v, head = x.copy(), -math.copysign(size, x[0])
    v[0] -= head
    return v / np.linalg.norm(v), head


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and upper diagonal that Householder reflections from both sides leave of a square matrix, and the reflections from the right."""
    a, d = a.copy(), len(a)
    diagonal, upper, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        v, diagonal[k] = reflection(a[k:, k])
        a[k:, k + 1 :] -= 2 * np.outer(v, v @ a[k:, k + 1 :])
        if k < d - 1:
            w, upper[k] = reflection(a[k, k + 1 :])
            a[k + 1 :, k + 1 :] -= 2 * np.outer(a[k + 1 :, k + 1 :] @ w, w)
            right.append(w)
    return diagonal, upper, right


def transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds step. The third list has what must stay positive; it ends early where the shift was too large."""
    ds, qs, es = [], [], []
    d = q[0] - shift
    for i in range(len(e)):
        ds.append(d)
        if not d > 0:
            return qs, es, ds
        new = d + e[i]
        ratio = q[i + 1] / new
        qs.append(new)
        es.append(e[i] * ratio)
        d = d * ratio - shift
    ds.append(d)
    qs.append(d)
    return qs, es, ds


def squares(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values, falling, of the bidiagonal matrix with squared entries ``q`` and ``e``, none of them 0.

    A step without shift gives the diagonal of the inverse; one over its sum is below the least square, so it is a safe shift. Shifts add up
    to the value found when the last off-diagonal entry has gone.
    """
    found, left = [], [(list(q), list(e), 0.0)]
    while left:
        q, e, total = left.pop()
        while True:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (total + min(q[i], q[i + 1]))), None)
            if cut is not None:
                left.append((q[: cut + 1], e[:cut], total))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if not e:
                found.append(total + q[0])
                break
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, ds = transform(q, e, 0.0)
            if min(ds) <= 0:
                q[-1] = max(q[-1], 0.0)
                left.append((q[:-1], e[:-1], total))
                found.append(total)
                break
            shift = (1 - 8 * EPS * len(q)) / sum(1 / d for d in ds)
            while shift > 0 and total + shift > total:
                moved = transform(q, e, shift)
                if len(moved[0]) == len(q) and min(moved[2]) > 0:
                    q, e, total = moved[0], moved[1], total + shift
                    break
                shift /= 4
    return sorted(found, reverse=True)


def twisted(a: np.ndarray, b: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """The unit vector of B'B for an eigenvalue; B has the diagonal ``a`` and the upper diagonal ``b``.

    The factorisations from the top and from the bottom of the shifted matrix meet where they leave the smallest pivot; from there the vector
    follows without a solve. ``others`` are vectors of near values; the result is made orthogonal to them, by inverse iteration if little is left of it.
    """
    n = len(a)
    d, low = a * a, b / a[:-1]
    tiny = EPS * EPS * max(float(d.max()), 1e-300)
    for _ in range(3):
        down, above, s = np.zeros(max(n - 1, 0)), np.zeros(n), -value
        for i in range(n - 1):
            above[i] = s
            pivot = s + d[i]
            pivot = pivot if abs(pivot) > tiny else -tiny
            down[i] = d[i] * low[i] / pivot
            s = down[i] * low[i] * s - value
        above[n - 1] = s
        up, below, p = np.zeros(max(n - 1, 0)), np.zeros(n), d[n - 1] - value
        below[n - 1] = p
        for i in range(n - 2, -1, -1):
            pivot = d[i] * low[i] * low[i] + p
            pivot = pivot if abs(pivot) > tiny else -tiny
            ratio = d[i] / pivot
            up[i] = low[i] * ratio
            p = p * ratio - value
            below[i] = p
        pivots = above + below + value
        k = int(np.argmin(np.abs(pivots)))
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -up[i] * z[i]
        square = float(z @ z)
        step = float(pivots[k]) / square
        if abs(step) <= EPS * value:
            break
        value += step
    z /= np.linalg.norm(z)
    if others:
        near = np.array(others)
        rest = z - near.T @ (near @ z)
        if np.linalg.norm(rest) < 0.5:
            full = np.diag(d + np.append(0, b * b)) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
            shifted = full - (value * (1 + 4 * EPS) + tiny) * np.eye(n)
            rest = np.cos(np.arange(1, n + 1) * 1.7)
            for _ in range(4):
                rest = rest - near.T @ (near @ rest)
                rest = np.linalg.solve(shifted, rest / np.linalg.norm(rest))
            rest = rest / np.linalg.norm(rest)
            rest = rest - near.T @ (near @ rest)
        rest = rest - near.T @ (near @ rest)
        z = rest / np.linalg.norm(rest)
    return z


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, unit directions as columns) of the ``most`` largest components of a triangle that have any."""
    if r.shape[0] < r.shape[1]:
        r = np.vstack([r, np.zeros((r.shape[1] - r.shape[0], r.shape[1]))])
    size = float(np.abs(r).max(initial=0))
    width = r.shape[1]
    if size == 0 or most < 1:
        return np.zeros(0), np.zeros((width, 0))
    a, b, right = bidiagonal(r / size)
    least = EPS * 1e-3 * max(float(np.abs(a).max()), float(np.abs(b).max(initial=0)))
    a = np.where(np.abs(a) < least, least, a)  # far below the rounding of the reflections
    joined = np.append(np.abs(b) >= least, False)
    found, begin = [], 0
    for end in np.flatnonzero(~joined).tolist():
        own_a, own_b = a[begin : end + 1], b[begin:end]
        found += [(value, begin, end) for value in squares((own_a**2).tolist(), (own_b**2).tolist())]
        begin = end + 1
    found.sort(key=lambda x: (-x[0], x[1]))
    found = [x for x in found[:most] if x[0] > LEAST * LEAST * found[0][0]]
    out = np.zeros((width, len(found)))
    for j, (value, begin, end) in enumerate(found):
        near = [out[begin : end + 1, i] for i in range(j) if found[i][1] == begin and found[i][0] - value < 1e-3 * value]
        out[begin : end + 1, j] = twisted(a[begin : end + 1], b[begin:end], value, near)
    for k in range(len(right) - 1, -1, -1):
        out[k + 1 :] -= 2 * np.outer(right[k], right[k] @ out[k + 1 :])
    if out.shape[1]:
        first = out[np.argmax(np.abs(out) > 0.5 * np.abs(out).max(axis=0), axis=0), np.arange(out.shape[1])]
        out *= np.where(first < 0, -1.0, 1.0)
    return np.array([x[0] for x in found]) * size * size, out


def project(centre: Centre, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in matrices(batch.column("vector"), len(centre.sums)):
                values = centre.centred(x) @ weights
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1])
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").slice(at, len(x)), "deviation": pa.array(centre.deviations(x), pa.int64()),
                    "whitened": pa.ListArray.from_arrays(offsets, pa.array(values.ravel())),
                })

    return run


def identity_error(rows: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` less the identity, centred before multiplying."""
    entry: list[Column] = [F.col("whitened")[i] for i in range(k)]
    means = rows.agg(*[F.avg(e) for e in entry]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = rows.agg(*[F.avg((entry[i] - means[i]) * (entry[j] - means[j])) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(got, pairs, strict=True))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``vectors`` has vec_id and embedding; other columns don't matter. A vector that is null, empty, or holds a null, NaN or infinite entry takes no
    part, nor does one whose length is not the commonest (the longest among equals). Repeated rows and rows with a null vec_id count and
    come back, one each. Components without variance don't come back, so a table of equal vectors, or an empty one, gives an empty result.
    ``deviation`` is null where it exceeds 64 bits; entries beyond 2**51 in absolute value are held there. Either direction of a component would do;
    the first entry of more than half the largest absolute value is positive.
    """
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = with_rows(vectors).select(F.col("row")["vec_id"].cast("bigint").alias("vec_id"), F.col("row")["embedding"].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & finite & (F.size("vector") > 0)).withColumn("size", F.size("vector"))
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    empty = vectors.sparkSession.createDataFrame([], schema)
    if common is None:
        return empty
    width = common["size"]
    rows = rows.filter(F.col("size") == width).select("vec_id", "vector")
    wide = "decimal(38,0)"
    sums = rows.select("vector").mapInArrow(add_up(width), "at int, n bigint, high bigint, low bigint")
    sums = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(20,0)")).cast(wide).alias("high"), F.sum(F.col("low").cast("decimal(20,0)")).cast(wide).alias("low"))
    sums = sums.orderBy("at").collect()  # a row per dimension
    centre = Centre(sums[0]["n"], [(int(s["high"]) << 32) + int(s["low"]) for s in sums])
    r = total_triangle(rows, centre)
    values, turned = directions(r, min(components, width))
    if not len(values):
        return empty
    out = stage(rows.mapInArrow(project(centre, turned * np.sqrt(centre.n / values)), "vec_id bigint, deviation bigint, whitened array<double>"), "whitening-rows")
    error = identity_error(out, len(values))
    shares = F.array(*[F.lit(float(v)) for v in values / float((r * r).sum())])
    out = out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(centre.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
