"""Whitening of vectors by a bidiagonal singular value decomposition.

The distinct vectors, centred, are a tall matrix. Each partition reduces its rows to a
triangular factor by blockwise QR; factors are merged in groups, round by round, to one
of the size of the dimension. Householder reflections make it bidiagonal; the
differential qd algorithm with shifts finds the squared singular values to high relative
accuracy, and twisted factorisations of the bidiagonal's square give the directions. No
covariance matrix is formed on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from oddsline.llm.common import row_batches, written

SCALE, SHIFT = 64, 1_000_000
#: Entries from this size on are not representable; with it, sums over 2**31 vectors fit a long.
LARGEST = float(1 << 31)
#: Factors merged by one task, and rows of a block of the first pass.
MERGED, BLOCK = 32, 4096
#: Directions with a smaller share of the largest deviation are rounding noise.
SMALLEST = 1e-11
EPS = float(np.finfo(float).eps)


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right reflections V of a square matrix U B V'."""
    a = matrix.astype(float).copy()
    n = a.shape[1]
    right = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0] or 1.0)
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = reflector(a[k, k + 1:].copy())
        if v is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= 2 * np.outer(right[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling.

    Works on squares q and e. A transform with a shift below the smallest value keeps all
    of them positive; one that does not is undone and tried with a smaller shift. Values
    are split off at the end, and the rest is split wherever an e vanishes.
    """
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    # A zero diagonal would stop the recurrence: a value far below rounding stands for it.
    q = np.maximum((diagonal / scale) ** 2, 1e-280)
    e = (above / scale) ** 2
    out: list[float] = []
    parts = [(q.tolist(), e.tolist(), 0.0)]
    while parts:
        q, e, shift = parts.pop()
        least = None
        while q:
            n = len(q)
            if n == 1:
                out.append(q[0] + shift)
                break
            if e[-1] <= EPS * EPS * (shift + q[-1]):
                out.append(q.pop() + shift)
                e.pop()
                least = None
                continue
            cut = next((i for i in range(n - 2) if e[i] <= EPS * EPS * (shift + min(q[i], q[i + 1]))), None)
            if cut is not None:
                parts.append((q[cut + 1:], e[cut + 1:], shift))
                q, e, least = q[:cut + 1], e[:cut], None
                continue
            if q[0] * 1.5 < q[-1]:  # graded upwards: values come off at the small end
                q, e = flipped(q, e)
                least = None
            tried = 0.0 if least is None else 0.98 * least
            while True:
                result = transformed(q, e, tried)
                if result is not None:
                    break
                tried = tried / 4 if tried > EPS * (shift + EPS) else 0.0
            q, e, least = result
            shift += tried
    return np.sort(np.array(out))[::-1] * scale * scale


def flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The same values from the array read backwards."""
    return q[::-1], e[::-1]


def transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform; None if the shift is above the smallest value."""
    d = q[0] - shift
    least, new_q, new_e = d, [], []
    for k in range(len(q) - 1):
        if d < 0:
            return None
        top = d + e[k]
        new_q.append(top)
        ratio = q[k + 1] / top
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Eigenvectors, as columns, of the square B'B of a bidiagonal B for given eigenvalues.

    For each value, B'B less the value is factorised from both ends; where the two meet
    with the smallest pivot, the vector is read off. A Rayleigh correction sharpens the
    value once. Vectors of values that almost agree are made orthogonal to each other;
    where one vanishes by that, the factorisation is twisted at the next pivot.
    """
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(above).max(initial=0))
    a = np.where(np.abs(diagonal) < scale * 1e-140, scale * 1e-140, diagonal) / scale
    b = above / scale
    out = np.empty((n, len(values)))
    cluster = 0  # first column whose value almost agrees with the present one
    for column, value in enumerate(np.asarray(values) / (scale * scale)):
        previous = values[column - 1] / (scale * scale) if column else np.inf
        if previous - value > 1e-3 * previous:
            cluster = column
        down, up, pivots = twisted(a, b, value)
        k = int(np.abs(pivots).argmin())
        z = read_off(down, up, k)
        z /= np.abs(z).max()
        corrected = value + pivots[k] * z[k] ** 2 / (z @ z)
        if abs(corrected - value) <= 1e-8 * value:
            down, up, pivots = twisted(a, b, corrected)
        near = out[:, cluster:column]
        best = None
        for k in np.argsort(np.abs(pivots), kind="stable"):
            z = read_off(down, up, int(k))
            z /= np.abs(z).max()
            z /= np.linalg.norm(z)
            left = z - near @ (near.T @ z)
            size = np.linalg.norm(left)
            if best is None or size > np.linalg.norm(best):
                best = left
            if size > 0.5:
                break
        best /= np.linalg.norm(best)
        best -= near @ (near.T @ best)
        out[:, column] = best / np.linalg.norm(best)
    return out


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers of the factorisations from the top and the bottom, and the pivot of each twist."""
    n = len(a)
    q, e, ab = a * a, b * b, a[:-1] * b
    tiny = 1e-290
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    s[0], p[-1] = -value, q[-1] - value
    for k in range(n - 1):
        pivot = s[k] + q[k] or tiny
        down[k] = ab[k] / pivot
        s[k + 1] = e[k] * (s[k] / pivot) - value
    for k in range(n - 2, -1, -1):
        pivot = e[k] + p[k + 1] or tiny
        up[k] = ab[k] / pivot
        p[k] = p[k + 1] * (q[k] / pivot) - value
    return down, up, s + p + value


def read_off(down: np.ndarray, up: np.ndarray, k: int) -> np.ndarray:
    """The vector of the factorisation that is twisted at k."""
    z = np.empty(len(down) + 1)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, len(down)):
        z[i + 1] = -up[i] * z[i]
    return z


def decomposed(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right directions (columns) of a triangular factor.

    Values that are rounding noise beside the largest are left out. The largest entry
    of a direction is positive.
    """
    d = factor.shape[1]
    square = np.zeros((d, d))
    square[:len(factor)] = factor
    diagonal, above, right = bidiagonal(square)
    # Equal values make it fall into blocks; within one, no two values are equal.
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    cuts = np.r_[0, np.flatnonzero(np.abs(above) <= 16 * EPS * scale) + 1, d]
    blocks = [slice(i, j) for i, j in zip(cuts, cuts[1:])]
    values = [dqds(diagonal[b], above[b.start:b.stop - 1]) for b in blocks]
    largest = max((v.max(initial=0) for v in values), default=0)
    values = [v[v > largest * SMALLEST ** 2] for v in values]
    squares = np.concatenate([np.empty(0), *values])
    if not len(squares):
        return np.empty(0), np.empty((d, 0))
    vectors = np.hstack([right[:, b] @ directions(diagonal[b], above[b.start:b.stop - 1], v)
                         for b, v in zip(blocks, values) if len(v)])
    falling = np.argsort(-squares, kind="stable")
    squares, vectors = squares[falling], vectors[:, falling]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return np.sqrt(squares), vectors * signs


def lattice(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and ``x``: every valid vector as whole numbers floor(64 c) + 1,000,000."""
    entry = F.col(column).cast("array<double>")
    invalid = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(SCALE * c) >= LARGEST))
    return (vectors.filter(F.col(column).isNotNull() & ~invalid)
            .select("vec_id", F.transform(entry, lambda c: F.floor(SCALE * c) + F.lit(SHIFT)).alias("x")))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as rows."""
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def totals(frame: DataFrame, partial, size: int) -> list[float]:
    """The sums of ``size`` numbers that ``partial`` gives for each batch: one row a number at the driver."""
    kind = "long" if partial.exact else "double"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = partial(matrix(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    rows = frame.select("x").mapInArrow(summed, f"place long, value {kind}")
    found = dict(rows.groupBy("place").agg(F.sum("value")).collect())
    return [found.get(k, 0) for k in range(size)]


def exact(f):
    f.exact = True
    return f


def inexact(f):
    f.exact = False
    return f


def triangular(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangular factor of all centred vectors: per partition, then merged in groups."""
    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        factor, held = np.empty((0, len(sums))), []
        def fold():
            return np.linalg.qr(np.vstack([factor, *held]), mode="r")
        for batch in batches:
            if len(batch):
                held.append((n * matrix(batch) - sums) / n)
            if sum(map(len, held)) >= BLOCK:
                factor, held = fold(), []
        if held:
            factor = fold()
        if len(factor):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([factor.tobytes()], pa.binary())],
                ["part", "factor"])

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.frombuffer(f).reshape(-1, len(sums)) for f in group.sort_values("part")["factor"]])
        factor = np.linalg.qr(stacked, mode="r")
        return pd.DataFrame({"part": [group["part"].iloc[0] // MERGED], "factor": [factor.tobytes()]})

    schema = "part long, factor binary"
    factors = written(fit.select("x").mapInArrow(reduced, schema), "factors")
    while factors.count() > 1:
        factors = written(factors.groupBy(F.floor(F.col("part") / MERGED)).applyInPandas(merged, schema), "factors")
    return np.frombuffer(factors.first()["factor"]).reshape(-1, len(sums))


def whitened(vectors: DataFrame, column: str = "embedding", components: int = 16) -> DataFrame:
    """Per valid vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    A vector is valid if it and all its entries are given and finite, and its length is
    the commonest one (of equally common ones the largest). An entry of 2**25 or more,
    whose x would not leave room for sums, counts as not finite. Every distinct vector
    x counts once for the mean and the components. ``deviation`` is the exact sum of (n x
    - S)**2, null where it exceeds a long. ``explained`` is a component's share of all
    variance; ``identity_error`` the largest entry of the covariance of the whitened
    distinct vectors less the identity, as computed from them. Components without
    variance are not returned, so fewer than two distinct vectors, or an empty table,
    give no rows. Repeated rows get a row each; a null vec_id is kept; extra columns
    are ignored. The driver holds matrices of the size of the dimension only.
    """
    spark = vectors.sparkSession
    row_batches(spark, 1024)
    own = written(lattice(vectors, column), "lattice")
    size = F.size("x")
    common = own.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0
    own = own.filter(size == d)
    fit = written(own.select("x").distinct(), "fit")
    n = fit.count()
    sums = np.array(totals(fit, exact(lambda x: x.sum(axis=0)), d), np.int64)
    values, basis = (decomposed(triangular(fit, n, sums)) if d and n > 1 else (np.empty(0), np.empty((d, 0))))
    spread = values ** 2 / n if n else values
    used = min(components, len(values))
    to_white = basis[:, :used] / np.sqrt(spread[:used])
    error = identity_error(fit, n, sums, to_white)
    shares = (spread / spread.sum()).tolist()[:used]
    kind = own.schema["vec_id"].dataType.simpleString()
    listed = own.mapInArrow(projecting(n, sums, to_white), f"vec_id {kind}, deviation long, _all array<double>")
    return listed.select("vec_id", "deviation", F.posexplode("_all").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(F.array(*map(F.lit, shares)).cast("array<double>"), "_at").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def identity_error(fit: DataFrame, n: int, sums: np.ndarray, to_white: np.ndarray) -> float:
    """How far the covariance of the whitened distinct vectors is from the identity, at most."""
    k = to_white.shape[1]
    if not k:
        return 0.0

    @inexact
    def moments(x: np.ndarray) -> np.ndarray:
        z = (n * x - sums) / n @ to_white
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    found = np.array(totals(fit, moments, k + k * k))
    mean = found[:k] / n
    return float(np.abs(found[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def projecting(n: int, sums: np.ndarray, to_white: np.ndarray):
    """A batch function: vec_id, exact deviation and all components of each vector."""
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            y = n * matrix(batch) - sums
            if float(np.abs(y).max(initial=0)) ** 2 * max(1, len(sums)) < 2.0 ** 62:
                deviation = (y * y).sum(axis=1).tolist()
            else:
                deviation = [sum(v * v for v in row) for row in y.tolist()]  # whole numbers of any size
            deviation = [v if v < 1 << 63 else None for v in deviation]
            white = y / n @ to_white
            ends = np.arange(len(batch) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("vec_id")), pa.array(deviation, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(white.ravel()))], ["vec_id", "deviation", "_all"])

    return projected
