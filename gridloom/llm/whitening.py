"""Whitened embeddings: principal components of centred covariance, each scaled to variance 1.

Tasks count the vectors and sum them exactly, in whole numbers; then they centre their vectors on the mean and sum outer
products, which Spark adds by rows of the matrix. The driver gets a matrix of dimension by dimension, whatever the
number of vectors, and takes it apart: Householder reflections make it tridiagonal, bisection by Sturm counts finds the
leading eigenvalues, inverse iteration their vectors, made orthogonal again inside clusters of close values. The
components are broadcast (8 times the dimension) and every vector is projected in its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import ship_package

#: Leading components, and what makes a long of an entry: floor(SCALE * c) + SHIFT.
COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Entries beyond this would not leave a long exact; no embedding has any.
LARGEST = 2.0**30

# ---- eigenvectors of a symmetric matrix -----------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors (unit, or zero where nothing is to be done) of a symmetric matrix."""
    a, reflections = matrix.astype(np.float64).copy(), []
    for k in range(len(a) - 2):
        x = a[k + 1 :, k].copy()
        # Scaled by its largest entry, so that no square underflows.
        scale = np.abs(x[1:]).max()
        if scale == 0:
            reflections.append(np.zeros_like(x))
            continue
        x /= max(scale, abs(x[0]))
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        v = x / np.linalg.norm(x)
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = p - v * (v @ p)
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        column = a[k + 1 :, k]
        column -= 2 * v * (v @ column)
        a[k, k + 1 :] = column
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, square: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm counts: the eigenvalues of the tridiagonal matrix below each of the places ``at``."""
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for i, d in enumerate(diagonal):
        q = d - at - (square[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    norm = float((np.abs(diagonal) + reach).max())
    if norm == 0:
        return np.zeros(k)
    tiny = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * norm)
    low = np.full(k, float((diagonal - reach).min()) - tiny)
    high = np.full(k, float((diagonal + reach).max()) + np.finfo(float).eps * norm)
    wanted = n - 1 - np.arange(k)  # as many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        going = (middle > low) & (middle < high)
        if not going.any():
            return middle
        under = below(diagonal, off**2, middle, tiny) > wanted
        low, high = np.where(going & ~under, middle, low), np.where(going & under, middle, high)


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of (T - shift) x = right, by elimination with row exchanges."""
    n = len(diagonal)
    # rows[i]: the entries at i, i + 1, i + 2 of the eliminated row
    rows, x = np.zeros((n, 3)), right.copy()
    current = np.array([diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0])
    for i in range(n - 1):
        following = np.array([off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0])
        if abs(following[0]) > abs(current[0]):
            current, following = following, current
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(current[0]) < tiny:
            current[0] = tiny
        ratio = following[0] / current[0]
        rows[i] = current
        x[i + 1] -= ratio * x[i]
        current = np.array([following[1] - ratio * current[1], following[2] - ratio * current[2], 0.0])
    rows[n - 1] = current if abs(current[0]) >= tiny else (tiny, 0.0, 0.0)
    for i in range(n - 1, -1, -1):
        after = x[i + 1 : i + 3]
        x[i] = (x[i] - rows[i, 1 : 1 + len(after)] @ after) / rows[i, 0]
        largest = abs(x[i])
        if largest > 1e200:  # only the direction counts
            x /= largest
    return x


def eigenvectors(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows."""
    n = len(matrix)
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading(diagonal, off, k)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max()) if n > 1 else 0.0)
    if norm == 0:
        return values, np.eye(k, n)
    tiny, random = np.finfo(float).eps * norm, np.random.default_rng(42)
    vectors = np.zeros((k, n))
    first = 0  # of the cluster
    for i in range(k):
        if i and values[i - 1] - values[i] > 1e-3 * norm:
            first = i
        # Equal values would give equal vectors: each of a cluster is moved apart and kept orthogonal to those before.
        shift = values[i] - (i - first) * 4 * tiny
        best, best_rest = None, np.inf
        for _attempt in range(3):
            x = random.standard_normal(n)
            for _ in range(6):
                x -= vectors[first:i].T @ (vectors[first:i] @ x)
                x = solve(diagonal, off, shift, x / np.linalg.norm(x), tiny)
                for _ in range(2):
                    x /= np.abs(x).max()
                    x -= vectors[first:i].T @ (vectors[first:i] @ x)
                x /= np.linalg.norm(x)
            product = diagonal * x
            product[1:] += off * x[:-1]
            product[:-1] += off * x[1:]
            rest = float(np.abs(product - values[i] * x).max())
            if rest < best_rest:
                best, best_rest = x, rest
            if rest <= 16 * n * tiny:
                break
        vectors[i] = best
    for j in range(len(reflections) - 1, -1, -1):
        v = reflections[j]
        vectors[:, j + 1 :] -= 2 * np.outer(vectors[:, j + 1 :] @ v, v)
    return values, vectors


# ---- over all vectors ---------------------------------------------------------------------------------------------


@dataclass
class Components:
    """What the fit list gives: its size, sums, dimension, eigenvalues (falling), unit vectors, trace and identity error."""

    n: int
    sums: np.ndarray  # of whole numbers
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Centred vectors on the components, each over its deviation; NaN on a component without variance."""
        return (x - self.sums.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def usable(table: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is there, not empty, and has only entries that are finite (and below ``LARGEST``)."""
    odd = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    return table.where(F.col(column).isNotNull() & (F.size(column) > 0) & ~F.coalesce(odd, F.lit(True)))


def _longs(vectors: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """A batch's vectors as rows of longs."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    entries = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * entries).astype(np.int64).reshape(-1, size) + SHIFT


def _sums(vectors: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sums, as whole numbers of any size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            x = _longs(batch.column(0), size)
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(-1, size), pa.int32()), "s": [str(v) for v in (n, *total)]})

    found = vectors.mapInArrow(add, "at int, s string").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    total = np.zeros(size + 1, object)
    for r in found:
        total[r["at"] + 1] = int(r["s"])
    return int(total[0]), total[1:]


def _products(vectors: DataFrame, size: int, width: int, centred) -> np.ndarray:
    """Sum over the vectors of the outer product of ``centred`` (batch by ``width``), added by rows of the matrix."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for batch in batches:
            x = centred(_longs(batch.column(0), size))
            total, n = total + x.T @ x, n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(width), pa.int32()), "row": pa.array(total.tolist(), pa.list_(pa.float64()))})

    def add_rows(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": rows["at"].iloc[:1], "row": [np.sum(np.stack(list(rows["row"])), axis=0).tolist()]})

    rows = vectors.mapInArrow(add, "at int, row array<double>").groupBy("at").applyInPandas(add_rows, "at int, row array<double>").collect()
    total = np.zeros((width, width))
    for r in rows:
        total[r["at"]] = r["row"]
    return total


def fit(vectors: DataFrame, size: int, k: int = COMPONENTS) -> Components | None:
    """Components of a table of vectors (its first column) of ``size`` entries each; None without vectors."""
    ship_package(vectors.sparkSession)
    n, sums = _sums(vectors, size)
    if not n:
        return None
    mean = np.array([float(s) / n for s in sums])
    covariance = _products(vectors, size, size, lambda x: x - mean) / n
    covariance = (covariance + covariance.T) / 2
    values, directions = eigenvectors(covariance, min(k, size))
    trace = float(np.trace(covariance))
    # A component without variance, but for rounding, cannot be scaled to variance 1.
    values = np.where(values > 16 * size * np.finfo(float).eps * trace, values, np.nan)
    out = Components(n, sums, values, directions, trace)
    kept = ~np.isnan(values)
    if kept.any():
        width = int(kept.sum())

        def moments(x: np.ndarray) -> np.ndarray:
            # A one beside each vector: the product's last row has the sums, which centre the rest.
            return np.concatenate([out.whiten(x)[:, kept], np.ones((len(x), 1))], axis=1)

        total = _products(vectors, size, width + 1, moments) / n
        centre = total[-1, :-1]
        spread = total[:-1, :-1] - np.outer(centre, centre)
        out.identity_error = float(np.abs(spread - np.eye(width)).max())
    return out


def whiten(table: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable row and component.

    Null and empty vectors, and those that hold null, NaN, infinite or huge (2^30) entries give no rows, nor do vectors
    of another length than most have (of equal counts the greater length): they are no part of the fit list either. Vectors of fewer than
    ``k`` entries have as many components. A component without variance has a null ``whitened`` and explains 0. A ``deviation`` that
    is no long is null. Rows of equal or null ids each keep theirs; an empty table gives none; other columns are not read.
    """
    kept = usable(table.select(key, F.col(column).cast("array<double>").alias(column)), column)
    lengths = kept.groupBy(F.size(column).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    kind = table.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return table.sparkSession.createDataFrame([], schema)
    size = int(lengths["size"])
    kept = kept.where(F.size(column) == size).select(F.col(column).alias("v"), key)
    found = fit(kept.select("v"), size, k)
    given = table.sparkSession.sparkContext.broadcast(found)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = given.value
        width = len(own.values)
        explained = np.where(np.isnan(own.values), 0.0, own.values) / own.trace if own.trace > 0 else np.zeros(width)
        for batch in batches:
            x = _longs(batch.column(0), size)
            rows = len(x)
            keys = batch.column(1).take(pa.array(np.repeat(np.arange(rows), width)))
            y = own.whiten(x).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * width, own.n, np.int64)),
                    pa.array(np.repeat(np.array(_deviations(x, own.n, own.sums), object), width), pa.int64()),
                    pa.array(y, mask=np.isnan(y)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * width, own.identity_error)),
                ],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return kept.mapInArrow(project, schema)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None beyond a long."""
    rough = (float(n) * x - sums.astype(np.float64)) ** 2
    if rough.sum(axis=1).max(initial=0.0) < 2.0**62 and n * max(np.abs(x).max(initial=0), 1) < 2**62:  # all fits in longs
        far = np.int64(n) * x - sums.astype(np.int64)
        return (far * far).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]
