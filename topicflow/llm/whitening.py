"""Embedding whitening: a distributed covariance, its leading components, and every vector's projection on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, stored

EPS = float(np.finfo(float).eps)
#: Vectors of more entries are refused: the matrix of their products is solved on the driver.
MOST_DIMENSIONS = 1024
#: Components whose eigenvalue is a smaller part of the largest one are rounding, and left out.
LEAST = 1e-10
#: Rows that are taken to numpy at once.
_ROWS = 2048


class Whitening(NamedTuple):
    """What is learned from n vectors: their exact sums, and unit components (columns) by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The mean, rounded to whole numbers: whole vectors less it are exact."""
        return np.array([float((2 * s + self.n) // (2 * self.n)) for s in self.sums])

    @property
    def shift(self) -> np.ndarray:
        """The mean less the centre."""
        return np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, self.centre, strict=True)])


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: the diagonal and off-diagonal of q.T @ a @ q for a symmetric ``a``, and q."""
    a, n = np.array(a, float), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        scale = np.abs(x).max()
        if not np.abs(x[1:]).any():
            continue
        x /= scale
        length = np.copysign(np.sqrt(x @ x), x[0])
        x[0] += length
        v = x / np.sqrt(x @ x)
        inner = a[k + 1 :, k + 1 :]
        p = inner @ v
        w = p - (p @ v) * v
        inner -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0
        a[k + 1, k] = -length * scale
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return a.diagonal().copy(), a.diagonal(-1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a symmetric tridiagonal matrix are less than each of ``at``: negative pivots."""
    least = EPS * EPS * max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)), np.finfo(float).tiny / EPS**3)
    pivot, counts = np.ones(len(at)), np.zeros(len(at), np.int64)
    for i, d in enumerate(diagonal):
        pivot = d - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        counts += pivot < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling: bisection on Sturm counts until the intervals no longer shrink."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    width = EPS * max(abs(low[0]), abs(high[0]))
    low, high = low - width, high + width
    wanted = n - np.arange(k)  # of the j-th largest, so many are less than anything over it
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        below = sturm_counts(diagonal, off, middle) >= wanted
        low, high = np.where(below, low, middle), np.where(below, middle, high)
    return (low + high) / 2


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for eigenvalues in falling order.

    Eigenvalues within a thousandth of the matrix's norm of their neighbour make a cluster, whose
    vectors are made orthogonal to each other in every step: inverse iteration alone would find
    one and the same vector for equal eigenvalues.
    """
    n, rng = len(diagonal), np.random.default_rng(13)
    matrix = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    norm = np.abs(matrix).sum(1).max()
    found, first = np.zeros((n, len(values))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shifted = matrix - (value + 2 * EPS * norm) * np.eye(n)  # never singular to the last bit
        x = rng.standard_normal(n)
        for _ in range(4):
            try:
                x = np.linalg.solve(shifted, x / np.abs(x).max())
            except np.linalg.LinAlgError:
                shifted -= 8 * EPS * norm * np.eye(n)
                continue
            for _ in range(2):
                x -= found[:, first:j] @ (found[:, first:j].T @ x)
            x /= np.sqrt(x @ x)
        found[:, j] = x
    return found


def leading_components(covariance: np.ndarray, k: int, least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Up to k unit eigenvectors (columns) and their eigenvalues, falling; each one's largest entry is positive.

    Those whose eigenvalue is not over ``least`` times the largest are left out.
    """
    diagonal, off, q = tridiagonal(covariance)
    values = leading_eigenvalues(diagonal, off, min(k, len(diagonal)))
    values = values[values > max(least * values[0], 0)] if len(values) else values
    vectors = q @ inverse_iteration(diagonal, off, values)
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    return vectors * signs, values


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))


def steps(vector: Column) -> Column:
    """Each entry in whole steps of a 64th, from a million up. Those that a long cannot hold stop at 2**62."""
    most = float(1 << 62)
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * 64, F.lit(-most)), F.lit(most))).cast("long") + 1_000_000)


def _matrices(b: pa.RecordBatch, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    for i in range(0, len(b), _ROWS):
        part = b.column("x").slice(i, _ROWS)
        yield slice(i, i + len(part)), part.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(rows: DataFrame, width: int) -> tuple[int, ...]:
    """The exact sum of each entry: upper and lower halves of the numbers are summed apart, so that no long overflows."""

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for b in batches:
            for _, x in _matrices(b, width):
                high += (x >> 32).sum(0)
                low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(high), pa.array(low)], names=["i", "high", "low"])

    found = rows.select("x").mapInArrow(add, "i long, high long, low long").groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return tuple((r["high"] << 32) + r["low"] for r in sorted(found, key=lambda r: r["i"]))


def _covariance(rows: DataFrame, width: int, n: int, made: Callable[[np.ndarray], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean and covariance of ``made(x)``, vectors of ``size`` entries that are all but centred.

    Each task sends one matrix; what is left of the mean is taken off by its own products. Where
    the entries are whole numbers, as all but centred steps are, the sums are exact up to 2**53,
    so that neither order nor partitions change them.
    """

    @lean
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for b in batches:
            for _, x in _matrices(b, width):
                y = made(x)
                total += y.sum(0)
                products += y.T @ y
        i, j = np.tril_indices(size)
        entries = [np.concatenate([i, np.arange(size)]), np.concatenate([j, np.full(size, -1)]), np.concatenate([products[i, j], total])]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in entries], names=["i", "j", "v"])

    found = rows.select("x").mapInArrow(add, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    i, j, v = (found[c].to_numpy() for c in ("i", "j", "v"))
    mean, products = np.zeros(size), np.zeros((size, size))
    mean[i[j < 0]] = v[j < 0] / n
    i, j, v = i[j >= 0], j[j >= 0], v[j >= 0]
    products[i, j] = products[j, i] = v / n
    return mean, products - np.outer(mean, mean)


def fit_whitening(rows: DataFrame, components: int = 32) -> Whitening | None:
    """Learns from all rows of ``x``, whole numbers of one and the same count. None from an empty table.

    Two passes: exact sums, then products of what is centred. The driver gets a number for each
    pair of entries, MOST_DIMENSIONS of them a side at most, and never a vector.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = size["n"], size["width"] or 0
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} entries: at most {MOST_DIMENSIONS} can be whitened")
    if not n or not width:
        return None
    known = Whitening(n, _sums(rows, width), np.zeros((width, 0)), np.zeros(0), 0.0)
    centre = known.centre
    _, v = _covariance(rows, width, n, lambda x: x - centre, width)
    vectors, values = leading_components(v, components)
    return known._replace(components=vectors, eigenvalues=values, trace=float(np.trace(v)))


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The exact sum of (n * x - sum)**2 over the entries of each row; None where a long cannot hold it."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if reach < 1 << 62:
        far = n * x - np.array(sums, np.int64)
        if int(np.abs(far).max(initial=0)) ** 2 * len(sums) < 1 << 63:
            return (far * far).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """Whitened coordinates of ``vectors(id, vector)``: a row for each vector and component, numbered from 1.

    Vectors are rounded down to 64ths (``steps``). Columns: id, component, n, deviation (``deviations``),
    whitened, explained (the component's share of all variance) and identity_error: how far the
    whitened columns' covariance is from the identity at most. That is measured in a pass over all rows.

    Vectors that are null, or hold null or non-finite entries, are dropped; and so are those
    whose count of entries is not the most frequent one (the larger on a tie). Repeated rows and
    null ids are rows like others. Components that all vectors share alike (eigenvalue 0, or under
    LEAST of the largest) have no whitened coordinate: fewer come out, and none of vectors that
    are all equal, of a single vector, or of an empty table. Other columns are ignored.
    """
    good = vectors.filter(finite(F.col(vector))).select(F.col(id).alias("id"), steps(F.col(vector)).alias("x"))
    good = stored(good, "steps")
    sizes = good.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    width = sizes["width"] if sizes else 0
    rows = good.filter(F.size("x") == width)
    id_type = vectors.schema[id].dataType.simpleString()
    schema = f"`{id}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit_whitening(rows, components)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast((model.centre, model.shift, model.components / np.sqrt(model.eigenvalues)))

    def projected(x: np.ndarray) -> np.ndarray:
        centre, shift, axes = shared.value
        return ((x - centre) - shift) @ axes

    k = len(model.eigenvalues)
    _, again = _covariance(rows, width, model.n, projected, k)
    error = float(np.abs(again - np.eye(k)).max())
    n, sums, explained = model.n, model.sums, model.eigenvalues / model.trace

    @lean
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, x in _matrices(b, width):
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    b.column("id")[s].take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(each), pa.array(projected(x).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
                ], names=[id, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(out, schema)
