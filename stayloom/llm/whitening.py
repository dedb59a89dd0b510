"""Whitening of vectors on leading components that spectrum slicing finds.

1. Entries become whole numbers: floor(SCALE * c) + SHIFT. Everything summed over the table is a sum of whole numbers,
   so it does not depend on how the rows are partitioned.
2. The covariance is summed around a centre of whole numbers next to the mean; the rest of the mean, at most one half, is
   taken off exactly afterwards. Entries too large for exact products are summed in double precision, centred likewise.
3. The number of negative pivots of an LDLᵀ factorisation of V - sI is the number of eigenvalues below s (inertia). Such
   counts isolate the k-th largest eigenvalue in an interval of its own. Rayleigh quotient iteration then finds it with
   its vector, and two more counts, just below and just above it, certify that it is the k-th. Where eigenvalues cannot
   be told apart in double precision, an orthonormal basis of their common space is taken.

Only sums of the size of the dimension reach the driver: n, the sums and extremes of each dimension, and the matrix.
The vectors themselves are read by tasks, four times, and never moved.

Defined results: vectors that are null, or hold a null or a number that is not finite, are left out. So are vectors whose
length is not the most frequent one among those that remain (of equally frequent ones the longest) and empty ones; and
vectors with an entry whose whole number would not fit 64 bits. Repeated rows and rows without an id are rows like any
other. Components whose eigenvalue is zero within rounding cannot be whitened and are not returned, so a table of equal
vectors, of one vector, or of none gives no rows. ``deviation`` is null where the number does not fit 64 bits. Other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Numbers up to this are added and multiplied as 64-bit integers.
_EXACT = 1 << 62
#: Eigenvalues up to this share of the bound on the largest one are zero within rounding.
NOTHING = 1e-11
#: Rows of an Arrow block that are worked on at once.
_ROWS = 4096


@dataclass
class Spectrum:
    """Fit list and its leading components: ``vectors`` has a unit eigenvector in each row, ``values`` fall."""

    n: int
    sums: list[int]
    centre: list[int]
    spread: int
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


# --- eigenvalues -----------------------------------------------------------------------------------------------------

def negative_pivots(a: np.ndarray) -> int:
    """Negative entries of D in an LDLᵀ factorisation of the symmetric ``a``, which is its number of negative
    eigenvalues. Pivots of one or two rows are chosen by Bunch and Kaufman's rule, so none is divided by that is small
    beside its column."""
    a, n, below, k = a.copy(), len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        column = np.abs(a[k + 1:, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        most, two = (column.max() if len(column) else 0.0), False
        if max(abs(a[k, k]), most) == 0:
            k += 1
            continue
        if abs(a[k, k]) < alpha * most:
            others = np.abs(a[k:, r])
            others[r - k] = 0
            if abs(a[k, k]) * others.max() >= alpha * most * most:
                pass
            elif abs(a[r, r]) >= alpha * others.max():
                swap(k, r)
            else:
                two = True
                swap(k + 1, r)
        if not two:
            below += a[k, k] < 0
            rest = a[k + 1:, k].copy()
            a[k + 1:, k + 1:] -= np.outer(rest, rest / a[k, k])
            k += 1
        else:  # a pivot of two rows has one eigenvalue of either sign, or its signs are read off
            block = a[k:k + 2, k:k + 2].copy()
            below += int((np.linalg.eigvalsh(block) < 0).sum())
            rest = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
    return below


def _above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``."""
    return len(v) - negative_pivots(v - shift * np.eye(len(v)))


def _orthogonal(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for f in found:
            x = x - (f @ x) * f
    return x / np.linalg.norm(x)


def _solved(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    size = np.abs(v).max()
    for nudge in (0.0, 1e-15, 1e-14, 1e-13):
        try:
            y = np.linalg.solve(v - (shift + nudge * size) * np.eye(len(v)), x)
            if np.isfinite(y).all():
                return y / np.linalg.norm(y)
        except np.linalg.LinAlgError:
            continue
    return x


def _iterated(v: np.ndarray, low: float, high: float, found: list[np.ndarray],
              rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """Vector of an eigenvalue in (low, high]: inverse iteration until its quotient lies there, then Rayleigh's."""
    x, middle = _orthogonal(rng.standard_normal(len(v)), found), (low + high) / 2
    quotient = middle
    for _ in range(60):
        x = _orthogonal(_solved(v, middle, x), found)
        quotient = x @ v @ x
        if low <= quotient <= high:
            break
    for _ in range(12):
        y = _orthogonal(_solved(v, quotient, x), found)
        moved = y @ v @ y
        if not low <= moved <= high:
            break
        done = abs(moved - quotient) <= 1e-16 * abs(v).max() and abs(abs(x @ y) - 1) < 1e-15
        x, quotient = y, moved
        if done:
            break
    return float(quotient), x


def leading_components(v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the symmetric, positive semidefinite ``v``, falling, with unit vectors in rows."""
    d = len(v)
    scale = float(np.abs(v).sum(axis=1).max()) if d else 0.0  # no eigenvalue is larger
    if not scale > 0:
        return np.empty(0), np.empty((0, d))
    v, close = v / scale, d * np.finfo(float).eps
    counts = {-close: d, 1 + close: 0}  # shift: eigenvalues above it

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = _above(v, shift)
        return counts[shift]

    wanted = min(components, above(NOTHING))
    rng, found, values = np.random.default_rng(13), [], []
    while len(found) < wanted:
        k = len(found) + 1
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k)
        while (above(low) != k or above(high) != k - 1) and high - low > 2 * close:
            middle = (low + high) / 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        while True:
            value, x = _iterated(v, low, high, found, rng)
            near = np.linalg.norm(v @ x - value * x) <= 16 * close  # an eigenvector within rounding
            if high - low <= 2 * close or near and above(value - 16 * close) >= k > above(value + 16 * close):
                break  # not to be told apart from its neighbours, or certified
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        values.append(value)
        found.append(x)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * scale, np.array(found).reshape(-1, d)[order]


# --- passes over the table -------------------------------------------------------------------------------------------

def _whole(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the batch's vectors that count, and their whole numbers."""
    vectors = batch.column("vector")
    kept = np.asarray(vectors.value_lengths().fill_null(0)) == length
    rows = np.flatnonzero(kept)
    flat = vectors.filter(pa.array(kept)).flatten().cast(pa.float64())
    entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, length)
    with np.errstate(over="ignore", invalid="ignore"):
        floors = np.floor(SCALE * entries)
    fits = (np.abs(floors) < _EXACT).all(axis=1)  # false for what is not finite
    return rows[fits], floors[fits].astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            rows, x = _whole(part, length)
            if len(rows):
                yield part, rows, x


def _vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return df.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))


def _length(vectors: DataFrame) -> int:
    """Most frequent length of the vectors without nulls and numbers that are not finite."""
    good = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    row = vectors.filter(good & (F.size("vector") > 0)).groupBy(F.size("vector").alias("length")).agg(
        F.count("*").alias("n")).agg(F.max(F.struct("n", "length"))["length"].alias("length")).first()
    return row["length"] or 0


def _moments(vectors: DataFrame, length: int) -> tuple[int, list[int], list[int], list[int]]:
    """Number of vectors; sum, least and greatest whole number of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, least, most = 0, [0] * length, None, None
        for _, rows, x in _blocks(batches, length):
            n += len(rows)
            a, b = x.min(axis=0), x.max(axis=0)
            exact = max(-int(a.min()), int(b.max())) * len(rows) < _EXACT
            added = x.sum(axis=0) if exact else x.astype(object).sum(axis=0)
            sums = [s + int(t) for s, t in zip(sums, added)]
            least = a if least is None else np.minimum(least, a)
            most = b if most is None else np.maximum(most, b)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array([n] * length, pa.int64()), pa.array(range(length), pa.int32()),
                pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)), pa.array(least), pa.array(most)],
                names=["n", "i", "s", "a", "b"])

    parts = vectors.select("vector").mapInArrow(run, "n long, i int, s decimal(38,0), a long, b long")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("a").alias("a"),
                                  F.max("b").alias("b")).orderBy("i").collect()  # one row per dimension
    return (rows[0]["n"] if rows else 0, *([int(r[c]) for r in rows] for c in "sab"))


def _products(vectors: DataFrame, length: int, centre: list[int], exact: bool) -> np.ndarray:
    """Sum over all vectors of (x - centre)(x - centre)ᵀ."""
    kind = pa.int64() if exact else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, _, x in _blocks(batches, length):
            y = x - np.array(centre)
            # products of a block stay below 2^53 in all but odd tables, and there doubles are exact and fast
            small = int(np.abs(y).max()) ** 2 * len(y) < 1 << 53
            y = y.astype(float) if small or not exact else y
            part = y.T @ y
            part = part.astype(np.int64) if exact else part
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(length * length), pa.int32()), pa.array(total.reshape(-1), kind)], names=["at", "p"])

    parts = vectors.select("vector").mapInArrow(run, f"at int, p {'long' if exact else 'double'}")
    out = np.zeros(length * length)
    for row in parts.groupBy("at").agg(F.sum("p").alias("p")).collect():  # dimension squared, whatever the table
        out[row["at"]] = row["p"]
    out = out.reshape(length, length)
    return (out + out.T) / 2


def fit(df: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
        vector_column: str = "embedding") -> Spectrum | None:
    """Leading components of all vectors; None where there is nothing to whiten."""
    vectors = _vectors(df, id_column, vector_column)
    length = _length(vectors)
    n, sums, least, most = _moments(vectors, length) if length else (0, [], [], [])
    if not n:
        return None
    centre = [(2 * s + n) // (2 * n) for s in sums]
    spread = max(max(b - c, c - a) for a, b, c in zip(least, most, centre))
    products = _products(vectors, length, centre, spread * spread * n < _EXACT)
    rest = np.array([(s - n * c) / n for s, c in zip(sums, centre)])
    covariance = products / n - np.outer(rest, rest)
    values, rows = leading_components(covariance, components)
    return Spectrum(n, sums, centre, spread, covariance, values, rows) if len(values) else None


def _projection(model: Spectrum) -> tuple[np.ndarray, np.ndarray]:
    """Matrix and offset that take x - centre to its whitened coordinates."""
    rest = np.array([(s - model.n * c) / model.n for s, c in zip(model.sums, model.centre)])
    scaled = (model.vectors / np.sqrt(model.values)[:, None]).T
    return scaled, rest @ scaled


def identity_error(df: DataFrame, model: Spectrum, id_column: str = "vec_id",
                   vector_column: str = "embedding") -> float:
    """Largest entry of the covariance of the whitened vectors minus the identity, summed over the table itself."""
    length, k = len(model.centre), len(model.values)
    centre, (scaled, offset) = np.array(model.centre), _projection(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, total = np.zeros((k, k)), np.zeros(k)
        for _, _, x in _blocks(batches, length):
            w = (x - centre) @ scaled - offset
            gram += w.T @ w
            total += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(k * k + k), pa.int32()), pa.array(np.concatenate([gram.reshape(-1), total]))],
            names=["at", "p"])

    sums = np.zeros(k * k + k)
    parts = _vectors(df, id_column, vector_column).select("vector").mapInArrow(run, "at int, p double")
    for row in parts.groupBy("at").agg(F.sum("p").alias("p")).collect():
        sums[row["at"]] = row["p"]
    mean = sums[k * k:] / model.n
    return float(np.abs(sums[:k * k].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whitened(df: DataFrame, model: Spectrum, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened`` (array, one number per component): one row per vector of the fit list's kind."""
    length, n = len(model.centre), model.n
    centre, (scaled, offset) = np.array(model.centre), _projection(model)
    rest = [n * c - s for s, c in zip(model.sums, model.centre)]
    exact = length * (n * (model.spread + 1)) ** 2 < _EXACT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, x in _blocks(batches, length):
            y = x - centre
            if exact:
                deviation = pa.array(((n * y + np.array(rest)) ** 2).sum(axis=1), pa.int64())
            else:
                off = (n * y.astype(object) + np.array(rest, object)) ** 2
                deviation = pa.array([int(t) if t < 1 << 63 else None for t in off.sum(axis=1)], pa.int64())
            w = y @ scaled - offset
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()),
                                             pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("vec_id").take(pa.array(rows)), deviation, lists],
                                             names=["vec_id", "deviation", "whitened"])

    vectors = _vectors(df, id_column, vector_column)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def whitened_components(df: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
                        vector_column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    model = fit(df, components, id_column, vector_column)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None:
        kind = df.schema[id_column].dataType.simpleString()
        return df.sparkSession.createDataFrame([], (
            f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")).select(*names)
    shares = F.array(*(F.lit(float(e)) for e in model.explained))
    error = identity_error(df, model, id_column, vector_column)
    rows = whitened(df, model, id_column, vector_column)
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("_k", "w")).select(
        "vec_id", (F.col("_k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("w").alias("whitened"), F.get(shares, F.col("_k")).alias("explained"),
        F.lit(error).alias("identity_error"))
