"""Embedding whitening by spectrum slicing.

The covariance of quantised vectors is summed up exactly, in whole numbers, by the tasks. Its leading eigenvalues are
isolated by bisection on inertia counts: by Sylvester's law an LDL^T factorisation of the covariance less a shift has as many
positive pivots as there are eigenvalues above the shift. From the middle of an isolating interval Rayleigh quotient
iteration converges cubically, and two counts, just above and just below the value found, certify its number. Vectors
are then centred, projected on the eigenvectors and divided by the eigenvalues' roots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Steps of an entry's unit, what is added to the whole number, components, rows multiplied at a time.
SCALE, SHIFT, COMPONENTS, ROWS = 1024, 100_000, 8, 4096
#: The threshold of Bunch and Kaufman's pivoting; rounding errors that an eigenvalue may be off, in units of the largest.
ALPHA, EPS = (1 + math.sqrt(17)) / 8, 2.0**-52


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix lie above shift: the positive pivots of LDL^T with pivots of one or two
    rows, of which the latter have one eigenvalue of either sign."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    while k < n:
        step, chosen = 1, k
        if k < n - 1:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            largest, own = column[r - k - 1], abs(a[k, k])
            if max(largest, own) == 0:
                k += 1
                continue
            if own < ALPHA * largest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if own * other >= ALPHA * largest * largest:
                    pass
                elif abs(a[r, r]) >= ALPHA * other:
                    chosen = r
                else:
                    chosen, step = r, 2
        at = k + step - 1
        if chosen != at:
            a[[at, chosen]] = a[[chosen, at]]
            a[:, [at, chosen]] = a[:, [chosen, at]]
        if step == 1:
            positive += a[k, k] > 0
            if a[k, k] and k < n - 1:
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k] / a[k, k], a[k, k + 1 :])
        else:
            positive += 1
            if k < n - 2:
                a[k + 2 :, k + 2 :] -= a[k + 2 :, k : k + 2] @ np.linalg.solve(a[k : k + 2, k : k + 2], a[k : k + 2, k + 2 :])
        k += step
    return int(positive)


class Slicer:
    """Leading eigenpairs of a symmetric matrix without negative eigenvalues; counts are kept and used again."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.counts = matrix, {}
        self.top = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
        self.fine = 8 * len(matrix) * EPS * self.top

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, i: int) -> tuple[float, float]:
        """An interval (lo, hi] that holds eigenvalue number i, counted from 1, and no other, or else is as fine as rounding."""
        lo = max((s for s, c in self.counts.items() if c >= i), default=-self.top * EPS - 1e-300)
        hi = min((s for s, c in self.counts.items() if c < i), default=self.top * (1 + EPS) + 1e-300)
        while hi - lo > self.fine and not (self.counts.get(lo) == i and self.counts.get(hi) == i - 1):
            mid = (lo + hi) / 2
            if self.count(mid) >= i:
                lo = mid
            else:
                hi = mid
            self.count(lo), self.count(hi)
        return lo, hi

    def solve(self, shift: float, b: np.ndarray) -> np.ndarray:
        """(matrix - shift)^-1 b; where that is singular to the last bit, at a shift next to it."""
        n = len(self.matrix)
        for push in (0.0, 1.0, 3.0, 9.0):
            try:
                z = np.linalg.solve(self.matrix - (shift + push * EPS * self.top) * np.eye(n), b)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(z).all():
                return z
        return b

    def one(self, i: int, lo: float, hi: float, found: np.ndarray) -> tuple[float, np.ndarray]:
        """The eigenpair in an isolating interval by Rayleigh quotient iteration. Where a quotient leaves the interval, it is
        halved by a count, and the iteration begins at its middle."""
        clear = lambda z: unit(z - found.T @ (found @ z))  # noqa: E731  orthogonal to the eigenvectors found before
        rng = np.random.default_rng(i)
        for _ in range(200):
            shift, z, left = (lo + hi) / 2, clear(rng.normal(size=len(self.matrix))), False
            z, last = clear(self.solve(shift, z)), np.inf
            for _ in range(40):
                value = float(z @ self.matrix @ z)
                if not lo < value <= hi:
                    left = True
                    break
                residual = float(np.linalg.norm(self.matrix @ z - value * z))
                if residual <= self.fine / 8 or residual >= last / 2 and residual <= self.fine:
                    if self.certified(i, value):
                        return value, z
                    left = True
                    break
                last = residual
                z = clear(self.solve(value, z))
            if left and hi - lo <= self.fine:
                break
            lo, hi = (shift, hi) if self.count(shift) >= i else (lo, shift)
        return self.cluster(lo, hi, 1, found)[0]

    def certified(self, i: int, value: float) -> bool:
        return self.count(value - self.fine) >= i and self.count(value + self.fine) < i

    def cluster(self, lo: float, hi: float, many: int, found: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """`many` eigenpairs of values that rounding can't tell apart: inverse iteration on a block and Rayleigh-Ritz in it."""
        z = np.random.default_rng(many).normal(size=(len(self.matrix), many))
        for _ in range(4):
            z = z - found.T @ (found @ z)
            z = np.linalg.qr(self.solve((lo + hi) / 2, z))[0]
        z = np.linalg.qr(z - found.T @ (found @ z))[0]
        inner, turn = np.linalg.eigh(z.T @ self.matrix @ z)
        return [(float(v), unit(z @ t)) for v, t in zip(inner[::-1], turn.T[::-1])]

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The `most` largest eigenvalues in falling order, and their unit eigenvectors as rows, the largest entry of each
        positive. Values that are 0 to rounding are left out."""
        values, vectors = [], np.zeros((0, len(self.matrix)))
        while len(values) < min(most, len(self.matrix)) and self.top > 0:
            i = len(values) + 1
            lo, hi = self.interval(i)
            if hi <= 2 * self.fine:
                break
            last = self.count(lo)
            if last == i and self.count(hi) == i - 1:
                pairs = [self.one(i, lo, hi, vectors)]
            else:
                pairs = self.cluster(lo, hi, min(last, most, len(self.matrix)) - i + 1, vectors)
            pairs = [(value, z) for value, z in pairs if value > 2 * self.fine]
            if not pairs:
                break
            for value, z in pairs:
                values.append(value)
                vectors = np.vstack([vectors, z * np.sign(z[np.abs(z).argmax()])])
        order = np.argsort(-np.array(values), kind="stable")
        return np.array(values)[order], vectors[order]


def unit(z: np.ndarray) -> np.ndarray:
    return z / max(np.linalg.norm(z), 1e-300)


class Whitening(NamedTuple):
    n: int
    centre: np.ndarray  # whole numbers next to the means
    rest: list[int]  # per dimension, the sum of what vectors are above the centre
    trace: float
    values: np.ndarray
    vectors: np.ndarray  # components x dimensions


def quantised(vector: Column) -> Column:
    """The vector as whole numbers floor(SCALE * entry) + SHIFT, or null if it is null or empty or has an entry that is
    null, not finite, or beyond a long."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= 2.0**52)
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return F.when((F.size(vector) > 0) & ~F.exists(vector, bad), whole)


def as_matrix(lists: pa.ListArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def sums(x: DataFrame, centre: np.ndarray, products: bool) -> tuple[int, list[int], dict[tuple[int, int], int]]:
    """Number of rows of x (column x, whole numbers), the sums of their entries less the centre and, if asked for, the sums of
    all products of two of these, exactly. A task gives one row per sum, and these are added up as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(len(centre), object), np.zeros((len(centre), len(centre)), object)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                y = as_matrix(batch.column("x").slice(lo, ROWS)) - centre
                n += len(y)
                plain = len(y) and float(np.abs(y).max()) ** 2 * len(y) < 2.0**52  # every sum is exact in floating point
                first += y.astype(float if plain else object).sum(axis=0).astype(np.int64 if plain else object)
                if products:
                    z = y.astype(float if plain else object)
                    second += (z.T @ z).astype(np.int64 if plain else object)
        d = len(centre)
        rows = [(-1, -1, n)] + [(i, -1, first[i]) for i in range(d)] + ([(i, j, second[i, j]) for i in range(d) for j in range(i, d)] if products else [])
        i, j, v = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(k)) for k in v], pa.decimal128(38, 0))], ["i", "j", "v"])

    found = {(r.i, r.j): int(r.v) for r in x.select("x").mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    return found.get((-1, -1), 0), [found.get((i, -1), 0) for i in range(len(centre))], found


def fit(x: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of x (column x: arrays of whole numbers, of one length); None without rows.

    The driver holds one number for each two dimensions, whatever the number of rows. Every vector is centred by the whole numbers next to the
    means before it is multiplied, and what is left of the means is taken off in exact arithmetic.
    """
    top = x.select(F.size("x").alias("d")).limit(1).first()
    if top is None:
        return None
    n, total, _ = sums(x, np.full(top.d, SHIFT, np.int64), False)
    centre = np.array([SHIFT + round(t / n) for t in total], np.int64)
    n, rest, found = sums(x, centre, True)
    v = np.zeros((top.d, top.d))
    for i in range(top.d):
        for j in range(i, top.d):
            v[i, j] = v[j, i] = (n * found[i, j] - rest[i] * rest[j]) / (n * n)  # whole numbers, rounded once
    values, vectors = Slicer(v).leading(most)
    return Whitening(n, centre, rest, float(np.trace(v)), values, vectors)


def projected(x: Column, model: Whitening, spark) -> Column:
    """A struct (deviation, whitened) of each quantised vector: the sum over dimensions of (n * x - S)^2, null where it is
    beyond a long, and the whitened components."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("deviation long, whitened array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        turn, mean = (m.vectors / np.sqrt(m.values)[:, None]).T, np.array([r / m.n for r in m.rest])
        for batch in batches:
            y = np.array(batch.tolist(), np.int64).reshape(len(batch), -1) - m.centre if len(batch) else np.zeros((0, len(m.centre)), np.int64)
            plain = len(y) and (m.n * float(np.abs(y).max()) + max(map(abs, m.rest))) ** 2 * y.shape[1] < 2.0**62
            d = m.n * y.astype(np.int64 if plain else object) - np.array(m.rest, np.int64 if plain else object)
            deviation = [k if k < 1 << 63 else None for k in (d * d).sum(axis=1).tolist()]
            yield pd.DataFrame({"deviation": pd.array(deviation, "Int64"), "whitened": list((y - mean) @ turn)})

    return run(x)


def whiten(docs: DataFrame, vector: str = "embedding", most: int = COMPONENTS, out: str = "white") -> DataFrame:
    """The rows of docs whose vector counts, with all other columns and a struct `out` (replacing one of that name): n, deviation,
    whitened and explained (arrays, one entry per component), identity_error.

    Vectors that are null, empty, or hold an entry that is null, not finite or beyond a long are dropped; so are those
    of another length than most have (of equally frequent ones, the longest). Repeated rows and null ids count as they
    stand. There are min(most, dimensions) components, fewer where the covariance has lower rank; of equal vectors, or
    of one, there are none. An empty table stays empty. Whitened rows are written to the shared folder, and their own
    covariance, centred by their means, is measured there: identity_error, null without components.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("_stratalake_x", quantised(F.col(vector))).where("_stratalake_x IS NOT NULL")
    lengths = rows.groupBy(F.size("_stratalake_x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    model = fit(rows.where(F.size("_stratalake_x") == lengths.d).select(F.col("_stratalake_x").alias("x")), most) if lengths else None
    if model is None:
        none = F.struct(*[F.lit(None).cast(t).alias(c) for c, t in (("n", "long"), ("deviation", "long"), ("whitened", "array<double>"), ("explained", "array<double>"), ("identity_error", "double"))])
        return docs.where("false").withColumn(out, none)
    rows = stored(rows.where(F.size("_stratalake_x") == lengths.d).withColumn("_stratalake_p", projected(F.col("_stratalake_x"), model, spark)).drop("_stratalake_x"), "whitened")
    entry = lambda k: F.get("_stratalake_p.whitened", k)
    k, error = len(model.values), None
    if k:
        means = rows.agg(*[F.avg(entry(i)).alias(f"m{i}") for i in range(k)]).first()
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        found = rows.agg(*[F.avg((entry(i) - F.lit(means[i])) * (entry(j) - F.lit(means[j]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    return rows.withColumn(out, F.struct(
        F.lit(model.n).cast("long").alias("n"), F.col("_stratalake_p.deviation").alias("deviation"), F.col("_stratalake_p.whitened").alias("whitened"),
        explained.alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )).drop("_stratalake_p")
