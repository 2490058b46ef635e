"""PCA whitening of embeddings by spectrum slicing.

Vectors become whole numbers, each distinct one is fitted once, and Spark sums
their covariance: every task hands on the sums of its part, one row per
dimension. What comes to the driver is d sums and a d x d matrix, whatever the
number of rows.

There the leading eigenvalues are taken one by one. The pivots of the LDL'
factors of a shifted covariance tell how many eigenvalues lie below the shift
(Sylvester's law of inertia); bisection by these counts isolates the eigenvalue
with a given number, Rayleigh quotient iteration converges to it cubically, and
two more counts on either side of the result certify its number. Factors are
pivoted by Bunch and Kaufman's rule, so the counts hold for any symmetric matrix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import small_batches, store

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# entries of this size or more take no part, like those that are not finite
LIMIT = float(1 << 40)
# eigenvalues below this share of the trace are rounding, and have no component
RANK_SHARE = 1e-12
# vectors of eigenvalues nearer than this share of the norm are kept orthogonal one by one
CLOSE_SHARE = 1e-3

_PIVOT = (1 + math.sqrt(17)) / 8
_EPS = np.finfo(float).eps


# the spectrum of one symmetric matrix


def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie below the shift: the negative pivots of LDL' of matrix - shift I."""
    a = matrix - shift * np.eye(len(matrix))
    size, k, negative = len(a), 0, 0

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < size:
        column = np.abs(a[k + 1 :, k])
        most = column.max(initial=0.0)
        width = 1
        if abs(a[k, k]) < _PIVOT * most:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            if abs(a[k, k]) * row.max() < _PIVOT * most * most:
                if abs(a[r, r]) >= _PIVOT * row.max():
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    width = 2
        block, side = a[k : k + width, k : k + width], a[k + width :, k : k + width]
        if width == 2:
            # pivots of two are indefinite by the rule that picks them
            negative += 1
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(block, side.T)
        elif block[0, 0] != 0:
            negative += int(block[0, 0] < 0)
            a[k + 1 :, k + 1 :] -= np.outer(side[:, 0], side[:, 0] / block[0, 0])
        k += width
    return negative


class Spectrum:
    """Leading eigenpairs of a symmetric matrix, numbered from 1 by falling eigenvalue."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.size = len(matrix)
        radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        self.norm = float(np.max(np.diag(matrix) + radius, initial=0.0)) or 1.0
        self.tiny = 4 * self.size * _EPS * self.norm
        self.low = float(np.min(np.diag(matrix) - radius, initial=0.0)) - self.tiny
        self.high = self.norm + self.tiny
        self.counts: dict[float, int] = {}

    def below(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = below(self.matrix, shift)
        return self.counts[shift]

    def isolate(self, number: int) -> tuple[float, float]:
        """An interval that holds eigenvalue `number` alone, or a cluster no wider than rounding."""
        rank = self.size - number  # so many eigenvalues are smaller
        # the counts of earlier numbers give the first interval
        low = max((s for s, n in self.counts.items() if n <= rank), default=self.low)
        high = min((s for s, n in self.counts.items() if n > rank), default=self.high)
        while high - low > self.tiny and self.below(high) - self.below(low) > 1:
            low, high = self._halve(low, high, rank)
        return low, high

    def _halve(self, low: float, high: float, rank: int) -> tuple[float, float]:
        middle = (low + high) / 2
        return (low, middle) if self.below(middle) > rank else (middle, high)

    def _solve(self, shift: float, vector: np.ndarray) -> np.ndarray:
        shifted = self.matrix - shift * np.eye(self.size)
        try:
            found = np.linalg.solve(shifted, vector)
        except np.linalg.LinAlgError:
            found = np.linalg.solve(shifted + self.tiny * np.eye(self.size), vector)
        return found / np.linalg.norm(found)

    def pair(self, number: int, found: list[tuple[float, np.ndarray]]) -> tuple[float, np.ndarray]:
        """Eigenvalue and unit vector, orthogonal to those found before that lie close by."""
        low, high = self.isolate(number)
        rank = self.size - number
        while True:
            middle = (low + high) / 2
            near = [v for e, v in found if abs(e - middle) <= CLOSE_SHARE * self.norm + (high - low)]

            def apart(vector: np.ndarray, near=near) -> np.ndarray:
                for _ in range(2):
                    for v in near:
                        vector = vector - (v @ vector) * v
                return vector / np.linalg.norm(vector)

            vector = apart(np.random.default_rng(number).standard_normal(self.size))
            shift = middle
            for step in range(30):
                vector = apart(self._solve(shift, vector))
                image = self.matrix @ vector
                value = float(vector @ image)
                error = float(np.linalg.norm(image - value * vector))
                if error <= self.tiny:
                    break
                # the first steps keep the middle, which favours the interval's own vector
                shift = value if step > 1 and low <= value <= high else middle
            margin = self.tiny + error
            inside = low - margin <= value <= high + margin and error <= 1e3 * self.tiny
            if inside and self.below(value - margin) <= rank < self.below(value + margin):
                return value, vector
            if high - low <= self.tiny:
                raise ArithmeticError(f"eigenvalue {number} is not certified")
            low, high = self._halve(low, high, rank)

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to `most` eigenvalues above rounding, falling, and their vectors as columns."""
        least = RANK_SHARE * float(np.trace(self.matrix))
        found: list[tuple[float, np.ndarray]] = []
        for number in range(1, min(most, self.size) + 1):
            # by count alone: too few eigenvalues above the least
            if not least or self.below(least) > self.size - number:
                break
            value, vector = self.pair(number, found)
            vector = vector * np.sign(vector[np.abs(vector).argmax()])
            found.append((value, vector))
        values = np.array([e for e, _ in found])
        return values, np.array([v for _, v in found]).reshape(len(found), self.size).T


# vectors on Spark


def whole_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): x = floor(64 c) + 1,000,000 for each entry c.

    Left out: vectors that are null, hold a null, a NaN, an infinity or an entry of
    2^40 or more either way, and vectors of another length than most (of lengths
    equally frequent the larger counts).
    """
    fine = F.forall(vec_col, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))
    whole = F.transform(
        vec_col, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET)
    )
    rows = df.where(F.col(vec_col).isNotNull() & fine)
    rows = store(rows.select(F.col(id_col).alias("id"), whole.alias("x")))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    usual = lengths.first()
    return rows.where(F.size("x") == (usual["d"] if usual else 0))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)


class Fit:
    """Mean, covariance and leading components of the distinct vectors."""

    def __init__(self, vectors: DataFrame, most: int = COMPONENTS):
        self.distinct = store(vectors.select("x").distinct())
        first = vectors.select(F.size("x")).first()
        self.dims = first[0] if first else 0
        self._sum()
        covariance = self._covariance()
        self.trace = float(np.trace(covariance))
        self.values, self.vectors = Spectrum(covariance).leading(most)

    def _sum(self) -> None:
        dims = self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums = _matrix(batch, dims).sum(axis=0)
                rows = np.full(dims, batch.num_rows)
                yield pa.record_batch([np.arange(dims), sums, rows], names=["i", "s", "n"])

        parts = self.distinct.mapInArrow(run, "i long, s long, n long").groupBy("i")
        exact = parts.agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
        found = {r["i"]: r for r in exact.collect()}
        self.n = found[0]["n"] if found else 0
        self.sums = [int(found[i]["s"]) for i in range(len(found))]
        # the mean as a whole number and a rest, so that entries are centred without rounding
        self.near = [round(Fraction(s, self.n)) for s in self.sums]
        self.rest = [s - self.n * r for s, r in zip(self.sums, self.near, strict=True)]

    def centred(self) -> "Centred":
        return Centred(self.n, np.array(self.near, dtype=np.int64), self.rest)

    def _covariance(self) -> np.ndarray:
        dims, centre = self.dims, self.centred()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((dims, dims))
            for batch in batches:
                y = centre(_matrix(batch, dims))
                total += y.T @ y
            yield pa.record_batch([np.arange(dims), list(total)], names=["i", "row"])

        parts = self.distinct.mapInArrow(run, "i long, row array<double>")
        return _added(parts, dims, dims) / max(self.n, 1)

    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def identity_error(self) -> float | None:
        """Largest absolute entry of the covariance of the whitened distinct vectors minus the identity.

        Measured in a pass over the vectors, not derived from the eigenpairs.
        """
        dims, centre, weights = self.dims, self.centred(), self.weights()
        kept = weights.shape[1]
        if not kept:
            return None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((kept + 1, kept))
            for batch in batches:
                w = centre(_matrix(batch, dims)) @ weights
                total[:kept] += w.T @ w
                total[kept] += w.sum(axis=0)
            yield pa.record_batch([np.arange(kept + 1), list(total)], names=["i", "row"])

        parts = self.distinct.mapInArrow(run, "i long, row array<double>")
        moments = _added(parts, kept + 1, kept) / self.n
        covariance = moments[:kept] - np.outer(moments[kept], moments[kept])
        return float(np.abs(covariance - np.eye(kept)).max())


class Centred:
    """x - S / n as double; and n x - S exactly, for sums of squares."""

    def __init__(self, n: int, near: np.ndarray, rest: list[int]):
        self.n, self.near, self.rest = n, near, rest

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near) - np.array([r / max(self.n, 1) for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n x - S)^2, exactly; None beyond the range of a long."""
        z = x - self.near
        if np.abs(z).max(initial=0) >= 1 << 25:
            z = z.astype(object)
        squares = (z * z).sum(axis=1)
        cross = (z.astype(object) * np.array(self.rest, dtype=object)).sum(axis=1)
        own = sum(r * r for r in self.rest)
        found = (self.n**2 * int(a) - 2 * self.n * int(b) + own for a, b in zip(squares, cross, strict=True))
        return [d if d < 1 << 63 else None for d in found]


def _added(parts: DataFrame, rows: int, columns: int) -> np.ndarray:
    """The sum of the tasks' matrices, which came as rows (i, row)."""
    cells = parts.select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((rows, columns))
    for r in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"]
    return out


def whiten(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Vectors are fitted as ``whole_vectors`` gives them, each distinct one once; all
    rows are whitened, repeated rows and ids included. Components are unit
    eigenvectors of the covariance, numbered from 1 by falling eigenvalue, with
    their largest entry positive; those whose eigenvalue is rounding (one vector
    only, fewer dimensions, dependent ones) don't exist, and without any the result
    is empty, as it is for an empty table. Equal eigenvalues share a space, of which
    one basis is taken. deviation is the sum over dimensions of (n x - S)^2, null
    beyond the range of a long. Other columns are ignored. Sums of doubles are added
    as tasks end: reruns may differ in the last bits.
    """
    small_batches(df.sparkSession)
    vectors = whole_vectors(df, id_col, vec_col)
    kind = vectors.schema["id"].dataType.simpleString()
    schema = "id " + kind + ", component int, n long, deviation long, whitened double, explained double"
    fit = Fit(vectors, most)
    kept, dims = len(fit.values), fit.dims
    centre, weights, n = fit.centred(), fit.weights(), fit.n
    shares = fit.values / fit.trace if kept else fit.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if kept else ():
            x = _matrix(batch, dims)
            each = np.repeat(np.arange(len(x)), kept)
            columns = [
                batch.column("id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), n)),
                pa.array(centre.deviations(x), pa.int64()).take(pa.array(each)),
                pa.array((centre(x) @ weights).ravel()),
                pa.array(np.tile(shares, len(x))),
            ]
            names = ["id", "component", "n", "deviation", "whitened", "explained"]
            yield pa.record_batch(columns, names=names)

    error = F.lit(fit.identity_error()).cast("double")
    rows = vectors.mapInArrow(run, schema)
    return rows.withColumn("identity_error", error).withColumnRenamed("id", id_col)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
