"""Embedding whitening by spectrum slicing.

Entries become whole numbers, so sums and second moments are exact: tasks centre
their vectors at the rounded mean, multiply and add up whole numbers, and each
entry of the covariance is rounded once. The matrix has the size of one vector
squared and is the only thing that reaches the driver.

Eigenvalues are told apart by counting: an LDL^T factorisation of the shifted
covariance has as many positive pivots as eigenvalues lie above the shift
(Sylvester). Bisection on these counts gives every leading eigenvalue an interval of
its own, Rayleigh quotient iteration converges inside it, and two more counts
certify that the value found is the one with this number. Values that cannot be
told apart in double precision are taken together, with an orthonormal basis.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import python_ready, stored

_EPS = float(np.finfo(np.float64).eps)
#: Ratio that keeps the growth of Bunch-Kaufman pivoting least (a fixed value).
_PIVOT = (1 + math.sqrt(17)) / 8


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, negative and zero eigenvalues, from LDL^T with Bunch-Kaufman pivots."""
    a = np.array(matrix, dtype=np.float64)
    size = len(a)
    positive = negative = zero = 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    k = 0
    while k < size:
        own = abs(a[k, k])
        below = np.abs(a[k + 1 :, k])
        far = int(below.argmax()) + k + 1 if len(below) else k
        most = float(below.max()) if len(below) else 0.0
        if own == 0 and most == 0:
            zero, k = zero + 1, k + 1
            continue
        pair = False
        if own < _PIVOT * most:
            row = np.abs(a[far, k:])
            row[far - k] = 0
            widest = float(row.max())
            if own * widest < _PIVOT * most * most:
                if abs(a[far, far]) >= _PIVOT * widest:
                    swap(k, far)
                else:
                    swap(k + 1, far)
                    pair = True
        if pair:
            # such a block has a negative determinant: one eigenvalue of each sign
            positive, negative = positive + 1, negative + 1
            block, rest = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
            k += 2
        else:
            pivot, rest = a[k, k], a[k + 1 :, k]
            positive, negative = positive + (pivot > 0), negative + (pivot < 0)
            a[k + 1 :, k + 1 :] -= np.outer(rest, rest / pivot)
            k += 1
    return positive, negative, zero


class _Slices:
    """Shifts with the number of eigenvalues above each; a shift is factorised once."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        top = self.norm * (1 + 1e-12)
        self.known = {top: 0, -top or -1.0: len(matrix)}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia(self.matrix - shift * np.eye(len(self.matrix)))[0]
        return self.known[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue of this number."""
        low = max(s for s, count in self.known.items() if count >= number)
        return low, min(s for s, count in self.known.items() if count < number and s > low)


def _shifted_solve(matrix: np.ndarray, shift: float, right: np.ndarray, norm: float) -> np.ndarray:
    """(matrix - shift) \\ right; a shift that hits an eigenvalue is moved by a rounding error."""
    for nudge in (0.0, 1.0, -1.0, 7.0):
        try:
            found = np.linalg.solve(matrix - (shift + nudge * _EPS * norm) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    return right


def _rayleigh(matrix: np.ndarray, start: np.ndarray, norm: float) -> tuple[float, np.ndarray, float]:
    """Rayleigh quotient iteration: value, unit vector and residual, once the residual stops falling."""
    vector = start / np.linalg.norm(start)
    best = (0.0, vector, math.inf)
    for _ in range(12):
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if residual >= best[2]:
            break
        best = (value, vector, residual)
        if residual <= _EPS * norm:
            break
        moved = _shifted_solve(matrix, value, vector, norm)
        vector = moved / np.linalg.norm(moved)
    return best


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues above rounding error, falling, and their unit vectors as columns.

    Meant for a symmetric matrix without negative eigenvalues, such as a covariance.
    """
    matrix = np.asarray(matrix, dtype=np.float64)
    size = len(matrix)
    if not size:
        return np.zeros(0), np.zeros((0, 0))
    slices = _Slices(matrix)
    norm = slices.norm
    nought = 8 * size * _EPS * norm
    count = min(most, slices.above(nought)) if norm else 0
    rng = np.random.default_rng(7)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < count:
        number = len(values) + 1
        low, high = slices.around(number)
        middle = low + (high - low) / 2
        close = high - low <= 16 * _EPS * norm or not low < middle < high
        inside = slices.above(low) - slices.above(high)
        if inside > 1 and not close:
            slices.above(middle)
            continue
        if close:
            # one value, or several that double precision cannot tell apart: a basis of their space
            block = rng.standard_normal((size, inside))
            for _ in range(4):
                block, _ = np.linalg.qr(_shifted_solve(matrix, middle, block, norm))
            for column in block.T[: max(1, count - len(values))]:
                values.append(float(column @ matrix @ column))
                vectors.append(column)
            continue
        start = _shifted_solve(matrix, middle, rng.standard_normal(size), norm)
        for _ in range(2):
            start = _shifted_solve(matrix, middle, start / np.linalg.norm(start), norm)
        value, vector, residual = _rayleigh(matrix, start, norm)
        error = max(residual, size * _EPS * norm)
        certified = (
            low < value <= high
            and residual <= math.sqrt(size) * 64 * _EPS * norm
            and slices.above(value + error) < number <= slices.above(value - error)
        )
        if not certified:
            slices.above(middle)  # the quotient went to a neighbour: halve the interval
            continue
        values.append(value)
        vectors.append(vector)
    basis = np.array(vectors[:count]).T.reshape(size, count)
    for k in range(count):
        if k:
            basis[:, k] -= basis[:, :k] @ (basis[:, :k].T @ basis[:, k])
        basis[:, k] /= np.linalg.norm(basis[:, k])
    return np.array(values[:count]), basis


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: n vectors with sums per dimension, eigenpairs, trace."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def pivot(self) -> tuple[int, ...]:
        return _pivot(self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of whole numbers."""
        centred = (x - np.array(self.pivot, dtype=np.int64)).astype(np.float64)
        centred -= [(s - self.n * p) / self.n for s, p in zip(self.sums, self.pivot, strict=True)]
        return centred @ (self.vectors / np.sqrt(self.values))


def _pivot(n: int, sums: tuple[int, ...]) -> tuple[int, ...]:
    return tuple((2 * s + n) // (2 * n) for s in sums)


#: Entries up to this size become whole numbers that a long holds.
_LARGEST = 2.0**52


def whole_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, shift: int = 100_000
) -> DataFrame:
    """id and x = floor(scale * entry) + shift of every usable vector.

    Left out: null and empty vectors, those with a null or non-finite entry or one of 2**52 or
    more, and those of another length than the most frequent one (the longer of
    equally frequent ones).
    """
    given = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.transform(
        given, lambda c: F.when(F.abs(c) < F.lit(_LARGEST), F.floor(c * scale).cast("long") + F.lit(shift))
    )
    read = vectors.select(F.col(f"`{id_col}`").alias("id"), whole.alias("x")).filter(
        F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull())
    )
    usual = (
        read.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    )
    return read.filter(F.size("x") == (usual[0]["length"] if usual else 0))


def _sums(whole: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and exact sum of each dimension."""
    added = whole.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    rows = sorted(added.collect())
    return (rows[0]["n"] if rows else 0), tuple(int(r["s"]) for r in rows)


def _products(y: np.ndarray) -> np.ndarray:
    """y^T y of whole numbers, exact, as Python integers."""
    largest = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if largest < 1 << 53:
        return (lambda f: f.T @ f)(y.astype(np.float64)).astype(np.int64).astype(object)
    if largest < 1 << 63:
        return (y.T @ y).astype(object)
    big = y.astype(object)
    return big.T @ big


def _moments(whole: DataFrame, pivot: tuple[int, ...]) -> dict[tuple[int, int], int]:
    """Exact sums of products of the centred vectors, upper triangle."""
    size = len(pivot)
    at = np.triu_indices(size)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                found = _products(np.stack(batch["x"].to_list()) - np.array(pivot, dtype=np.int64))[at]
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"i": at[0], "j": at[1], "m": [Decimal(int(v)) for v in total]})

    parts = whole.select("x").mapInPandas(add, "i int, j int, m decimal(38,0)")
    return {(r["i"], r["j"]): int(r["m"]) for r in parts.groupBy("i", "j").agg(F.sum("m").alias("m")).collect()}


def fit(whole: DataFrame, components: int = 8) -> Whitening:
    """Eigenpairs of the covariance (divisor n) of all rows of :func:`whole_vectors`."""
    python_ready(whole.sparkSession)
    n, sums = _sums(whole)
    size = len(sums)
    if not n:
        return Whitening(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    pivot = _pivot(n, sums)
    rest = [s - n * p for s, p in zip(sums, pivot, strict=True)]
    covariance = np.zeros((size, size))
    for (i, j), m in _moments(whole, pivot).items():
        covariance[i, j] = covariance[j, i] = (n * m - rest[i] * rest[j]) / (n * n)  # rounded once
    values, vectors = leading_eigenpairs(covariance, components)
    return Whitening(n, sums, math.fsum(np.diag(covariance)), values, vectors)


def _deviation(model: Whitening) -> Column:
    """Exact sum over dimensions of (n * x - S)^2."""
    sums = F.array(*[F.lit(s).cast("long") for s in model.sums])
    away = F.zip_with("x", sums, lambda x, s: (x * F.lit(model.n).cast("long") - s).cast("decimal(19,0)"))
    return F.aggregate(
        away, F.lit(0).cast("decimal(38,0)"), lambda total, z: (total + z * z).cast("decimal(38,0)")
    )


def whiten(
    vectors: DataFrame,
    components: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    shift: int = 100_000,
) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation (decimal), whitened,
    explained, identity_error.

    Vectors are chosen as :func:`whole_vectors` says, and all of them are fitted.
    Components are those with an eigenvalue above rounding error, so there may be
    fewer than asked for, and none for equal vectors. identity_error is the
    largest entry of the whitened coordinates' covariance minus the identity,
    measured on the result. Repeated rows count one by one; an empty table gives an empty result;
    other columns are not read.
    """
    whole = whole_vectors(vectors, id_col, vector_col, scale, shift)
    model = fit(whole, components)
    count = len(model.values)
    if not count:
        return whole.limit(0).select(
            F.col("id").alias(id_col), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
            F.lit(0).cast("decimal(38,0)").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")],
        )

    @F.pandas_udf("array<double>")
    def projected(x: pd.Series) -> pd.Series:
        return pd.Series(list(model.project(np.stack(x.to_list()))) if len(x) else [], index=x.index, dtype="object")

    told = stored(whole.select("id", _deviation(model).alias("deviation"), projected("x").alias("w")))
    means = told.agg(*[F.avg(F.col("w")[k]).alias(f"m{k}") for k in range(count)]).first()
    centred = [F.col("w")[k] - F.lit(means[k]) for k in range(count)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    spread = told.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(spread, pairs, strict=True))
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return told.select("id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("k")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
