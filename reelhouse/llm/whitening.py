"""Whitening components of embeddings by shifted CholeskyQR.

The centred rows are far too many to be held in one place, but the Gram matrix of any
small transform of them is a sum over rows. Each pass takes the Gram matrix of the rows
times the inverse of the triangular factor so far, and its Cholesky factor makes the rows
nearly orthonormal; the first is shifted, so that it exists for badly scaled rows too. The
product R of the factors is all that is left of the rows: its singular values and vectors
give the components with the accuracy of an orthogonal factorisation, which the covariance
matrix itself, with squared scales, would not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import pick, written

_ROUNDING = float(np.finfo(float).eps)
_ROWS = 4096  # rows that are transformed at once


@dataclass(frozen=True)
class Whitening:
    """Entries become ``floor(scale * entry) + offset``; ``passes`` bounds the Gram passes over the rows."""

    components: int = 32
    scale: int = 64
    offset: int = 1_000_000
    passes: int = 8


@dataclass(frozen=True)
class Fit:
    """``axes`` has a unit component in each column, ``values`` their eigenvalues, ``trace`` that of the covariance."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows minus their mean; the difference is exact up to its one division."""
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)


def whole_vectors(embeddings: DataFrame, how: Whitening = Whitening()) -> DataFrame:
    """(vec_id, x array<long>) of the rows whose vector is whole: not null, without null or non-finite entries."""
    rows = pick(embeddings, "vec_id", "embedding").withColumn("c", F.col("embedding").cast("array<double>"))
    bad = F.exists("c", lambda v: F.isnull(v) | F.isnan(v) | (F.abs(v) == float("inf")))
    x = F.transform("c", lambda v: F.floor(v * how.scale) + F.lit(how.offset))
    return rows.where(F.col("c").isNotNull() & ~bad).select("vec_id", x.alias("x"))


def _blocks(part: pd.Series) -> Iterator[np.ndarray]:
    for i in range(0, len(part), _ROWS):
        yield np.stack(part.iloc[i : i + _ROWS].to_numpy()).astype(np.int64)


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> np.ndarray:
    """The sum over all ``x`` of a function of blocks of them that gives ``size`` numbers.

    Every task sends its own sums by cell, so the driver gets ``size`` numbers whatever the tasks.
    """

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for part in parts:
            for block in _blocks(part["x"]):
                found = of(block)
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"cell": np.arange(size), "value": total})

    cells = rows.select("x").mapInPandas(partial, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(size, np.int64 if kind == "long" else float)
    for r in cells.collect():
        out[r["cell"]] = r["value"]
    return out


def _gram(rows: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``yᵀ y`` over the rows ``y`` that a function makes of blocks of ``x``, each of ``d`` numbers."""
    upper = np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        y = of(x)
        return (y.T @ y)[upper]

    found = np.zeros((d, d))
    found[upper] = _summed(rows, products, len(upper[0]), "double")
    return found + np.triu(found, 1).T


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """The upper Cholesky factor, with a shift that grows until there is one."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, len(gram) * _ROUNDING * max(np.trace(gram), np.finfo(float).tiny))


def fit(rows: DataFrame, d: int, n: int, how: Whitening = Whitening()) -> Fit:
    """The components of ``n`` rows (x of ``d`` longs each).

    A pass whose Gram matrix is the identity up to rounding ends the loop. Its symmetric
    square root is the last factor, so that rows which cannot become orthonormal, because
    their dimensions depend on each other, are described right too.
    """
    sums = _summed(rows, lambda x: x.sum(axis=0), d, "long")
    # Triangular factors are kept apart: rows go through their solves one after the other.
    factors: list[np.ndarray] = []
    trace = 0.0

    def orthogonal(x: np.ndarray) -> np.ndarray:
        y = ((n * x - sums) / n).T
        for r in factors:
            y = np.linalg.solve(r.T, y)
        return y.T

    for i in range(how.passes):
        gram = _gram(rows, d, orthogonal)
        if i == 0:
            trace = float(np.trace(gram))
            if trace == 0:
                break
            # The shift of Fukaya and others for the first pass, with the trace as bound of the norm.
            factors.append(_factor(gram, 11 * (n * d + d * (d + 1)) * _ROUNDING / 2 * trace))
            continue
        if i == how.passes - 1 or np.abs(gram - np.eye(d)).max() < 64 * _ROUNDING:
            break
        factors.append(_factor(gram, 0.0))
    values, vectors = np.linalg.eigh(gram)
    composed = (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T
    for r in reversed(factors):
        composed = composed @ r
    _, singular, axes = np.linalg.svd(composed)
    known = singular > singular[0] * d * 2.0**-44 if trace else np.zeros(d, bool)
    axes, singular = axes[known][: how.components].T, singular[known][: how.components]
    return Fit(n, sums, axes, singular**2 / n, trace / n)


def identity_error(rows: DataFrame, found: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(found.values)
    if not k:
        return 0.0
    mean = _summed(rows, lambda x: found.whitened(x).sum(axis=0), k, "double") / found.n
    covariance = _gram(rows, k, lambda x: found.whitened(x) - mean) / found.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum of (n x - S)² of each row, exactly; null where it is no long."""
    apart = n * x - sums
    rough = (apart.astype(float) ** 2).sum(axis=1)
    if not len(rough) or rough.max() < 2.0**62:
        return (apart * apart).sum(axis=1).tolist()
    exact = (apart.astype(object) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in exact]


def whitened(embeddings: DataFrame, how: Whitening = Whitening()) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    One row for each row of ``embeddings`` with a whole vector and each of the leading
    ``components``. Vectors of another length than most (of equally many, the longest) and
    empty ones count as not whole. Components without variance, up to rounding, cannot be
    scaled to one and are left out: rows all alike, or a single one, give no rows, nor does
    an empty table. Repeated rows and null ids stay. Other columns are passed over.
    """
    kept = written(whole_vectors(embeddings, how).withColumn("d", F.size("x")).where("d > 0"), "vectors")
    kind = kept.schema["vec_id"].dataType.simpleString()
    columns = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    most = kept.groupBy("d").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d")).alias("most")).first()["most"]
    if most is None:
        return embeddings.sparkSession.createDataFrame([], columns)
    n, d = most["n"], most["d"]
    rows = kept.where(F.col("d") == d).select("vec_id", "x")
    found = fit(rows, d, n, how)
    error = identity_error(rows, found)
    shares = (found.values / found.trace).tolist() if len(found.values) else []

    def project(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for i in range(0, len(part), _ROWS):
                some = part.iloc[i : i + _ROWS]
                x = np.stack(some["x"].to_numpy()).astype(np.int64)
                deviation = pd.Series(deviations(x, n, found.sums), dtype="Int64")
                yield pd.DataFrame({"vec_id": some["vec_id"].array, "deviation": deviation, "values": list(found.whitened(x))})

    projected = rows.mapInPandas(project, f"vec_id {kind}, deviation long, values array<double>")
    # Explained shares are as many as components, a parameter.
    parts = F.arrays_zip("values", F.array(*[F.lit(s) for s in shares]).cast("array<double>").alias("shares"))
    single = projected.select("vec_id", "deviation", F.posexplode(parts).alias("place", "part"))
    return single.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.col("part.values").alias("whitened"),
        F.col("part.shares").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
