"""Whitening of embeddings by eigenvectors refined in mixed precision.

The covariance is summed exactly over all vectors. Its eigenvectors are computed
in single precision and corrected by the iteration of Ogita and Aishima, matrix
products in extended precision. Eigenvalues that this iteration cannot separate
form clusters, each solved anew within its own small subspace.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrace.llm.common import table

#: x = floor(SCALE · c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries whose x would not be held exactly by a double count as non-finite.
EXACT = 2.0**52
#: An eigenvalue of at most this share of the largest, per dimension, counts as zero.
ZERO = 1e-15
ROUNDS = 12
#: Eigenvalues count as apart beyond so many times the proven bound, so that no
#: single correction is large.
CLEAR = 16
#: Iterations with sub-solves after them, and how deep sub-solves may nest.
PASSES, DEPTH = 4, 6
_WIDE = np.longdouble


@dataclass(frozen=True)
class Moments:
    """Exact sums over the fit list: count, sums, and products about ``centre``."""

    n: int
    sums: list[int]
    centre: list[int]
    products: list[list[int]]

    def covariance(self) -> np.ndarray:
        """The covariance in extended precision: exact fractions, rounded once."""
        d = len(self.sums)
        off = [s - self.n * m for s, m in zip(self.sums, self.centre, strict=True)]
        out = np.zeros((d, d), _WIDE)
        for i in range(d):
            for j in range(i, d):
                exact = Fraction(self.n * self.products[i][j] - off[i] * off[j], self.n**2)
                high = float(exact)
                out[i, j] = out[j, i] = _WIDE(high) + _WIDE(float(exact - Fraction(high)))
        return out


@dataclass(frozen=True)
class Whitening:
    """Means as integer plus rest, unit eigenvectors (columns), and their eigenvalues."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def whole_vectors(df: DataFrame, column: str) -> DataFrame:
    """Rows whose vector takes part, with the vector as long integers x.

    A vector that is null or empty, or holds null, non-finite or huge entries (|x|
    above 2^52), takes no part, nor does one whose length is not the commonest
    (of equally common ones, the longest).
    """

    def entry(c: Column) -> Column:
        number = c.cast("double") * SCALE
        return F.when(F.abs(number) < EXACT - SHIFT, F.floor(number) + SHIFT)

    entries = F.transform(F.col(column), entry)
    fits = F.forall(F.col(column), lambda c: entry(c).isNotNull())
    usable = df.filter(F.col(column).isNotNull() & (F.size(column) > 0)).filter(fits)
    usual = (
        usable.groupBy(F.size(column).alias("size"))
        .agg(F.count(F.lit(1)).alias("held"))
        .orderBy(F.desc("held"), F.desc("size"))
        .first()
    )
    size = usual["size"] if usual else 0
    return usable.filter(F.size(column) == size).withColumn(column, entries.cast("array<bigint>"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def product_sums(z: np.ndarray) -> list[list[int]]:
    """Exact products zᵀz of integer rows.

    Double-precision products are exact while every partial sum stays below
    2^53; rows are cut so that it does. Larger entries are multiplied as Python
    integers.
    """
    top = int(np.abs(z).max(initial=0))
    rows = len(z) if top == 0 else (2**53 - 1) // top**2
    d = z.shape[1]
    if rows == 0:
        wide = z.astype(object)
        return (wide.T @ wide).tolist()
    total = np.zeros((d, d), object)
    for at in range(0, len(z), rows):
        part = z[at : at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total.tolist()


def fit_moments(vectors: DataFrame, column: str) -> Moments | None:
    """Sums and centred products of all rows, added up by Spark; None without rows.

    Each task gives one row per dimension, or pair of them, so what reaches the
    driver depends on the dimension only. Products are about the mean rounded
    to an integer, which keeps them exact.
    """
    sums = (
        vectors.select(F.posexplode(column).alias("i", "x"))
        .groupBy("i")
        .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.count(F.lit(1)).alias("n"))
        .orderBy("i")
        .collect()
    )
    if not sums:
        return None
    n, added = sums[0]["n"], [int(r["x"]) for r in sums]
    centre = [round(Fraction(s, n)) for s in added]

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        middle = np.array(centre, np.int64)
        total = None
        for rows in batches:
            part = np.array(product_sums(_matrix(rows[column]) - middle), object)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(centre))
            yield pd.DataFrame({"i": i, "j": j, "p": [Decimal(int(v)) for v in total[i, j]]})

    cells = (
        vectors.select(column)
        .mapInPandas(products, "i int, j int, p decimal(38,0)")
        .groupBy("i", "j")
        .agg(F.sum("p").alias("p"))
        .collect()
    )
    d = len(added)
    held = [[0] * d for _ in range(d)]
    for cell in cells:
        held[cell["i"]][cell["j"]] = held[cell["j"]][cell["i"]] = int(cell["p"])
    return Moments(n, added, centre, held)


def _correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One step of the iteration: (vectors, eigenvalues, bound of what is apart, error).

    From R = I − XᵀX and S = XᵀAX, entries of the correction are exact to second
    order for eigenvalues further apart than the bound; for others only
    orthogonality is mended.
    """
    r = np.eye(x.shape[1], dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    bound = 2 * (_norm(off) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    bound = CLEAR * bound
    apart = np.abs(gap) > bound
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(bound), float(_norm(e))


def _norm(m: np.ndarray) -> np.ndarray:
    """The Frobenius norm, which bounds the spectral norm."""
    return np.sqrt((m * m).sum())


def refined_eigenvectors(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric extended matrix.

    Starts from single precision and iterates until corrections vanish. Then
    each cluster of eigenvalues not told apart is projected on its subspace,
    shifted by its mean, and solved there by the same method, where its
    differences are no longer small; the iteration then joins the parts. Vectors
    of equal eigenvalues are some orthonormal basis.
    """
    a = a.astype(_WIDE)
    size = _norm(a)
    if len(a) == 1 or size == 0:
        return np.diag(a).copy(), np.eye(len(a), dtype=_WIDE)
    scaled = a / size
    noise = 8 * len(a) * np.finfo(_WIDE).eps
    x = np.linalg.eigh(scaled.astype(np.float32))[1].astype(_WIDE)
    for _ in range(PASSES):
        x, values, bound = _iterated(scaled, x)
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        solved = _orthonormal(x)
        s = solved.T @ (scaled @ solved)
        if _norm(s - np.diag(np.diag(s))) <= noise:
            x = solved
            break
        cuts = np.flatnonzero(-np.diff(values) > bound) + 1
        for cluster in np.split(np.arange(len(values)), cuts):
            if len(cluster) < 2 or depth == DEPTH:
                continue
            basis = solved[:, cluster]
            inner = basis.T @ (scaled @ basis - values[cluster].mean() * basis)
            # What is left of a true multiple eigenvalue is rounding, not a spread.
            if _norm(inner) > noise:
                turn = refined_eigenvectors((inner + inner.T) / 2, depth + 1)[1]
                solved[:, cluster] = basis @ turn
        x = _orthonormal(solved)
    values = np.einsum("ij,ij->j", x, scaled @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def _iterated(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Correction steps until they vanish, or no longer get smaller.

    A step that tells more eigenvalues apart than the one before can be larger,
    so only the third step without a gain ends the iteration.
    """
    best, idle = np.inf, 0
    for _ in range(ROUNDS):
        x, values, bound, error = _correct(a, x)
        if error < 4 * len(a) * np.finfo(_WIDE).eps:
            break
        idle = 0 if error < best / 2 else idle + 1
        best = min(best, error)
        if idle == 3:
            break
    return x, values, bound


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Mend orthogonality to extended precision by Newton steps to the polar factor."""
    for _ in range(6):
        r = np.eye(x.shape[1], dtype=_WIDE) - x.T @ x
        x = x + x @ r / 2
        if _norm(r) < np.sqrt(np.finfo(_WIDE).eps) / len(x):
            break
    return x


def fit_whitening(moments: Moments, components: int = COMPONENTS) -> Whitening:
    """The leading components; each vector's largest entry is positive."""
    v = moments.covariance()
    values, vectors = refined_eigenvectors(v)
    values, vectors = values[:components], vectors[:, :components]
    lead = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[lead, np.arange(vectors.shape[1])])
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    trace = np.trace(v)
    values = np.where(values > ZERO * len(v) * max(values.max(), 0), values, 0)
    explained = values / trace if trace > 0 else values
    off = [s - moments.n * m for s, m in zip(moments.sums, moments.centre, strict=True)]
    return Whitening(
        moments.n,
        np.array(moments.centre, np.int64),
        np.array([float(Fraction(o, moments.n)) for o in off]),
        moments.sums,
        vectors.astype(np.float64),
        values.astype(np.float64),
        explained.astype(np.float64),
    )


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the exact sum of (n·x − S)²; null where it is no long integer."""
    wide = max(n * int(np.abs(x).max(initial=0)), max(map(abs, sums)))
    if 4 * wide**2 * x.shape[1] < 2**63:
        v = n * x - np.array(sums, np.int64)
        return (v * v).sum(axis=1).tolist()
    if 2 * wide < 2**63:
        v = n * x - np.array(sums, np.int64)
        if int(np.abs(v).max()) ** 2 * x.shape[1] < 2**63:
            return (v * v).sum(axis=1).tolist()
    v = n * x.astype(object) - np.array(sums, object)
    return [int(s) if s < 2**63 else None for s in (v * v).sum(axis=1)]


def whitened(vectors: DataFrame, column: str, fitted: Whitening, out: str = "whitened") -> DataFrame:
    """Add ``out``: each row's deviation and whitened components, as a struct.

    A component without variance has null instead of a value. All other columns
    are kept.
    """
    added = T.StructType().add("deviation", "long").add("components", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*vectors.schema.fields]).add(out, added)
    used = fitted.values > 0
    turn = fitted.vectors / np.sqrt(np.where(used, fitted.values, 1))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            x = _matrix(rows[column])
            values = ((x - fitted.centre) - fitted.rest) @ turn
            listed = [[v if u else None for v, u in zip(row, used)] for row in values.tolist()]
            held = deviations(x, fitted.n, fitted.sums)
            rows[out] = [{"deviation": d, "components": c} for d, c in zip(held, listed)]
            yield rows

    return vectors.mapInPandas(apply, schema)


def identity_error(rows: DataFrame, values: str, fitted: Whitening) -> float | None:
    """Largest entry by which the covariance of whitened rows differs from the identity.

    Components without variance are left out; None if there is no other.
    """
    used = [i for i, v in enumerate(fitted.values) if v > 0]
    if not used:
        return None
    cells = [(i, j) for i in used for j in used if i <= j]
    names = [F.col(values)[i].alias(f"w{i}") for i in used]
    row = rows.select(*names).agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in cells]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, cells))


def op11_mixed_precision_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of all embeddings: one row per vector and component.

    Rows without a usable vector (``whole_vectors``) are not returned, null and
    repeated ids are. With no usable vector the result is empty. ``deviation``
    is null where it exceeds a long, ``whitened`` where the component has no
    variance.
    """
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double,"
        " explained double, identity_error double"
    )
    vectors = whole_vectors(rows, "embedding")
    moments = fit_moments(vectors, "embedding")
    if moments is None:
        return spark.createDataFrame([], schema)
    fitted = fit_whitening(moments)
    done = whitened(vectors, "embedding", fitted)
    error = identity_error(done, "whitened.components", fitted)
    explained = F.array(*[F.lit(float(v)) for v in fitted.explained])
    listed = done.select(
        "vec_id",
        F.col("whitened.deviation").alias("deviation"),
        F.posexplode("whitened.components").alias("place", "whitened"),
    )
    return listed.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
