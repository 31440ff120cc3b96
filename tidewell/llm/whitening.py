"""Embedding whitening: principal components by contour integration, coordinates of unit variance.

An entry ``c`` becomes the whole number ``floor(64 * c) + 1000000``. The fit list is every different vector
once, found by a shuffle of the vectors that collapses copies on the map side. Two passes over it give the exact
sums per dimension and the covariance of the centred vectors: a vector is centred as ``n * x - S`` in whole
numbers, so nothing is lost before multiplying. Spark sums the moments per entry of the matrix, and only they
reach the driver: ``d * (d + 1) / 2`` numbers for ``d`` dimensions, whatever the number of rows.

The eigenvalues wanted lie in intervals that inertia counts set (``feast.py``). Each interval is a task of its own:
quadrature of complex shifted solves projects onto its vectors, Rayleigh-Ritz extracts them. The counts must be
met, or the job fails; so no component is missed. A last Rayleigh-Ritz step over the vectors of all intervals
makes them orthogonal to each other. A component's sign makes its largest entry positive.

Then every row is centred, projected and divided by the root of the eigenvalue. ``identity_error`` is measured
over the fit list by one more pass.

Defined results: a row takes no part where its vector is null or empty, holds a null, a number that is not finite
or one of 2^46 or more in size (whose whole number is no longer exact), or has another length than most different vectors
(the greater length at equal numbers). Equal vectors weigh once but every row is returned, repeated or without an
id. Components whose eigenvalue is within rounding of zero (a share below 1e-12 of the largest) can't be whitened
and are left out; so a table with fewer than two different vectors, or an empty one, gives an empty result. A
``deviation`` beyond a long is null.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed, stored
from tidewell.llm.feast import intervals, rayleigh_ritz, solve_interval

SCALE, OFFSET = 64, 1_000_000
_LARGEST = float(2**46)
_ROWS = 4096
# An eigenvalue below this share of the largest counts as zero.
_ZERO = 1e-12
_LONG = 2**63


def whole_numbers(vector: Column) -> Column:
    """The vector in whole numbers; null where it takes no part."""
    v = vector.cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= _LARGEST))
    there = vector.isNotNull() & (F.size(vector) > 0) & ~odd
    return F.when(there, F.transform(v, lambda c: F.floor(c * SCALE) + OFFSET))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


@dataclass(frozen=True)
class Centre:
    """The number of different vectors and their sums per dimension."""

    n: int
    sums: list[int]

    def exact(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S`` in whole numbers, of Python's kind where 64 bits don't hold them."""
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [s - self.n * m for s, m in zip(self.sums, middle)]
        apart = x - np.array(middle, np.int64)
        if int(np.abs(apart).max(initial=0)) * self.n < _LONG // 4:
            return apart * self.n - np.array(rest, np.int64)
        return apart.astype(object) * self.n - np.array(rest, object)

    def deviations(self, exact: np.ndarray) -> list[int | None]:
        if int(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < _LONG:
            return (exact * exact).sum(1).tolist()
        exact = exact.astype(object)
        return [s if s < _LONG else None for s in (exact * exact).sum(1).tolist()]

    def centred(self, exact: np.ndarray) -> np.ndarray:
        return (exact / self.n).astype(float)


@dataclass(frozen=True)
class Components:
    """Eigenvalues, falling, the map onto the whitened components and each one's share of the trace."""

    centre: Centre
    values: np.ndarray
    onto: np.ndarray
    explained: list[float]


def _sums(lists: pa.Array):
    x = _matrix(lists)
    if int(np.abs(x).max()) * len(x) >= _LONG:
        x = x.astype(object)
    totals = [Decimal(int(s)) for s in x.sum(0)]
    return range(len(totals)), totals, [len(x)] * len(totals)


def _products(z: np.ndarray):
    """The entries of ``z^T z`` on and above the diagonal."""
    i, j = np.triu_indices(z.shape[1])
    return i, j, (z.T @ z)[i, j]


def _moments(parts: DataFrame, d: int) -> np.ndarray:
    """The symmetric matrix that the parts add up to."""
    out = np.zeros((d, d))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # d (d + 1) / 2 rows
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


_ENTRY = "i int, j int, value double"


def fit_list(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Each different vector of the usual length once, in whole numbers; stored."""
    x = vectors.select(whole_numbers(F.col(f"`{vec_col}`")).alias("x")).filter("x IS NOT NULL")
    different = stored(x.distinct(), "vectors")
    usual = different.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return different.filter(F.size("x") == (usual.d if usual else 0))


def fit(different: DataFrame, components: int) -> Components | None:
    """Centre and leading components of the fit list; None where nothing varies."""
    totals = map_rows(different, _sums, "i int, total decimal(38,0), n long", _ROWS)
    totals = totals.groupBy("i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("i").collect()
    if not totals:
        return None
    centre = Centre(totals[0].n, [int(r.total) for r in totals])
    parts = map_rows(different, lambda x: _products(centre.centred(centre.exact(_matrix(x)))), _ENTRY, _ROWS)
    covariance = _moments(parts, len(totals)) / centre.n
    norm = np.linalg.norm(covariance)
    if norm == 0:
        return None
    values, vectors = _leading(different.sparkSession, covariance / norm, components)
    values = values * norm
    kept = values > _ZERO * values.max(initial=0.0)
    values, vectors = values[kept], vectors[:, kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), range(len(values))])
    return Components(centre, values, vectors * signs / np.sqrt(values), (values / np.trace(covariance)).tolist())


def _leading(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a matrix of norm one, each interval solved by a task of its own."""
    parts = intervals(matrix, wanted, _ZERO / 10)
    shared = spark.sparkContext.broadcast(matrix)  # d * d numbers

    def solve(lows: pa.Array, highs: pa.Array, counts: pa.Array):
        found = [solve_interval(shared.value, *p) for p in zip(lows.to_pylist(), highs.to_pylist(), counts.to_pylist())]
        return [[v for values, vectors in found for v in vectors.T.tolist()]]

    tasks = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts))
    block = np.array([r.vector for r in map_rows(tasks, solve, "vector array<double>", 1).collect()]).T
    if block.shape[1] != sum(count for _, _, count in parts):
        raise ArithmeticError("the components found are not as many as inertia counts")
    values, vectors = rayleigh_ritz(matrix, block)
    return values[:wanted], vectors[:, :wanted]


def whiten(
    vectors: DataFrame, vec_col: str = "embedding", components: int = 16, carry: list[str] | None = None
) -> DataFrame:
    """One row for each row and component: ``row`` (the input, or its ``carry`` columns), ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    frame = packed(vectors, carry, x=whole_numbers(F.col(f"`{vec_col}`"))).filter("x IS NOT NULL")
    schema = T.StructType().add("row", frame.schema["row"].dataType)
    schema = schema.add("deviation", T.LongType()).add("z", T.ArrayType(T.DoubleType()))
    different = fit_list(vectors, vec_col)
    model = fit(different, components)
    if model is None:
        model = Components(Centre(0, []), np.zeros(0), np.zeros((0, 0)), [])
        frame = frame.filter("false")
    centre, onto, k = model.centre, model.onto, len(model.values)
    error = _identity_error(different, model) if k else 0.0

    def project(rows: pa.Array, lists: pa.Array):
        exact = centre.exact(_matrix(lists))
        return rows, centre.deviations(exact), list(centre.centred(exact) @ onto)

    done = map_rows(frame.filter(F.size("x") == len(centre.sums)), project, schema, _ROWS)
    done = done.select("row", "deviation", F.posexplode("z").alias("at", "whitened"))
    return done.select(
        "row",
        (F.col("at") + 1).alias("component"),
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(x) for x in model.explained or [0.0]]), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _identity_error(different: DataFrame, model: Components) -> float:
    """The largest entry, in size, of the whitened fit list's covariance less the identity."""
    centre, onto, k = model.centre, model.onto, len(model.values)

    def products(lists: pa.Array):
        z = centre.centred(centre.exact(_matrix(lists))) @ onto
        return _products(np.column_stack([z, np.ones(len(z))]))  # the column of ones sums the others

    moments = _moments(map_rows(different, products, _ENTRY, _ROWS), k + 1) / centre.n
    mean = moments[:k, k]
    return float(np.abs(moments[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())
