import math

import numpy as np
import pytest
from helpers import CLASHING

from tidewell.llm.feast import above, inertia, intervals, rayleigh_ritz, solve_interval
from tidewell.llm.queries import QUERIES
from tidewell.llm.whitening import whiten


def turned(values, seed=0):
    """A symmetric matrix with these eigenvalues."""
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    return (basis * np.array(values)) @ basis.T


def whole(vector):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in vector)


def usable(vector):
    return vector is not None and len(vector) > 0 and all(c is not None and math.isfinite(c) for c in vector)


def check(found, rows, components=16):
    """Every figure against plain numpy and exact whole numbers."""
    rows = [(i, whole(v)) for i, v in rows if usable(v)]
    different = sorted({x for _, x in rows})
    n, sums = len(different), [sum(c) for c in zip(*different)]
    x = np.array(different, float) - np.array(sums, float) / n
    covariance = x.T @ x / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    got = {}
    for r in found:
        got.setdefault((r.row.vec_id, r.deviation), {})[r.component] = r
        assert r.n == n
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert abs(r.identity_error) < 1e-8
    assert len(found) == k * len(rows)
    signs = None
    for i, own in rows:
        deviation = sum((n * c - s) ** 2 for c, s in zip(own, sums))
        parts = got[i, deviation]
        assert sorted(parts) == list(range(1, k + 1))
        z = np.array([parts[c].whitened for c in range(1, k + 1)])
        expected = (np.array(own, float) - np.array(sums) / n) @ vectors[:, :k] / np.sqrt(values[:k])
        if signs is None:
            signs = np.sign(z) * np.sign(expected)
        assert z == pytest.approx(expected * signs, abs=1e-6)


def test_inertia_counts_the_eigenvalues_of_each_sign():
    draw = np.random.default_rng(1)
    for _ in range(200):
        d = draw.integers(1, 12)
        m = draw.normal(size=(d, d))
        m = np.round(m + m.T) if draw.random() < 0.4 else m + m.T
        e = np.linalg.eigvalsh(m)
        assert inertia(m) == ((e > 1e-9).sum(), (e < -1e-9).sum(), (abs(e) <= 1e-9).sum())
    assert inertia(np.zeros((0, 0))) == (0, 0, 0)


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 0.01, 64),
        np.logspace(0, -10, 40),
        [1.0] * 30,
        [0.9] * 20 + [0.9 - 1e-10] * 3 + [0.1] * 5,
        [1, 1 - 1e-6, 1 - 2e-6, 0.5, 0.5, 0.2, 0.1],
        [1.0],
    ],
)
def test_intervals_hold_the_largest_eigenvalues_and_their_vectors_are_found(values):
    a = turned(values)
    a = a / np.linalg.norm(a)
    e = np.sort(np.linalg.eigvalsh(a))[::-1]
    parts = intervals(a, 16, 1e-13)
    for low, high, count in parts:
        assert above(a, low) - above(a, high) == count
    block = np.concatenate([solve_interval(a, *p)[1] for p in parts], axis=1)
    found, vectors = rayleigh_ritz(a, block)
    k = min(16, len(e))
    assert found[:k] == pytest.approx(e[:k], abs=1e-13)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12


@pytest.mark.parametrize("shape", [(300, 24), (40, 5), (10, 20)])
def test_whitened_rows(spark, shape):
    draw = np.random.default_rng(shape[0])
    x = draw.normal(size=shape) @ draw.normal(size=(shape[1], shape[1])) * 0.3
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(i, x[0].tolist()) for i in range(1000, 1200)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    check(found.collect(), rows)


def test_awkward_vectors(spark):
    rows = [
        (1, [0.5, 0.25, -1.0]), (1, [0.5, 0.25, -1.0]), (None, [0.1, 0.2, 0.3]), (2, None), (3, []), (4, [1.0, None, 2.0]),
        (5, [float("nan"), 0.0, 0.0]), (6, [float("inf"), 0.0, 0.0]), (7, [0.5, 0.25]), (8, [3.0, -2.0, 7.5]), (9, [0.5, 0.25, -1.001]),
        (10, [1e300, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in [*CLASHING, "x", "z", "component", "at"]:
        df = df.selectExpr("*", f"'extra' AS `{name}`")
    found = whiten(df).collect()
    assert {*CLASHING, "x", "vec_id"} <= set(found[0].row.asDict())
    check(found, [r for r in rows if r[0] not in (7, 10)])


def test_nothing_varies_and_no_rows(spark):
    layout = "vec_id long, embedding array<float>"
    columns = ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [0.5, 1.0])] * 3, [(1, None)], [(1, [float("nan")])]):
        found = whiten(spark.createDataFrame(rows, layout))
        assert found.columns == columns
        assert found.collect() == []


def test_numbers_too_large_for_a_long(spark):
    big = float(2**45)
    rows = [(i, [big * (-1) ** i, float(i)]) for i in range(64)]
    found = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    assert len(found) == 64
    assert {r.deviation for r in found} == {None}
    assert {round(abs(r.whitened), 6) for r in found} == {1.0}


def test_query_over_the_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = QUERIES["op12_embedding_whitening"](spark, sf_dir)
    assert dict(df.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    check(df.selectExpr("struct(vec_id) AS row", "*").collect(), rows)
