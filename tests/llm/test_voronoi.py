import math
import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm.voronoi import join_plan, top_k

LAYOUT = "vec_id long, embedding array<float>, label int, id string, v string, g string"


def brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault((i, tuple(math.floor(256 * x) for x in v)), None)
    good = list(good)
    out = []
    for q, a in good:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if (i, b) != (q, a))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return sorted(out)


def found(spark, rows, k=5, **options):
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], LAYOUT)
    return sorted(tuple(r) for r in top_k(df, F.col("id") % 50 == 0, k=k, **options).collect())


def vectors(n, width, seed, spread=1.0):
    draw = random.Random(seed)
    return [[float(int(256 * draw.gauss(0, spread)) / 256) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize(("width", "pivots", "chunk", "block"), [(4, 8, 16, 2), (16, 64, 64, 256), (2, 3, 7, 1)])
def test_agrees_with_brute_force(spark, width, pivots, chunk, block):
    rows = list(enumerate(vectors(700, width, width)))
    assert found(spark, rows, n_pivots=pivots, chunk_rows=chunk, block_rows=block) == brute(rows, 5)


def test_clusters_ties_and_copies(spark):
    centres = vectors(6, 3, 1, 8.0)
    rows = [(i, centres[i % 6] if i % 3 else [0.5, 0.25, -0.5]) for i in range(400)]
    assert found(spark, rows, n_pivots=5, chunk_rows=8, block_rows=4) == brute(rows, 5)


def test_awkward_rows(spark):
    rows = [(i, v) for i, v in enumerate(vectors(60, 3, 9))]
    rows += [(100, None), (150, []), (200, [1.0, None, 2.0]), (250, [float("nan"), 1.0, 1.0]), (300, [float("inf"), 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (350, [2.0]), (350, [2.0]), (350, [3.0, 1.0]), (400, [1e6, -1e6, 0.0])]
    assert found(spark, rows) == brute(rows, 5)
    assert found(spark, rows[:3]) == brute(rows[:3], 5)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert found(spark, []) == []


def test_components_beyond_the_bound_are_refused(spark):
    with pytest.raises(Exception, match="beyond 2\\^62"):
        found(spark, [(0, [1e30]), (1, [1.0])])


def share_that_meets(spark, rows, **options):
    """Pairs of a query and a row that are scored, of all pairs."""
    df = spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], LAYOUT)
    settings = {"k": 5, "id_col": "vec_id", "vector_col": "embedding", "scale": 256, "n_pivots": None, "chunk_rows": 64, "block_rows": 4}
    wanted, blocks, chunks, _ = join_plan(df, F.col("id") % 50 == 0, **{**settings, **options})
    sizes = wanted.join(blocks.selectExpr("piece AS block", "size(ids) AS q"), "block")
    sizes = sizes.join(chunks.selectExpr("piece AS chunk", "size(ids) AS d"), "chunk")
    met = sizes.agg(F.sum(F.col("q") * F.col("d"))).first()[0]
    every = [x.selectExpr("sum(size(ids))").first()[0] for x in (blocks, chunks)]
    return met / (every[0] * every[1])


def test_clustered_vectors_meet_a_part_of_the_rows(spark):
    draw = random.Random(5)
    centres = [[draw.gauss(0, 1) for _ in range(16)] for _ in range(40)]
    centres = [[x / math.sqrt(sum(y * y for y in c)) for x in c] for c in centres]
    rows = [(i, [x + draw.gauss(0, 0.01) for x in centres[draw.randrange(40)]]) for i in range(4000)]
    assert share_that_meets(spark, rows) <= 0.2
    assert found(spark, rows, chunk_rows=64, block_rows=4) == brute(rows, 5)


def test_the_bounds_hold_for_vectors_of_many_lengths(spark):
    draw = random.Random(6)
    rows = [(i, [draw.gauss(0, 1) * 10 ** draw.uniform(-2, 1) for _ in range(3)]) for i in range(1500)]
    assert found(spark, rows, n_pivots=40, chunk_rows=16, block_rows=4) == brute(rows, 5)


def test_a_score_beyond_a_long_is_refused(spark):
    with pytest.raises(Exception, match="beyond the range of a long"):
        found(spark, [(0, [3e9] * 8), (1, [3e9] * 8), (2, [1.0] * 8)])
