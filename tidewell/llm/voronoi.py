"""Exact top-k by inner product as a Voronoi kNN join.

Vectors become whole numbers, ``floor(scale * x)``. An inner product is turned into a distance by one more
coordinate: data get ``sqrt(M^2 - |x|^2)`` with M the longest norm, queries get 0, and then
``distance^2 = |q|^2 + M^2 - 2 * score``, so the nearest are those of the highest scores.

Queries and data are grouped by their nearest pivot; there are four times as many pivots as the root of the rows, up to ``MAX_PIVOTS``. A
data group's summary holds its smallest distances to the pivot. A query's bound on its k-th distance is the k-th
smallest of "distance to a pivot + summary distance" over the groups. A data row can only matter to the query if

* its distance to its own pivot differs from the query's by no more than the bound (both sides of the triangle), and
* the plane between its pivot and the query's lies within the bound, as the row is on its pivot's side.

Pivots are numbered so that neighbours in number are neighbours in space. Rows are stored in chunks, and queries in
blocks, in the order of their groups and of the distance to the pivot. A chunk knows the range of distances it holds of each of its groups, a
block asks for what any of its queries needs, and only the chunks asked for meet it. Chunks are
scored exactly in whole numbers and give their k best to a ranked merge.

Equal vectors score alike, so only the ``k + 1`` smallest ids of each different vector are candidates
(one more than k, as a query is no candidate of its own). That is exact and keeps a vector that fills a
third of the table from filling a group.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part, nor do
rows without an id; shorter vectors count as filled with zeros; rows that agree in id and vector are one;
ties go to the smaller id; a query without candidates gives no rows; an empty table gives an empty result.
A component beyond 2^62 in size is refused with an error, and so is a score beyond the range of a long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.llm.common import map_rows, stored

_LONG = 2**63 - 1
MAX_PIVOTS = 1024
_COARSE = 1e8


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v``: the vectors that take part, as whole numbers without trailing zeros."""
    vector = F.col(f"`{vector_col}`")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    whole = F.transform(vector, lambda x: F.floor(scale * x.cast("double")))
    good = F.col(f"`{id_col}`").isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: finite(x.cast("double")))
    tame = F.forall(vector, lambda x: F.abs(scale * x.cast("double")) < 2.0**62)
    checked = F.when(tame, whole).otherwise(F.raise_error(F.lit("a component is beyond 2^62")))
    return vectors.filter(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), checked.alias("v")).distinct()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled with zeros."""
    if len(column) == 0:
        return np.zeros((0, width), np.int64)
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    if (lengths == width).all():
        return flat[ends[0] : ends[-1]].reshape(-1, width)
    out = np.zeros((len(column), width), np.int64)
    for row, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        out[row, : b - a] = flat[a:b]
    return out


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    bound = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if bound < 2**53:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    if bound < 2**63:
        return left @ right.T
    exact = left.astype(object) @ right.astype(object).T
    if exact.size and (exact.max() > _LONG or exact.min() < -_LONG):
        raise OverflowError("a score is beyond the range of a long")
    return exact.astype(np.int64)


def all_distances(rows: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to all pivots. ``extra`` is the added coordinate."""
    full = np.column_stack([rows.astype(float), extra])
    apart = (full**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(apart, 0))


def to_pivots(rows: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest pivot and the distance to it."""
    nearest = all_distances(rows, extra, pivots).argmin(1)
    # Not from the squares above: those lose digits where the distance is small.
    full = np.column_stack([rows.astype(float), extra])
    return nearest, np.sqrt(((full - pivots[nearest]) ** 2).sum(1))


def in_a_row(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest one left."""
    left = list(range(1, len(pivots)))
    order = [0]
    while left:
        apart = ((pivots[left] - pivots[order[-1]]) ** 2).sum(1)
        order.append(left.pop(int(apart.argmin())))
    return pivots[order]


def _grouped(rows: DataFrame, pivots: np.ndarray, longest: float, data: bool) -> DataFrame:
    """Adds the group ``g`` and the distance ``far`` to its pivot."""
    width = pivots.shape[1] - 1

    def run(ids: pa.Array, vectors: pa.Array):
        x = matrix(vectors, width)
        squared = (x.astype(float) ** 2).sum(1)
        extra = np.sqrt(np.maximum(longest**2 - squared, 0)) if data else np.zeros(len(x))
        g, far = to_pivots(x, extra, pivots)
        return ids, vectors, g, far

    return map_rows(rows.select("id", "v"), run, "id long, v array<long>, g int, far double", rows=4096)


def _needs(pivots: np.ndarray, summary: np.ndarray, width: int, slack: float):
    """``block, g, low, high``: the groups a block needs, and of them rows with a distance to the pivot in this range."""
    between = np.array([np.sqrt(((pivots - p) ** 2).sum(1)) for p in pivots])
    k = summary.shape[1] - 1
    # Squares of very long vectors are rounded too coarsely for the test by planes.
    by_planes = between.max() < _COARSE

    def run(blocks: pa.Array, vectors: pa.Array):
        out = [[], [], [], []]
        for block, rows in zip(blocks.to_pylist(), vectors):
            x = matrix(rows.values, width)
            apart = all_distances(x, np.zeros(len(x)), pivots)
            # k + 1, as one of the rows may be the query itself.
            bound = np.array([np.partition((d[:, None] + summary).ravel(), k)[k] for d in apart])[:, None] + slack
            home = apart.argmin(1)
            plane = np.full(apart.shape, -np.inf)
            if by_planes:
                beyond = apart**2 - apart[np.arange(len(x)), home][:, None] ** 2
                np.divide(beyond, 2 * between[home], out=plane, where=between[home] > 0)
            asked = (plane <= bound) & np.isfinite(summary[:, 0])[None, :]
            low = np.where(asked, apart - bound, np.inf).min(0)
            high = np.where(asked, apart + bound, -np.inf).max(0)
            wanted = np.flatnonzero(asked.any(0))
            for column, value in zip(out, ([block] * len(wanted), wanted, low[wanted], high[wanted])):
                column.extend(value)
        return out

    return run


def pivots_for(rows: int) -> int:
    return min(MAX_PIVOTS, max(16, 4 * math.isqrt(rows)))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    n_pivots: int | None = None,
    chunk_rows: int = 2048,
    block_rows: int = 256,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` best of all other rows for each row that ``is_query`` holds for.

    ``is_query`` refers to column ``id``. The driver holds the pivots, at most ``MAX_PIVOTS`` of the rows,
    and ``k + 1`` distances for each.
    """
    plan = join_plan(vectors, is_query, k, id_col, vector_col, scale, n_pivots, chunk_rows, block_rows)
    if plan is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    wanted, blocks, chunks, width = plan
    # Queries travel to the data: a block is an eighth of a chunk.
    left = blocks.select(F.col("piece").alias("block"), F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"))
    right = chunks.select(F.col("piece").alias("chunk"), "ids", "vs")
    met = wanted.join(left, "block").join(right, "chunk").select("q_ids", "q_vs", "ids", "vs")
    best = map_rows(met, _scored(k, width), "query_id long, q_key long, id long, score long", rows=1)
    return _ranked(best, k)


def join_plan(
    vectors: DataFrame, is_query: Column, k: int, id_col: str, vector_col: str, scale: int, n_pivots: int | None,
    chunk_rows: int, block_rows: int,
) -> tuple[DataFrame, DataFrame, DataFrame, int] | None:
    """Which ``block`` of queries needs which ``chunk`` of data, both kinds of pieces, and the width; None without queries."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vector_col, scale), "vectors")
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest, width = rows.agg(F.max(squared), F.max(F.size("v"))).first()
    if longest is None:
        return None
    longest = float(longest) ** 0.5

    by_id = W.partitionBy("v").orderBy("id")
    candidates = rows.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1).drop("n")
    # Pivots: the vectors whose hash is smallest, the same for the same rows however they lie.
    n_pivots = n_pivots or pivots_for(rows.count())
    chosen = candidates.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(n_pivots).collect()
    points = np.zeros((len(chosen), width + 1))
    for row, (v,) in zip(points, chosen):
        row[: len(v)] = v
        row[-1] = max(longest**2 - float((row[:-1] ** 2).sum()), 0) ** 0.5
    points = in_a_row(points)

    data = stored(_grouped(candidates, points, longest, True), "data-groups")
    queries = stored(_grouped(rows.filter(is_query), points, longest, False), "query-groups")
    nearest = W.partitionBy("g").orderBy("far")
    summary = np.full((len(points), k + 1), np.inf)
    smallest = data.select("g", "far").withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1)
    for g, far, n in smallest.collect():  # k + 1 rows for each pivot
        summary[g, n - 1] = far
    if queries.isEmpty():
        return None

    chunks, heads = _pieces(data, chunk_rows)
    blocks, _ = _pieces(queries, block_rows)
    # Distances are rounded; the bounds give way by far more than that.
    needs = _needs(points, summary, width, slack=1e-6 * (1 + longest))
    needs = map_rows(blocks.select("piece", "vs"), needs, "block string, g int, low double, high double", rows=1)
    met = (F.col("far") >= F.col("low")) & (F.col("near") <= F.col("high"))
    heads = heads.withColumnRenamed("piece", "chunk")
    wanted = heads.join(stored(needs, "needs"), "g").filter(met).select("block", "chunk").distinct()
    return wanted, blocks, chunks, width


def _pieces(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Neighbouring rows (by group, then distance to the pivot) in pieces of ``size`` rows or fewer: ``piece, ids, vs``.

    Next to them, for each piece and group it holds rows of, their least and largest distance: ``piece, g, near, far``.
    Pieces are parts of range partitions, so no task orders a whole group.
    """
    ranged = rows.repartitionByRange("g", "far", "id").withColumn("part", F.spark_partition_id().cast("long"))
    inside = W.partitionBy("part").orderBy("g", "far", "id")
    number = F.floor((F.row_number().over(inside) - 1) / size)
    numbered = stored(ranged, "ranged").withColumn("piece", F.concat_ws(":", "part", number))
    numbered = stored(numbered.drop("part"), "numbered")
    pieces = numbered.groupBy("piece").agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs"))
    heads = numbered.groupBy("piece", "g").agg(F.min("far").alias("near"), F.max("far").alias("far"))
    return stored(pieces, "pieces"), stored(heads, "heads")


def _scored(k: int, width: int):
    def run(q_ids: pa.Array, q_vs: pa.Array, ids: pa.Array, vs: pa.Array):
        query, data = q_ids[0].values.to_numpy(), ids[0].values.to_numpy()
        left, right = matrix(q_vs[0].values, width), matrix(vs[0].values, width)
        scores = inner_products(left, right)
        keys = (left * _KEY[np.arange(width) % len(_KEY)]).sum(1)
        out_q, out_key, out_id, out_score = [], [], [], []
        for i in range(len(query)):
            own = (data == query[i]) & (right == left[i]).all(1)
            others = np.nonzero(~own)[0]
            mine = scores[i, others]
            if len(mine) > k:
                least = np.partition(mine, -k)[-k]
                others, mine = others[mine >= least], mine[mine >= least]
            first = np.lexsort((data[others], -mine))[:k]
            out_q += [query[i]] * len(first)
            out_key += [keys[i]] * len(first)
            out_id += data[others[first]].tolist()
            out_score += mine[first].tolist()
        return out_q, out_key, out_id, out_score

    return run


# Tells rows of one id with different vectors apart; odd multipliers, wrapping.
_KEY = np.random.default_rng(7).integers(1, 2**62, 1024) * 2 + 1


def _ranked(best: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id", "q_key").orderBy(F.desc("score"), "id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
