"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these. Needs ``a > b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link: the smallest node that links reach from it.

    ``links`` has long columns ``a`` and ``b``; repeated, reversed and self links do no harm. Each round
    is a stored table; their number grows with the logarithm of the longest path.
    """
    turned = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(turned.distinct(), "links")
    state = _state(links)
    while True:
        links = stored(_small_star(_large_star(links).distinct()).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
