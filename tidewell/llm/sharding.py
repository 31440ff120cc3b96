"""Sharding by longest processing time: groups of equal texts go, largest first, to the least loaded shard.

The groups are never brought together. Spark counts them by size bin (sizes to ``BIN_BITS`` significant
bits, so at most ``BIN_LIMIT`` bins for any input) and the driver schedules bins, largest first: the items
of a bin are equal, and taking the least loaded shard for each of them is a heap's work done in bulk up to
the last few. The schedule says how many items of each bin every shard gets; Spark numbers the groups of a
bin and looks the shard up by number. A bin counts its items at their mean size, rounded, so the loads are
those of the real sizes to a fraction of an item.

Defined results: a null text has size 1 and belongs to the group of empty texts; repeated rows stay
together and have slots of their own; an empty table gives an empty result; rows without an id are placed
like others.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import running_start, stored

BIN_BITS = 10
#: Sizes are below 2^63: exact bins below 2^BIN_BITS, then half as many in each octave.
BIN_LIMIT = 2**BIN_BITS + (63 - BIN_BITS) * 2 ** (BIN_BITS - 1)


def size_bin(size: Column) -> Column:
    """The size with all but its first ``BIN_BITS`` bits cleared."""
    length = F.length(F.regexp_replace(F.bin(size), "^0+", ""))
    drop = F.greatest(length - BIN_BITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)


def deal(loads: list[int], size: int, items: int) -> list[int]:
    """How many of ``items`` equal items each shard gets, one by one to the least loaded (first on ties).

    Changes ``loads``. All but the last items are dealt at once: shard i gets those of its steps
    ``load_i + j * size`` that lie below a level, the highest level that does not use up the items.
    """
    shards = range(len(loads))
    got = [0] * len(loads)
    if items > 4 * len(loads):
        low, high = min(loads), max(loads) + size * (items // len(loads) + 2)
        while high - low > 1:
            level = (low + high) // 2
            if sum(max(0, -((loads[i] - level) // size)) for i in shards) <= items:
                low = level
            else:
                high = level
        got = [max(0, -((loads[i] - low) // size)) for i in shards]
    heap = [(loads[i] + got[i] * size, i) for i in shards]
    heapq.heapify(heap)
    for _ in range(items - sum(got)):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        got[i] += 1
    for i in shards:
        loads[i] += got[i] * size
    return got


def schedule(bins: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """For ``(bin, items, total size)``: per bin, the items given to shards 0..i, largest bin first."""
    loads = [0] * shards
    out = []
    for number, items, total in sorted(bins, reverse=True):
        upto, sums = 0, []
        for got in deal(loads, max(1, round(total / items)), items):
            upto += got
            sums.append(upto)
        out.append((number, sums))
    return out


def shard_by_size(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shards: int = 16, carry: list[str] | None = None
) -> DataFrame:
    """Returns ``row`` (the input), ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Rows with equal texts are in one shard. The result is the same for the same rows, however they lie.
    ``carry`` limits ``row`` to these columns, so that texts that nobody reads again are not moved.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    size = (F.octet_length(text) + 1).cast("long")
    groups = stored(docs.select(digest.alias("g"), size.alias("s")).groupBy("g").agg(F.sum("s").alias("s")), "groups")
    groups = groups.withColumn("bin", size_bin(F.col("s"))).withColumn("one", F.lit(1).cast("long"))
    bins = groups.groupBy("bin").agg(F.count("*").alias("n"), F.sum("s").alias("total")).collect()  # BIN_LIMIT rows at most
    plan = spark.createDataFrame(schedule([tuple(b) for b in bins], shards), "bin long, upto array<long>")
    numbered = running_start(groups, ["bin"], "g", ["g"], "one", "number")
    # As many rows as bins, so the broadcast has BIN_LIMIT rows of ``shards`` numbers at most.
    placed = numbered.join(F.broadcast(plan), "bin").select(
        "g", F.size(F.filter("upto", lambda n: n <= F.col("number"))).alias("shard")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row")
    marked = docs.select(row, digest.alias("g"), size.alias("size"), F.col(f"`{id_col}`").alias("id")).join(placed, "g")
    ordered = marked.select("row", "g", "id", "size", "shard", F.lit(1).cast("long").alias("one"))
    # Equal texts may be a third of the rows: the slice is taken from the id, not from the text.
    return running_start(ordered, ["shard"], "id", ["id", "g"], "one", "slot").select("row", "size", "shard", "slot")
