"""Mixing sources to target weights, block by block.

The words of a source's documents, in a fixed order, are packed into blocks of ``block_words``. Output
shards of ``shard_blocks`` slots draw how many slots each source gets: the whole part of the expectation,
and the rest multinomially by the fractions, so that small sources come near their targets too, which
a draw of all slots would miss by the root of their number. The slots of a source are numbered through all shards, and a
pseudorandom permutation of the block indexes, another one for each pass, says which block a slot holds.
Blocks and documents then meet by (source, block index); only slots and document positions are joined, and
texts are cut at the end.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and share ``share`` times all
words; a target stops at ``most`` times its source and the excess is shared again by weight.

Defined results: a null text has no words; documents without words are never taken; a null source is a
source; repeated rows are documents of their own; an empty table gives an empty result. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.llm.common import WORD, running_start, stored

# A word and the blanks after it; the first word of a text has the blanks before it too.
UNIT = rf"[\x20\x09-\x0D]*{WORD}[\x20\x09-\x0D]*"
WEIGHTS = (3, 1, 2)
PLACES = "array<struct<pass: long, shard: long, slot: long>>"
SHARE_PERCENT, MOST = 150, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def _draw(*parts: Column | str) -> Column:
    """48 pseudorandom bits that depend on the parts only."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 12), 16, 10).cast("long")


def targets(sources: DataFrame, share_percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """Adds ``s`` (place in order), ``weight`` and ``target`` to ``source, source_size``: one row per source.

    Sources are filled in order of the share at which they reach their limit. A source is at its limit if an
    equal share of what the sources before it leave over would take it further.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("s", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("s") % len(WEIGHTS) + 1))
    ranked = ranked.withColumn("limit", most * F.col("source_size"))
    fill = W.orderBy(F.col("limit") / F.col("weight"), "s")
    before, every = fill.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    ranked = (
        ranked.withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("rest", share_percent * F.col("all_words") / 100 - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("rest_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("full", F.col("limit") * F.col("rest_weight") <= F.col("weight") * F.col("rest"))
    )
    level = F.max(F.when(~F.col("full"), F.struct(-F.col("limit") / F.col("weight"), -F.col("s"), F.col("rest") / F.col("rest_weight")))).over(every)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * level.getField("col3"))
    return ranked.select("source", "s", "source_size", "weight", target.alias("target"))


def slots(sources: DataFrame, block_words: int, shard_blocks: int, seed: int, most: int) -> DataFrame:
    """``s, block, uses, places``: how often each block of each source is taken, ``most`` times at most, and
    for each pass the output shard and the slot in it that hold the block."""
    spark = sources.sparkSession
    blocks = F.ceil(F.col("source_size") / block_words)
    shares = (
        sources.filter("source_size > 0")
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("expected", F.col("target") * F.col("blocks") / F.col("source_size"))
    )
    total = shares.agg(F.ceil(F.sum("expected")).cast("long"), F.sum("expected")).first()
    if total[0] is None:
        return spark.createDataFrame([], f"s int, block long, uses long, places {PLACES}")
    n_shards = -(-total[0] // shard_blocks)
    last = total[0] - (n_shards - 1) * shard_blocks
    # Shards of two lengths: the last one may be shorter.
    by_length = shares.withColumn("length", F.explode(F.array_distinct(F.array(F.lit(shard_blocks), F.lit(last)))))
    by_length = by_length.withColumn("mean", F.col("length") * F.col("expected") / F.lit(total[1]))
    by_length = by_length.withColumn("whole", F.floor("mean")).withColumn("part", F.col("mean") - F.col("whole"))
    upto = W.partitionBy("length").orderBy("s").rowsBetween(W.unboundedPreceding, W.currentRow)
    by_length = by_length.withColumn("upto", F.sum("part").over(upto))
    shard_length = F.when(F.col("shard") == n_shards - 1, last).otherwise(shard_blocks).cast("long")
    drawn_sources = by_length.groupBy("length").agg(
        (F.col("length") - F.sum("whole")).alias("rest"),
        F.max("upto").alias("all_parts"),
        F.sort_array(F.collect_list(F.struct("s", "upto"))).alias("parts"),
    )
    rest = (
        spark.range(n_shards)
        .select(F.col("id").alias("shard"))
        .withColumn("length", shard_length)
        .join(drawn_sources, "length")
        .filter("rest > 0")
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)))
        .withColumn("at", _draw(F.lit(f"slot{seed}"), "shard", "j") / F.lit(2.0**48) * F.col("all_parts"))
        .select("shard", F.element_at(F.filter("parts", lambda p: p["upto"] > F.col("at")), 1)["s"].alias("s"))
        .groupBy("s", "shard")
        .agg(F.count("*").alias("n"))
    )
    # A shard has no more slots than ``shard_blocks``, so at most as many sources have a whole one: a bounded table.
    sure = F.broadcast(by_length.filter("whole > 0").select("s", "length", F.col("whole").alias("n")))
    shards = spark.range(n_shards).select(F.col("id").alias("shard")).withColumn("length", shard_length)
    whole = shards.join(sure, "length").select("s", "shard", "n")
    counts = whole.union(rest).groupBy("s", "shard").agg(F.sum("n").alias("n"))
    # Inside a shard the sources' slots stand one after the other.
    earlier = W.partitionBy("shard").orderBy("s").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    first = running_start(stored(counts, "shard-counts"), ["s"], "shard", ["shard"], "n", "first")
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    each = first.select("s", "shard", "begin", "first", step.alias("step"))
    each = each.select("s", "shard", (F.col("begin") + F.col("step")).alias("slot"), (F.col("first") + F.col("step")).alias("i"))
    numbered = each.join(shares.select("s", "blocks"), "s").filter(F.col("i") < most * F.col("blocks"))
    passes = numbered.withColumn("pass", F.floor(F.col("i") / F.col("blocks"))).withColumn("j", F.col("i") % F.col("blocks"))
    block = permuted(F.col("j"), F.col("blocks"), F.lit(f"pass{seed}"), F.col("s"), F.col("pass"))
    places = F.sort_array(F.collect_list(F.struct("pass", "shard", "slot")))  # ``most`` at most
    return passes.withColumn("block", block).groupBy("s", "block").agg(F.count("*").alias("uses"), places.alias("places"))


# Rounds of the Feistel network, an even number; steps of a walk, at most.
_ROUNDS, _WALK = 4, 64


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1 that depends on ``key``.

    A keyed Feistel network over pairs from ``a`` times ``b`` numbers, ``a`` the root of ``n`` and ``a * b`` just
    above it, walked on until it is below ``n``. Fewer than ``a`` pairs lie beyond ``n``, so a walk ends within ``a``
    steps, and 64 are enough for certain up to 4096; above that a walk takes another step with a
    probability below 1/64 each, and one that has not ended after 64 raises.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.floor((n + a - 1) / a).cast("long")

    def network(x: Column) -> Column:
        left, right = x % a, F.floor(x / a).cast("long")
        for j in range(_ROUNDS):
            size = b if j % 2 else a
            left, right = right, F.pmod(left + F.pmod(F.xxhash64(*key, F.lit(j), right), size), size)
        return a * right + left

    first = network(index)
    # Nearly every walk is over after one step; the others are rare enough for a loop.
    more = F.aggregate(F.sequence(F.lit(2), F.lit(_WALK)), first, lambda x, _: F.when(x < n, x).otherwise(network(x)))
    walk = F.when(first < n, first).otherwise(more)
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("a walk of the permutation did not end")).cast("long"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 256,
    shard_blocks: int = 1024,
    seed: int = 1,
    share_percent: int = SHARE_PERCENT,
    most: int = MOST,
) -> DataFrame:
    """One row per document: ``id, text_hash, size, source_size, target, taken, spans``.

    ``taken`` counts the words the mix takes, repeats included. ``spans`` lists what is taken, in order:
    ``start`` and ``length`` in words of the document, ``uses``, and the ``places`` (pass, shard, slot) that hold it.
    """
    text = F.col(f"`{text_col}`")
    sized = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.xxhash64(text).alias("text_hash"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            word_count(text).alias("size"),
        ),
        "sizes",
    )
    sources = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share_percent, most), "targets")
    numbered = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "id", "text_hash", "size", "s", "source_size", "target"
    )
    placed = stored(running_start(numbered, ["s"], "id", ["id", "text_hash"], "size", "off"), "places")
    used = slots(sources, block_words, shard_blocks, seed, most)
    end = F.col("off") + F.col("size")
    low, high = F.floor(F.col("off") / block_words), F.floor((end - 1) / block_words)
    pieces = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(low, high)))
    start = F.greatest(F.col("block") * block_words, F.col("off"))
    length = F.least((F.col("block") + 1) * block_words, end) - start
    taken = (
        pieces.select("s", "off", "block", (start - F.col("off")).alias("start"), length.alias("length"))
        .join(used, ["s", "block"])
        .groupBy("s", "off")
        .agg(
            F.sum(F.col("length") * F.col("uses")).alias("taken"),
            F.sort_array(F.collect_list(F.struct("start", "length", "uses", "places"))).alias("spans"),
        )
    )
    # Documents without words share an offset with the next one, so they stay out of the join.
    full = placed.filter("size > 0").join(taken, ["s", "off"], "left")
    none = placed.filter("size = 0").select("*", F.lit(0).cast("long").alias("taken"), F.lit(None).cast(taken.schema["spans"].dataType).alias("spans"))
    columns = ["id", "text_hash", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "spans"]
    return full.select(*columns).union(none.select(*columns))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: a document's columns once for each pass that takes words of it.

    The text holds the words that the pass takes, each with the blanks after it (the first word of a document
    also those before it), so that a document taken whole comes back as it was. Documents the mix leaves out are gone.
    """
    plan = mix(docs, id_col, text_col, **options).filter("taken > 0")
    text = F.col(f"`{text_col}`")
    alike = W.partitionBy("_id", "_hash").orderBy(F.lit(0))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_hash"))
    left = left.withColumn("_n", F.row_number().over(alike))
    right = plan.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "spans").withColumn("_m", F.row_number().over(alike))
    # Equal rows are told apart by their number, which is part of the key: each row meets one other.
    same = left["_id"].eqNullSafe(right["_id"]) & (left["_hash"] == right["_hash"]) & (left["_n"] == right["_m"])
    units = F.regexp_extract_all(F.col(f"row.`{text_col}`"), F.lit(UNIT), F.lit(0))
    both = left.join(right, same).select("row", "spans", units.alias("units"))
    both = both.withColumn("pass", F.explode(F.sequence(F.lit(1), F.array_max(F.col("spans.uses")).cast("int"))))
    chosen = F.filter("spans", lambda x: x["uses"] >= F.col("pass"))
    cut = F.transform(chosen, lambda x: F.slice(F.col("units"), (x["start"] + 1).cast("int"), x["length"].cast("int")))
    return both.select("row", F.array_join(F.flatten(cut), "").alias("kept_text"))
