"""SimHash near-duplicates by exact comparison of tiles.

A fingerprint has a bit set where more than half of a text's word-shingle hashes (XXH64, seed 42) have it.
Equal fingerprints are one class. Different ones are put into tiles by the population counts of their four
16-bit quarters. Each quarter's counts differ by at most the bits that differ there, so two tiles whose
counts differ by more than the radius in sum hold no link and are never paired. Paired tiles are compared
in full with exclusive-or and bit counts; a pair of tiles returns links that span its local components
instead of all its links, so that a group of n near copies costs n links.

Defined results: a null text or one without words has fingerprint zero, which links like any other; a text
shorter than a shingle is one shingle; rows without an id share their class but never name it (their
component is null where nobody else is in it); repeated rows are returned as often as they come.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed, stored, words_of
from tidewell.llm.components import components

SEED = 42
# Per byte value, which of its bits are set: lowest bit first.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
# Rows of a tile's one side that are compared at a time, so that a block is a few megabytes.
_BLOCK = 256


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint as an unsigned number. Only A-Z are lower-cased."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first, ends[shingle - 1 :].tolist())], np.uint64)
    as_bytes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(as_bytes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text_col: str, id_col: str, shingle: int, carry: list[str] | None = None) -> DataFrame:
    """``row`` with the input's columns (or those to ``carry``), ``id``, and ``fp`` as a signed long."""

    def run(rows: pa.Array, ids: pa.Array, texts: pa.Array):
        found = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
        return rows, ids, found.view(np.int64)

    frame = packed(docs, carry, id=F.col(f"`{id_col}`"), text=F.col(f"`{text_col}`"))
    schema = T.StructType([frame.schema["row"], frame.schema["id"], T.StructField("fp", T.LongType())])
    return map_rows(frame, run, schema)


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of two tiles (``right`` none: of one) under ``radius`` bits."""
    same = right is None
    every = left if same else np.concatenate([left, right])
    offset = 0 if same else len(left)
    other = left if same else right
    label = np.arange(len(every))
    for start in range(0, len(left), _BLOCK):
        block = left[start : start + _BLOCK]
        near = np.bitwise_count(block[:, None] ^ other[None, :]) <= radius
        for i in np.nonzero(near.any(axis=1))[0]:
            mine = start + i
            linked = np.unique(label[np.append(np.nonzero(near[i])[0] + offset, mine)])
            if len(linked) > 1:
                label[np.isin(label, linked)] = linked[0]
    moved = np.nonzero(label != np.arange(len(every)))[0]
    return every[moved], every[label[moved]]


def _offsets(radius: int) -> list[int]:
    """Differences of tile numbers whose counts differ by at most ``radius``, one of each opposite two.

    A tile's number has its counts 0..16 as digits to base 64, so a count out of range is no tile's.
    """
    steps = [d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius]
    numbers = [((a * 64 + b) * 64 + c) * 64 + d for a, b, c, d in steps]
    return [n for n in numbers if n >= 0]


def _links(tiles: DataFrame, radius: int) -> DataFrame:
    """Links between the fingerprints of all tile pairs within reach."""
    if not 0 <= radius <= 16:
        raise ValueError("the radius is 0 to 16 bits")
    # At most 17^4 tile numbers exist, so this table has a fixed bound.
    numbers = F.broadcast(tiles.groupBy("tile").agg(F.max("chunks").alias("other_chunks")).withColumnRenamed("tile", "other"))
    reach = F.array(*[F.lit(n) for n in _offsets(radius)])
    left = (
        tiles.select("tile", "chunk", F.col("fps").alias("left"), F.explode(F.transform(reach, lambda n: n + F.col("tile"))).alias("other"))
        .join(numbers, "other")
        .withColumn("other_chunk", F.explode(F.sequence(F.lit(0), F.col("other_chunks") - 1)))
        .filter((F.col("other") > F.col("tile")) | (F.col("other_chunk") >= F.col("chunk")))
    )
    right = tiles.select(F.col("tile").alias("other"), F.col("chunk").alias("other_chunk"), F.col("fps").alias("right"))
    pairs = left.join(right, ["other", "other_chunk"]).select(
        "left", "right", ((F.col("other") == F.col("tile")) & (F.col("other_chunk") == F.col("chunk"))).alias("same")
    )

    def run(lefts: pa.Array, rights: pa.Array, sames: pa.Array):
        a, b = [], []
        for k, same in enumerate(sames.to_pylist()):
            one = lefts[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            two = None if same else rights[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            found = spanning_links(one, two, radius)
            a.append(found[0])
            b.append(found[1])
        return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)

    return map_rows(pairs, run, "a long, b long", rows=64)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    tile_rows: int = 8192,
    carry: list[str] | None = None,
) -> DataFrame:
    """Returns ``row`` (the input, or its ``carry`` columns), ``fingerprint``, ``component_id`` and ``stays``.

    ``component_id`` is the smallest id that links of ``radius`` bits or fewer reach. ``stays`` holds for one
    row of each component, one with that id. A tile number with more than ``tile_rows`` fingerprints is split
    into chunks; all pairs of chunks are compared.
    """
    # The table is written once, so the numbers that tell equal rows apart are fixed from then on.
    found = fingerprints(docs, text_col, id_col, shingle, carry).withColumn("uid", F.monotonically_increasing_id())
    marked = stored(found, "fingerprints")
    first = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"), F.col("uid").alias("uid"))
    classes = marked.groupBy("fp").agg(F.min(first).alias("least"))
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int") for k in (3, 2, 1, 0)]
    number = ((quarters[0] * 64 + quarters[1]) * 64 + quarters[2]) * 64 + quarters[3]
    classes = stored(classes.withColumn("tile", number), "classes")
    sizes = classes.groupBy("tile").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = classes.join(F.broadcast(sizes), "tile").groupBy("tile", "chunks", chunk.alias("chunk")).agg(F.collect_list("fp").alias("fps"))
    roots = components(_links(stored(tiles, "tiles"), radius))
    linked = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("first")), "root").select("fp", "first")
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    stays = F.col("uid") == F.col("first.uid")
    return marked.join(named, "fp").select("row", hexadecimal, F.col("first.id").alias("component_id"), stays.alias("stays"))
