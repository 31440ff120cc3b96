"""Language ID by rank-order profiles: the out-of-place distance between frequent n-grams.

Letters are lower-cased one by one, combining marks stay with them, and whatever lies between words becomes one
blank, in front of the first word and after the last one too. Grams are one to three of these signs, never a
blank alone and never one with a blank inside. A language's profile lists its ``PROFILE`` most frequent grams
over all training texts; a text's own profile lists its most frequent ones. The distance of the two sums, over
the text's grams, how far their ranks lie apart, and ``PROFILE`` for a gram the language does not list. The
nearest language is predicted. Equal counts rank by gram (shorter first, then by code points), equal distances go
to the language that sorts first.

``score`` is ``second / (first + second)`` for the distances of the nearest and the next language (the farthest
possible distance where there is no other): 0.5 is a tie, 1 a perfect match.

A gram is an exact number, 21 bits a sign. Texts are read in blocks, so a text needs memory for one block and for
its different grams. Counts are summed by Spark over all training texts. The most frequent grams of a language are
found in slices of the grams first, so that no task ranks a whole language. What reaches the driver at once is
``PASS_LANGUAGES`` profiles of ``PROFILE`` numbers each; more languages than that take further passes over the
texts' own profiles, each of which keeps the two nearest languages so far.

Defined results: a text that is null or holds no letter is ``und`` with score 0, as is every text where no
language could be learned; a null language teaches nothing, an empty one is a language like any other; a language
whose texts hold no letter is not learned; repeated rows count as often as they come; rows pass through, repeated or without
an id; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed, stored

PROFILE = 300
UNDETERMINED = "und"
PASS_LANGUAGES = 4096
_BLANK = 32
_BITS = 21
_BLOCK = 1 << 16
# Keys that wait to be counted, at most.
_PENDING = 1 << 20
# Languages whose ranks lie in one matrix.
_TOGETHER = 64
_SLICES = 32


@lru_cache(maxsize=1)
def _signs() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter or mark, else a blank; and whether it is a letter."""
    folded = np.full(0x110000, _BLANK, np.int64)
    letter = np.zeros(0x110000, bool)
    for point in range(0x110000):
        sign = chr(point)
        if sign.isalpha():
            lower = sign.lower()
            folded[point] = ord(lower) if len(lower) == 1 else point
            letter[point] = True
        elif unicodedata.category(sign)[0] == "M":
            folded[point] = point
    return folded, letter


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


class GramCounts:
    """Grams of texts and how often they come."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self.letters = False

    def add(self, text: str) -> None:
        folded, letter = _signs()
        # The last two signs of the block before: grams that end in this block may begin there.
        before = np.array([_BLANK])
        for start in range(0, len(text) + 1, _BLOCK):
            block = text[start : start + _BLOCK]
            points = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32)
            self.letters = self.letters or bool(letter[points].any())
            last = start + _BLOCK > len(text)
            signs = np.concatenate([before, folded[points], [_BLANK] if last else []]).astype(np.int64)
            signs = signs[np.concatenate([[True], (signs[1:] != _BLANK) | (signs[:-1] != _BLANK)])]
            new = min(len(before), len(signs))
            one, two, three = signs[new:], signs[max(0, new - 1) :], signs[max(0, new - 2) :]
            triples = three[:-2] << 2 * _BITS | three[1:-1] << _BITS | three[2:]
            for keys in (
                one[one != _BLANK],
                two[:-1] << _BITS | two[1:],
                triples[three[1:-1] != _BLANK] if len(three) > 2 else triples[:0],
            ):
                self.pending.append(keys)
                self.waiting += len(keys)
            before = signs[-2:]
            if self.waiting > _PENDING:
                self._count()

    def _count(self) -> None:
        keys, counts = np.unique(np.concatenate(self.pending), return_counts=True) if self.pending else (self.keys[:0],) * 2
        self.pending, self.waiting = [], 0
        if len(self.keys):
            keys, counts = _summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.keys, self.counts = keys, counts

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        if self.pending:
            self._count()
        return self.keys, self.counts

    def ranked(self, size: int) -> np.ndarray:
        """The most frequent grams, most frequent first."""
        keys, counts = self.totals()
        return keys[np.argsort(-counts, kind="stable")[:size]]  # keys are in order, so ties are too


def _count_grams(langs: pa.Array, texts: pa.Array):
    found: dict[str, GramCounts] = {}
    for lang, text in zip(langs.to_pylist(), texts.to_pylist()):
        found.setdefault(lang, GramCounts()).add(text)
    names, totals = list(found), [c.totals() for c in found.values()]
    if not names:
        return None
    sizes = [len(keys) for keys, _ in totals]
    at = pa.array(np.repeat(np.arange(len(names)), sizes))
    return pa.array(names, pa.string()).take(at), np.concatenate([k for k, _ in totals]), np.concatenate([c for _, c in totals])


def learn_profiles(
    docs: DataFrame, train: Column | None = None, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE
) -> DataFrame:
    """``lang`` and ``grams``, the most frequent first, of every language in the rows that ``train`` picks; stored."""
    taught = docs.filter(train) if train is not None else docs
    taught = taught.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    taught = taught.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    parts = map_rows(taught, _count_grams, "lang string, gram long, times long")
    counts = parts.groupBy("lang", "gram").agg(F.sum("times").alias("times"))
    # The best of every slice of the grams, as one row a slice; then the best of these.
    counts = counts.withColumn("slice", F.pmod(F.xxhash64("gram"), F.lit(_SLICES)).cast("int"))
    order = W.partitionBy("lang", "slice").orderBy(F.desc("times"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    entry = F.struct((-F.col("times")).alias("minus"), "gram")
    slices = best.groupBy("lang", "slice").agg(F.collect_list(entry).alias("part"))
    merged = slices.groupBy("lang").agg(F.slice(F.sort_array(F.flatten(F.collect_list("part"))), 1, size).alias("all"))
    return stored(merged.select("lang", F.col("all.gram").alias("grams")), "profiles")


class Profiles:
    """The ranks of the grams of some languages."""

    def __init__(self, profiles: list[tuple[str, list[int]]], size: int):
        self.size = size
        self.parts = []
        for start in range(0, len(profiles), _TOGETHER):
            names = [lang for lang, _ in profiles[start : start + _TOGETHER]]
            lists = [np.array(grams, np.int64) for _, grams in profiles[start : start + _TOGETHER]]
            grams = np.unique(np.concatenate(lists))
            ranks = np.full((len(names), len(grams) + 1), -1, np.int32)
            for row, listed in zip(ranks, lists):
                row[np.searchsorted(grams, listed)] = np.arange(len(listed))
            self.parts.append((names, grams, ranks))

    def nearest(self, ranked: np.ndarray, first: int | None, name: str | None, second: int | None):
        """The nearest language and the two least distances, those given included."""
        for names, grams, ranks in self.parts:
            at = np.searchsorted(grams, ranked)
            at[grams[np.minimum(at, len(grams) - 1)] != ranked] = len(grams)
            found = ranks[:, at]
            apart = np.where(found < 0, self.size, np.abs(found - np.arange(len(ranked), dtype=np.int32))).sum(1)
            for lang, distance in zip(names, apart.tolist()):
                if first is None or distance < first or (distance == first and lang < name):
                    first, name, second = distance, lang, first
                elif second is None or distance < second:
                    second = distance
        return first, name, second


def _passes(profiles: DataFrame, size: int) -> Iterator[list[tuple[str, list[int]]]]:
    rows = profiles.orderBy("lang").toLocalIterator()
    while part := [(r.lang, r.grams) for r in islice(rows, size)]:
        yield part


def _lists(found: list[np.ndarray | None]) -> pa.Array:
    return pa.array(found, pa.list_(pa.int64()))


def identify_languages(
    docs: DataFrame,
    profiles: DataFrame,
    text_col: str = "text",
    carry: list[str] | None = None,
    size: int = PROFILE,
    pass_languages: int = PASS_LANGUAGES,
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns), ``lang_pred`` and ``score``.

    ``profiles`` has ``lang`` and ``grams``, as ``learn_profiles`` gives them.
    """
    spark = docs.sparkSession
    frame = packed(docs, carry, given=F.col(f"`{text_col}`"))
    state = T.StructType().add("row", frame.schema["row"].dataType).add("given", T.ArrayType(T.LongType()))
    state = state.add("first", T.LongType()).add("name", T.StringType()).add("second", T.LongType()).add("length", T.IntegerType())

    def step(broadcast, key: str, more: bool):
        def run(rows: pa.Array, given: pa.Array, *so_far: pa.Array):
            known = _model(broadcast, key, size)
            kept, out = [], ([], [], [], [])
            before = zip(*[c.to_pylist() for c in so_far]) if so_far else iter(lambda: (None, None, None, None), 0)
            for item, (first, name, second, _) in zip(given, before):
                if so_far:
                    ranked = item.values.to_numpy() if item.is_valid else None
                else:
                    ranked = _own_profile(item.as_py(), size)
                if ranked is not None:
                    first, name, second = known.nearest(ranked, first, name, second)
                kept.append(ranked if more else None)
                for column, value in zip(out, (first, name, second, None if ranked is None else len(ranked))):
                    column.append(value)
            return rows, _lists(kept), *out

        return run

    found, passes = None, -(-profiles.count() // pass_languages)
    for number, part in enumerate(_passes(profiles, pass_languages)):
        run = step(spark.sparkContext.broadcast(part), uuid.uuid4().hex, number + 1 < passes)
        found = map_rows(frame if found is None else stored(found, "nearest"), run, state)
    if found is None:
        return frame.select("row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    first, second = F.col("first"), F.coalesce(F.col("second"), F.col("length") * F.lit(size))
    share = F.when(first + second == 0, F.lit(0.5)).otherwise(second.cast("double") / (first + second))
    return found.select(
        "row",
        F.coalesce("name", F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(F.col("name").isNull(), F.lit(0.0)).otherwise(share).alias("score"),
    )


def _own_profile(text: str | None, size: int) -> np.ndarray | None:
    counts = GramCounts()
    counts.add(text or "")
    return counts.ranked(size) if counts.letters else None


_MODELS: dict[str, Profiles] = {}


def _model(broadcast, key: str, size: int) -> Profiles:
    """The profiles of this Python worker, built when first asked for; those of another pass are let go."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Profiles(broadcast.value, size)
    return _MODELS[key]
