"""Substring dedup by seed and extend: words inside a repeat of an earlier document are removed.

A *window* is ``window`` consecutive words. Seeds are winnowed: the anchor of a window is the leftmost of its
``seed``-word grams with the smallest hash, so equal windows have equal anchors, and one anchor serves a run
of neighbouring windows (its *stretch*; windows of equal anchors side by side, as in a text of one word, are one stretch).
One row per stretch is kept: the anchor's hash, the hash of all words of the stretch, and where it lies.

1. Stretches are joined on their anchors; anchors of a single document are gone after one aggregation.
2. Extension to whole stretches: where all stretches of an anchor are equal (the inside of a copied passage),
   each one outside the smallest document is a repeat as it stands.
3. Extension word by word: where stretches of an anchor differ (the edges of passages, or passages that share
   a few words), the first of each kind of stretch is opened into its windows, and windows are compared by
   hash. A window that is in a smaller document is a repeat.

Overlapping repeats unite to maximal ones when they are cut out. Windows are judged on the input, not on what
is left. A passage in n documents costs n rows, never n^2, and equal stretches meet in partial aggregates.

Defined results: a null or blank text has no words; texts shorter than a window lose nothing; rows without an
id lose nothing and make nobody lose words; rows that share an id are no smaller than each other; an empty
table gives an empty result. Hashes are 64 bits for the anchor and 64 more for the words compared under it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, stored, words_of

# Odd multipliers of the two polynomial hashes, modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Hashes:
    """Hashes of any run of words of one text, from prefix sums of a polynomial modulo 2^64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, words: list[bytes]):
        digests = b"".join(map(xxhash.xxh3_128_digest, words))
        pairs = np.frombuffer(digests, "<u8").reshape(-1, 2)
        self.sums, self.ups = [], []
        for lane, base in enumerate(_BASES):
            up, down = self._power(base, len(words) + 1)
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(pairs[:, lane] * down[: len(words)], out=sums[1:])
            self.sums.append(sums)
            self.ups.append(up)

    @classmethod
    def _power(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse: the sums weigh word i by the inverse to the power i."""
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(n, 4096)
            out = []
            for number in (base, pow(base, -1, 2**64)):
                steps = np.full(size, number, np.uint64)
                steps[0] = 1
                out.append(np.cumprod(steps, dtype=np.uint64))
            have = (out[0], out[1])
            if size <= 2**20:
                cls._powers[base] = have
        return have

    def runs(self, lane: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Mixed hashes of words ``starts`` to ``ends`` (exclusive)."""
        sums = self.sums[lane]
        x = (sums[ends] - sums[starts]) * self.ups[lane][starts]
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of the leftmost smallest: by doubling the width."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at


def stretches(words: list[bytes], window: int, seed: int):
    """Anchor hash, stretch hash, first window and number of windows of each stretch."""
    if len(words) < window:
        return None
    hashes = Hashes(words)
    starts = np.arange(len(words) - seed + 1)
    grams = hashes.runs(0, starts, starts + seed)
    anchors = grams[leftmost_least(grams, window - seed + 1)]
    first = np.concatenate(([0], np.nonzero(np.diff(anchors))[0] + 1))
    count = np.diff(np.append(first, len(anchors)))
    whole = hashes.runs(1, first, first + count - 1 + window)
    return anchors[first].view(np.int64), whole.view(np.int64), first, count


def _seeds(window: int, seed: int):
    def run(docs: pa.Array, versions: pa.Array, texts: pa.Array):
        parts, owners = [], []
        for k, text in enumerate(texts.to_pylist()):
            found = stretches(words_of(text), window, seed)
            if found:
                parts.append(found)
                owners.append(np.full(len(found[0]), k))
        if not parts:
            return None
        owner = pa.array(np.concatenate(owners))
        columns = [np.concatenate([p[i] for p in parts]) for i in range(4)]
        return docs.take(owner), versions.take(owner), *columns

    return run


def _windows(window: int):
    """Opens stretches into windows: the second hash of each, under the stretch's anchor."""

    def run(docs: pa.Array, versions: pa.Array, texts: pa.Array, lists: pa.Array):
        rows = [[], [], [], [], []]
        for doc, version, text, found in zip(docs.to_pylist(), versions.to_pylist(), texts.to_pylist(), lists.to_pylist()):
            hashes = Hashes(words_of(text))
            for s in found:
                starts = np.arange(s["at"], s["at"] + s["n"])
                values = (doc, version, s["h"])
                for column, value in zip(rows, values):
                    column.append(np.full(s["n"], value))
                rows[3].append(hashes.runs(1, starts, starts + window).view(np.int64))
                rows[4].append(starts)
        return [np.concatenate(x) for x in rows]

    return run


def removed_words(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of ``n`` words the runs cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, seed: int = 16) -> DataFrame:
    """``doc, version, at, length``: runs of words that are repeats. ``version`` tells texts of one id apart."""
    if not 0 < seed <= window:
        raise ValueError("a seed is at least one word and at most a window")
    source = _source(docs, id_col, text_col)
    layout = "doc long, version int, h long, g long, at int, n int"
    found = stored(map_rows(source, _seeds(window, seed), layout), "stretches")
    anchors = found.groupBy("h").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("g").alias("g0"), F.max("g").alias("g1")
    )
    shared = anchors.filter(F.col("first") < F.col("last")).select("h", "first", (F.col("g0") == F.col("g1")).alias("alike"))
    # What is joined with its own aggregate is stored first: read back, a hot anchor's rows can be split over tasks.
    joined = stored(found.join(stored(shared, "shared-anchors"), "h"), "shared-stretches")

    alike = joined.filter("alike and doc > first")
    differ = joined.filter("not alike").drop("first", "alike")
    kinds = differ.groupBy("h", "g").agg(F.min("doc").alias("first"))
    differ = stored(differ.join(stored(kinds, "kinds"), ["h", "g"]), "differing-stretches")
    whole = alike.select("doc", "version", "at", "n").union(differ.filter("doc > first").select("doc", "version", "at", "n"))
    whole = whole.select("doc", "version", "at", (F.col("n") + (window - 1)).alias("length"))

    opened = differ.filter("doc = first").groupBy("doc", "version").agg(F.collect_list(F.struct("h", "at", "n")).alias("found"))
    texts = source.join(opened, ["doc", "version"]).select("doc", "version", "text", "found")
    # Texts come once for each row of the table; equal rows give equal windows.
    windows = map_rows(texts, _windows(window), "doc long, version int, h long, w long, at int", rows=32)
    windows = stored(windows, "windows")
    earlier = windows.groupBy("h", "w").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    earlier = stored(earlier.select("h", "w", "first"), "earlier-windows")
    single = windows.join(earlier, ["h", "w"]).filter("doc > first")
    return whole.union(single.select("doc", "version", "at", F.lit(window).alias("length")))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    doc = F.col(f"`{id_col}`").cast("long")
    return docs.select(doc.alias("doc"), F.hash(text).alias("version"), text.alias("text")).filter(F.col("doc").isNotNull())


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    seed: int = 16,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns), ``n_words``, ``n_removed`` and ``kept_text``.

    The kept words are joined by one space.
    """
    runs = repeats(docs, id_col, text_col, window, seed)
    lists = runs.groupBy("doc", "version").agg(F.collect_list(F.struct("at", "length")).alias("runs"))
    text = F.col(f"`{text_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns])
    marked = docs.select(row.alias("row"), text.alias("t"), F.col(f"`{id_col}`").cast("long").alias("_doc"), F.hash(text).alias("_version"))
    same = (F.col("_doc") == F.col("doc")) & (F.col("_version") == F.col("version"))
    joined = marked.join(lists, same, "left").select("row", "t", "runs")

    def run(rows: pa.Array, texts: pa.Array, cuts: pa.Array):
        n_words, n_removed, kept = [], [], []
        for text, cut in zip(texts.to_pylist(), cuts):
            words = words_of(text)
            n_words.append(len(words))
            n_removed.append(0)
            if cut.is_valid:
                at, length = (cut.values.field(x).to_numpy().astype(np.int64) for x in ("at", "length"))
                gone = removed_words(len(words), at, length)
                n_removed[-1] = int(gone.sum())
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return rows, n_words, n_removed, kept

    schema = T.StructType().add("row", joined.schema["row"].dataType)
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return map_rows(joined, run, schema, rows=128)
