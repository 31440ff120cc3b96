"""Quality rules: how far a document's histograms lie from those of its language.

Two histograms per document, of character classes and of common words, are compared with the language's
by Jensen-Shannon distance (base 2, so 0 to 1). The references are counted over all given documents of
the language: character classes of all their text, and the ``common_words`` most frequent words plus one
bin for the rest. A document is held against a histogram only if it is long enough for it, and a language
is its own reference only if it has ``min_reference`` words; else the reference of all languages counts.
A text that is too far from its own language is still kept if another language's reference accepts it, so
that a wrong label or a text in two languages does no harm.

Base rules (few words, repeated three-word windows) come first and do not depend on the references.

Defined results: a null or empty text has no words and fails the base rule; a null language is a language
of its own, under the same ``min_reference``; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed, stored, words_of

_SLICES = 256
# Fixed by the rule's definition: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "sentence", "symbol", "other", "beyond")


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules. Distances above the ``max`` values reject."""

    min_words: int = 50
    max_repeated_percent: int = 50
    common_words: int = 64
    min_chars_for_classes: int = 200
    min_words_for_words: int = 50
    max_class_distance: float = 0.32
    max_word_distance: float = 0.5
    min_reference: int = 1000


def _class_table() -> np.ndarray:
    """The class of each UTF-8 byte; bytes that continue a character have the number past the last."""
    of = np.full(256, CLASSES.index("other"))
    for low, high, name in (("a", "z", "lower"), ("A", "Z", "upper"), ("0", "9", "digit")):
        of[ord(low) : ord(high) + 1] = CLASSES.index(name)
    for chars, name in ((" \t\n\x0b\f\r", "blank"), (".,;:!?'\"()-", "sentence"), (SYMBOLS, "symbol")):
        of[[ord(c) for c in chars]] = CLASSES.index(name)
    of[0x80:0xC0] = len(CLASSES)
    of[0xC0:] = CLASSES.index("beyond")
    return of


_CLASS = _class_table()


def class_counts(data: bytes) -> np.ndarray:
    """Characters of each class in a UTF-8 text."""
    return np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(x):
        there = x > 0
        return float((x[there] * np.log2(x[there] / m[there])).sum())

    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more, each word once."""
    if len(words) <= size:
        return 0
    windows = list(zip(*[words[k:] for k in range(size)]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    starts = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[k : k + len(windows)] |= starts
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _letter_count(words: list[bytes]) -> int:
    return len(b"".join(words).decode("utf-8", "surrogatepass"))


def _language_counts(langs: pa.Array, texts: pa.Array):
    """One row per language, kind and key of these texts: counts before the shuffle."""
    classes: dict = {}
    words: dict = {}
    for lang, text in zip(langs.to_pylist(), texts.to_pylist()):
        if text:
            data = text.encode("utf-8", "surrogatepass")
            classes[lang] = classes.get(lang, 0) + class_counts(data)
            words.setdefault(lang, Counter()).update(data.lower().split())
    rows = [(lang, "class", name, int(n)) for lang, c in classes.items() for name, n in zip(CLASSES, c)]
    rows += [(lang, "word", w.decode("utf-8", "replace"), n) for lang, c in words.items() for w, n in c.items()]
    return [list(x) for x in zip(*rows)] if rows else None


def language_references(docs: DataFrame, lang_col: str, text_col: str, limits: Limits) -> dict:
    """``{language: (class histogram, {word: bin}, word histogram)}``; key ``""`` stands for all together.

    What comes to the driver are the class counts and the most frequent words of the languages that have
    ``min_reference`` words, so at most one language for so many words of the table.
    """
    source = docs.select(F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`"))
    counted = map_rows(source, _language_counts, "lang string, kind string, key string, n long")
    totals = stored(counted.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "language-counts")
    every = totals.groupBy("kind", "key").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "kind", "key", "n")
    named = totals.withColumn("lang", F.concat(F.lit("="), "lang")).union(every)
    size = named.groupBy("lang", "kind").agg(F.sum("n").alias("size"))
    large = size.filter((F.col("lang") == "") | ((F.col("kind") == "word") & (F.col("size") >= limits.min_reference)))
    sizes = {(r["lang"], r["kind"]): r["size"] for r in large.collect()}
    # The best of each slice of the keys first, one row a slice, then the best of sixteen slices: no task ranks a language.
    kept = F.broadcast(large.select(F.col("lang").alias("large")).distinct())
    sliced = named.join(kept, F.col("lang").eqNullSafe(F.col("large")), "left_semi")
    sliced = sliced.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(_SLICES)).cast("int"))
    first = W.partitionBy("lang", "kind", "slice").orderBy(F.desc("n"), "key")
    best = sliced.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= limits.common_words)
    entry = F.struct((-F.col("n")).alias("minus"), "key")
    top = best.groupBy("lang", "kind", "slice").agg(F.collect_list(entry).alias("all"))
    for fewer in (_SLICES // 16, 1):
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("all"))), 1, limits.common_words)
        top = top.groupBy("lang", "kind", (F.col("slice") % fewer).alias("slice")).agg(merged.alias("all"))
    found: dict = {}
    for r in top.collect():
        found.setdefault(r["lang"], {"class": {}, "word": {}})[r["kind"]] = {x["key"]: -x["minus"] for x in r["all"]}
    references = {}
    for lang, kinds in found.items():
        total = sizes.get((lang, "word"), 0)
        if lang == "" or total >= limits.min_reference:
            common = kinds["word"]
            histogram = np.array([*common.values(), total - sum(common.values())], float)
            bins = {w.encode(): k for k, w in enumerate(common)}
            references[lang] = (np.array([kinds["class"].get(c, 0) for c in CLASSES], float), bins, histogram)
    return references


def distances(data: bytes, words: list[bytes], reference: tuple | None, limits: Limits) -> tuple[float | None, float | None]:
    """Distances of the class and the word histogram; null where the text is too short for one."""
    if reference is None:
        return None, None
    by_class = by_word = None
    counts = class_counts(data)
    if counts.sum() >= limits.min_chars_for_classes and reference[0].sum():
        by_class = js_distance(counts.astype(float), reference[0])
    if len(words) >= limits.min_words_for_words and reference[2].sum():
        bins = reference[1]
        times = Counter(map(bins.get, data.lower().split()))
        histogram = np.zeros(len(bins) + 1)
        for k, n in times.items():
            histogram[-1 if k is None else k] += n
        by_word = js_distance(histogram, reference[2])
    return by_class, by_word


def accepted(by_class: float | None, by_word: float | None, limits: Limits) -> bool:
    return (by_class is None or by_class <= limits.max_class_distance) and (
        by_word is None or by_word <= limits.max_word_distance
    )


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "class_distance double, word_distance double, kept boolean"
)


def judge(text: str | None, key: str | None, references: dict, limits: Limits) -> tuple:
    """The values of ``RESULT`` for one text, ``key`` naming its language; distances are to this language."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    repeated = repeated_words(words)
    failed = len(words) < limits.min_words or 100 * repeated > limits.max_repeated_percent * len(words)
    by_class, by_word = distances(data, words, references.get(key, references.get("")), limits)
    kept = not failed and (
        accepted(by_class, by_word, limits)
        or any(accepted(*distances(data, words, r, limits), limits) for k, r in references.items() if k not in (key, ""))
    )
    symbols = sum(data.count(c.encode()) for c in SYMBOLS)
    return len(words), _letter_count(words), symbols, repeated_lines(data), repeated, failed, by_class, by_word, kept


def judge_documents(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits(), carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns) and the columns of ``RESULT``; ``kept`` is the verdict."""
    references = language_references(docs, lang_col, text_col, limits)
    frame = packed(docs, carry, lang=F.col(f"`{lang_col}`").cast("string"), text=F.col(f"`{text_col}`"))
    schema = T.StructType([T.StructField("row", frame.schema["row"].dataType), *T.StructType.fromDDL(RESULT)])
    shared = docs.sparkSession.sparkContext.broadcast(references)

    def run(rows: pa.Array, langs: pa.Array, texts: pa.Array):
        found = [
            judge(text, None if lang is None else f"={lang}", shared.value, limits)
            for lang, text in zip(langs.to_pylist(), texts.to_pylist())
        ]
        return rows, *[list(x) for x in zip(*found)]

    return map_rows(frame, run, schema)
