import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, documents
from pyspark.sql import functions as F

from tidewell.llm import language_id
from tidewell.llm.language_id import GramCounts, identify_languages, learn_profiles
from tidewell.llm.queries import QUERIES


def folded(text):
    signs = []
    for c in text:
        if c.isalpha():
            signs.append(c.lower() if len(c.lower()) == 1 else c)
        else:
            signs.append(c if unicodedata.category(c).startswith("M") else " ")
    words = "".join(signs).split(" ")
    return [" " + w + " " for w in words if w]


def brute_grams(text):
    found = Counter()
    for word in folded(text):
        for n in (1, 2, 3):
            for i in range(len(word) - n + 1):
                if word[i : i + n] != " ":
                    found[word[i : i + n]] += 1
    return found


def brute_ranked(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]


def brute(rows, train, size):
    """(language, score) of each row, by plain Python."""
    taught = defaultdict(Counter)
    for (_, text, lang, _), learn in zip(rows, train):
        if learn and lang is not None and text is not None:
            taught[lang].update(brute_grams(text))
    profiles = {lang: {g: r for r, g in enumerate(brute_ranked(c, size))} for lang, c in taught.items() if c}
    out = []
    for _, text, _, _ in rows:
        own = brute_ranked(brute_grams(text or ""), size)
        if not profiles or not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        far = sorted(
            (sum(abs(p[g] - r) if g in p else size for r, g in enumerate(own)), lang) for lang, p in profiles.items()
        )
        second = far[1][0] if len(far) > 1 else size * len(own)
        out.append((far[0][1], 0.5 if far[0][0] + second == 0 else second / (far[0][0] + second)))
    return out


def got(spark, rows, train, size=300, **options):
    # The id is the row's number; the other columns of ``rows`` stay.
    df = documents(spark, [(i, *r[1:]) for i, r in enumerate(rows)])
    picked = F.col("doc_id").isin([i for i, learn in enumerate(train) if learn])
    found = identify_languages(df, learn_profiles(df, picked, size=size), size=size, **options)
    assert found.columns == ["row", "lang_pred", "score"]
    return [(r.lang_pred, r.score) for r in found.orderBy("row.doc_id").collect()]


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 16])
def test_grams_are_those_of_plain_python_wherever_blocks_end(monkeypatch, block):
    monkeypatch.setattr(language_id, "_BLOCK", block)
    monkeypatch.setattr(language_id, "_PENDING", 3 * block)
    draw = random.Random(block)
    for _ in range(200):
        text = "".join(draw.choice("aB éß.\n1 İ́中") for _ in range(draw.randint(0, 40)))
        counts = GramCounts()
        counts.add(text)
        keys, times = counts.totals()
        expected = {sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)): n for g, n in brute_grams(text).items()}
        assert dict(zip(keys.tolist(), times.tolist())) == expected


def texts(draw, n):
    """Rows of three made-up languages with letters in common, some without a label or a letter."""
    alphabets = {"xa": "aeioubcd", "xb": "aeiouklm", "": "aeiouxyz"}
    rows = []
    for _ in range(n):
        lang = draw.choice(list(alphabets))
        words = ["".join(draw.choice(alphabets[lang]) for _ in range(draw.randint(1, 6))) for _ in range(draw.randint(0, 30))]
        rows.append((None, " ".join(words), draw.choice([lang, lang, lang, None]), None))
    return rows


@pytest.mark.parametrize("size", [5, 300])
def test_same_as_plain_python(spark, size):
    draw = random.Random(size)
    rows = texts(draw, 60) + AWKWARD
    train = [draw.random() < 0.6 for _ in rows]
    assert got(spark, rows, train, size) == brute(rows, train, size)


def test_more_languages_than_a_pass_or_a_matrix_takes(spark, monkeypatch):
    draw = random.Random(4)
    rows = [(None, "".join(draw.choice("abcdef ") for _ in range(30)), f"l{i % 9}", None) for i in range(40)]
    train = [True] * len(rows)
    expected = brute(rows, train, 300)
    assert got(spark, rows, train) == expected
    assert got(spark, rows, train, pass_languages=2) == expected


def test_equal_distances_go_to_the_language_that_sorts_first(spark):
    rows = [(None, "abc abd", lang, None) for lang in ("zz", "b", "B", "b")]
    assert got(spark, rows, [True] * 4) == [("B", 0.5)] * 4


def test_nothing_to_learn_from_and_no_rows(spark):
    assert set(got(spark, AWKWARD, [False] * len(AWKWARD))) == {("und", 0.0)}
    assert got(spark, [(None, "12 .", "en", None), (None, "word", None, None)], [True, True]) == [("und", 0.0)] * 2
    assert got(spark, [], []) == []


def test_one_language_scores_against_the_farthest_distance(spark):
    ((lang, score),) = got(spark, [(None, "some words", "en", None)], [True])
    assert (lang, score) == ("en", 1.0)


def test_held_out_accuracy_and_labels_of_held_out_rows_teach_nothing(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["op11_language_id"](spark, sf_dir).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.99
