import random

import numpy as np
import pytest
from helpers import AWKWARD, documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm.repeats import leftmost_least, remove_repeats, stretches


def brute(rows, window):
    """doc_id, text -> kept text, where a window of a smaller id covers words."""
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        out.append((doc, text, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def got(spark, rows, **options):
    df = documents(spark, [(d, t, None, None) for d, t in rows])
    found = remove_repeats(df, **options).select("row.doc_id", "row.text", "n_words", "n_removed", "kept_text")
    return [tuple(r) for r in found.collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


@pytest.mark.parametrize(("window", "seed", "letters"), [(8, 3, 4), (6, 6, 2), (5, 1, 3)])
def test_random_texts_agree_with_brute_force(spark, window, seed, letters):
    draw = random.Random(window)
    passages = [" ".join(draw.choices("abcdefgh"[:letters], k=draw.randint(3, 30))) for _ in range(25)]
    rows = [(d, " ".join(draw.choices(passages, k=draw.randint(1, 5)))) for d in range(80)]
    rows += [(3, "another text of an id that is there " * 3), (90, rows[0][1]), (90, rows[0][1])]
    assert same(got(spark, rows, window=window, seed=seed), brute(rows, window))


def test_a_passage_in_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(d, f"own{d} words{d} {passage} tail{d}") for d in range(300)]
    kept = {r[0]: r[3] for r in got(spark, rows, window=50, seed=16)}
    assert kept[0] == 0
    assert set(kept.values()) == {0, 120}
    assert same(got(spark, rows[:40]), brute(rows[:40], 50))


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in AWKWARD] + [(20, AWKWARD[3][1])]
    assert same(got(spark, rows), brute(rows, 50))
    assert got(spark, []) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 12))
def test_leftmost_least(values, width):
    values = np.array(values)
    if width <= len(values):
        expected = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert leftmost_least(values, width).tolist() == expected


def test_equal_windows_have_equal_anchors_and_hashes():
    w = [f"w{i * i % 31}".encode() for i in range(200)]
    h, g, first, count = stretches(w, 20, 5)
    moved = stretches([b"front"] * 7 + w, 20, 5)
    assert count.sum() == 181
    assert set(zip(h[1:-1].tolist(), g[1:-1].tolist())) <= set(zip(moved[0].tolist(), moved[1].tolist()))


def test_a_text_of_one_word_is_one_stretch(spark):
    words = [b"same"] * 100_000
    assert len(stretches(words, 50, 16)[0]) == 1
    rows = [(1, "same " * 70), (2, "same " * 20_000), (3, "x " + "same " * 60 + "y"), (4, "other " * 49)]
    assert same(got(spark, rows, window=50, seed=16), brute(rows, 50))
