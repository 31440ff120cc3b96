import math
from collections import Counter

import numpy as np
import pytest
from helpers import documents, table_rows, words

from tidewell.llm.quality_rules import CLASSES, Limits, class_counts, distances, js_distance, judge_documents


def base(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) for k in range(3) if windows[tuple(w[i : i + 3])] > 1}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def judged(spark, rows, **options):
    found = judge_documents(documents(spark, rows), **options)
    return found.select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()


def test_base_columns_agree_with_plain_python(spark, sf_dir):
    rows = [(i, t, lang, source) for i, t, lang, source, _ in table_rows(spark, sf_dir, "documents")]
    rows += [(500, "a b c " * 40, "en", None), (501, "a  b\x0bc\x85d e | # |\n\n |\n |", None, None)]
    for r in judged(spark, rows):
        assert tuple(r)[2:8] == base(r.text), r.doc_id
        assert not (r.base_failed and r.kept)


def test_clean_documents_stay_and_junk_goes(spark, sf_dir):
    rows = table_rows(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents")
    quality = {r[0]: r[1] for r in table_rows(spark, sf_dir.replace("sf0.001", "sf0.01"), "labels")}
    got = [r for r in judged(spark, [r[:4] for r in rows]) if r.doc_id in quality and not r.base_failed]
    clean = [r.kept for r in got if quality[r.doc_id] == 1]
    junk = [r.kept for r in got if quality[r.doc_id] == 0]
    assert np.mean(clean) >= 0.99
    assert np.mean(junk) <= 0.5


def test_a_few_rows_without_a_language_are_no_reference(spark):
    draw = np.random.default_rng(6)
    word = ["".join(draw.choice(list("etaoinshrdlu"), size=draw.integers(2, 9))) for _ in range(300)]
    rows = [(i, " ".join(draw.choice(word, size=120)), "en", None) for i in range(40)]
    junk = [" ".join("".join(draw.choice(list("#*$%&|<>0123456789"), size=6)) for _ in range(60)) for _ in range(2)]
    rows += [(100, junk[0], None, None), (101, junk[1], "xx", None)]
    got = {r.doc_id: r.kept for r in judged(spark, rows)}
    assert not got[100] and not got[101]
    assert sum(got[i] for i in range(40)) == 40


def test_js_distance():
    assert js_distance(np.array([1.0, 0]), np.array([0, 3.0])) == pytest.approx(1)
    assert js_distance(np.array([2.0, 2]), np.array([1.0, 1])) == 0
    p, q = np.array([0.5, 0.5]), np.array([0.9, 0.1])
    m = (p + q) / 2
    expected = math.sqrt(sum(x * math.log2(x / y) for x, y in zip(p, m)) / 2 + sum(x * math.log2(x / y) for x, y in zip(q, m)) / 2)
    assert js_distance(p, q) == pytest.approx(expected)


def test_short_texts_are_held_against_nothing():
    reference = (np.ones(len(CLASSES)), {b"the": 0}, np.array([5.0, 5.0]))
    assert distances(b"x" * 199, [b"x"], reference, Limits()) == (None, None)
    assert distances(b"x" * 200, [b"x"], reference, Limits())[0] is not None
    assert class_counts("aB1 .#é\U0001f642@".encode()).tolist() == [1, 1, 1, 1, 1, 1, 1, 2]


def test_awkward_rows(spark):
    got = judged(spark, [*[(i, "ordinary words in a row " * 20, "en", None) for i in range(3)], (9, None, None, None), (9, None, None, None), (None, "", "xx", None)])
    assert len(got) == 6
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in got if not r.text)
    assert judged(spark, []) == []
