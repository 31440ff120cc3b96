import random

import numpy as np
import pytest
from helpers import AWKWARD, LONG, documents, table_rows

from tidewell.llm.pieces import DEFAULT_MODEL, SPACE, Codec, decode, encode, read_pieces, round_trip


def vocabulary():
    pieces = [("<unk>", 0.0, "control")] + [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)]
    for i, p in enumerate([SPACE, SPACE * 2, "a", "b", SPACE + "a", "ab", "ba", "aba", SPACE + "ab", "bb", SPACE + "abab", "xa"]):
        pieces.append((p, -float(i * 7 % 5) - 1, "piece"))
    return pieces


def brute(pieces, text):
    """Best sum of scores over all segmentations, bytes at the price of an unknown character."""
    score = {p: s for p, s, kind in pieces if kind == "piece"}
    unknown = min(s for p, s in score.items() if set(p) != {SPACE}) - 10
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            s = score.get(text[start:end], unknown if end - start == 1 else -np.inf)
            best[end] = max(best[end], best[start] + s)
    return best[-1]


def total(codec, pieces, ids):
    out, k = 0.0, 0
    byte_ids = {i: b for b, i in enumerate(codec.byte_ids)}
    while k < len(ids):
        if ids[k] in byte_ids:
            lead = byte_ids[ids[k]]
            out += codec.unknown
            k += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        else:
            out += pieces[ids[k]][1]
            k += 1
    return out


def test_best_segmentation(spark):
    pieces = vocabulary()
    codec, draw = Codec(pieces), random.Random(2)
    for _ in range(400):
        text = "".join(draw.choices("aabb xé\U0001f642", k=draw.randint(0, 14)))
        ids = codec.encode(text).tolist()
        assert codec.decode(ids) == text
        if text:
            assert total(codec, pieces, ids) == pytest.approx(brute(pieces, SPACE + text.replace(" ", SPACE))), text


@pytest.mark.parametrize("blanks", [{1: -3.0, 2: -1.0}, {1: -1e9, 2: -1e9, 3: -1e9}])
def test_spans_of_spaces_before_characters_without_a_piece(blanks):
    """Pieces of several blanks are worth taking, whatever comes after the blanks."""
    pieces = [p for p in vocabulary() if p[2] != "piece" or set(p[0]) != {SPACE}] + [(SPACE * n, s, "piece") for n, s in blanks.items()]
    codec, draw = Codec(pieces), random.Random(3)
    texts = ["x \ny", "a  \nb", "a \tb", "a   \u4e2d\u6587", "  \n", "a    ", *("".join(draw.choices("ab   x\n", k=draw.randint(1, 14))) for _ in range(300))]
    for text in texts:
        ids = codec.encode(text).tolist()
        assert codec.decode(ids) == text
        assert total(codec, pieces, ids) == pytest.approx(brute(pieces, SPACE + text.replace(" ", SPACE)), rel=1e-12), repr(text)


@pytest.mark.parametrize("text", ["line  \nnext", "a  \tb", "a  \u4e2d\u6587", "    if x:\n\n        y  "])
def test_the_public_vocabulary_on_spans_of_spaces(text):
    pieces = read_pieces(DEFAULT_MODEL)
    codec = Codec(pieces)
    assert total(codec, pieces, codec.encode(text).tolist()) == pytest.approx(brute(pieces, SPACE + text.replace(" ", SPACE)), rel=1e-12)


def test_the_public_vocabulary_on_real_texts(spark, sf_dir):
    pieces = read_pieces(DEFAULT_MODEL)
    codec = Codec(pieces)
    for _, text, *_ in table_rows(spark, sf_dir, "documents")[:30]:
        start = text[:60]
        assert total(codec, pieces, codec.encode(start).tolist()) == pytest.approx(brute(pieces, SPACE + start.replace(" ", SPACE)))


def test_round_trip_of_awkward_rows(spark):
    coded = encode(documents(spark))
    back = decode(coded.select("row.doc_id", "row.text", "ids")).select("row.doc_id", "row.text", "row.ids", "text").toPandas()
    assert len(back) == len(AWKWARD)
    texts = [(r.iloc[1], r.iloc[3]) for _, r in back.iterrows()]
    assert all(a == b for a, b in texts)
    assert sorted(repr(a) for a, _ in texts) == sorted(repr(r[1]) for r in AWKWARD)
    assert all((ids is None) == (text is None) for ids, (text, _) in zip(back["ids"], texts))
    both = {(r.row.doc_id, tuple(r.ids or ()), r.text) for r in round_trip(documents(spark)).collect()}
    assert both == {(r.row.doc_id, tuple(r.row.ids or ()), r.text) for r in decode(coded.select("row.doc_id", "ids")).collect()}
    assert round_trip(documents(spark, [])).collect() == []
    assert encode(documents(spark, [])).collect() == []
    assert decode(encode(documents(spark, [])).select("ids")).collect() == []


def test_long_words_and_the_cache_bound():
    codec = Codec(vocabulary())
    assert codec.decode(codec.encode("ab" * 50_000).tolist()) == "ab" * 50_000
    assert codec.decode(codec.encode(LONG).tolist()) == LONG
    assert all(len(w) <= 64 for w in codec.recent)


def test_pieces_across_words_are_refused():
    with pytest.raises(ValueError, match="after another character"):
        Codec([(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)] + [("a" + SPACE + "b", -1.0, "piece")])
