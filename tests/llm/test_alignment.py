import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, CLASHING, LONG, documents

from tidewell.llm import alignment
from tidewell.llm.alignment import MODEL_A, MODEL_B, Aligner, align_tokenizers, groups_of, interleaved, links_of, parts_of
from tidewell.llm.queries import QUERIES

ODD = [
    "a  b   c", "x \ny", "tab\there \t ", "▁already", "<s>not special</s> <|endoftext|>", "don't we'll I'm",
    "中文字符 と かな", "\U0001f642\U0001f469‍\U0001f680", "<0x41> <unk>", "é    x", "1234567 89.01", "\r\n\r\n", "a\x00b", "ﬁ Å ①",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(MODEL_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL_B)


def whole(libraries, text):
    """Ids and byte strings of both token lists, by the libraries, of the whole text; None where they differ from it."""
    a, b = libraries
    if not text:
        return None
    signs = alignment.byte_signs()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(signs[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    data = (" " + text).encode()
    return ((ids_a, bytes_a), (ids_b, bytes_b)) if b"".join(bytes_a) == b"".join(bytes_b) == data else None


def spans(ids, values):
    at = 0
    for i, v in zip(ids, values):
        yield i, at, at + len(v)
        at += len(v)


def brute(libraries, texts):
    found, counts = [], Counter()
    for text in texts:
        tokens = whole(libraries, text)
        if tokens is None:
            found.append(None)
            continue
        a, b = (list(spans(*t)) for t in tokens)
        links, first = [], 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, at_a, at_b = [], 0, 0
        for end in ends:
            own_a, own_b = [], []
            while at_a < len(a) and a[at_a][2] <= end:
                own_a.append(a[at_a][0])
                at_a += 1
            while at_b < len(b) and b[at_b][2] <= end:
                own_b.append(b[at_b][0])
                at_b += 1
            groups.append((own_a, own_b))
        counts.update(set(links))
        found.append((len(a), len(b), groups, links))
    most = Counter()
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
            best = sum(counts[p] == most[p[0]] for p in f[3])
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((f[0], f[1], len(f[2]), len(f[3]), best, sum(counts[p] for p in f[3]), digest))
    return out


def digits(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


def got(spark, texts, **options):
    df = documents(spark, [(i, t, None, None) for i, t in enumerate(texts)]).repartition(3)
    return [digits(r) for r in align_tokenizers(df, **options).orderBy("row.doc_id").collect()]


@pytest.mark.parametrize("frequent", [0, 7, 1_000_000])
def test_same_as_the_libraries_and_plain_python(spark, libraries, frequent):
    draw = random.Random(frequent)
    made = ["".join(draw.choice("ab cé \n.'s1中▁") for _ in range(draw.randint(1, 40))) for _ in range(40)]
    texts = [r[1] for r in AWKWARD] + ODD + made
    assert got(spark, texts, frequent_pairs=frequent) == brute(libraries, texts)


def test_parts_give_the_tokens_of_the_whole_text(libraries, monkeypatch):
    draw = random.Random(8)
    aligner = Aligner(*map(alignment._read, (MODEL_A, MODEL_B)))
    texts = [" ".join(draw.choice(ODD) for _ in range(30)) for _ in range(20)] + [None, "", "x", LONG[:5000], "a" * 3000]
    expected = [x.row() for x in aligner.align(texts)]
    for part, batch in ((1, 1), (5, 40), (200, 700)):
        monkeypatch.setattr(alignment, "_PART", part)
        monkeypatch.setattr(alignment, "_BATCH", batch)
        cut = lambda text: parts_of(text, part)
        assert all("".join(cut(t)) == t for t in texts if t)
        monkeypatch.setattr(alignment, "parts_of", cut)
        for x, y in zip(expected, aligner.align(texts)):
            assert all(np.array_equal(a, b) for a, b in zip(x, y.row()))


def test_groups_end_where_both_lists_end():
    draw = np.random.default_rng(2)
    for _ in range(300):
        n = draw.integers(1, 60)
        ends_a, ends_b = (np.append(np.flatnonzero(draw.random(n - 1) < p) + 1, n) for p in draw.random(2))
        group_a, group_b = groups_of(ends_a, ends_b)
        common = np.intersect1d(ends_a, ends_b)
        assert group_a.tolist() == np.searchsorted(common, ends_a).tolist()
        assert group_b.tolist() == np.searchsorted(common, ends_b).tolist()
        starts_a, starts_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
        over = [(i, j) for i in range(len(ends_a)) for j in range(len(ends_b)) if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]
        assert list(zip(*(x.tolist() for x in links_of(ends_a, ends_b)))) == over
        place_a, place_b = interleaved(group_a, group_b)
        order = sorted([(g, 0, i) for i, g in enumerate(group_a)] + [(g, 1, i) for i, g in enumerate(group_b)])
        assert [order.index((g, 0, i)) for i, g in enumerate(group_a)] == place_a.tolist()
        assert [order.index((g, 1, i)) for i, g in enumerate(group_b)] == place_b.tolist()


def test_one_chain_over_a_long_text():
    # B's borders lie inside A's tokens all along, so that only the end of the text is common.
    ends_a = np.append(np.arange(2, 100_000, 2), 100_001)
    ends_b = np.append(np.arange(1, 100_000, 2), 100_001)
    group_a, group_b = groups_of(ends_a, ends_b)
    assert set(group_a) == set(group_b) == {0}


def test_ranks_are_those_of_the_library(libraries, spark, sf_dir):
    coder = Aligner(*map(alignment._read, (MODEL_A, MODEL_B))).a
    texts = [" " + r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text IS NOT NULL").collect()]
    # Every kind of character next to letters, digits, spaces and itself.
    texts += [f" a{c}b {c}1{c}{c} .x" for c in map(chr, [*range(0x3000), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F700)])]
    assert coder.encode(texts) == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


def test_empty_table_clashing_names_and_rows_that_repeat(spark):
    none = documents(spark, []).selectExpr("*", "1 AS pairs", "1 AS key", "1 AS n_a")
    assert align_tokenizers(none).collect() == []
    rows = align_tokenizers(documents(spark).selectExpr("*", "1 AS pairs", "1 AS key", "1 AS n_a")).collect()
    assert len(rows) == len(AWKWARD)
    assert {*CLASHING, "pairs", "key", "n_a"} <= set(rows[0].row.asDict())
    twice = [digits(r) for r in rows if r.row.text == "one text that comes twice"]
    assert len(twice) == 3 and len(set(twice)) == 1


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        alignment.ByteTokens(alignment._read(MODEL_A.replace("byte_bpe_50k", "word_bpe_49k")))


def test_query_over_the_whole_table(spark, sf_dir, libraries):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_token_alignment"](spark, sf_dir).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    assert [digits(r) for r in rows] == brute(libraries, [d.text for d in docs])
