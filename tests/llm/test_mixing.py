import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, documents, words
from conftest import plan
from pyspark.sql import functions as F

from tidewell.llm.mixing import mix, mixed_documents, permuted, targets


def plain_targets(sizes):
    """Water filling: sources by code point, null last, weigh 3, 1, 2 and stop at twice their size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        share = rest / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if weight[s] * share > 2 * sizes[s]}
        if not full:
            return out | {s: weight[s] * share for s in open_}
        out |= {s: 2.0 * sizes[s] for s in full}
        rest -= sum(2 * sizes[s] for s in full)
        open_ -= full


def corpus(n=300):
    draw = np.random.default_rng(4)
    name = ["big", "big", "big", "zeta", "Alpha", None, "é"]
    return [(i, " ".join(f"w{i}_{k}" for k in range(draw.integers(0, 90))), "en", name[i % 7]) for i in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 1, None: 500}, {"x": 7}, {"a": 0, "b": 9, "": 4}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_words_taken_come_near_the_targets(spark):
    rows = corpus()
    found = mix(documents(spark, rows), block_words=16, shard_blocks=32).collect()
    assert sorted(r.id for r in found) == list(range(300))
    size = {i: len(words(t)) for i, t, *_ in rows}
    by_source = defaultdict(int)
    for i, *_, source in rows:
        by_source[source] += size[i]
    want, taken = plain_targets(by_source), defaultdict(int)
    for r in found:
        source = rows[r.id][3]
        assert (r.size, r.source_size) == (size[r.id], by_source[source])
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.05 * target + 4 * 16


def test_reruns_and_other_partitions_agree(spark):
    df = documents(spark, corpus(120))
    once, again = (sorted((r.id, r.taken) for r in mix(x, block_words=8).collect()) for x in (df, df.repartition(7, "text")))
    assert once == again


def test_the_mix_holds_the_words_it_took(spark):
    rows = corpus(100)
    df = documents(spark, rows)
    taken = {r.id: r.taken for r in mix(df, block_words=16).collect()}
    got = defaultdict(int)
    for r in mixed_documents(df, block_words=16).select("row.doc_id", "row.text", "kept_text").collect():
        kept, own = words(r.kept_text), words(r.text)
        assert kept
        assert kept == [w for w in own if w in set(kept)]
        got[r.doc_id] += len(kept)
    assert got == {i: n for i, n in taken.items() if n}


def test_a_document_taken_whole_keeps_its_layout(spark):
    texts = ["  def f(x):\n\treturn  x\r\n\n", "one", "- é \U0001f642\n  - b\x0b\n", "\n\nlast  line"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    whole = mixed_documents(documents(spark, rows), most=1, share_percent=100).select("row.text", "kept_text").collect()
    assert sorted(r.text for r in whole) == sorted(texts)
    assert all(r.kept_text == r.text for r in whole)
    # Cut in blocks of two words, the passes hold what lies between the words of a block, and nothing else.
    text = "".join(f"w{k}" + " \n\t"[k % 3] * (1 + k % 4) for k in range(40))
    cut = mixed_documents(documents(spark, [(1, text, "en", "a")]), block_words=2).select("kept_text").collect()
    blocks = re.findall(r"\S+\s+\S+\s+", text)
    assert cut and all(re.findall(r"\S+\s+\S+\s+", r.kept_text) == [b for b in blocks if b in r.kept_text] for r in cut)
    assert all(len(r.kept_text) == sum(len(b) for b in blocks if b in r.kept_text) for r in cut)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000, 4097])
def test_permutations(spark, n):
    keys = [permuted(F.col("id"), F.lit(n).cast("long"), F.lit(f"p{k}")).alias(f"p{k}") for k in range(6)]
    columns = list(zip(*[tuple(r)[1:] for r in spark.range(n).select("id", *keys).orderBy("id").collect()]))
    assert all(sorted(c) == list(range(n)) for c in columns)
    if n >= 50:
        assert len(set(columns)) == 6
        for c in columns:
            # No stride: neighbours lie at many different distances.
            steps = {(x - y) % n for x, y in zip(c, c[1:])}
            assert len(steps) > n // 3
            assert abs(np.corrcoef(range(n), c)[0, 1]) < 0.5


def test_permutations_of_many(spark):
    n = 10**12 + 7
    got = spark.range(20_000).select(permuted(F.col("id"), F.lit(n), F.lit("k")).alias("p")).agg(
        F.count_distinct("p"), F.min("p"), F.max("p"), F.avg("p")
    ).first()
    assert got[0] == 20_000 and 0 <= got[1] and got[2] < n and abs(got[3] / n - 0.5) < 0.02


def test_taken_follows_from_the_places(spark):
    """Every slot of every shard holds one block, and a document's words are those its blocks' places take."""
    rows = corpus(150)
    block, shard = 16, 32
    found = mix(documents(spark, rows), block_words=block, shard_blocks=shard).collect()
    held = defaultdict(set)
    at = {}
    for r in found:
        spans = r.spans or []
        assert r.taken == sum(x.length * len(x.places) for x in spans)
        assert all(x.uses == len(x.places) == len({p["pass"] for p in x.places}) for x in spans)
        for x in spans:
            assert 0 <= x.start and x.start + x.length <= r.size
            for p in x.places:
                held[p.shard].add(p.slot)
                at.setdefault((p.shard, p.slot), []).append((rows[r.id][3], r.id, x.start, x.length))
    assert sorted(held) == list(range(len(held)))
    assert all(max(slots) < shard for slots in held.values())
    for parts in at.values():
        # One slot, one block: words of one source, a block's number at most, and whole documents in its middle.
        assert len({source for source, *_ in parts}) == 1
        assert sum(length for *_, length in parts) <= block


def test_many_equal_rows_meet_one_each(spark):
    rows = [(None, "the same text of a few words", "en", "a")] * 3000
    got = mixed_documents(documents(spark, rows), most=1, share_percent=100)
    assert got.count() == 3000
    keys = [line for line in plan(got).split("\n") if "Join" in line and "_hash" in line]
    assert any("_n" in line and "_m" in line for line in keys)


def test_awkward_rows(spark):
    found = mix(documents(spark))
    assert sorted((r.id, r.size) for r in found.collect() if r.id) == sorted((r[0], len(words(r[1]))) for r in AWKWARD if r[0])
    assert found.count() == len(AWKWARD)
    assert found.filter("taken > 2 * size OR taken IS NULL").count() == 0
    assert mixed_documents(documents(spark)).filter("row.text IS NULL").count() == 0
    assert mix(documents(spark, [])).collect() == []
    assert mixed_documents(documents(spark, [])).collect() == []
    blank = mix(documents(spark, [(1, None, None, None), (2, " ", "en", "a")])).collect()
    assert [(r.size, r.taken, r.target) for r in blank] == [(0, 0, 0.0)] * 2
