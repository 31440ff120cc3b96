import random

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, LONG, documents

from tidewell.llm.components import components
from tidewell.llm.simhash import fingerprint, near_duplicates, spanning_links


def plain(text, size=4):
    w = [x.lower() for x in (text or "").encode().split()]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + size]), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius):
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[top(i)] = top(j)
    return [top(i) for i in range(len(prints))]


def expected(rows, radius=4):
    prints = [plain(t) for _, t in rows]
    of = classes(prints, radius)
    least = {}
    for (doc, _), c in zip(rows, of):
        if doc is not None:
            least[c] = min(least.get(c, doc), doc)
    return sorted([(doc, f"{p:016x}", least.get(c)) for (doc, _), p, c in zip(rows, prints, of)], key=repr), len(set(of))


def check(spark, rows, **options):
    df = documents(spark, [(d, t, None, None) for d, t in rows])
    found = near_duplicates(df, **options).select("row.doc_id", "fingerprint", "component_id", "stays").collect()
    want, groups = expected(rows, options.get("radius", 4))
    assert sorted([tuple(r)[:3] for r in found], key=repr) == want
    staying = [r for r in found if r.stays]
    assert len(staying) == groups
    assert all(r.doc_id == r.component_id for r in staying)


@pytest.mark.parametrize(("tile_rows", "radius"), [(8192, 4), (3, 6), (1, 0)])
def test_agrees_with_brute_force(spark, tile_rows, radius):
    draw = random.Random(radius)
    rows = []
    for _ in range(25):
        w = draw.choices(["Some", "words", "that", "come", "again", "and", "AGAIN"], k=draw.randint(2, 200))
        for _ in range(draw.randint(1, 5)):
            rows.append((len(rows), " ".join(w)))
            w[draw.randrange(len(w))] = "other"
    check(spark, rows, tile_rows=tile_rows, radius=radius)


def test_awkward_rows(spark):
    check(spark, [(r[0], r[1]) for r in AWKWARD])
    check(spark, [(None, "only rows without an id"), (None, "only rows without an id"), (None, "another one of these texts")])
    assert near_duplicates(documents(spark, [])).collect() == []


def test_fingerprints():
    for text in ("", None, "One", "one two THREE", "a b c d", "É é a b c", LONG[:3000], "same " * 50):
        assert fingerprint(text, 4) == plain(text)


def test_spanning_links_keep_the_components():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 6).astype(np.uint64)
    near = np.unique([b ^ np.uint64(1 << int(k)) for b in base for k in draw.integers(0, 60, 40)])
    a, b = spanning_links(near, None, 2)
    assert len(a) == len(near) - len(set(classes([int(x) for x in near], 2)))


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(200 + i, 100) for i in range(30)] + [(7, 7), (5, 4), (0, 1)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, **dict.fromkeys(range(200, 230), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
