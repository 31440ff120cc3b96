import hashlib
import random
from collections import defaultdict

import pytest
from helpers import AWKWARD, documents, line_key

from tidewell.llm.line_dedup import LineRuns, drop_repeated_lines, keep_documents, line_hashes


def brute(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for key in map(line_key, (text or "").split("\n")):
                if len(key) >= min_chars:
                    holders[key].add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or gone.get(line_key(x), doc) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, **options):
    df = documents(spark, [(d, t, None, None) for d, t in rows])
    found = drop_repeated_lines(df, **options).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted([(r[0], r[1], r[2], hashlib.sha256((r[3] or "").encode()).hexdigest()) for r in found], key=repr)


@pytest.mark.parametrize("batches", [1, 5])
def test_agrees_with_brute_force_however_many_batches(spark, batches):
    draw = random.Random(batches)
    pool = [" ".join(draw.choices(["Alpha", "beta", "GAMMA", "İx"], k=draw.randint(1, 9))) for _ in range(40)]
    rows = [(d, "\n".join(draw.choice(["", "  ", "\t"]) + x + " \r" for x in draw.choices(pool, k=draw.randint(1, 8)))) for d in range(60)]
    rows += [(7, "a second row of an id\n" + pool[0]), (None, rows[0][1]), (61, rows[1][1]), (61, rows[1][1])]
    assert got(spark, rows, batches=batches) == brute(rows)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in AWKWARD]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    back = keep_documents(drop_repeated_lines(documents(spark)))
    assert back.columns == documents(spark).columns
    assert back.filter("text IS NULL").count() == sum(r[1] is None for r in AWKWARD)


def test_runs_are_compacted_and_hold_each_key_once(spark):
    runs = LineRuns(spark, fanout=2)
    for k in range(5):
        rows = [(10 * k + d, f"a shared line of some length {d % 3}\na line of its own {k} {d} long", None, None) for d in range(4)]
        runs.add(line_hashes(documents(spark, rows, clashing=False), 20))
    assert {level: len(names) for level, names in runs.levels.items() if names} == {0: 1, 2: 1}
    keys = [(r.h1, r.h2) for level in runs.levels.values() for name, _ in level for r in spark.table(name).collect()]
    assert len(keys) == len(set(keys)) == 3 + 20
    assert sorted(r.n for r in runs.keys().collect()) == [1] * 20 + [5, 5, 10]
