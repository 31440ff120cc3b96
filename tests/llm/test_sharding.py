import heapq
import random
from collections import defaultdict

from helpers import AWKWARD, documents
from pyspark.sql import functions as F

from tidewell.llm.sharding import BIN_LIMIT, deal, schedule, shard_by_size, size_bin


def one_by_one(loads, size, items):
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    got = [0] * len(loads)
    for _ in range(items):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        got[i] += 1
    return got


def test_dealing_in_bulk_is_dealing_one_by_one():
    draw = random.Random(6)
    for _ in range(200):
        loads = [draw.randint(0, 500) for _ in range(draw.randint(1, 20))]
        size, items = draw.randint(1, 60), draw.randint(0, 400)
        mine = list(loads)
        got = deal(mine, size, items)
        expected = one_by_one(loads, size, items)
        assert got == expected
        assert mine == [x + n * size for x, n in zip(loads, expected)]


def test_schedule_balances():
    plan = schedule([(100, 3, 300), (10, 50, 500), (1, 7, 7)], 4)
    assert [b for b, _ in plan] == [100, 10, 1]
    assert [sums[-1] for _, sums in plan] == [3, 50, 7]


def test_bins(spark):
    sizes = [1, 2, 1023, 1024, 1025, 2**20 + 12345, 2**62 + 1]
    got = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", size_bin(F.col("s")).alias("b")).collect()
    for r in got:
        assert r.b <= r.s < r.b * 1.002 + 1
    assert BIN_LIMIT < 30_000


def shards(spark, rows, **options):
    return shard_by_size(documents(spark, rows), **options).select("row.doc_id", "row.text", "size", "shard", "slot").collect()


def test_groups_stay_together_and_loads_are_even(spark):
    draw = random.Random(8)
    texts = ["x" * draw.randint(0, 3000) + str(i) for i in range(400)]
    rows = [(i, draw.choice(texts) if i % 3 else texts[0], "en", None) for i in range(900)]
    found = shards(spark, rows)
    assert sorted(r.doc_id for r in found) == list(range(900))
    place, load, slots = {}, defaultdict(int), defaultdict(list)
    for r in found:
        assert place.setdefault(r.text, r.shard) == r.shard
        assert r.size == len(r.text) + 1
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = defaultdict(int)
    for r in found:
        groups[r.text] += r.size
    heap = [(0, i) for i in range(16)]
    for size in sorted(groups.values(), reverse=True):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
    # Sizes are scheduled in bins of a thousandth, so loads are those of the plain heap to about that.
    assert max(load.values()) <= 1.01 * max(x for x, _ in heap)


def test_order_and_partitions_do_not_matter(spark):
    df = documents(spark, [(i, f"text {i % 40}", "en", None) for i in range(200)])
    once, again = (sorted(tuple(r) for r in shard_by_size(x).select("row.doc_id", "shard", "slot").collect()) for x in (df, df.repartition(5, "doc_id")))
    assert once == again


def test_awkward_rows(spark):
    found = shards(spark, AWKWARD)
    assert len(found) == len(AWKWARD)
    assert len({r.shard for r in found if not r.text}) == 1
    assert all(r.size == 1 for r in found if not r.text)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shards(spark, []) == []
