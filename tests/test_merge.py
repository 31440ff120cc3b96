"""Loads that can be repeated, interrupted and traced."""

import random
import threading

import pytest
from conftest import plan, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewell.operators import commits, ledger, merge
from tidewell.sources import files
from tidewell.sources.layers import scan_layer

PRODUCTS = "batch_id string, product_id long, brand string"
FAILURES = (PySparkException, Py4JJavaError)


class Store:
    """A warehouse with its ledger, in a folder of the test."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.runs, self.marks = f"{root}/runs", f"{root}/marks"

    def load(self, df, pk=("product_id",), mode="first", order_by=()):
        self.schema = df.schema
        return merge.load_batches(
            self.spark, df, self.root, "products", "postgres", pk, self.runs, self.marks, mode, order_by
        )

    def table(self):
        return merge.read_table(self.spark, self.root, "products", self.schema)

    def latest(self, pk, order_by):
        return merge.read_latest(self.spark, self.root, "products", self.schema, pk, order_by)

    def manifest(self):
        return commits.read_manifest(self.spark, self.root, "products")

    def events(self):
        return ledger.read_runs(self.spark, self.runs)

    def state(self):
        cols = ["watermark_value", "status", "records_extracted", "records_loaded", "records_ignored"]
        return rows(ledger.run_state(self.events()).select(*cols), *cols)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


@pytest.fixture
def products(spark):
    return spark.createDataFrame([("b_1", 1, "Apple"), ("b_1", 2, None), ("b_1", 3, "Samsung")], PRODUCTS)


def test_second_load_inserts_nothing(store, products):
    assert store.load(products) is not None
    first = sorted(rows(store.table()))
    assert len(first) == 3
    assert store.load(products) is None
    assert sorted(rows(store.table())) == first
    assert store.state() == [("b_1", "success", 3, 3, 0)]
    marks = ledger.latest_mark(ledger.read_marks(store.spark, store.marks))
    assert rows(marks.select("watermark_column", "watermark_value")) == [("batch_id", "b_1")]


def test_first_batch_wins_in_numeric_order(spark, store):
    df = spark.createDataFrame([("t_10", 1, "late"), ("t_2", 1, "early"), ("t_10", 2, "x")], PRODUCTS)
    store.load(df)
    assert rows(store.table().select("product_id", "brand"), "product_id") == [(1, "early"), (2, "x")]
    assert store.state() == [("t_10", "success", 2, 1, 1), ("t_2", "success", 1, 1, 0)]
    mark = ledger.read_mark(ledger.read_marks(spark, store.marks), "products", "postgres")
    assert mark[0] == "t_10"


def test_loaded_rows_never_change(spark, store, products):
    store.load(products)
    store.load(spark.createDataFrame([("b_2", 2, "New"), ("b_2", 4, "Sony")], PRODUCTS))
    assert rows(store.table().select("product_id", "brand"), "product_id") == [
        (1, "Apple"), (2, None), (3, "Samsung"), (4, "Sony"),
    ]


def test_composite_and_null_keys(spark, store):
    df = spark.createDataFrame([("b_1", 1, "A"), ("b_1", 1, "B"), ("b_1", 1, None), ("b_1", None, "A")], PRODUCTS)
    store.load(df, pk=("product_id", "brand"))
    assert sorted(rows(store.table().select("product_id", "brand"))) == [(1, "A"), (1, "B")]
    keyed, rejected = merge.split_null_keys(df, ["product_id", "brand"])
    assert keyed.count() == 2 and rejected.count() == 2
    # The rows no merge can place are kept, and every row read is accounted for.
    kept = scan_layer(spark, store.root, merge.UNKEYED, "postgres", "products", df.schema)
    assert sorted(rows(kept.select(*df.columns)), key=repr) == sorted(rows(rejected), key=repr)
    run = ledger.run_state(store.events()).first()
    assert (run.records_extracted, run.records_loaded, run.records_ignored, run.records_rejected) == (4, 2, 0, 2)


def test_latest_wins(spark, store):
    schema = "batch_id string, product_id long, brand string, updated_at string"
    newest = [F.desc("updated_at")]
    store.load(spark.createDataFrame([("b_1", 1, "old", "2025-01-01"), ("b_1", 2, "two", "2025-01-01")], schema),
               mode="latest", order_by=newest)
    store.load(spark.createDataFrame([("b_2", 1, "new", "2025-02-01"), ("b_2", 1, "mid", "2025-01-15")], schema),
               mode="latest", order_by=newest)
    versions = store.table()
    assert versions.count() == 3
    current = merge.merge_latest_wins(versions, ["product_id"], newest)
    assert rows(current.select("product_id", "brand"), "product_id") == [(1, "new"), (2, "two")]
    read = store.latest(("product_id",), newest)
    assert rows(read, "product_id") == rows(current.drop("load_id"), "product_id")


def test_failure_is_recorded_and_raised(spark, store, products):
    poison = products.withColumn("brand", F.raise_error(F.lit("bad brand")).cast("string"))
    with pytest.raises(FAILURES, match="bad brand"):
        store.load(poison)
    assert store.state() == [("b_1", "failed", None, None, None)]
    assert store.table().isEmpty()
    # The batch is still pending, so the next run loads it.
    store.load(products)
    assert store.table().count() == 3
    assert sorted(s[1] for s in store.state()) == ["failed", "success"]


def test_a_long_error_is_stored_whole(spark, store, products, monkeypatch):
    text = "x" * 5000 + " the cause"

    def broken(*args):
        raise ValueError(text)

    monkeypatch.setattr(merge, "first_per_key", broken)
    with pytest.raises(ValueError):
        store.load(products)
    assert rows(ledger.run_state(store.events()).select("error_message")) == [(text,)]


def test_a_failure_after_the_commit_is_no_failed_load(spark, store, products, monkeypatch):
    def broken(*args):
        raise OSError("marks are away")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "write_mark", broken)
        with pytest.raises(OSError):
            store.load(products)
    assert [s[:2] for s in store.state()] == [("b_1", "success")]
    assert store.table().count() == 3
    assert store.load(products) is None


def test_a_load_that_is_overtaken_inserts_no_key_twice(spark, store, products, monkeypatch):
    counts, overtaking = merge._counts, []

    def overtaken(*args):
        if not overtaking:
            overtaking.append(True)
            store.load(spark.createDataFrame([("b_0", 1, "first come"), ("b_0", 7, "Seven")], PRODUCTS))
        return counts(*args)

    monkeypatch.setattr(merge, "_counts", overtaken)
    store.load(products)
    got = rows(store.table().select("product_id", "brand"), "product_id")
    assert [r[0] for r in got] == sorted({r[0] for r in got})
    assert got[0] == (1, "first come")
    assert len(got) == 4


def crash(*args, **kwargs):
    raise KeyboardInterrupt("driver lost")


def test_crash_before_commit_leaves_nothing_visible(spark, store, products, monkeypatch):
    store.load(products)
    more = spark.createDataFrame([("b_2", 9, "Nine")], PRODUCTS)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            store.load(more)
    # The data files are there, but no manifest names their folder.
    assert spark.read.parquet(merge.warehouse_path(store.root, "products")).count() == 4
    assert store.table().count() == 3
    store.load(more)
    assert rows(store.table().select("product_id"), "product_id") == [(1,), (2,), (3,), (9,)]


def test_crash_after_commit_is_settled_by_the_next_load(spark, store, products, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "mark_success", crash)
        with pytest.raises(KeyboardInterrupt):
            store.load(products)
    # The rows are there, and the manifest knows what the ledger does not.
    assert store.table().count() == 3
    assert [s[:2] for s in store.state()] == [("b_1", "started")]
    assert store.load(products) is None
    assert store.state() == [("b_1", "success", 3, 3, 0)]
    assert store.table().count() == 3


def test_an_earlier_batch_after_a_crash_still_wins_once(spark, store, monkeypatch):
    late = spark.createDataFrame([("t_2", 1, "late")], PRODUCTS)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            store.load(late)
    store.load(late.unionByName(spark.createDataFrame([("t_1", 1, "early")], PRODUCTS)))
    assert rows(store.table().select("product_id", "brand")) == [(1, "early")]


def test_loaders_that_pass_the_last_look_together_insert_each_key_once(spark, store, products, monkeypatch):
    """Another load commits after this one has looked for the last time, and right before its commit."""
    commit = commits.commit
    others = [[("b_0", 1, "first come")], [("b_x", 2, "second"), ("b_x", 8, "Eight")]]

    def late(*args, **kwargs):
        if others:
            rows_of = others.pop(0)
            with monkeypatch.context() as patch:
                patch.setattr(commits, "commit", commit)
                store.load(spark.createDataFrame(rows_of, PRODUCTS))
        return commit(*args, **kwargs)

    monkeypatch.setattr(commits, "commit", late)
    store.load(products)
    got = rows(store.table().select("product_id", "brand"), "product_id")
    assert got == [(1, "first come"), (2, "second"), (3, "Samsung"), (8, "Eight")]
    assert store.manifest().number == 3
    counts = {s[0]: s[2:] for s in store.state()}
    assert counts == {"b_0": (1, 1, 0), "b_x": (2, 2, 0), "b_1": (3, 1, 2)}


def test_loads_at_the_same_time(spark, tmp_path):
    """Five threads load overlapping keys: each key is there once, and every load is in the ledger."""
    def load(n):
        df = spark.createDataFrame([(f"b_{n}", k, f"by {n}") for k in range(n, n + 6)], PRODUCTS)
        Store(spark, tmp_path).load(df)

    threads = [threading.Thread(target=load, args=(n,)) for n in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = Store(spark, tmp_path)
    store.schema = spark.createDataFrame([], PRODUCTS).schema
    assert [r[0] for r in rows(store.table().select("product_id"), "product_id")] == list(range(10))
    state = store.state()
    assert sorted(s[0] for s in state) == [f"b_{n}" for n in range(5)]
    assert {s[1] for s in state} == {"success"} and sum(s[3] for s in state) == 10


def test_a_name_is_taken_once(spark, tmp_path):
    taken = []

    def take(n):
        taken.append(files.put_if_absent(spark, f"{tmp_path}/c/1", f"writer {n} \u00e9"))

    threads = [threading.Thread(target=take, args=(n,)) for n in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(taken) == 1
    assert list(files.names(spark, f"{tmp_path}/c")) == ["1"]
    assert files.read_text(spark, f"{tmp_path}/c/1").endswith("\u00e9")
    # Elsewhere than on a local disk the name is taken by a rename.
    one, _ = files._open(spark, f"{tmp_path}/c/1")
    two, _ = files._open(spark, f"{tmp_path}/c/2")
    files.rename_new(spark, one, two)
    assert files.put_if_absent(spark, f"{tmp_path}/c/1", "again")
    with pytest.raises(Py4JJavaError, match="FileAlreadyExists"):
        files.rename_new(spark, one, two)


@pytest.mark.parametrize("mode", ["first", "latest"])
def test_reading_does_not_grow_with_the_number_of_loads(spark, store, monkeypatch, mode):
    monkeypatch.setattr(merge, "FAN", 3)
    schema = "batch_id string, product_id long, brand string, updated_at long"
    newest = [F.desc("updated_at")]
    draw, every, folders = random.Random(3), [], []
    for n in range(9):
        part = [(f"b_{n}", draw.randrange(30), f"v{n}", draw.randrange(10**6)) for _ in range(draw.choice([1, 2, 9]))]
        every += part
        store.load(spark.createDataFrame(part, schema), mode=mode, order_by=newest if mode == "latest" else ())
        folders.append(len(store.manifest().segments))
    assert max(folders) <= 2 * 4  # under three for each of the few powers of three
    if mode == "first":
        seen = {}
        for b, k, brand, at in every:
            old = seen.setdefault(k, (b, brand, at))
            if old[0] == b:
                seen[k] = min(old, (b, brand, at))
        got = store.table()
        assert got.count() == len(seen)
        assert {r.product_id: r.batch_id for r in got.collect()} == {k: v[0] for k, v in seen.items()}
    else:
        best = {}
        for b, k, brand, at in every:
            best[k] = max(best.get(k, (-1,)), (at, brand))
        got = store.latest(("product_id",), newest)
        assert {r.product_id: (r.updated_at, r.brand) for r in got.collect()} == best
        assert got.count() == len(best)
        # Rows of the largest segment that no later load names are neither shuffled nor ranked.
        text = plan(store.latest(("product_id",), newest))
        assert text.count("Window [") == 1


def test_a_large_batch_meets_a_bucketed_table_without_shuffling_it(spark, store, monkeypatch):
    monkeypatch.setattr(merge, "BUCKET_ROWS", 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = spark.range(4_000).select(F.lit("b_1").alias("batch_id"), F.col("id").alias("product_id"), F.lit("x").alias("brand"))
        store.load(wide)
        (segment,) = store.manifest().segments
        assert segment.buckets == 8 and segment.rows == 4_000
        staged = wide.withColumn("product_id", F.col("product_id") + 1_000)
        left = merge._without_known(staged, store.root, "products", [segment], wide.schema, ["product_id"])
        text = plan(left)
        below = text[: text.index("SelectedBucketsCount")].rsplit("Join", 1)[1]
        assert "Exchange" not in below
        assert left.count() == 1_000
        # A session that has never seen the table opens it by its manifest.
        spark.sql(f"DROP TABLE {merge._bucket_table(merge._segment_path(store.root, 'products', segment.folder))}")
        store.load(staged.withColumn("batch_id", F.lit("b_2")))
        assert store.table().count() == store.table().select("product_id").distinct().count() == 5_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_are_small_enough_for_one_task():
    """A bucket is sorted by one task, and met by its part of a batch."""
    assert merge.BUCKET_ROWS <= 1_000_000


@pytest.mark.parametrize("few", [True, False])
def test_a_large_load_shuffles_keys_only(spark, store, monkeypatch, few):
    """The rows of unique keys are written as they are read; of keys that repeat the first is kept, hot ones too."""
    monkeypatch.setattr(merge, "BUCKET_ROWS", 100)
    monkeypatch.setattr(merge, "HOT_ROWS", 50)
    if not few:
        monkeypatch.setattr(merge, "REPEATED", 3)
    key = F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 == 1, F.col("id") % 90).otherwise(F.col("id"))
    rows_of = spark.range(1_000).select(
        F.concat(F.lit("b_"), (F.col("id") % 3).cast("string")).alias("batch_id"), key.alias("product_id"),
        F.col("id").cast("string").alias("brand"),
    )
    store.load(rows_of)
    (segment,) = store.manifest().segments
    assert segment.index and segment.buckets == 10
    keys = merge._read_keys(spark, store.root, "products", segment, rows_of.schema, ["product_id"])
    assert "default.tidewell_" in plan(keys) and keys.columns == ["product_id"]
    want = merge.first_per_key(rows_of, ["product_id"], [F.col("batch_id"), F.col("brand")])
    got = store.table().select(*rows_of.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # Another load brings known keys and new ones; a third only known ones.
    more = rows_of.withColumns({"batch_id": F.lit("b_9"), "product_id": F.col("product_id") + 500})
    store.load(more)
    assert store.load(more.withColumn("batch_id", F.lit("b_10")))
    added = merge.first_per_key(more, ["product_id"], [F.col("brand")]).join(want, "product_id", "left_anti")
    now = store.table().select(*rows_of.columns)
    assert now.exceptAll(want.unionByName(added)).isEmpty() and now.count() == want.count() + added.count()
    assert min(s.rows for s in store.manifest().segments) == 0
    merge.sweep(spark, store.root, "products", hours=-1)
    assert store.table().count() == now.count()
    if few:
        text = plan(merge._one_per_key(rows_of, ["product_id"], [F.col("brand")], 1_000, f"{store.root}/repeated"))
        assert "LeftAnti, BuildRight" in text and text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("most", [3, 70, 10_000])
def test_many_known_keys_are_left_out_by_the_few_that_are_new(spark, store, monkeypatch, most):
    monkeypatch.setattr(merge, "BUCKET_ROWS", 100)
    monkeypatch.setattr(merge, "REPEATED", most)
    rows_of = spark.range(1_000).select(F.lit("b_1").alias("batch_id"), F.col("id").alias("product_id"), F.lit("x").alias("brand"))
    store.load(rows_of)
    # Half of the new keys come twice, with versions of their own.
    staged = rows_of.withColumn("product_id", F.col("product_id") + 60).unionByName(rows_of.filter("product_id >= 970").select(
        "batch_id", (F.col("product_id") + 60).alias("product_id"), F.lit("a").alias("brand")
    ))
    left = merge._without_known(
        staged, store.root, "products", store.manifest().segments, rows_of.schema, ["product_id"], 1_030, f"{store.root}/known"
    )
    assert "Exchange hashpartitioning" not in plan(left)
    assert left.count() == 90 and left.agg(F.min("product_id")).first()[0] == 1_000
    assert store.load(staged.withColumn("batch_id", F.lit("b_2")))
    got = store.table().filter("batch_id = 'b_2'")
    assert {(r.product_id, r.brand) for r in got.collect()} == {(k, "a" if k >= 1_030 else "x") for k in range(1_000, 1_060)}
    # A rerun ranks nothing.
    with monkeypatch.context() as patch:
        ranked = []
        patch.setattr(merge, "first_per_key", lambda df, *a, f=merge.first_per_key: ranked.append(df.count()) or f(df, *a))
        assert store.load(staged.withColumn("batch_id", F.lit("b_3")))
    assert sum(ranked) == 0 and store.table().count() == 1_060


def test_a_batch_many_times_a_segment_leaves_its_few_buckets(spark, store, monkeypatch):
    monkeypatch.setattr(merge, "BUCKET_ROWS", 50)
    rows_of = spark.range(100).select(F.lit("b_1").alias("batch_id"), F.col("id").alias("product_id"), F.lit("x").alias("brand"))
    store.load(rows_of)
    (segment,) = store.manifest().segments
    known = ["products", [segment], rows_of.schema, ["product_id"]]
    assert segment.buckets == 2
    for most, times in ((400, 1), (401, 0)):
        left = merge._without_known(rows_of, store.root, *known, most)
        assert ("default.tidewell_" in plan(left)) == bool(times)
        assert left.isEmpty()


def test_sweep_removes_what_nobody_needs(spark, store, products, monkeypatch):
    monkeypatch.setattr(merge, "FAN", 2)
    store.load(products)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            store.load(spark.createDataFrame([("b_x", 9, "Nine")], PRODUCTS))
    store.load(spark.createDataFrame([("b_2", 4, "Sony"), ("b_2", 5, "LG"), ("b_2", 6, "HP")], PRODUCTS))
    before = sorted(rows(store.table().select("product_id", "brand")), key=repr)
    assert len(store.manifest().segments) == 1
    assert merge.sweep(spark, store.root, "products", hours=1) == []
    gone = merge.sweep(spark, store.root, "products", hours=-1)
    assert len(gone) >= 4
    assert len(files.names(spark, merge.warehouse_path(store.root, "products"))) == 1
    assert sorted(rows(store.table().select("product_id", "brand")), key=repr) == before
    assert store.load(products) is None


def test_a_compacted_ledger_says_the_same(spark, store, products):
    for n in range(3):
        store.load(spark.createDataFrame([(f"b_{n}", n, "x")], PRODUCTS))
        ledger.compact(spark, store.runs)
        ledger.compact(spark, store.marks)
    assert store.state() == [(f"b_{n}", "success", 1, 1, 0) for n in range(3)]
    assert store.load(spark.createDataFrame([("b_1", 1, "x")], PRODUCTS)) is None
    assert ledger.read_mark(ledger.read_marks(spark, store.marks), "products", "postgres")[0] == "b_2"
    ledger.compact(spark, store.runs)
    ledger.compact(spark, store.runs)
    assert len([n for n in files.names(spark, store.runs) if not n.startswith("_")]) == 1
    assert store.events().count() == 6


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(merge.first_per_key(df, ["k"], [F.col("id")]))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_only_committed_folders_are_listed(spark, store, products, monkeypatch):
    store.load(products)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", crash)
        with pytest.raises(KeyboardInterrupt):
            store.load(spark.createDataFrame([("b_2", 9, "Nine")], PRODUCTS))
    table = store.table().select("product_id")
    assert "Join" not in plan(table)
    assert len(table.inputFiles()) > 0
    (segment,) = store.manifest().segments
    assert all(segment.folder in f for f in table.inputFiles())


def test_a_hot_batch_is_not_shuffled_by_its_id(spark, store, monkeypatch):
    """The pending rows are ranked as they are read: no join and no shuffle by batch."""
    plans, ranked = [], merge.first_per_key
    monkeypatch.setattr(
        merge, "first_per_key", lambda df, *a: plans.append(plan(df)) or ranked(df, *a)
    )
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "b_2").otherwise("b_1").alias("batch_id"),
        (F.col("id") % 7_000).alias("product_id"), F.col("id").cast("string").alias("brand"),
    )
    store.load(hot)
    assert "Join" not in plans[0] and "Exchange" not in plans[0]
    want = merge.first_per_key(hot, ["product_id"], [F.col("batch_id"), F.col("brand")])
    got = store.table().select(*hot.columns)
    assert got.count() == 7_000
    assert got.exceptAll(want).isEmpty()


def test_marks_and_runs(spark, tmp_path):
    path = f"{tmp_path}/marks"
    assert ledger.read_mark(ledger.read_marks(spark, path), "orders", "postgres") == (None, 0)
    ledger.write_mark(spark, path, "orders", "postgres", "updated_at", "2025-01-01", 3)
    ledger.write_mark(spark, path, "orders", "postgres", "updated_at", "2025-02-01", 4)
    ledger.write_mark(spark, path, "payments", "postgres", "updated_at", "2025-03-01", 1)
    marks = ledger.read_marks(spark, path)
    assert ledger.read_mark(marks, "orders", "postgres") == ("2025-02-01", 4)
    assert ledger.latest_mark(marks).count() == 2

    df = spark.createDataFrame([("2025-01-05",), (None,), ("2025-01-09",)], "d string").select(F.col("d").cast("date"))
    assert ledger.advance_mark(df, "d").first()[0] == "2025-01-09"
    assert ledger.advance_mark(df, "d", "2025-02-01").first()[0] == "2025-02-01"
    assert ledger.advance_mark(df.limit(0), "d").first()[0] is None
    text = spark.createDataFrame([("2025-03-01T10:00:00+05:00",), ("2025-03-01T06:00:00Z",)], "at string")
    assert ledger.advance_mark(text, "at").first()[0] == "2025-03-01 06:00:00"


def test_skipped_and_bad_statuses(spark, tmp_path):
    path = f"{tmp_path}/runs"
    batches = spark.createDataFrame([("b_1",)], "batch_id string")
    ledger.mark_skipped(batches, path, "l1", "orders", "postgres")
    events = ledger.read_runs(spark, path)
    assert rows(ledger.run_state(events).select("status")) == [("skipped",)]
    assert ledger.bad_statuses(events).isEmpty()
    assert ledger.bad_statuses(events.withColumn("status", F.lit("done"))).count() == 1
    assert ledger.pending_batches(batches, events, "orders", "postgres").count() == 1


def test_recent_runs(spark, store):
    for n in (1, 2, 3):
        store.load(spark.createDataFrame([(f"b_{n}", n, "x")], PRODUCTS))
    recent = ledger.recent_runs(store.events(), "products", "postgres", 2)
    assert [r.watermark_value for r in recent.collect()] == ["b_3", "b_2"]
    assert "TakeOrderedAndProject" in plan(recent)


def test_extract_metrics(spark):
    df = spark.createDataFrame([("a", "f1"), ("a", "f2"), ("b", "f3")], "table_name string, file_name string")
    assert rows(ledger.extract_metrics(df), F.col("table_name").asc_nulls_last()) == [
        ("a", 2, 2), ("b", 1, 1), (None, 3, 3),
    ]
