"""Scans, layers, feeds and exports."""

import json
import os
from types import SimpleNamespace

import pytest
from conftest import plan, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewell import datasets as D
from tidewell.operators import feed
from tidewell.session import read_or_empty, shared_dir
from tidewell.sources import export, feeds, layers, scans


def test_declared_tables_in_order():
    assert [d.name for d in D.of_source("postgres")] == [
        "customers", "products", "orders", "order_items", "payments",
    ]
    assert D.BY_NAME["order_items"].mark is None


def test_incremental_scan_is_strict_and_pushed(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    top = df.agg(F.max("o_orderdate").cast("string")).first()[0]
    out = scans.incremental_scan(df, ["o_orderkey", "o_orderdate"], "o_orderdate", top)
    assert out.count() == 0
    text = plan(out)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_incremental_scan_compares_text_times_as_times(spark):
    df = spark.createDataFrame(
        [(1, "2025-03-01T10:00:00+05:00"), (2, "2025-03-01T06:00:00Z"), (3, None), (4, "bad")],
        "id long, updated_at string",
    )
    out = scans.incremental_scan(df, ["id"], "updated_at", "2025-03-01T05:30:00Z")
    assert rows(out) == [(2,)]


def test_without_a_mark_everything_is_scanned(spark):
    df = spark.range(3)
    assert scans.incremental_scan(df, ["id"], "id").count() == 3


def write_flat(root, source, table, name, frame):
    folder = os.path.join(root, "raw", source, table)
    os.makedirs(folder, exist_ok=True)
    frame.to_parquet(os.path.join(folder, name), index=False)


@pytest.fixture
def pandas():
    import pandas

    return pandas


def test_flat_layer_takes_the_batch_from_the_name(spark, tmp_path, pandas):
    root = str(tmp_path)
    for n in (1, 2):
        write_flat(root, "postgres", "products", f"products_20260705_101500_123_{n}.parquet",
                   pandas.DataFrame({"product_id": [n, n + 10]}))
    out = layers.scan_flat(spark, root, "raw", "postgres", "products", provenance=True)
    assert rows(out.select("batch_id", "row_index", "product_id"), "product_id") == [
        ("20260705_101500_123_1", 0, 1), ("20260705_101500_123_2", 0, 2),
        ("20260705_101500_123_1", 1, 11), ("20260705_101500_123_2", 1, 12),
    ]


def test_short_and_unknown_paths_are_reported(spark, tmp_path, pandas):
    root, frame = str(tmp_path), pandas.DataFrame({"a": [1]})
    os.makedirs(tmp_path / "raw" / "postgres")
    frame.to_parquet(tmp_path / "raw" / "postgres" / "products.parquet")
    write_flat(root, "postgres", "products", "products_1.parquet", frame)
    write_flat(root, "mongodb", "customers", "customers_1.parquet", frame)
    (tmp_path / "raw" / "mongodb" / "readme.txt").write_text("not data")
    assert rows(layers.skipped_paths(spark, root), "path") == [
        ("raw/mongodb/customers/customers_1.parquet", "unknown table"),
        ("raw/postgres/products.parquet", "path too short"),
    ]


def test_corrupt_parquet_raises(spark, tmp_path):
    folder = tmp_path / "raw" / "postgres" / "products" / "batch_id=b1"
    folder.mkdir(parents=True)
    (folder / "part.parquet").write_bytes(b"corrupted parquet")
    with pytest.raises((PySparkException, Py4JJavaError)):
        layers.scan_layer(spark, str(tmp_path), "raw", "postgres", "products").count()


def test_processed_keeps_batch_and_raw_stays(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([("b1", 1), ("b2", 2)], "batch_id string, product_id long")
    raw = layers.land(df, root, "postgres", "products")
    before = sorted(os.walk(raw))
    layers.write_processed(layers.scan_layer(spark, root, "raw", "postgres", "products"), root, "postgres", "products")
    assert sorted(os.walk(raw)) == before
    assert sorted(os.listdir(layers.table_path(root, "processed", "postgres", "products")))[-2:] == [
        "batch_id=b1", "batch_id=b2",
    ]
    # Writing one batch again leaves the other alone.
    layers.write_processed(df.filter("batch_id = 'b1'").withColumn("product_id", F.lit(9).cast("long")),
                           root, "postgres", "products")
    assert rows(layers.scan_layer(spark, root, "processed", "postgres", "products").select(
        "batch_id", "product_id"), "batch_id") == [("b1", 9), ("b2", 2)]


def test_land_limits_rows_per_file(spark, tmp_path):
    path = layers.land(spark.range(250).coalesce(1), str(tmp_path), "postgres", "orders", "b1", max_rows=100)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 100 and sum(r["count"] for r in sizes) == 250


def test_partition_pruning(spark, tmp_path):
    df = spark.range(60).select("id", (F.lit("2025-01-01").cast("date") + F.col("id").cast("int")).alias("day"))
    path = layers.write_partitioned(df, str(tmp_path / "t"), "day", "month")
    kept = spark.read.parquet(path).filter("day_month = '2025-02'")
    assert "PartitionFilters: [isnotnull(day_month" in plan(kept) and kept.count() == 28


def test_csv_round_trip(spark, tmp_path):
    data = [(1, 'say "hi", ok'), (2, ""), (3, None), (4, "two\nlines"), (5, " pad "), (6, "\\"), (7, "a\\N")]
    df = spark.createDataFrame(data, "id long, text string")
    path = export.csv_export(df, str(tmp_path / "csv"))
    assert rows(export.csv_import(spark, path, df.schema), "id") == data
    raw = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert '"say ""hi"", ok"' in raw and "3,\\N" in raw


SHIPMENT = {
    "shipment_id": "s1", "order_id": 1, "carrier_id": "c", "tracking_number": "t",
    "shipment_status": "delivered", "updated_at": "2025-01-01T00:00:00Z",
    "delivery_address": {"city": "Lagos"},
    "events": [{"event_type": "x", "event_time": "2025-01-01T00:00:00Z", "metadata": {"k": "v"}}],
}


def envelope(page, ids, total, pages):
    return {
        "page": page, "limit": 2, "total": total, "total_pages": pages,
        "next_page": page + 1 if page < pages else None,
        "shipments": [{**SHIPMENT, "shipment_id": i} for i in ids],
    }


def land_pages(tmp_path, pages):
    folder = tmp_path / "pages"
    folder.mkdir()
    for n, p in enumerate(pages):
        (folder / f"{n}.json").write_text(json.dumps(p))
    return str(folder)


def test_pages_read_and_complete(spark, tmp_path):
    path = land_pages(tmp_path, [envelope(1, ["a", "b"], 3, 2), envelope(2, ["c"], 3, 2)])
    out = feeds.read_pages(spark, path, D.SHIPMENT_SCHEMA)
    assert rows(out.select("shipment_id", "delivery_address.city", "events.metadata"), "shipment_id") == [
        (i, "Lagos", [{"k": "v"}]) for i in "abc"
    ]
    assert feeds.page_gaps(feeds.read_envelopes(spark, path, D.SHIPMENT_SCHEMA)).isEmpty()


def test_empty_feed_is_complete(spark, tmp_path):
    path = land_pages(tmp_path, [envelope(1, [], 0, 0)])
    assert feeds.read_pages(spark, path, D.SHIPMENT_SCHEMA).isEmpty()
    assert feeds.page_gaps(feeds.read_envelopes(spark, path, D.SHIPMENT_SCHEMA)).isEmpty()


def test_missing_page_and_items_are_found(spark, tmp_path):
    path = land_pages(tmp_path, [envelope(1, ["a", "b"], 5, 3), envelope(3, ["e"], 5, 3)])
    gaps = feeds.page_gaps(feeds.read_envelopes(spark, path, D.SHIPMENT_SCHEMA))
    assert sorted(rows(gaps)) == [("item_count", None, 3), ("missing_page", 2, None)]


def test_bad_payload_fails(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "1.json").write_text('{"page": 1, "shipments": [')
    with pytest.raises((PySparkException, Py4JJavaError)):
        feeds.read_pages(spark, str(folder), D.SHIPMENT_SCHEMA).collect()


def test_unpaged_array(spark, tmp_path):
    (tmp_path / "carriers.json").write_text(
        json.dumps([{"carrier_id": "a", "carrier_name": "A"}, {"carrier_id": "b"}], indent=2)
    )
    out = feeds.read_unpaged(spark, str(tmp_path / "carriers.json"), D.CARRIER_SCHEMA)
    assert rows(out, "carrier_id") == [("a", "A", None, None), ("b", None, None, None)]


FEED = "shipment_id string, shipment_status string, updated_at string"


def test_feed_filter(spark):
    df = spark.createDataFrame(
        [("a", "x", "2025-01-01T00:00:00Z"), ("b", "x", "2025-01-02"), ("c", "y", "bad"), ("d", "x", None)],
        FEED,
    )
    assert feed.feed_filter(df).count() == 4
    assert rows(feed.feed_filter(df, status="y").select("shipment_id")) == [("c",)]
    assert rows(feed.feed_filter(df, updated_since="2025-01-01T00:00:00").select("shipment_id")) == [("b",)]
    with pytest.raises(ValueError):
        feed.feed_filter(df, updated_since="yesterday")
    with pytest.raises(ValueError):
        feed.feed_filter(df, updated_since="2025-13-45")
    # Forms that Python reads but rows may not have.
    for text in ("2025-W01-1", "20250101", "2025-01-01T00"):
        with pytest.raises(ValueError, match="cutoff"):
            feed.feed_filter(df, updated_since=text)
    assert rows(feed.feed_filter(df, updated_since="2025-01-01T00:00:00 +00:00").select("shipment_id")) == [("b",)]


def test_page_bounds_and_totals(spark):
    df = spark.range(25).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("shipment_id"))
    got, totals = feed.page(df, ["shipment_id"], 3, 10)
    assert [r[0] for r in rows(got)] == ["020", "021", "022", "023", "024"]
    assert rows(totals) == [(3, 10, 25, 3, None)]
    assert rows(feed.page(df, ["shipment_id"], 1, 10)[1]) == [(1, 10, 25, 3, 2)]
    assert rows(feed.page(df.limit(0), ["shipment_id"], 1, 10)[1]) == [(1, 10, 0, 0, None)]
    after, _ = feed.page(df, ["shipment_id"], 3, 10, after=["019"])
    assert rows(after) == rows(got)
    pairs = spark.range(6).select((F.col("id") % 2).alias("a"), F.col("id").alias("b"))
    assert rows(feed.page(pairs, ["a", "b"], 1, 3, after=[0, 2])[0]) == [(0, 4), (1, 1), (1, 3)]
    for bad in ((0, 10), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            feed.page(df, ["shipment_id"], *bad)


def test_page_is_a_top_k(spark):
    got, _ = feed.page(spark.range(1000), ["id"], 2, 10)
    assert "TakeOrderedAndProject" in plan(got) and "Exchange rangepartitioning" not in plan(got)


def test_lookup(spark):
    assert feed.lookup(spark.range(5), "id", 3).count() == 1
    assert feed.lookup(spark.range(5), "id", 9).count() == 0


def test_shared_dir_reads_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base) and shared_dir(spark, "x") != shared_dir(spark, "x")


def test_only_a_local_session_may_use_its_own_disk():
    def session(master):
        conf = SimpleNamespace(get=lambda key, default: default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert "tidewell-" in shared_dir(session("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"), "x")


def test_read_or_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert read_or_empty(spark, str(tmp_path / "none"), schema).isEmpty()
