"""Streams that pick up each file once."""

import os

from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators import ledger, merge
from tidewell.plans.cleaning import clean_products
from tidewell.sources.layers import land, table_path
from tidewell.streaming import incremental

SCHEMA = "product_id long, brand string"


def test_only_new_files_are_processed(spark, tmp_path):
    root, out, check = str(tmp_path), f"{tmp_path}/out", f"{tmp_path}/check"
    raw = table_path(root, "raw", "postgres", "products")

    def run():
        df = spark.createDataFrame([], SCHEMA)
        incremental.stream_processed(spark, raw, out, check, df.schema, clean_products).awaitTermination()

    land(spark.createDataFrame([(1, None)], SCHEMA), root, "postgres", "products", "b_1")
    run()
    assert rows(spark.read.parquet(out).select("product_id", "brand", "batch_id")) == [(1, "Unknown", "b_1")]
    folders = sorted(os.listdir(out))
    run()
    assert sorted(os.listdir(out)) == folders
    land(spark.createDataFrame([(2, "x")], SCHEMA), root, "postgres", "products", "b_2")
    run()
    got = spark.read.parquet(out).select("product_id", "batch_id")
    assert rows(got, "product_id") == [(1, "b_1"), (2, "b_2")]
    # A lost checkpoint replays every batch into its own folder.
    check = f"{tmp_path}/check2"
    land(spark.createDataFrame([(3, "y")], SCHEMA), root, "postgres", "products", "b_3")
    run()
    got = spark.read.parquet(out).select("product_id", "batch_id")
    assert rows(got, "product_id") == [(1, "b_1"), (2, "b_2"), (3, "b_3")]


def test_stream_merge_is_idempotent(spark, tmp_path):
    root, runs = str(tmp_path), f"{tmp_path}/runs"
    source = table_path(root, "processed", "postgres", "products")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(checkpoint="check"):
        incremental.stream_merge(
            spark, source, root, f"{root}/{checkpoint}", schema, "products", "postgres",
            ["product_id"], runs,
        ).awaitTermination()

    def table():
        tagged = spark.createDataFrame([], SCHEMA + ", batch_id string").schema
        return rows(merge.read_table(spark, root, "products", tagged).select("product_id", "brand"), "product_id")

    land(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA), root, "postgres", "products", "b_1", layer="processed")
    run()
    assert table() == [(1, "a"), (2, "c")]
    land(spark.createDataFrame([(2, "z"), (3, "d")], SCHEMA), root, "postgres", "products", "b_2", layer="processed")
    run()
    assert table() == [(1, "a"), (2, "c"), (3, "d")]
    run()
    # A lost checkpoint replays all batches; the ledger lets only the new one through.
    land(spark.createDataFrame([(1, "q"), (4, "e")], SCHEMA), root, "postgres", "products", "b_10", layer="processed")
    run("other")
    assert table() == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    done = ledger.successes(ledger.read_runs(spark, runs))
    assert rows(done.select("watermark_value", "records_loaded"), F.col("watermark_value")) == [
        ("b_1", 2), ("b_10", 1), ("b_2", 1),
    ]


def test_batches_of_one_trigger_load_in_their_order(spark, tmp_path):
    root, runs = str(tmp_path), f"{tmp_path}/runs"
    source = table_path(root, "processed", "postgres", "products")
    schema = spark.createDataFrame([], SCHEMA).schema
    for batch, brand in (("20260101_000000_10", "apple-second"), ("20260101_000000_9", "zebra-first")):
        land(spark.createDataFrame([(1, brand)], SCHEMA), root, "postgres", "products", batch, layer="processed")
    incremental.stream_merge(
        spark, source, root, f"{root}/check", schema, "products", "postgres", ["product_id"], runs
    ).awaitTermination()
    tagged = spark.createDataFrame([], SCHEMA + ", batch_id string").schema
    table = merge.read_table(spark, root, "products", tagged)
    assert rows(table.select("brand")) == [("zebra-first",)]


def test_a_late_file_of_a_loaded_batch_is_loaded_once(spark, tmp_path):
    root, runs = str(tmp_path), f"{tmp_path}/runs"
    source = table_path(root, "processed", "postgres", "products")
    tagged = spark.createDataFrame([], SCHEMA + ", batch_id string").schema

    def arrive(batch, *values):
        """A file of its own, moved into place next to those that are there."""
        spark.createDataFrame(list(values), SCHEMA).coalesce(1).write.mode("append").parquet(f"{source}/batch_id={batch}")

    def run(checkpoint="check"):
        incremental.stream_merge(
            spark, source, root, f"{root}/{checkpoint}", spark.createDataFrame([], SCHEMA).schema, "products", "postgres",
            ["product_id"], runs,
        ).awaitTermination()
        return rows(merge.read_table(spark, root, "products", tagged).select("product_id", "brand"), "product_id")

    # A batch that is only half there when the trigger fires.
    arrive("b_1", (1, "a"), (None, "no key"))
    assert run() == [(1, "a")]
    arrive("b_2", (3, "c"))
    assert run() == [(1, "a"), (3, "c")]
    arrive("b_1", (2, "b"), (1, "late"), (None, "none either"))
    assert run() == [(1, "a"), (2, "b"), (3, "c")]
    assert run() == [(1, "a"), (2, "b"), (3, "c")]
    # A lost checkpoint offers every batch again; no file is read twice.
    arrive("b_2", (4, "d"))
    assert run("other") == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    done = ledger.successes(ledger.read_runs(spark, runs)).select("watermark_value", "records_extracted", "records_loaded", "records_rejected")
    assert sorted(rows(done)) == [("b_1", 2, 1, 1), ("b_1", 3, 1, 1), ("b_2", 1, 1, 0), ("b_2", 1, 1, 0)]
    unkeyed = spark.read.parquet(table_path(root, merge.UNKEYED, "postgres", "products"))
    assert sorted(r.brand for r in unkeyed.collect()) == ["no key", "none either"]
    assert merge.loaded_files(spark, root, "products").count() == 4
