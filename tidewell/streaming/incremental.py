"""New batches and files picked up by Structured Streaming, each exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.merge import load_landed
from tidewell.sources.layers import LANDED_FILE, read_files, with_batch


def _source(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(with_batch(schema)).option("pathGlobFilter", "*.parquet").parquet(path)


def stream_processed(
    spark: SparkSession,
    raw: str,
    out: str,
    checkpoint: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Clean the batches that arrived since the last run, then stop.

    Every landed batch keeps its ``batch_id`` and owns the folder of that name, which a replay
    overwrites whole. So neither a crash nor a lost checkpoint repeats a row.
    """

    def write(batch: DataFrame, number: int) -> None:
        names = [r.batch_id for r in batch.select("batch_id").distinct().collect()]  # the batches of one trigger
        if names:
            # Whole folders, as a trigger may have seen only some of a batch's files.
            rows = read_files(batch.sparkSession, raw, schema, [(n, None) for n in names]).drop(LANDED_FILE)
            transform(rows).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch_id").parquet(out)

    return (
        _source(spark, raw, schema)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_merge(
    spark: SparkSession,
    processed: str,
    root: str,
    checkpoint: str,
    schema: T.StructType,
    table: str,
    source: str,
    pk: Sequence[str],
    ledger_path: str,
    order_by: Sequence[Column] = (),
    mode: str = "first",
) -> StreamingQuery:
    """Merge newly processed batches into a warehouse table, one load per trigger.

    A trigger only says which batches to look at. What is loaded then are the files of these batches that no
    committed load has read, whatever the checkpoint says: a file that comes late into a loaded
    batch is loaded once, by the trigger that brings it, and batch order decides between versions.
    """

    def load(batch: DataFrame, number: int) -> None:
        names = [r.batch_id for r in batch.select("batch_id").distinct().collect()]  # the batches of one trigger
        if names:
            load_landed(
                batch.sparkSession, processed, root, table, source, with_batch(schema), pk, ledger_path,
                mode=mode, order_by=order_by, batches=names,
            )

    return (
        _source(spark, processed, schema)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
