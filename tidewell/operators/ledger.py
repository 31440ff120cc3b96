"""Run history and high-water marks as append-only Parquet tables.

State is never updated in place. Every change is a new row, and readers take the latest,
so a lost executor or a crashed driver can leave a row missing but never a row half written.
Every append is a folder of its own, so that runs side by side don't meet in one folder's commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.datasets import RUN_STATUSES, struct
from tidewell.functions.text import batch_order
from tidewell.session import read_or_empty
from tidewell.sources import files
from tidewell.sources.scans import mark_literal, mark_value

_TEXT, _LONG, _TIME = T.StringType(), T.LongType(), T.TimestampType()

RUN_EVENTS = struct(
    run_id=_TEXT, load_id=_TEXT, pipeline_name=_TEXT, source_name=_TEXT,
    event_seq=T.IntegerType(), event_time=_TIME, status=_TEXT, records_extracted=_LONG,
    records_loaded=_LONG, records_ignored=_LONG, records_rejected=_LONG, error_message=_TEXT, watermark_value=_TEXT,
)

MARKS = struct(
    pipeline_name=_TEXT, source_name=_TEXT, watermark_column=_TEXT, watermark_value=_TEXT,
    last_sequence=_LONG, updated_at=_TIME,
)

STARTED, FINISHED = 1, 2


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RUN_EVENTS, nested=True)


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, MARKS, nested=True)


def append_rows(df: DataFrame, path: str) -> None:
    """Add a few rows to an append-only table."""
    df.coalesce(1).write.parquet(f"{path}/{uuid.uuid4().hex}")


def _append(df: DataFrame, path: str, schema: T.StructType) -> None:
    have = set(df.columns)
    row = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    append_rows(df.select(*row), path)


def append_runs(df: DataFrame, path: str) -> None:
    """Append run events; columns ``df`` lacks are null. A few rows per load."""
    _append(df, path, RUN_EVENTS)


def append_marks(df: DataFrame, path: str) -> None:
    _append(df, path, MARKS)


def start_run(batches: DataFrame, path: str, load_id: str, pipeline: str, source: str) -> None:
    """A ``started`` row per batch; ``batches`` has one ``batch_id`` per row."""
    append_runs(
        batches.select(
            F.concat_ws(":", F.lit(load_id), F.lit(pipeline), "batch_id").alias("run_id"),
            F.lit(load_id).alias("load_id"),
            F.lit(pipeline).alias("pipeline_name"),
            F.lit(source).alias("source_name"),
            F.lit(STARTED).alias("event_seq"),
            F.current_timestamp().alias("event_time"),
            F.lit("started").alias("status"),
            F.col("batch_id").alias("watermark_value"),
        ),
        path,
    )


def _finish(
    spark: SparkSession, path: str, load_id: str, pipeline: str, source: str, status: str, runs: list[tuple],
    error: str | None = None,
) -> None:
    """A closing row for each batch of a load. ``runs`` holds the batch and its four counts."""
    numbers = "records_extracted long, records_loaded long, records_ignored long, records_rejected long"
    rows = spark.createDataFrame(runs, f"watermark_value string, {numbers}")
    append_runs(
        rows.select(
            "*",
            F.concat_ws(":", F.lit(load_id), F.lit(pipeline), "watermark_value").alias("run_id"),
            F.lit(load_id).alias("load_id"),
            F.lit(pipeline).alias("pipeline_name"),
            F.lit(source).alias("source_name"),
            F.lit(FINISHED).alias("event_seq"),
            F.current_timestamp().alias("event_time"),
            F.lit(status).alias("status"),
            F.lit(error).alias("error_message"),
        ),
        path,
    )


def mark_success(
    spark: SparkSession, path: str, load_id: str, pipeline: str, source: str, counts: list[list]
) -> None:
    """A ``success`` row per batch of the load.

    ``counts`` holds ``[batch, extracted, loaded, rejected]``. Rows read that were neither
    loaded nor rejected were ignored as already present.
    """
    runs = [(b, read, loaded, read - loaded - rejected, rejected) for b, read, loaded, rejected in counts]
    _finish(spark, path, load_id, pipeline, source, "success", runs)


def mark_fail(
    spark: SparkSession, path: str, load_id: str, pipeline: str, source: str, batches: list[str], error: str
) -> None:
    _finish(spark, path, load_id, pipeline, source, "failed", [(b, None, None, None, None) for b in batches], error)


def mark_skipped(batches: DataFrame, path: str, load_id: str, pipeline: str, source: str) -> None:
    names = [r.batch_id for r in batches.select("batch_id").collect()]
    _finish(batches.sparkSession, path, load_id, pipeline, source, "skipped", [(b, None, None, None, None) for b in names])


def run_state(events: DataFrame) -> DataFrame:
    """The current row of every run, with its start and completion times."""
    others = [c for c in events.columns if c not in ("run_id", "event_time")]
    latest = F.max_by(F.struct(*others), F.struct("event_seq", "event_time"))
    finished = F.max(F.when(F.col("event_seq") == FINISHED, F.col("event_time")))
    return events.groupBy("run_id").agg(
        latest.alias("_last"), F.min("event_time").alias("started_at"),
        finished.alias("completed_at"),
    ).select("run_id", "_last.*", "started_at", "completed_at")


def bad_statuses(events: DataFrame) -> DataFrame:
    return events.filter(F.col("status").isNull() | ~F.col("status").isin(*RUN_STATUSES))


def recent_runs(events: DataFrame, pipeline: str, source: str, limit: int = 20) -> DataFrame:
    """The newest runs of one pipeline and source."""
    wanted = events.filter(
        (F.col("pipeline_name") == pipeline) & (F.col("source_name") == source)
    )
    return run_state(wanted).orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit)


def successes(events: DataFrame) -> DataFrame:
    return events.filter(F.col("status") == "success")


def pending_batches(
    batches: DataFrame, events: DataFrame, pipeline: str, source: str
) -> DataFrame:
    """Batches without a successful run of the same pipeline, source and batch id."""
    done = (
        successes(events)
        .filter((F.col("pipeline_name") == pipeline) & (F.col("source_name") == source))
        .select(F.col("watermark_value").alias("batch_id"))
    )
    return batches.join(done, "batch_id", "left_anti")


def compact(spark: SparkSession, path: str) -> None:
    """Gather a table's appends into one, so that reading it doesn't grow with the number of loads.

    The appends that went in are named in a list and deleted by the next call. Until then their rows come
    twice, which no reader minds, as each takes the latest row of a run; so none meets a missing file or a missing row.
    """
    listed, there = f"{path}/_gathered", files.names(spark, path)
    gathered = files.read_text(spark, listed).split("\n") if "_gathered" in there else []
    for name in gathered:
        files.remove(spark, f"{path}/{name}")
    files.remove(spark, listed)
    small = sorted(n for n in there if not n.startswith("_") and n not in gathered)
    if len(small) > 1:
        append_rows(spark.read.parquet(*[f"{path}/{n}" for n in small]).dropDuplicates(), path)
        files.put_if_absent(spark, listed, "\n".join(small))


def pending_ids(batches: DataFrame, events: DataFrame, pipeline: str, source: str) -> list[str]:
    """The pending batches in load order: a few ids per run, never the history."""
    todo = pending_batches(batches, events, pipeline, source)
    return [r.batch_id for r in todo.orderBy(*batch_order(F.col("batch_id"))).collect()]


def latest_mark(marks: DataFrame) -> DataFrame:
    """The current mark per (pipeline, source): the last writer wins."""
    rest = [c for c in marks.columns if c not in ("pipeline_name", "source_name")]
    last = F.max_by(F.struct(*rest), F.struct("updated_at", "last_sequence"))
    return marks.groupBy("pipeline_name", "source_name").agg(last.alias("_m")).select(
        "pipeline_name", "source_name", "_m.*"
    )


def read_mark(marks: DataFrame, pipeline: str, source: str) -> tuple[str | None, int]:
    """Mark and last sequence of one object; ``(None, 0)`` asks for a full scan."""
    row = latest_mark(
        marks.filter((F.col("pipeline_name") == pipeline) & (F.col("source_name") == source))
    ).first()
    return (row["watermark_value"], row["last_sequence"] or 0) if row else (None, 0)


def advance_mark(
    batch: DataFrame, col: str, previous: str | None = None, mark_type: str = "timestamp"
) -> DataFrame:
    """One row: the highest value of ``col``, nulls ignored, never below ``previous``.

    Values compare in the column's own type, and times kept as text as times.
    """
    return batch.agg(highest_mark(batch, col, previous, mark_type).alias("watermark_value"))


def highest_mark(
    batch: DataFrame, col: str, previous: str | None = None, mark_type: str = "timestamp"
) -> Column:
    """The aggregate behind ``advance_mark``."""
    top = F.max(mark_value(batch, col, mark_type))
    if previous is not None:
        top = F.greatest(top, mark_literal(batch, col, previous, mark_type))
    return top.cast("string")


def write_mark(
    spark: SparkSession, path: str, pipeline: str, source: str, column: str,
    value: str, sequence: int = 0,
) -> None:
    """Upsert by append, keyed by (pipeline, source)."""
    row = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(source).alias("source_name"),
        F.lit(column).alias("watermark_column"),
        F.lit(value).alias("watermark_value"),
        F.lit(sequence).alias("last_sequence"),
        F.current_timestamp().alias("updated_at"),
    )
    append_marks(row, path)


def extract_metrics(landed: DataFrame, table_col: str = "table_name") -> DataFrame:
    """Rows and files per table, and over all tables (null table)."""
    return landed.rollup(table_col).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("file_name").alias("files")
    )
