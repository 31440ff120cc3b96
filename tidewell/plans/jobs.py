"""End-to-end runs: land, process, validate, load, star. Every step can be repeated safely."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.datasets import BY_NAME, DATASETS, Dataset, of_source
from tidewell.functions.text import batch_order
from tidewell.operators import ledger
from tidewell.operators.clean import dedup_by_hash
from tidewell.operators.merge import load_landed, loaded_files, read_latest, read_table, row_order
from tidewell.operators.nested import flatten_struct
from tidewell.operators.quality import ValidationFailed, validate
from tidewell.plans.cleaning import CASTING, EVENT_NO, process
from tidewell.plans.integrity import TEXT_TIMES, integrity_report
from tidewell.plans.schemas import conform, processed_schema, raw_schema, source_schema
from tidewell.plans.star import build_star
from tidewell.plans.suites import SUITES
from tidewell.session import read_or_empty
from tidewell.sources import files
from tidewell.sources.layers import (
    LANDED,
    LANDED_FILE,
    choose_files,
    land,
    landed_files,
    read_files,
    scan_layer,
    table_path,
    write_processed,
)
from tidewell.sources.scans import scan

EXTRACT = "extract"


def runs_path(root: str) -> str:
    return f"{root.rstrip('/')}/control/pipeline_runs"


def marks_path(root: str) -> str:
    return f"{root.rstrip('/')}/control/pipeline_watermarks"


def new_batch_id(sequence: int = 1) -> str:
    now = datetime.now(timezone.utc)
    return f"{now:%Y%m%d_%H%M%S}_{now.microsecond // 1000:03d}_{sequence}"


def extract(
    spark: SparkSession, root: str, dataset: Dataset, source: DataFrame, batch_id: str | None = None
) -> str | None:
    """Land the rows beyond the stored mark, then advance the mark once.

    The mark is read back from the landed batch, so it never runs ahead of durable data.
    Returns the batch id, or ``None`` when there was nothing new.
    """
    name = f"{EXTRACT}:{dataset.name}"
    marks = ledger.read_marks(spark, marks_path(root))
    previous, sequence = ledger.read_mark(marks, name, dataset.source)
    batch_id = batch_id or new_batch_id(sequence + 1)
    folder = f"{table_path(root, 'raw', dataset.source, dataset.name)}/batch_id={batch_id}"
    rows = flatten_struct(conform(scan(dataset, source, previous), source_schema(dataset.name)))
    if not read_or_empty(spark, folder, rows.schema).isEmpty():
        raise ValueError(f"batch {batch_id} of {dataset.name} is already landed")
    land(rows, root, dataset.source, dataset.name, batch_id)
    landed = read_or_empty(spark, folder, rows.schema)
    mark = (
        ledger.highest_mark(landed, dataset.mark, previous, dataset.mark_type)
        if dataset.mark
        else F.lit(None)
    )
    found = landed.agg(F.count(F.lit(1)).alias("rows"), mark.alias("mark")).first()
    if found["rows"] == 0:
        return None
    if found["mark"] is not None and found["mark"] != previous:
        ledger.write_mark(
            spark, marks_path(root), name, dataset.source, dataset.mark, found["mark"], sequence + 1
        )
    return batch_id


def consumed_path(root: str, dataset: Dataset) -> str:
    return f"{root.rstrip('/')}/control/processed_files/{dataset.source}/{dataset.name}"


def process_dataset(
    spark: SparkSession, root: str, dataset: Dataset, on_failure: str = "warn"
) -> dict | None:
    """Clean the batches with raw files not processed yet, write them, validate what was written.

    A batch is cleaned as a whole, so a file that came late is de-duplicated against the others of its batch; the
    load then leaves out what it has.
    With ``quarantine`` the rejected rows go to the ``rejected`` layer instead, and so do rows with an
    integer or a time that can't be read, which otherwise raises or becomes null.
    Returns the validation summary, if the dataset has a suite and anything was pending.
    """
    name, source = dataset.name, dataset.source
    raw = table_path(root, "raw", source, name)
    listed = landed_files(spark, raw)
    done = read_or_empty(spark, consumed_path(root, dataset), LANDED, nested=True)
    new = listed.join(done, ["batch_id", "file"], "left_anti")
    pending = [batch for batch, _ in choose_files(listed, new)]
    if not pending:
        return None
    rows = read_files(spark, raw, raw_schema(name), [(b, None) for b in pending]).drop(LANDED_FILE)
    quarantined = on_failure == "quarantine" and (name in SUITES or name in CASTING)
    scratch = f"{root.rstrip('/')}/staging/{name}/{uuid.uuid4().hex}"
    clean = process(name, rows, reasons=quarantined, dedup=partial(dedup_by_hash, path=scratch))
    suite = SUITES.get(name, () if quarantined else None)
    # Checks run over a written copy, so the cleaning is not computed once per check.
    layer = "checked" if quarantined else "processed"
    land(clean, root, source, name, layer=layer, spread=False)
    files.remove(spark, scratch)
    summary = None
    if suite is not None:
        checked = scan_layer(spark, root, layer, source, name, clean.schema, pending)
        kept, rejected, summary = validate(checked.select(*clean.columns), suite, on_failure)
        if rejected is not None:
            write_processed(kept, root, source, name, spread=False)
            land(rejected, root, source, name, layer="rejected", spread=False)
    # Named last: what is lost before is processed again, into the same folders.
    ledger.append_rows(new.filter(F.col("batch_id").isin(pending)), consumed_path(root, dataset))
    return summary


def load_dataset(
    spark: SparkSession, root: str, dataset: Dataset, mode: str = "first"
) -> str | None:
    """Merge the processed files that no load has read into the warehouse.

    ``first`` never changes a loaded row. ``latest`` keeps every version, and
    ``warehouse_table`` then shows the newest.
    """
    path = table_path(root, "processed", dataset.source, dataset.name)
    schema = processed_schema(dataset.name)
    return load_landed(
        spark, path, root, dataset.name, dataset.source, schema, dataset.primary_key,
        runs_path(root), marks_path(root), mode, _within_batch(schema, mode),
    )


def _within_batch(schema: T.StructType, mode: str) -> list[Column]:
    """The newest version first, or the order the events had in their document."""
    if mode == "latest":
        return [F.col("updated_at").desc()] if "updated_at" in schema.names else []
    return [F.col(EVENT_NO)] if EVENT_NO in schema.names else []


def run(
    spark: SparkSession,
    root: str,
    inputs: Mapping[str, DataFrame],
    on_failure: str = "warn",
    mode: str = "first",
    workers: int = 1,
    integrity: str = "skip",
) -> dict[str, dict | None]:
    """All stages for every dataset given, parents before children, and a summary of each one's suite.

    With ``integrity`` set to ``warn`` the loaded tables are then checked as a whole, and the broken checks
    come under the key ``integrity``; ``fail`` raises when there are any.

    With several ``workers`` datasets run side by side: loads check no foreign keys, so none waits for another, and the
    many short jobs of one leave most of a cluster to the others. An error is raised once all have ended.
    """

    def one(dataset: Dataset) -> dict | None:
        extract(spark, root, dataset, inputs[dataset.name])
        summary = process_dataset(spark, root, dataset, on_failure)
        load_dataset(spark, root, dataset, mode)
        return summary

    given = [d for d in DATASETS if d.name in inputs]
    if workers <= 1:
        summaries = {d.name: one(d) for d in given}
    else:
        with ThreadPoolExecutor(workers) as pool:
            runs = {d.name: pool.submit(one, d) for d in given}
        summaries = {name: run.result() for name, run in runs.items()}
    if integrity != "skip":
        broken = [r.asDict() for r in check(spark, root, mode).collect()]  # one row a check
        if broken and integrity == "fail":
            raise ValidationFailed(", ".join("{table_name}:{check}:{column}".format(**r) for r in broken))
        summaries["integrity"] = {"success": not broken, "broken": broken}
    return summaries


def check(spark: SparkSession, root: str, mode: str = "first") -> DataFrame:
    """Constraints, lengths, keys, amounts and unreadable times over all that is loaded and landed."""
    tables = {d.name: warehouse_table(spark, root, d.name, mode) for d in DATASETS}
    raw = {
        d.name: read_or_empty(spark, table_path(root, "raw", d.source, d.name), raw_schema(d.name))
        for d in DATASETS if d.name in TEXT_TIMES
    }
    return integrity_report(tables, raw)


def run_source(
    spark: SparkSession, root: str, source: str, inputs: Mapping[str, DataFrame], **options
) -> dict[str, dict | None]:
    names = {d.name for d in of_source(source)}
    return run(spark, root, {n: df for n, df in inputs.items() if n in names}, **options)


def warehouse_table(
    spark: SparkSession, root: str, table: str, mode: str = "first"
) -> DataFrame:
    """The committed rows of a table; one row per key in either mode."""
    dataset, schema = BY_NAME[table], processed_schema(table)
    if mode == "first":
        return read_table(spark, root, table, schema)
    newest = [*_within_batch(schema, mode), *[c.desc() for c in batch_order(F.col("batch_id"))]]
    order = row_order(spark.createDataFrame([], schema), dataset.primary_key, *newest)
    return read_latest(spark, root, table, schema, dataset.primary_key, order)


# Tables whose declared key is coarser than an event: the merge keeps one event per key, and
# the shipment columns of the first version. Their facts come from the processed layer instead, of committed batches.
FROM_PROCESSED = ("customer_sessions", "shipments")


def committed_rows(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """The processed rows of the files that a load has committed; no other file is opened, and nothing is joined."""
    path = table_path(root, "processed", dataset.source, dataset.name)
    listed = landed_files(spark, path)
    parts = choose_files(listed, loaded_files(spark, root, dataset.name))
    return read_files(spark, path, processed_schema(dataset.name), parts).drop(LANDED_FILE)


def star(spark: SparkSession, root: str, mode: str = "first") -> dict[str, DataFrame]:
    """The star schema over the loaded warehouse, with every event and the latest shipments."""
    tables = {}
    for d in DATASETS:
        if d.name in FROM_PROCESSED:
            tables[d.name] = committed_rows(spark, root, d)
        else:
            tables[d.name] = warehouse_table(spark, root, d.name, mode)
    tables["shipment_events"] = tables["shipments"]
    return build_star(tables)
