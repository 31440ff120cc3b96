"""Idempotent loads into warehouse tables.

A table is a list of segments, Parquet folders ``load_id=<id>`` that never change. A load writes a new segment
and becomes visible when it creates the next numbered manifest (``commits``), so a crash
at any point leaves nothing to undo, a rerun of loaded batches reads nothing, and two loads of a table
never both commit on the same view of it.

Segments of about one size are merged into one, so that a table has a few segments for each power of
``FAN`` of its rows, however often it was loaded. Large segments have their keys, or in ``latest`` mode their rows,
bucketed and sorted by key: a large batch then meets them without a shuffle of the table.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewell.functions.text import batch_order
from tidewell.operators import commits, ledger
from tidewell.operators.clean import REPEATED
from tidewell.operators.commits import Segment
from tidewell.sources import files, layers


def first_per_key(df: DataFrame, pk: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order_by``; null keys form a group.

    Ranking ``<= 1`` lets Spark cut every map task to one row per key before the shuffle,
    so a key that holds most of the table costs no more than any other.
    """
    window = Window.partitionBy(*pk).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def row_order(df: DataFrame, pk: Sequence[str], *first: Column) -> list[Column]:
    """A total order within a key: the given columns, then every sortable column left."""
    rest = [
        F.col(f.name) for f in df.schema
        if f.name not in pk and not isinstance(f.dataType, T.MapType)
    ]
    return [*first, *rest]


def split_null_keys(df: DataFrame, pk: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and rows with a null key part, which no merge can place."""
    null_part = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    return df.filter(~null_part), df.filter(null_part)


def merge_first_wins(
    staged: DataFrame, target: DataFrame, pk: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """The staged rows to insert: one per key, and only keys the target lacks."""
    keyed, _ = split_null_keys(staged, pk)
    candidates = first_per_key(keyed, pk, order_by)
    return candidates.join(target.select(*pk), list(pk), "left_anti")


def merge_latest_wins(
    versions: DataFrame, pk: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """The current version per key; ``order_by`` names the newest first."""
    keyed, _ = split_null_keys(versions, pk)
    return first_per_key(keyed, pk, order_by)


# Segments of one level that are merged into one; a level is a power of this many rows.
FAN = 8
# Rows for each bucket of a bucketed segment, which one task sorts and meets with its part of a batch. A segment with
# less than two buckets' rows is left plain. Spark takes no more than the most buckets.
BUCKET_ROWS = 500_000
MOST_BUCKETS = 100_000
# A batch of so many times a segment's rows doesn't go by its buckets: they are too few for it.
TOO_MANY = 4
# Keys that hold more rows of a batch than this are cut to one row a task before they are shuffled.
HOT_ROWS = 10_000
# The layer that keeps rows no merge can place, because part of their key is null.
UNKEYED = "unkeyed"


def warehouse_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/warehouse/{table}"


def _segment_path(root: str, table: str, folder: str) -> str:
    return f"{warehouse_path(root, table)}/load_id={folder}"


def _keys_path(root: str, table: str, folder: str = "") -> str:
    return f"{root.rstrip('/')}/control/keys/{table}" + (f"/load_id={folder}" if folder else "")


def _sources_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/control/loaded_files/{table}"


# Segments: written, read, merged


def _bucket_table(path: str) -> str:
    return f"tidewell_{hashlib.md5(path.encode()).hexdigest()}"


def _write_segment(
    rows: DataFrame, root: str, table: str, folder: str, pk: Sequence[str], most: int, sources: str | None = None,
    index: bool = False,
) -> Segment:
    """Write rows as a new segment, not counted yet; ``most`` bounds their number.

    With an ``index`` the rows are written by the tasks that have them, and only their keys are shuffled to buckets.
    """
    path = at = _segment_path(root, table, folder)
    buckets = min(most // BUCKET_ROWS, MOST_BUCKETS)
    if buckets < 2 or index:
        rows.write.mode("errorifexists").parquet(path)
    if buckets < 2:
        return Segment(folder, 0, 0, sources)
    if index:
        at = _keys_path(root, table, folder)
        rows = rows.sparkSession.read.schema(rows.schema).parquet(path).select(*pk)
    writer = rows.repartition(buckets, *pk).write.format("parquet").mode("errorifexists")
    writer.bucketBy(buckets, *pk).sortBy(*pk).option("path", at).saveAsTable(_bucket_table(path))
    return Segment(folder, 0, buckets, sources, index)


def _read(
    spark: SparkSession, root: str, table: str, segment: Segment, schema: T.StructType, pk: Sequence[str]
) -> DataFrame:
    """The rows of one segment, by its buckets where they hold rows."""
    path = _segment_path(root, table, segment.folder)
    if not segment.buckets or segment.index:
        return spark.read.schema(schema).parquet(path)
    return _bucketed(spark, _bucket_table(path), path, segment.buckets, schema, pk)


def _read_keys(
    spark: SparkSession, root: str, table: str, segment: Segment, schema: T.StructType, pk: Sequence[str]
) -> DataFrame:
    """The keys of one segment, by its buckets where it has some."""
    if not segment.index:
        return _read(spark, root, table, segment, schema, pk).select(*pk)
    name = _bucket_table(_segment_path(root, table, segment.folder))
    keys = T.StructType([schema[c] for c in pk])
    return _bucketed(spark, name, _keys_path(root, table, segment.folder), segment.buckets, keys, pk)


def _bucketed(
    spark: SparkSession, name: str, path: str, buckets: int, schema: T.StructType, pk: Sequence[str]
) -> DataFrame:
    if not spark.catalog.tableExists(name):
        # Another session wrote it.
        keys = ", ".join(f"`{c}`" for c in pk)
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name).select(*schema.names)


def _together(
    spark: SparkSession, root: str, table: str, segments: Sequence[Segment], schema: T.StructType
) -> DataFrame:
    """The rows of some segments with their ``load_id``; only their folders are listed."""
    tagged = T.StructType(schema.fields + [T.StructField("load_id", T.StringType())])
    if not segments:
        return spark.createDataFrame([], tagged)
    paths = [_segment_path(root, table, s.folder) for s in segments]
    return spark.read.schema(tagged).option("basePath", warehouse_path(root, table)).parquet(*paths)


def read_table(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of all committed loads; the folders of others are not opened.

    Without a ``schema`` the columns are the union over the segments.
    """
    segments = commits.read_manifest(spark, root, table).segments
    if schema is None:
        paths = [_segment_path(root, table, s.folder) for s in segments]
        return spark.read.option("mergeSchema", True).option("basePath", warehouse_path(root, table)).parquet(*paths)
    return _together(spark, root, table, segments, schema)


def read_latest(
    spark: SparkSession, root: str, table: str, schema: T.StructType, pk: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """The current version of each key, first by ``order_by``, of a table loaded in ``latest`` mode.

    A segment holds one version of a key. So rows of the largest segment stand unless a later load names
    their key, and only the other segments, and the rows they replace, are shuffled and ranked.
    """
    segments = sorted(commits.read_manifest(spark, root, table).segments, key=lambda s: -s.rows)
    if len(segments) < 2:
        return _together(spark, root, table, segments, schema).drop("load_id")
    base = _read(spark, root, table, segments[0], schema, pk)
    later = _together(spark, root, table, segments[1:], schema).drop("load_id")
    keys = later.select(*pk).distinct()
    met = later.unionByName(base.join(keys, list(pk), "left_semi").select(*schema.names))
    current = first_per_key(met, pk, order_by).select(*schema.names)
    return base.join(keys, list(pk), "left_anti").select(*schema.names).unionByName(current)


def _level(segment: Segment) -> int:
    return int(math.log(max(segment.rows, 1), FAN) + 1e-9)


def merge_segments(
    spark: SparkSession, root: str, table: str, schema: T.StructType, pk: Sequence[str], ledger_path: str,
    order_by: Sequence[Column] | None = None,
) -> int:
    """Merge the segments of every level that has ``FAN`` of them; returns how many merges were committed.

    Keys of a table in ``first`` mode are unique over its segments, so rows are only copied. With an ``order_by``
    the first version of each key is kept. A merge that a sweep or another merge overtakes is dropped.
    """
    done = 0
    while True:
        manifest = commits.read_manifest(spark, root, table)
        levels = defaultdict(list)
        for s in manifest.segments:
            levels[_level(s)].append(s)
        crowded = [level for level, held in sorted(levels.items()) if len(held) >= FAN]
        if not crowded:
            return done
        old = levels[crowded[0]]
        folder = f"m{uuid.uuid4().hex}"
        rows = _together(spark, root, table, old, schema).drop("load_id")
        if order_by is not None:
            rows = first_per_key(rows, pk, order_by)
        sources = _merge_sources(spark, root, table, old, folder)
        rows = rows.select(*schema.names).hint("rebalance")
        new = _write_segment(rows, root, table, folder, pk, sum(s.rows for s in old), sources, order_by is None)
        new = replace(new, rows=_read(spark, root, table, new, schema, pk).count())
        while set(old) <= set(manifest.segments):
            commits.settle(spark, ledger_path, manifest)
            kept = [s for s in manifest.segments if s not in old]
            if commits.commit(spark, root, table, manifest, [new, *kept]):
                done += 1
                break
            manifest = commits.read_manifest(spark, root, table)
        else:
            return done


def sweep(spark: SparkSession, root: str, table: str, hours: float = 168.0) -> list[str]:
    """Delete what no reader needs and nobody has changed for ``hours``: folders that no manifest lists,
    and manifests but the newest. A load or a query that takes longer than that loses its footing."""
    newest = commits.read_manifest(spark, root, table)
    live = newest.folders() | {s.sources for s in newest.segments}
    now = spark._jvm.java.lang.System.currentTimeMillis()
    gone = []
    for base in (warehouse_path(root, table), _sources_path(root, table), _keys_path(root, table)):
        for name, changed in files.names(spark, base).items():
            if name.removeprefix("load_id=") not in live and now - changed > hours * 3_600_000:
                spark.sql(f"DROP TABLE IF EXISTS {_bucket_table(f'{base}/{name}')}")
                gone.append(f"{base}/{name}")
    for name, changed in files.names(spark, commits.manifests_path(root, table)).items():
        if name.isdigit() and int(name) < newest.number and now - changed > hours * 3_600_000:
            gone.append(f"{commits.manifests_path(root, table)}/{name}")
    for path in gone:
        files.remove(spark, path)
    return gone


# Landed files that went into a table


def loaded_files(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``batch_id`` and ``file`` of every landed file that committed loads have read."""
    ids = sorted({s.sources for s in commits.read_manifest(spark, root, table).segments if s.sources})
    if not ids:
        return spark.createDataFrame([], layers.LANDED)
    return spark.read.schema(layers.LANDED).parquet(*[f"{_sources_path(root, table)}/load_id={i}" for i in ids])


def _merge_sources(spark: SparkSession, root: str, table: str, old: Sequence[Segment], folder: str) -> str | None:
    ids = sorted({s.sources for s in old if s.sources})
    if not ids:
        return None
    rows = spark.read.schema(layers.LANDED).parquet(*[f"{_sources_path(root, table)}/load_id={i}" for i in ids])
    rows.hint("rebalance").write.mode("errorifexists").parquet(f"{_sources_path(root, table)}/load_id={folder}")
    return folder


# Loads


def load_landed(
    spark: SparkSession, path: str, root: str, table: str, source: str, schema: T.StructType, pk: Sequence[str],
    ledger_path: str, marks_path: str | None = None, mode: str = "first", order_by: Sequence[Column] = (),
    batches: Sequence[str] | None = None,
) -> str | None:
    """Load the landed files under ``path`` that no committed load has read; all in one job.

    The unit is the file: one that arrives in a batch that is already loaded is loaded by the next call, alone and
    once. Only the named ``batches`` are looked at, or all. See ``load_batches``.
    """
    listed = layers.landed_files(spark, path, batches)
    new = listed.join(loaded_files(spark, root, table), ["batch_id", "file"], "left_anti")
    parts = layers.choose_files(listed, new)
    if not parts:
        return None
    rows = layers.read_files(spark, path, schema, parts)
    pending = [b for b, _ in parts]
    return load_batches(
        spark, rows, root, table, source, pk, ledger_path, marks_path, mode, order_by, pending, new
    )


def load_batches(
    spark: SparkSession,
    processed: DataFrame,
    root: str,
    table: str,
    source: str,
    pk: Sequence[str],
    ledger_path: str,
    marks_path: str | None = None,
    mode: str = "first",
    order_by: Sequence[Column] = (),
    pending: Sequence[str] | None = None,
    landed: DataFrame | None = None,
) -> str | None:
    """Load every batch of ``processed`` the ledger does not list as done; all in one job.

    ``pending`` names those batches, in load order, where the caller has looked them up, and
    ``landed`` the files their rows come from, to be remembered as loaded.

    ``mode='first'`` inserts keys the table lacks: the earliest batch wins, then
    ``order_by``. ``mode='latest'`` appends the newest version of each key, first by
    ``order_by``, then the latest batch; read it through ``read_latest``. Returns
    the load id, or ``None`` when nothing was pending. On error before the commit the run is
    marked failed and the error raised again.

    Rows with a null key part go to the ``unkeyed`` layer and are counted as rejected. A load
    that others overtake takes their keys out and writes again before it commits.
    """
    load_id = uuid.uuid4().hex
    manifest = commits.read_manifest(spark, root, table)
    commits.settle(spark, ledger_path, manifest)
    if pending is None:
        batches = processed.select("batch_id").distinct()
        pending = ledger.pending_ids(batches, ledger.read_runs(spark, ledger_path), table, source)
    if not pending:
        return None
    started = spark.createDataFrame([(b,) for b in pending], "batch_id string")
    ledger.start_run(started, ledger_path, load_id, table, source)
    staging = f"{root.rstrip('/')}/staging/{table}/{load_id}"
    try:
        schema = T.StructType([f for f in processed.schema if f.name != layers.LANDED_FILE])
        rows = processed.filter(F.col("batch_id").isin(list(pending)))
        keyed, unkeyed = split_null_keys(rows, pk)
        read = {c.batch_id: (c.records_extracted, c.records_rejected) for c in _counts(rows, pk)}
        if any(rejected for _, rejected in read.values()):
            layers.land(unkeyed, root, source, table, layer=UNKEYED)
        number = batch_order(F.col("batch_id"))
        if mode == "first":
            order = [*number, *order_by]
        else:
            order = [*order_by, *[c.desc() for c in number]]
        order = row_order(processed.select(*schema.names), pk, *order)
        most = sum(n for n, _ in read.values())
        large = most >= 2 * BUCKET_ROWS
        repeated = f"{staging}/repeated" if large else None
        if mode == "first" and large:
            # Known keys are taken out first, so that only rows of new ones are ranked.
            keyed = _without_known(keyed, root, table, manifest.segments, schema, pk, most, f"{staging}/before")
        inserted = _one_per_key(keyed, pk, order, most, repeated).select(*schema.names)
        if mode == "first" and manifest.segments and not large:
            # The staging table cuts the lineage and gives the planner the batch's true size,
            # so a small batch is broadcast against the target instead of shuffling the target.
            inserted.write.parquet(f"{staging}/rows")
            inserted = spark.read.schema(schema).parquet(f"{staging}/rows")
        sources = None
        if landed is not None:
            sources = load_id
            landed.write.mode("errorifexists").parquet(f"{_sources_path(root, table)}/load_id={load_id}")
        seen: set[Segment] = set(manifest.segments) if large else set()
        attempt, folder = 0, load_id
        # Keys of segments that others commit meanwhile are taken out before this load commits.
        while True:
            if mode == "first":
                fresh = [s for s in manifest.segments if s not in seen]
                known = f"{staging}/known_{attempt}" if large else None
                inserted = _without_known(inserted, root, table, fresh, schema, pk, most, known)
            segment = _write_segment(
                inserted.select(*schema.names), root, table, folder, pk, most, sources, mode == "first"
            )
            inserted = _read(spark, root, table, segment, schema, pk)
            written = dict(inserted.groupBy("batch_id").count().collect())
            segment = replace(segment, rows=sum(written.values()))
            load = {
                "load_id": load_id, "pipeline": table, "source": source,
                "counts": [[b, *read.get(b, (0, 0))[:1], written.get(b, 0), *read.get(b, (0, 0))[1:]] for b in pending],
            }
            committed = commits.commit(spark, root, table, manifest, [*manifest.segments, segment], load)
            if committed:
                break
            seen |= set(manifest.segments)
            manifest = commits.read_manifest(spark, root, table)
            commits.settle(spark, ledger_path, manifest)
            attempt += 1
            folder = f"{load_id}_{attempt}"
    except Exception as error:
        ledger.mark_fail(spark, ledger_path, load_id, table, source, list(pending), str(error))
        raise
    # The load is committed: what fails from here on raises, but it is no failed load.
    ledger.mark_success(spark, ledger_path, **committed.load)
    if marks_path:
        ledger.write_mark(spark, marks_path, table, source, "batch_id", pending[-1])
    files.remove(spark, staging)
    merge_segments(spark, root, table, schema, pk, ledger_path, None if mode == "first" else order)
    return load_id


def _counts(rows: DataFrame, pk: Sequence[str]) -> list:
    """Rows read and rows without a whole key, per pending batch."""
    null_part = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    return rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("records_extracted"),
        F.count(F.when(null_part, 1)).alias("records_rejected"),
    ).collect()


def _one_per_key(
    keyed: DataFrame, pk: Sequence[str], order_by: Sequence[Column], most: int, path: str | None
) -> DataFrame:
    """What ``first_per_key`` gives; of a large batch, with a ``path`` for its keys that repeat, by these.

    Where few keys repeat only their rows are shuffled and ranked. Where many do all rows are shuffled, to as many tasks
    as a segment of them has buckets; keys that hold very many rows are cut to one a task before.
    """
    if path is None:
        return first_per_key(keyed, pk, order_by)
    counted = keyed.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counted.write.parquet(path)
    repeated = keyed.sparkSession.read.schema(counted.schema).parquet(path)
    few = repeated.count() <= REPEATED
    apart = F.broadcast((repeated if few else repeated.filter(F.col("n") > HOT_ROWS)).select(*pk))
    rest = keyed.join(apart, list(pk), "left_anti")
    if not few:
        rest = first_per_key(rest.repartition(max(most // BUCKET_ROWS, 1), *pk), pk, order_by)
    return rest.unionByName(first_per_key(keyed.join(apart, list(pk), "left_semi"), pk, order_by))


def _without_known(
    staged: DataFrame, root: str, table: str, segments: Sequence[Segment], schema: T.StructType, pk: Sequence[str],
    most: int = 0, path: str | None = None,
) -> DataFrame:
    """The staged rows, at ``most`` so many, whose key none of the segments holds.

    Bucketed segments are met one by one, each in its own buckets; the others, which are small, together. With a ``path`` the
    keys they hold are stored there first. Where these are few, or the keys that are left are, the rows are not shuffled.
    """
    spark = staged.sparkSession
    by_bucket = [s for s in segments if s.buckets and most <= TOO_MANY * s.rows]
    targets = [_read_keys(spark, root, table, s, schema, pk) for s in by_bucket]
    plain = [s for s in segments if s not in by_bucket]
    if plain:
        targets.append(_together(spark, root, table, plain, schema))
    if not targets:
        return staged
    within = _key_range(staged, pk[0])
    met = []
    for target in targets:
        keys = target.select(*pk) if within is None else target.filter(within).select(*pk)
        met.append(keys.join(staged.select(*pk), list(pk), "left_semi"))
    known = reduce(DataFrame.unionByName, met)
    if path is None:
        return staged.join(known, list(pk), "left_anti")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    known = stored(known, "known")
    found = known.count()
    if not found:
        return staged
    if found <= REPEATED:
        return staged.join(F.broadcast(known), list(pk), "left_anti")
    fresh = stored(staged.select(*pk).join(known, list(pk), "left_anti").distinct(), "fresh")
    if fresh.count() <= REPEATED:
        return staged.join(F.broadcast(fresh), list(pk), "left_semi")
    return stored(staged.join(known, list(pk), "left_anti"), "rows")


def _key_range(staged: DataFrame, col: str) -> Column | None:
    """The batch's range of a key column, by which Parquet statistics can prune a target."""
    if not isinstance(staged.schema[col].dataType, (T.NumericType, T.StringType)):
        return None
    low, high = staged.agg(F.min(col), F.max(col)).first()
    return None if low is None else F.col(col).between(low, high)
