"""The raw and processed layers: ``<root>/<layer>/<source>/<table>/batch_id=<b>/*.parquet``."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.datasets import DATASETS, MAX_ROWS_PER_FILE
from tidewell.functions.text import batch_id_from_name, batch_order


# The column that says which landed file a row comes from.
LANDED_FILE = "landed_file"


def table_path(root: str, layer: str, source: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{source}/{table}"


def land(
    df: DataFrame,
    root: str,
    source: str,
    table: str,
    batch_id: str | None = None,
    max_rows: int = MAX_ROWS_PER_FILE,
    layer: str = "raw",
    spread: bool = True,
) -> str:
    """Write one batch, or the batches named by a ``batch_id`` column, replacing only those.

    Rows that name the file they come from (``LANDED_FILE``) replace only what that file brought before.
    A single batch is written by the tasks that read it, without a shuffle. Several batches
    are rebalanced first: small ones then share no task with thousands of tiny files, and
    one that holds most of the rows is split over many tasks. ``spread=False`` is for rows read from files
    of one batch each: written as they lie, they make about as many files as were read.
    """
    path = table_path(root, layer, source, table)
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id))
    elif spread:
        df = df.hint("rebalance", F.col("batch_id"))
    parts = [c for c in ("batch_id", LANDED_FILE) if c in df.columns]
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows)
        .partitionBy(*parts)
        .parquet(path)
    )
    return path


def write_processed(df: DataFrame, root: str, source: str, table: str, spread: bool = True) -> str:
    """The processed form of the batches in ``df``, under the same batch ids."""
    return land(df, root, source, table, layer="processed", spread=spread)


LANDED = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("file", T.StringType())])


def landed_files(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> DataFrame:
    """``batch_id`` and name of the files under a table's folder, from the listing alone; none where nothing was landed.

    Only the folders of the named ``batches`` are listed, or all.
    """
    folders = [path] if batches is None else [f"{path}/batch_id={b}" for b in batches]
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("basePath", path)
            .load(folders)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LANDED)
        raise
    if "batch_id" not in listed.columns:
        return spark.createDataFrame([], LANDED)
    return listed.select(F.col("batch_id").cast("string"), F.element_at(F.split("path", "/"), -1).alias("file"))


def batch_ids(spark: SparkSession, root: str, layer: str, source: str, table: str) -> DataFrame:
    """The batch ids of a table, from the file listing alone."""
    return landed_files(spark, table_path(root, layer, source, table)).select("batch_id").distinct()


def choose_files(listed: DataFrame, wanted: DataFrame) -> list[tuple[str, list[str] | None]]:
    """Batches with wanted files, in load order, and the names of these files where the batch has others too.

    One short row per batch comes to the driver, and the names of files that share their batch with unwanted ones.
    """
    keys = ["batch_id", "file"]
    marked = listed.join(wanted.select(*keys).distinct().withColumn("wanted", F.lit(True)), keys, "left")
    some = marked.groupBy("batch_id").agg(
        F.count("wanted").alias("n"), F.count(F.lit(1)).alias("total"),
        F.collect_list(F.when(F.col("wanted"), F.col("file"))).alias("names"),
    )
    some = some.filter("n > 0").select("batch_id", F.when(F.col("n") < F.col("total"), F.col("names")).alias("names"))
    return [(r.batch_id, r.names) for r in some.orderBy(*batch_order(F.col("batch_id"))).collect()]


# Paths one reader is given; more are read by further readers and put together.
_PATHS = 1000


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[tuple[str, Sequence[str] | None]]
) -> DataFrame:
    """The rows of whole batches, and of single files of others, as ``choose_files`` names them.

    Only these folders and files are listed and opened, and the batch id comes from the folder: nothing is joined.
    ``LANDED_FILE`` says which file a row comes from.
    """
    tagged = with_batch(schema)
    columns = [*map(F.col, tagged.names), F.col("_metadata.file_name").alias(LANDED_FILE)]
    paths = [
        f"{path}/batch_id={b}" if names is None else f"{path}/batch_id={b}/{n}" for b, names in parts for n in (names or [""])
    ]
    reader = spark.read.schema(tagged).option("pathGlobFilter", "*.parquet").option("basePath", path)
    reads = [reader.parquet(*paths[i : i + _PATHS]).select(*columns) for i in range(0, len(paths), _PATHS)]
    if not reads:
        return spark.createDataFrame([], tagged).withColumn(LANDED_FILE, F.lit(""))
    return reduce(DataFrame.unionByName, reads)


def with_batch(schema: T.StructType) -> T.StructType:
    """The schema with the folder's ``batch_id``."""
    if "batch_id" in schema.names:
        return schema
    return T.StructType(schema.fields + [T.StructField("batch_id", T.StringType())])


def scan_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    source: str,
    table: str,
    schema: T.StructType | None = None,
    batches: Sequence[str] | None = None,
) -> DataFrame:
    """The batches of a table as one frame, ``batch_id`` always text.

    Only the folders of the named ``batches`` are listed and read. Without a ``schema`` the
    columns are the union over the files read. An unreadable file fails the job.
    """
    path = table_path(root, layer, source, table)
    reader = (
        spark.read.option("pathGlobFilter", "*.parquet")
        .option("basePath", path)
        .option("mergeSchema", schema is None)
    )
    if schema is not None:
        reader = reader.schema(with_batch(schema))
    folders = [path] if batches is None else [f"{path}/batch_id={b}" for b in batches]
    df = reader.parquet(*folders)
    return df.withColumn("batch_id", F.col("batch_id").cast("string"))


def scan_flat(
    spark: SparkSession, root: str, layer: str, source: str, table: str, provenance: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table landed as plain files ``<table>_<time>_<n>.parquet``; the name gives the batch.

    Without a ``schema`` the columns are the union over the files.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    df = reader.parquet(table_path(root, layer, source, table))
    extra: dict[str, Column] = {
        "batch_id": batch_id_from_name(F.col("_metadata.file_name"), table)
    }
    if provenance:
        extra |= {
            "file_name": F.col("_metadata.file_name"),
            "row_index": F.col("_metadata.row_index"),
        }
    return df.select("*", *[c.alias(n) for n, c in extra.items()])


def skipped_paths(
    spark: SparkSession,
    root: str,
    layer: str = "raw",
    known: Iterable[tuple[str, str]] | None = None,
) -> DataFrame:
    """Parquet files no scan will pick up, with the reason. File contents are not read."""
    known = list(known if known is not None else [(d.source, d.name) for d in DATASETS])
    base = f"{root.rstrip('/')}/{layer}"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select(F.regexp_replace("path", "^.*?" + _quoted(base) + "/", f"{layer}/").alias("path"))
    )
    parts = F.split("path", "/")
    table = F.concat_ws("/", F.element_at(parts, 2), F.element_at(parts, 3))
    short = F.size(parts) < 4
    unknown = ~table.isin([f"{s}/{t}" for s, t in known])
    reason = F.when(short, "path too short").when(unknown, "unknown table")
    return files.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def _quoted(text: str) -> str:
    """Drop the scheme, which Spark may print differently, and quote the rest."""
    return r"\Q" + text.split("://", 1)[-1].removeprefix("file:") + r"\E"


def write_partitioned(
    df: DataFrame, path: str, date_col: str, grain: str = "month", replace_all: bool = True
) -> str:
    """Parquet partitioned by day, month or year of ``date_col``; rows without one keep a null part.

    ``replace_all=False`` replaces only the parts ``df`` has rows for.
    """
    pattern = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[grain]
    part = f"{date_col}_{grain}"
    (
        df.withColumn(part, F.date_format(date_col, pattern))
        .hint("rebalance", F.col(part))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(part)
        .parquet(path)
    )
    return path
