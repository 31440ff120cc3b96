"""Session settings and the shared folder for tables that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method beyond this size, as casts of several columns make; their plans use smaller ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Landed rows take some ten times their file's size in memory: about a million a task, so that sorts don't spill.
    "spark.sql.files.maxPartitionBytes": "32m",
    # A quarter to a half less on disk than the default, for about the same time.
    "spark.sql.parquet.compression.codec": "zstd",
    # A task with rows of a few batches writes them side by side instead of sorting by batch.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(master: str | None = None, app: str = "tidewell", **extra: str) -> SparkSession:
    """A session with this package's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidewell-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may fall back to a temporary folder of its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_dir()
    return f"{base.rstrip('/')}/tidewell/{purpose}-{uuid.uuid4().hex}"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, nested: bool = False) -> DataFrame:
    """The Parquet table at ``path``, or no rows where nothing was written yet; ``nested`` with all folders below."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", nested).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
