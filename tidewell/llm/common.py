"""What the text operators share: word and row conventions, stored tables, distributed numbering.

Operators that return documents keep the input columns in one struct column ``row``, so that an
input column may have any name without clashing with a result column.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewell.session import shared_dir

# U+0020 and U+0009..U+000D part words; ``bytes.split()`` parts at exactly these.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; a null text has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def packed(df: DataFrame, carry: list[str] | None = None, **more: Column) -> DataFrame:
    """All columns, or those to ``carry``, in one struct ``row``, next to the given ones."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("row"), *[c.alias(k) for k, c in more.items()])


def unpacked(df: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``row`` in their order, some replaced."""
    names = df.schema["row"].dataType.names
    return df.select(*[replaced.get(c, F.col(f"row.`{c}`")).alias(c) for c in names])


def stored(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts lineage and outlives executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn, schema: str | T.StructType, rows: int = 512) -> DataFrame:
    """``mapInArrow`` in small steps: ``fn`` takes columns as lists and returns columns as lists.

    ``rows`` bounds what Python holds at once to a few hundred texts.
    """
    spark_schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow_schema = to_arrow_schema(spark_schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = fn(*part.columns)
                if out is not None:
                    arrays = [
                        x.cast(f.type) if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type)
                        for x, f in zip(out, arrow_schema)
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return df.mapInArrow(run, spark_schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_start(df: DataFrame, group: list[str], key: str, order: list[str], size: str, name: str, slices: int = 1024) -> DataFrame:
    """Adds ``name``: the sum of ``size`` over the rows before each one in its group.

    Rows are in order of their slice (``slice_of`` the key), then of ``order``. Sums run inside a slice, and
    a slice starts where the sums of the slices before it end, so that no task holds more than a slice of a
    group, however large the group. Group columns must not be null.
    """
    df = df.withColumn("_slice", slice_of(F.col(key), slices))
    keys = [*group, "_slice"]
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = df.groupBy(*keys).agg(F.sum(size).alias("_sum"))
    starts = starts.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return local.join(starts, keys).withColumn(name, F.col("_local") + F.col("_start")).drop("_slice", "_local", "_start")


def slice_of(key: Column, slices: int) -> Column:
    """A number below ``slices`` from the first three hexadecimal digits of ``md5`` of the key as text."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10).cast("int")
    return F.floor(digits * slices / 4096).cast("int")
