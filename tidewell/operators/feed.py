"""Filter, paging and lookup with the semantics of the paged logistics feed."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions.casts import ISO_TIMESTAMP
from tidewell.session import shared_dir
from tidewell.sources.scans import incremental_scan

MAX_PAGE_SIZE = 100


def feed_filter(
    df: DataFrame,
    status: str | None = None,
    updated_since: str | None = None,
    status_col: str = "shipment_status",
    updated_col: str = "updated_at",
) -> DataFrame:
    """Equality on status and strict ``>`` on the update time, each only when given.

    A row whose update time is missing or unreadable never passes ``updated_since``. A
    cutoff in a form that rows could not have either is an error.
    """
    if status:
        df = df.filter(F.col(status_col) == status)
    if updated_since:
        unread = f"cannot read the cutoff time {updated_since!r}"
        if not re.match(ISO_TIMESTAMP, updated_since):
            raise ValueError(unread)
        try:
            cutoff = datetime.fromisoformat(re.sub(r" (?=(Z|[+-]\d{2}:?\d{2})$)", "", updated_since))
        except ValueError:
            raise ValueError(unread) from None
        if cutoff.tzinfo is not None:
            cutoff = cutoff.astimezone(timezone.utc).replace(tzinfo=None)
        df = incremental_scan(df, (), updated_col, cutoff.isoformat(" "))
    return df


def page_index(df: DataFrame, order_by: Sequence[str], limit: int = 50) -> DataFrame:
    """``page`` and the key its first row has, for every page; stored, one row a page.

    Keys are numbered in two levels: ranges of the key are sorted and counted each by a task of its own, and a
    range starts where the counts of those before it end. No task sees more than a range.
    """
    keys = df.select(*order_by)
    path = shared_dir(df.sparkSession, "page-index")
    ranged = keys.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(f"{path}/keys")
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(f"{path}/keys")
    # One row per range: a task of their own for their running sum.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by)) - 1
    numbered = ranged.withColumn("_n", inside).join(F.broadcast(starts), "_range").withColumn("_n", F.col("_n") + F.col("_start"))
    first = numbered.filter(F.col("_n") % limit == 0)
    pages = first.select((F.floor(F.col("_n") / limit) + 1).cast("long").alias("page"), *order_by)
    pages.write.parquet(f"{path}/pages")
    return df.sparkSession.read.schema(pages.schema).parquet(f"{path}/pages")


def page(
    df: DataFrame,
    order_by: Sequence[str],
    page: int = 1,
    limit: int = 50,
    after: Sequence[object] | None = None,
    index: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One page of rows, and one row of totals.

    ``order_by`` must be a unique key. An offset page makes every task keep
    ``page * limit`` rows, so deep walks should pass ``after``, the key of the last row
    seen, or jumps an ``index`` made by ``page_index`` with the same key and limit: the page then
    costs ``limit`` rows a task however deep it lies.
    """
    if page < 1 or not 1 <= limit <= MAX_PAGE_SIZE:
        raise ValueError(f"page must be >= 1 and limit between 1 and {MAX_PAGE_SIZE}")
    rows = df
    if index is not None:
        start = index.filter(F.col("page") == page).select(*order_by).first()
        if start is None:
            rows = rows.limit(0)
        else:
            first = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, start)]
            # On the leading column alone first, which the source can use to skip data.
            rows = rows.filter(F.col(order_by[0]) >= first[0])
            rows = rows.filter(F.struct(*order_by) >= F.struct(*first)).orderBy(*order_by).limit(limit)
    elif after is not None:
        last = [
            F.lit(v).cast(df.schema[c].dataType).alias(c)
            for c, v in zip(order_by, after, strict=True)
        ]
        # On the leading column alone first, which the source can use to skip data.
        rows = rows.filter(F.col(order_by[0]) >= last[0])
        rows = rows.filter(F.struct(*order_by) > F.struct(*last)).orderBy(*order_by).limit(limit)
    else:
        rows = rows.orderBy(*order_by).offset((page - 1) * limit).limit(limit)
    total = F.count(F.lit(1))
    pages = F.ceil(total / F.lit(limit)).cast("long")
    totals = df.agg(
        F.lit(page).cast("long").alias("page"),
        F.lit(limit).cast("long").alias("limit"),
        total.alias("total"),
        pages.alias("total_pages"),
        F.when(F.lit(page) < pages, F.lit(page + 1).cast("long")).alias("next_page"),
    )
    return rows, totals


def lookup(df: DataFrame, key: str, value: object) -> DataFrame:
    """The row with this id, or no row."""
    return df.filter(F.col(key) == F.lit(value))
