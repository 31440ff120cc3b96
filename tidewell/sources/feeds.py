"""Landed API payloads: page envelopes and bare arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.datasets import struct


def envelope_schema(item_schema: T.StructType, items: str = "shipments") -> T.StructType:
    counts = {c: T.LongType() for c in ("page", "limit", "total", "total_pages", "next_page")}
    return struct(**counts, **{items: T.ArrayType(item_schema)})


def read_envelopes(
    spark: SparkSession, path: str, item_schema: T.StructType, items: str = "shipments"
) -> DataFrame:
    """One row per landed page. A payload that is not valid JSON fails the read."""
    return (
        spark.read.schema(envelope_schema(item_schema, items))
        .option("mode", "FAILFAST")
        .json(path)
    )


def read_pages(
    spark: SparkSession, path: str, item_schema: T.StructType, items: str = "shipments"
) -> DataFrame:
    """The items of all pages as rows. An empty page adds none."""
    return read_envelopes(spark, path, item_schema, items).select(F.inline(items))


def page_gaps(envelopes: DataFrame, items: str = "shipments") -> DataFrame:
    """What a landed walk lacks: one row per missing page, and one if items are short.

    No rows means the walk is complete. The expected page numbers come from a
    distributed range, however many pages the feed claims.
    """
    spark = envelopes.sparkSession
    totals = envelopes.agg(
        F.coalesce(F.max("total_pages"), F.lit(0)).alias("pages"),
        F.coalesce(F.max("total"), F.lit(0)).alias("total"),
    ).first()
    missing = (
        spark.range(1, totals["pages"] + 1)
        .select(F.col("id").alias("page"))
        .join(envelopes.select("page"), "page", "left_anti")
        .select(F.lit("missing_page").alias("issue"), "page", F.lit(None).cast("long").alias("items"))
    )
    # A page landed twice counts once.
    per_page = envelopes.groupBy("page").agg(F.max(F.size(items)).cast("long").alias("items"))
    short = (
        per_page.agg(F.coalesce(F.sum("items"), F.lit(0)).alias("items"))
        .filter(F.col("items") != totals["total"])
        .select(
            F.lit("item_count").alias("issue"), F.lit(None).cast("long").alias("page"), "items"
        )
    )
    return missing.unionByName(short)


def read_unpaged(spark: SparkSession, path: str, item_schema: T.StructType) -> DataFrame:
    """An endpoint that answers with a bare array. Each file is one answer."""
    return (
        spark.read.schema(item_schema)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
    )
