"""Header-less CSV in the shape bulk loaders take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The null token and quoting rule of the export format.
_OPTIONS = {
    "header": False,
    "quote": '"',
    "escape": '"',
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
NULL_TOKEN = "\\N"


def csv_export(df: DataFrame, path: str, null_token: str = NULL_TOKEN) -> str:
    """Quotes are doubled and empty strings stay quoted, so both survive a round trip."""
    df.write.mode("overwrite").options(**_OPTIONS).option("nullValue", null_token).csv(path)
    return path


def csv_import(
    spark: SparkSession, path: str, schema: T.StructType, null_token: str = NULL_TOKEN
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .options(**{**_OPTIONS, "emptyValue": ""}, multiLine=True, maxCharsPerColumn=-1)
        .option("nullValue", null_token)
        .option("mode", "FAILFAST")
        .csv(path)
    )
