"""Structs to columns, arrays to rows, and back. Driven by the schema, never by the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.clean import maps_to_json


def _leaves(schema: T.StructType, path: str, name: str, sep: str) -> list[Column]:
    out: list[Column] = []
    for field in schema:
        full = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        label = f"{name}{sep}{field.name}" if name else field.name
        if isinstance(field.dataType, T.StructType):
            out += _leaves(field.dataType, full, label, sep)
        else:
            out.append(F.col(full).alias(label))
    return out


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """``device.os`` becomes ``device_os`` at any depth; arrays stay; a null struct gives nulls."""
    return df.select(*_leaves(df.schema, "", "", sep))


def explode_events(
    df: DataFrame, col: str = "events", into: str = "event", position: str | None = None
) -> DataFrame:
    """One row per element. An empty or null array keeps one row with a null element."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != col]
    if position:
        return df.select(*rest, F.posexplode_outer(col).alias(position, into))
    return df.select(*rest, F.explode_outer(col).alias(into))


def expand_event(df: DataFrame, col: str = "event", sep: str = "_") -> DataFrame:
    """The struct's fields become columns; nested structs flatten, maps become JSON text."""
    fields = _leaves(df.schema[col].dataType, f"`{col}`", "", sep)
    rest = [F.col(f"`{c}`") for c in df.columns if c != col]
    return maps_to_json(df.select(*rest, *fields))


def nest_events(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    name: str = "events",
    part: Column | None = None,
    part_name: str = "part",
) -> DataFrame:
    """Rows back to documents: one array of structs per key and ``part``, sorted by ``cols``.

    ``part`` is for keys that may hold a large share of the rows: an expression over a row's
    content, such as a time slot and a hash bucket. It always applies, so the documents depend
    neither on the number of rows nor on how they lie in files, and copies of a row share a
    document. Without it a key is one document.
    """
    item = F.sort_array(F.collect_list(F.struct(*cols))).alias(name)
    if part is None:
        # Grouped by the keys alone, the documents meet others by key without a further shuffle.
        return df.groupBy(*keys).agg(item).select(*keys, F.lit(0).cast("long").alias(part_name), name)
    return df.withColumn(part_name, part.cast("long")).groupBy(*keys, part_name).agg(item)
