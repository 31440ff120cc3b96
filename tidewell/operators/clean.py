"""Row-wise cleaning and exact de-duplication. No operator here needs a Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.casts import is_integral, parse_timestamp, to_bool, to_int
from tidewell.functions.text import strip


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def fill_null(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls column by column; columns the frame lacks are ignored."""
    kept = {c: v for c, v in values.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in kept.items()}) if kept else df


def drop_if_exists(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def pass_through(df: DataFrame) -> DataFrame:
    """A dataset without a rule is copied unchanged."""
    return df


def to_timestamp_coerce(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text columns become timestamps, unreadable values become null."""
    text = [c for c in _present(df, cols) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_timestamp(F.col(c)) for c in text}) if text else df


def to_int_nullable(df: DataFrame, cols: Iterable[str], on_bad: str = "raise") -> DataFrame:
    return df.withColumns(
        {c: to_int(F.col(c), df.schema[c].dataType, on_bad, c) for c in _present(df, cols)}
    )


REASONS = "reject_reasons"


def cast_with_reasons(df: DataFrame, times: Iterable[str] = (), ints: Iterable[str] = ()) -> DataFrame:
    """Both casts in one projection, which also says why a row should be rejected.

    A value that can't be read becomes null, and ``reject_reasons`` holds ``unreadable:<column>=<value>`` or
    ``not_integer:<column>=<value>`` for each, after the reasons the row has already. So no bad
    value ends a run, and none is lost: rows that differ in one stay different rows.
    """
    cast: dict[str, Column] = {}
    found: list[Column] = []

    def tell(kind: str, c: str, bad: Column) -> None:
        found.append(F.when(bad, F.concat(F.lit(f"{kind}:{c}="), F.col(c).cast("string"))))

    for c in _present(df, times):
        if isinstance(df.schema[c].dataType, T.StringType):
            cast[c] = parse_timestamp(F.col(c))
            tell("unreadable", c, F.col(c).isNotNull() & cast[c].isNull())
    for c in _present(df, ints):
        dtype = df.schema[c].dataType
        cast[c] = to_int(F.col(c), dtype, "null")
        if not isinstance(dtype, T.IntegralType):
            tell("not_integer", c, F.col(c).isNotNull() & cast[c].isNull())
    reasons = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    if REASONS in df.columns:
        reasons = F.concat(REASONS, reasons)
    return df.withColumns({**cast, REASONS: reasons})


def int_offenders(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with the number of values ``to_int_nullable`` refuses."""
    bad = [
        F.count_if(F.col(c).isNotNull() & ~is_integral(F.col(c), df.schema[c].dataType)).alias(c)
        for c in cols
    ]
    return df.agg(*bad).unpivot([], list(cols), "column", "offenders")


def to_bool_default(df: DataFrame, cols: Iterable[str], default: bool = False) -> DataFrame:
    return df.withColumns({c: to_bool(F.col(c), default) for c in _present(df, cols)})


def id_to_string(df: DataFrame, col: str = "_id") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("string"))


def strip_strings(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Strip the named columns, or every text column."""
    chosen = _present(df, cols) if cols is not None else [
        f.name for f in df.schema if isinstance(f.dataType, T.StringType)
    ]
    return df.withColumns({c: strip(F.col(c)) for c in chosen}) if chosen else df


def holds_map(dtype: T.DataType) -> bool:
    """Whether a type is a map or has one inside; such values have no hash."""
    return "map<" in dtype.simpleString()


def maps_to_json(df: DataFrame) -> DataFrame:
    """Map columns as JSON text, since maps can be neither grouped nor compared."""
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    return df.withColumns({c: F.to_json(F.col(c)) for c in maps}) if maps else df


def dedup_full_row(
    df: DataFrame, keep_first: str | None = None, copies: str | None = None
) -> DataFrame:
    """Drop exact copies; null equals null.

    The scope is whatever the rows carry: keep ``batch_id`` among the columns to
    de-duplicate batch by batch. ``keep_first`` names a position column left out of the
    comparison, of which the smallest value survives. ``copies`` adds how many rows each
    survivor stands for. Copies collapse before the shuffle, so a row repeated
    any number of times reaches the reducer once per map task.
    """
    if keep_first is None and copies is None:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c != keep_first]
    aggs = []
    if keep_first:
        aggs.append(F.min(keep_first).alias(keep_first))
    if copies:
        aggs.append(F.count(F.lit(1)).alias(copies))
    return df.groupBy(*keys).agg(*aggs)


# Most values that travel to every task, to tell the rows that need a shuffle from those that don't.
REPEATED = 1_000_000


def dedup_by_hash(
    df: DataFrame, path: str, keep_first: str | None = None, expand: Callable[[DataFrame], DataFrame] | None = None,
    alike: Column | None = None,
) -> DataFrame:
    """What ``dedup_full_row`` gives, of a frame that can be read twice: most rows are not shuffled.

    The hashes of the rows are counted and those of several rows stored under ``path``. A row with
    a hash of its own has no copy. The others are compared as whole rows, so rows that share a hash by chance
    all stay. Where more than ``REPEATED`` hashes repeat, all rows are compared.

    With ``expand`` the frame holds documents, and the rows are those it makes of them, each with the document's
    columns. Copies then lie in documents that share a hash or in one that is ``alike``, which must hold of every document
    with two events that become copies; so documents are counted, and of most the events are read once.
    """
    rows = expand(df) if expand else df
    if any(isinstance(f.dataType, T.MapType) for f in rows.schema):
        return dedup_full_row(rows, keep_first)
    spark, own = df.sparkSession, "_row_hash"
    hashed = [c for c in df.columns if c in rows.columns and c != keep_first and not (expand and holds_map(df.schema[c].dataType))]
    tagged = df.withColumn(own, F.xxhash64(*[F.col(f"`{c}`") for c in hashed]))
    several = [F.count(F.lit(1)) > 1, *([] if alike is None else [F.bool_or(alike)])]
    counted = tagged.groupBy(own).agg(F.greatest(*several, F.lit(False)).alias("several")).filter("several").select(own)
    counted.write.parquet(path)
    repeated = spark.read.schema(counted.schema).parquet(path)
    found = repeated.count()
    if expand and not found:
        return rows
    if found > REPEATED:
        return dedup_full_row(rows, keep_first)
    repeated, made = F.broadcast(repeated), expand or (lambda some: some)
    alone = tagged.join(repeated, own, "left_anti").select(*df.columns)
    several = tagged.join(repeated, own, "left_semi").select(*df.columns)
    return made(alone).unionByName(dedup_full_row(made(several), keep_first))


def dedup_metrics(raw: DataFrame, exploded: DataFrame, within: str = "batch_id") -> DataFrame:
    """Rows before, after the explode, removed and final, per batch.

    The three counts come from aggregates over the data, not from accumulators, so a
    recomputed task cannot count twice.
    """
    before = raw.groupBy(within).agg(F.count(F.lit(1)).alias("rows_before"))
    after = (
        dedup_full_row(exploded, copies="_copies")
        .groupBy(within)
        .agg(
            F.sum("_copies").alias("rows_after_explode"),
            (F.sum("_copies") - F.count(F.lit(1))).alias("duplicates_removed"),
            F.count(F.lit(1)).alias("final_rows"),
        )
    )
    return before.join(after, within, "left")


def null_metrics(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its null count, taken before any filling."""
    cols = list(cols or df.columns)
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    ).unpivot([], cols, "column", "nulls")
