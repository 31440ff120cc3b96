"""Expectation suites evaluated in one pass, and quarantine of the rows they reject."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """One check. ``kind`` is one of the names the constructors below use."""

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    severity: str = "critical"


def expect_row_count_between(low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation("row_count_between", None, low, high)


def expect_column_to_exist(column: str) -> Expectation:
    return Expectation("column_to_exist", column)


def expect_not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def expect_between(column: str, low: float | None = None, high: float | None = None) -> Expectation:
    """Inclusive bounds; nulls are not judged."""
    return Expectation("between", column, low, high)


def expect_in_set(column: str, values: Sequence) -> Expectation:
    return Expectation("in_set", column, values=tuple(values))


def expect_unique(column: str) -> Expectation:
    """Every row that shares its value with another is unexpected; nulls are not judged."""
    return Expectation("unique", column)


def expect_length_between(
    column: str, low: int | None = None, high: int | None = None
) -> Expectation:
    """Length in code points; nulls are not judged."""
    return Expectation("length_between", column, low, high)


def _outside(value: Column, low: float | None, high: float | None) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (value < F.lit(low))
    if high is not None:
        bad = bad | (value > F.lit(high))
    return bad


def violation(e: Expectation) -> Column | None:
    """True on the rows that break a row-level expectation; ``None`` for other kinds."""
    if e.kind == "not_null":
        return F.col(e.column).isNull()
    if e.kind == "between":
        return F.coalesce(_outside(F.col(e.column), e.low, e.high), F.lit(False))
    if e.kind == "length_between":
        return F.coalesce(_outside(F.char_length(e.column), e.low, e.high), F.lit(False))
    if e.kind == "in_set":
        return F.coalesce(~F.col(e.column).isin(*e.values), F.lit(False))
    return None


def _row(
    e: Expectation,
    position: int,
    success: Column,
    elements: Column,
    missing: Column,
    unexpected: Column,
    low: Column,
    high: Column,
) -> Column:
    judged = elements if e.kind == "not_null" else elements - missing
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).cast("string").alias("column"),
        success.alias("success"),
        elements.cast("long").alias("element_count"),
        missing.cast("long").alias("missing_count"),
        unexpected.cast("long").alias("unexpected_count"),
        F.try_divide(unexpected * F.lit(100.0), judged).alias("unexpected_pct"),
        low.cast("string").alias("lowest_unexpected"),
        high.cast("string").alias("highest_unexpected"),
        F.lit(e.severity).alias("severity"),
    )


def run_suite(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation.

    Everything but uniqueness is one aggregate over one scan. The unique columns together
    add an aggregate by value. The sample of bad values is their lowest and highest, which
    needs constant space and does not depend on row order.
    """
    null = F.lit(None)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    fused: list[tuple[int, Expectation]] = []
    unique: list[tuple[int, Expectation]] = []
    for i, e in enumerate(expectations):
        absent = e.column is not None and e.column not in df.columns
        if e.kind == "unique" and not absent:
            unique.append((i, e))
            continue
        fused.append((i, e))
        bad = None if absent else violation(e)
        if bad is not None:
            value = F.col(e.column)
            aggs += [
                F.count_if(value.isNull()).alias(f"m{i}"),
                F.count_if(bad).alias(f"u{i}"),
                F.min(F.when(bad, value)).alias(f"l{i}"),
                F.max(F.when(bad, value)).alias(f"h{i}"),
            ]
    rows = []
    for i, e in fused:
        n = F.col("n")
        if e.kind == "row_count_between":
            rows.append(_row(e, i, ~_outside(n, e.low, e.high), n, null, null, null, null))
        elif e.kind == "column_to_exist":
            rows.append(_row(e, i, F.lit(e.column in df.columns), n, null, null, null, null))
        elif e.column not in df.columns:
            rows.append(_row(e, i, F.lit(False), n, null, null, null, null))
        else:
            u = F.col(f"u{i}")
            rows.append(
                _row(e, i, u == 0, n, F.col(f"m{i}"), u, F.col(f"l{i}"), F.col(f"h{i}"))
            )
    result = df.agg(*aggs).select(F.inline(F.array(*rows))) if rows else None
    if unique:
        one = _unique_rows(df, unique)
        result = one if result is None else result.unionByName(one)
    return result


def _unique_rows(df: DataFrame, unique: Sequence[tuple[int, Expectation]]) -> DataFrame:
    """All unique columns in one pass: counted by (check, value), then summed into one row.

    Each check has a column of its own for its values, so that they keep their type.
    """
    none = {f"v{i}": F.lit(None).cast(df.schema[e.column].dataType) for i, e in unique}
    entries = [
        F.struct(F.lit(i).alias("i"), *[(F.col(e.column) if c == f"v{i}" else v).alias(c) for c, v in none.items()])
        for i, e in unique
    ]
    counted = df.select(F.explode(F.array(*entries)).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    counted = counted.select("x.*", "c", F.coalesce(*[F.col(c).cast("string") for c in none]).isNull().alias("missing"))
    aggs = []
    for i, _ in unique:
        here, value = F.col("i") == i, F.col(f"v{i}")
        shared = here & (F.col("c") > 1) & ~F.col("missing")
        aggs += [
            F.coalesce(F.sum(F.when(here, F.col("c"))), F.lit(0)).alias(f"n{i}"),
            F.coalesce(F.sum(F.when(here & F.col("missing"), F.col("c"))), F.lit(0)).alias(f"m{i}"),
            F.coalesce(F.sum(F.when(shared, F.col("c"))), F.lit(0)).alias(f"u{i}"),
            F.min(F.when(shared, value)).alias(f"l{i}"),
            F.max(F.when(shared, value)).alias(f"h{i}"),
        ]
    rows = [_row(e, i, F.col(f"u{i}") == 0, *[F.col(f"{k}{i}") for k in "nmulh"]) for i, e in unique]
    return counted.agg(*aggs).select(F.inline(F.array(*rows)))


def suite_summary(results: DataFrame) -> DataFrame:
    """Overall success, counts and the failed checks by name; as long as the suite, no more."""
    name = F.concat_ws(":", "expectation", "column")
    return results.agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("success").alias("successful"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(~F.col("success"), name))), ","
        ).alias("failed"),
    )


def unexpected_values(df: DataFrame, e: Expectation, limit: int = 20) -> DataFrame:
    """The most frequent bad values of a row-level expectation, with their counts."""
    return (
        df.filter(violation(e))
        .groupBy(F.col(e.column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "value")
        .limit(limit)
    )


def row_rules(expectations: Sequence[Expectation]) -> dict[str, Column]:
    """The row-level expectations as named reject conditions."""
    rules = {f"{e.kind}:{e.column}": violation(e) for e in expectations}
    return {name: bad for name, bad in rules.items() if bad is not None}


def tag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reasons``, the names of all rules a row breaks, empty for a clean row; those it has stay."""
    hits = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]
    reasons = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    if "reject_reasons" in df.columns:
        reasons = F.concat("reject_reasons", reasons)
    return df.withColumn("reject_reasons", reasons)


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rejected rows with their reasons."""
    tagged = tag_rejects(df, rules)
    rejected = F.size("reject_reasons") > 0
    return tagged.filter(~rejected).drop("reject_reasons"), tagged.filter(rejected)


class ValidationFailed(RuntimeError):
    """A suite failed and the caller asked for that to stop the run."""


def validate(
    df: DataFrame, expectations: Sequence[Expectation], on_failure: str = "warn"
) -> tuple[DataFrame, DataFrame | None, dict]:
    """Run a suite and act on it.

    ``warn`` keeps every row, ``fail`` raises, ``quarantine`` splits off the rows that
    break row-level checks. Returns rows to keep, rejected rows or ``None``, and the summary.
    """
    if expectations:
        summary = suite_summary(run_suite(df, expectations)).first().asDict()
    else:
        summary = {"success": True, "evaluated": 0, "successful": 0, "failed": ""}
    if on_failure == "fail" and not summary["success"]:
        raise ValidationFailed(summary["failed"])
    if on_failure == "quarantine":
        present = [e for e in expectations if e.column is None or e.column in df.columns]
        clean, rejected = quarantine(df, row_rules(present))
        return clean, rejected, summary
    return df, None, summary
