"""Integrity checks across rows and tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.datasets import ORDER_STATUSES, PAYMENT_STATUSES
from tidewell.functions.casts import parse_timestamp
from tidewell.functions.text import normalize_case
from tidewell.operators.quality import (
    Expectation,
    expect_between,
    expect_in_set,
)

# The CHECK constraints of the source tables.
CONSTRAINTS: dict[str, tuple[Expectation, ...]] = {
    "products": (
        expect_between("unit_price", low=0),
        expect_between("cost_price", low=0),
        expect_between("stock_quantity", low=0),
    ),
    "orders": (expect_in_set("order_status", ORDER_STATUSES),),
    "order_items": (expect_between("quantity", low=1),),
    "payments": (expect_in_set("payment_status", PAYMENT_STATUSES),),
}

# Child table, child column, parent table, parent column.
FOREIGN_KEYS = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("customer_sessions", "product_id", "products", "product_id"),
    ("product_reviews", "product_id", "products", "product_id"),
)

# Table and column(s) that must identify one row.
UNIQUE_KEYS = (
    ("customers", ("customer_id",)),
    ("customers", ("email",)),
    ("products", ("product_id",)),
    ("orders", ("order_id",)),
    ("order_items", ("order_item_id",)),
    ("payments", ("payment_id",)),
    ("payments", ("transaction_reference",)),
)


def orphan_keys(child: DataFrame, parent: DataFrame, col: str, parent_col: str) -> DataFrame:
    """Foreign key values without a parent, with the rows that hold them; nulls are allowed.

    The child is counted by key before the join, so a key that fills a third of the
    child arrives as one row.
    """
    counted = (
        child.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counted.join(parent.select(F.col(parent_col).alias("key")), "key", "left_anti")


def orphans(child: DataFrame, parent: DataFrame, col: str, parent_col: str) -> DataFrame:
    """The child rows whose key has no parent, for quarantine."""
    keys = orphan_keys(child, parent, col, parent_col).select(F.col("key").alias(col))
    return child.join(keys, col, "left_semi")


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Null keys are not compared."""
    return (
        df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    )


def key_counts(
    tables: Mapping[str, DataFrame],
    foreign: Sequence[tuple[str, str, str, str]] = (),
    unique: Sequence[tuple[str, Sequence[str]]] = (),
) -> DataFrame:
    """Every key that some check looks at, with the rows that hold it, all checks in one pass.

    One row per ``domain`` (the columns of the table a key identifies) and ``key``, as text, with a count for
    each place the key may stand: ``n0`` the identified table, ``n1`` and on the children that refer to it, in the order of
    ``foreign``. Each table is scanned once, its keys are unpivoted and counted before the one shuffle, so a key
    that fills a third of a table arrives as one row per task. Keys with a null part are not compared.
    """
    places: dict[tuple[str, tuple[str, ...]], list[tuple[str, tuple[str, ...]]]] = {}
    for table, columns in unique:
        places.setdefault((table, tuple(columns)), [(table, tuple(columns))])
    for child, column, parent, parent_column in foreign:
        held = places.setdefault((parent, (parent_column,)), [(parent, (parent_column,))])
        held.append((child, (column,)))
    entries: dict[str, list[Column]] = {}
    # Rows are shuffled with the domain's number; its name comes back with the counts.
    for number, held in enumerate(places.values()):
        for n, (holder, own) in enumerate(held):
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in own])
            text = F.concat_ws(",", *[F.col(c).cast("string") for c in own])
            entries.setdefault(holder, []).append(
                F.struct(F.lit(number).alias("number"), F.when(whole, text).alias("key"), F.lit(n).alias("place"))
            )
    width = max(len(held) for held in places.values())
    every = reduce(
        DataFrame.unionByName,
        [tables[t].select(F.explode(F.array(*found)).alias("e")).select("e.*") for t, found in entries.items() if t in tables],
    )
    counts = [F.count_if(F.col("place") == n).alias(f"n{n}") for n in range(width)]
    counted = every.filter(F.col("key").isNotNull()).groupBy("number", "key").agg(*counts)
    domains = F.array(*[F.lit(f"{table}.{','.join(columns)}") for table, columns in places])
    return counted.select(domains[F.col("number")].alias("domain"), *counted.columns[1:])


def broken_keys(
    tables: Mapping[str, DataFrame],
    foreign: Sequence[tuple[str, str, str, str]] = (),
    unique: Sequence[tuple[str, Sequence[str]]] = (),
) -> DataFrame:
    """Foreign key values without a parent and keys held by more than one row, all checks in one pass.

    One row per finding: ``check`` (``foreign_key`` or ``unique_key``), ``table_name, column, parent, key, rows``.
    """
    found, place = [], dict.fromkeys(((p, c) for _, _, p, c in foreign), 0)

    def tell(here: Column, check: str, table: str, column: str, parent: str | None, rows: Column) -> None:
        names = {"check": check, "table_name": table, "column": column, "parent": parent}
        texts = [F.lit(v).cast("string").alias(k) for k, v in names.items()]
        found.append(F.when(here, F.struct(*texts, "key", rows.alias("rows"))))

    for child, column, parent, parent_column in foreign:
        place[parent, parent_column] += 1
        n = F.col(f"n{place[parent, parent_column]}")
        here = (F.col("domain") == f"{parent}.{parent_column}") & (F.col("n0") == 0) & (n > 0)
        tell(here, "foreign_key", child, column, parent, n)
    for table, columns in unique:
        named = ",".join(columns)
        tell((F.col("domain") == f"{table}.{named}") & (F.col("n0") > 1), "unique_key", table, named, None, F.col("n0"))
    odd = key_counts(tables, foreign, unique).filter("n0 != 1")
    return odd.select(F.explode(F.array_compact(F.array(*found))).alias("x")).select("x.*")


def orphan_report(tables: Mapping[str, DataFrame], foreign: Sequence[tuple[str, str, str, str]] = FOREIGN_KEYS) -> DataFrame:
    """Foreign key values without a parent over all tables: ``child, column, parent, key, rows``."""
    return broken_keys(tables, foreign).select(F.col("table_name").alias("child"), "column", "parent", "key", "rows")


def duplicate_report(tables: Mapping[str, DataFrame], unique: Sequence[tuple[str, Sequence[str]]] = UNIQUE_KEYS) -> DataFrame:
    """Keys held by more than one row over all tables: ``table_name, key_columns, key, rows``."""
    return broken_keys(tables, (), unique).select("table_name", F.col("column").alias("key_columns"), "key", "rows")


def mismatches(df: DataFrame, left: Column, right: Column, tolerance: float = 0) -> DataFrame:
    """Rows whose two amounts differ by more than ``tolerance``."""
    gap = left - right
    return df.withColumn("gap", gap).filter(F.abs(gap) > F.lit(tolerance))


def payment_gaps(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments whose amount is not the order's total."""
    totals = orders.select("order_id", "total_amount")
    return mismatches(
        payments.select("payment_id", "order_id", "amount").join(totals, "order_id"),
        F.col("amount"),
        F.col("total_amount"),
    )


def order_total_gaps(orders: DataFrame) -> DataFrame:
    """Orders whose total is not subtotal + shipping - discount."""
    expected = F.col("subtotal") + F.col("shipping_fee") - F.col("discount_amount")
    return mismatches(orders, F.col("total_amount"), expected)


def line_total_gaps(items: DataFrame) -> DataFrame:
    """Items whose line total is not quantity * price - discount."""
    expected = F.col("quantity") * F.col("unit_price") - F.col("discount_amount")
    return mismatches(items, F.col("line_total"), expected)


def timestamp_rejects(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that hold text no timestamp rule accepts: one row per column and value."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    )
    found = df.select(pairs.alias("p")).select("p.*")
    bad = F.col("value").isNotNull() & parse_timestamp(F.col("value")).isNull()
    return found.filter(bad).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(col) < low) | (F.col(col) > high))


def case_variants(df: DataFrame, col: str) -> DataFrame:
    """Values that change under case normalisation, with the rows that hold them."""
    return (
        df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("normalized", normalize_case(F.col(col)))
        .filter(F.col(col) != F.col("normalized"))
    )


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null count of every column of every table, one pass per table."""
    out = None
    for name, df in tables.items():
        cols = df.columns
        one = df.agg(
            *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
        ).unpivot([], cols, "column", "nulls").withColumn("table", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def event_time_ties(df: DataFrame, keys: Sequence[str] = ("session_id",), col: str = "event_time") -> DataFrame:
    """Times shared by several events of one session."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(*keys, col)
        .agg(F.count(F.lit(1)).alias("events"))
        .filter("events > 1")
    )
