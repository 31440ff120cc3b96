"""Suites, quarantine and integrity checks."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidewell.operators import checks, quality
from tidewell.operators.quality import (
    expect_between,
    expect_column_to_exist,
    expect_in_set,
    expect_length_between,
    expect_not_null,
    expect_row_count_between,
    expect_unique,
)
from tidewell.plans.integrity import integrity_report
from tidewell.plans.schemas import processed_schema
from tidewell.plans.suites import PRODUCT_REVIEWS, SUITES

SCHEMA = "k long, name string, score double"


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 0.5), (1, "bb", 2.0), (2, "", None), (None, None, -1.0), (None, "é", 9.0)], SCHEMA
    )


SUITE = (
    expect_row_count_between(1, 4),
    expect_column_to_exist("gone"),
    expect_not_null("k"),
    expect_between("score", 0, 5),
    expect_in_set("name", ("a", "bb", "é")),
    expect_unique("k"),
    expect_length_between("name", 1, 1),
    expect_not_null("gone"),
)


def test_run_suite(df):
    got = quality.run_suite(df, SUITE).orderBy("position").select(
        "expectation", "success", "element_count", "missing_count", "unexpected_count",
        "unexpected_pct", "lowest_unexpected", "highest_unexpected",
    )
    assert rows(got) == [
        ("row_count_between", False, 5, None, None, None, None, None),
        ("column_to_exist", False, 5, None, None, None, None, None),
        ("not_null", False, 5, 2, 2, 40.0, None, None),
        ("between", False, 5, 1, 2, 50.0, "-1.0", "9.0"),
        ("in_set", False, 5, 1, 1, 25.0, "", ""),
        ("unique", False, 5, 2, 2, 2 * 100 / 3, "1", "1"),
        ("length_between", False, 5, 1, 2, 50.0, "", "bb"),
        ("not_null", False, 5, None, None, None, None, None),
    ]


def test_one_scan_for_all_but_uniqueness(df):
    fused = [e for e in SUITE if e.kind != "unique"]
    assert plan(quality.run_suite(df, fused)).count("Scan") == 1
    assert plan(quality.run_suite(df, SUITE)).count("Scan") == 2


def test_empty_frame(df):
    got = quality.run_suite(df.limit(0), SUITE[:1] + (expect_unique("k"), expect_not_null("k")))
    assert rows(got.select("success", "element_count"), "position") == [(False, 0), (True, 0), (True, 0)]


def test_summary(df):
    got = quality.suite_summary(quality.run_suite(df, (expect_row_count_between(1), expect_not_null("k"))))
    assert rows(got) == [(False, 2, 1, "not_null:k")]


def test_unexpected_values(df):
    got = quality.unexpected_values(df, expect_between("score", 0, 1), limit=2)
    assert rows(got) == [("-1.0", 1), ("2.0", 1)]


def test_quarantine_splits_without_loss(df):
    rules = quality.row_rules((expect_not_null("k"), expect_between("score", 0, 5)))
    clean, rejected = quality.quarantine(df, rules)
    assert clean.columns == df.columns
    assert clean.count() + rejected.count() == df.count()
    assert sorted(rows(rejected.select("reject_reasons"))) == [(["not_null:k", "between:score"],)] * 2


def test_validate_modes(df):
    suite = (expect_not_null("k"), expect_column_to_exist("gone"))
    kept, rejected, summary = quality.validate(df, suite)
    assert kept is df and rejected is None and not summary["success"]
    with pytest.raises(quality.ValidationFailed, match="not_null:k"):
        quality.validate(df, suite, "fail")
    kept, rejected, _ = quality.validate(df, suite, "quarantine")
    assert kept.count() == 3 and rejected.count() == 2


def test_recorded_suites():
    assert len(SUITES["customer_sessions"]) == 4 and len(PRODUCT_REVIEWS) == 12


def test_recorded_review_suite_finds_the_empty_title(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 5, "ok", "text", True, 0), ("b", 1, 1, 5, "", "text", False, 3)],
        "_id string, customer_id long, product_id long, rating long, title string, "
        "review_text string, verified_purchase boolean, helpful_votes long",
    )
    failed = quality.run_suite(df, PRODUCT_REVIEWS).filter("not success")
    assert rows(failed.select("expectation", "column", "unexpected_count")) == [("length_between", "title", 1)]


def test_orphans_aggregate_before_the_join(spark):
    child = spark.createDataFrame([(1, 7), (2, 7), (3, 1), (4, None)], "id long, fk long")
    parent = spark.createDataFrame([(1,)], "pk long")
    keys = checks.orphan_keys(child, parent, "fk", "pk")
    assert rows(keys) == [(7, 2)]
    assert sorted(r.id for r in checks.orphans(child, parent, "fk", "pk").collect()) == [1, 2]
    text = plan(keys)
    assert text.index("Join") < text.index("partial_count")


def test_duplicates_ignore_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert rows(checks.duplicates(df, ["k"])) == [(1, 2)]


def test_amount_checks(spark):
    orders = spark.createDataFrame([(1, 10, 2, 1, 11), (2, 10, 2, 1, 12)],
                                   "order_id long, subtotal long, shipping_fee long, discount_amount long, total_amount long")
    assert [r.order_id for r in checks.order_total_gaps(orders).collect()] == [2]
    payments = spark.createDataFrame([(1, 1, 11), (2, 2, 9)], "payment_id long, order_id long, amount long")
    assert rows(checks.payment_gaps(payments, orders).select("payment_id", "gap")) == [(2, -3)]
    items = spark.createDataFrame([(1, 2, 5, 1, 9), (2, 2, 5, 1, 10)],
                                  "order_item_id long, quantity long, unit_price long, discount_amount long, line_total long")
    assert [r.order_item_id for r in checks.line_total_gaps(items).collect()] == [2]


def test_timestamp_rejects(spark):
    df = spark.createDataFrame([("2025/04/05 10:30:00", "2025-01-01"), (None, "x"), ("2025-01-01", "x")], "a string, b string")
    assert sorted(rows(checks.timestamp_rejects(df, ["a", "b"]))) == [("a", "2025/04/05 10:30:00", 1), ("b", "x", 2)]


def test_small_checks(spark):
    df = spark.createDataFrame([("lagos", 0), ("Lagos", 3), ("Port Harcourt", 6)], "city string, rating long")
    assert rows(checks.case_variants(df, "city")) == [("lagos", 1, "Lagos")]
    assert sorted(r.rating for r in checks.out_of_range(df, "rating", 1, 5).collect()) == [0, 6]
    ties = spark.createDataFrame([("s", "t1"), ("s", "t1"), ("s", None), ("s", None)], "session_id string, event_time string")
    assert rows(checks.event_time_ties(ties)) == [("s", "t1", 2)]
    profile = checks.null_profile({"t": ties})
    assert sorted(rows(profile.select("table", "column", "nulls"))) == [("t", "event_time", 2), ("t", "session_id", 0)]


def test_constraints_cover_the_declared_states(spark):
    orders = spark.createDataFrame([("shipped",), ("lost",)], "order_status string")
    got = quality.run_suite(orders, checks.CONSTRAINTS["orders"])
    assert rows(got.select("unexpected_count", F.col("lowest_unexpected"))) == [(1, "lost")]


def test_unique_columns_share_one_pass_and_keep_their_types(spark):
    df = spark.createDataFrame(
        [(9, "a", 1), (10, "b", 1), (10, "a", 2), (9, None, 3), (7, None, 4)], "k long, name string, one long"
    )
    found = quality.run_suite(df, [expect_unique(c) for c in df.columns])
    got = rows(found.select("column", "success", "element_count", "missing_count", "unexpected_count",
                            "lowest_unexpected", "highest_unexpected").orderBy("position"))
    assert got == [("k", False, 5, 0, 4, "9", "10"), ("name", False, 5, 2, 2, "a", "a"), ("one", False, 5, 0, 2, "1", "1")]
    text = plan(quality.run_suite(df, [expect_unique(c) for c in df.columns]))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Scan") == 1
    empty = quality.run_suite(df.limit(0), [expect_unique("k"), expect_unique("name")])
    assert rows(empty.select("success", "element_count", "unexpected_count")) == [(True, 0, 0)] * 2


def test_all_keys_in_one_pass(spark):
    tables = {
        "p": spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "x")], "id long, code string"),
        "c": spark.createDataFrame([(1, 5), (7, 5), (7, 6), (None, 6)], "p_id long, other long"),
    }
    foreign = (("c", "p_id", "p", "id"), ("c", "other", "p", "id"), ("p", "id", "c", "p_id"))
    assert sorted(rows(checks.orphan_report(tables, foreign))) == [
        ("c", "other", "p", "5", 2), ("c", "other", "p", "6", 2), ("c", "p_id", "p", "7", 2), ("p", "id", "c", "2", 1),
    ]
    unique = (("p", ("id",)), ("p", ("code",)), ("p", ("id", "code")), ("c", ("p_id",)))
    assert sorted(rows(checks.duplicate_report(tables, unique))) == [
        ("c", "p_id", "7", 2), ("p", "code", "x", 2), ("p", "id", "1", 2),
    ]
    text = plan(checks.orphan_report(tables, foreign))
    assert text.count("Exchange") == 1 and "Join" not in text
    both = rows(checks.broken_keys(tables, foreign, unique).select("check", "table_name", "column", "parent", "key", "rows"))
    assert sorted(both, key=str) == sorted(
        [("foreign_key", *r) for r in rows(checks.orphan_report(tables, foreign))]
        + [("unique_key", t, c, None, k, n) for t, c, k, n in rows(checks.duplicate_report(tables, unique))], key=str
    )


def test_a_report_counts_all_keys_in_one_shuffle(spark):
    tables = {
        "customers": spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "customer_id long, email string"),
        "orders": spark.createDataFrame([(1, 5), (1, 1), (2, None)], "order_id long, customer_id long"),
    }
    def kinds(name):
        return [(f.name, f.dataType) for f in processed_schema(name)]

    for name, df in list(tables.items()):
        tables[name] = df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in kinds(name) if c not in df.columns])
    found = integrity_report(tables).filter("check LIKE '%key'")
    shuffles = [line for line in plan(found).splitlines() if "Exchange hashpartitioning" in line and "key#" in line]
    assert len(shuffles) == 1
    assert sorted(rows(found)) == [
        ("customers", "unique_key", "customer_id", 2), ("customers", "unique_key", "email", 2),
        ("orders", "foreign_key", "customer_id", 1), ("orders", "unique_key", "order_id", 2),
    ]
