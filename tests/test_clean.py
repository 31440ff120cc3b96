"""Casts, filling, stripping and de-duplication on the small fixtures."""

import re
from datetime import datetime
from functools import partial

import pytest
from conftest import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewell.functions.casts import parse_timestamp
from tidewell.functions.text import WHITESPACE, batch_id_from_name, batch_order, strip
from tidewell.operators import clean
from tidewell.plans import cleaning


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-03-01T08:00:00.000Z", datetime(2025, 3, 1, 8)),
        ("2025-03-01T08:00:00Z", datetime(2025, 3, 1, 8)),
        ("2025-03-01 08:00:00", datetime(2025, 3, 1, 8)),
        ("2025-03-01T08:00", datetime(2025, 3, 1, 8)),
        ("2025-03-01", datetime(2025, 3, 1)),
        ("2025-03-01T08:00:00+01:00", datetime(2025, 3, 1, 7)),
        ("2025-03-01T08:00:00-0230", datetime(2025, 3, 1, 10, 30)),
        ("2025-03-01 08:00:00 Z", datetime(2025, 3, 1, 8)),
        ("2025-03-01 08:00:00 +01:00", datetime(2025, 3, 1, 7)),
        ("2025-03-01T08:00:00.123456Z", datetime(2025, 3, 1, 8, 0, 0, 123456)),
        # The three odd formats of the sources, and what a bare cast would accept.
        ("2025/04/05 10:30:00", None),
        ("04-15-2025 12:00:00", None),
        ("2025.05.06 14:30:00", None),
        ("invalid-date", None),
        ("12:00", None),
        ("2025", None),
        ("2025-13-01", None),
        ("2025-02-30T00:00:00Z", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_timestamp_does_not_depend_on_the_session_zone(spark, text, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = one(spark, F.unix_micros(parse_timestamp(F.lit(text).cast("string"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = None if expected is None else (expected - datetime(1970, 1, 1)).total_seconds()
    assert (None if micros is None else micros / 1e6) == want


def test_strip_takes_all_unicode_space_and_only_that(spark):
    inner = f"a{WHITESPACE}b"
    assert one(spark, strip(F.lit(WHITESPACE + inner + WHITESPACE))) == inner
    assert all(c.isspace() for c in WHITESPACE)
    every = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(every) == set(WHITESPACE)


def test_to_int_nullable(spark):
    df = spark.createDataFrame([(1.0, "7"), (None, " 8.0 "), (3.0, None)], "a double, b string")
    out = clean.to_int_nullable(df, ["a", "b", "absent"])
    assert out.dtypes == [("a", "bigint"), ("b", "bigint")]
    assert rows(out) == [(1, 7), (None, 8), (3, None)]


@pytest.mark.parametrize("bad", [2.7, float("nan"), 1e30])
def test_to_int_refuses_fractions(spark, bad):
    df = spark.createDataFrame([(bad,)], "a double")
    with pytest.raises(PySparkException, match="not an integer"):
        clean.to_int_nullable(df, ["a"]).collect()
    assert rows(clean.to_int_nullable(df, ["a"], on_bad="null")) == [(None,)]
    assert rows(clean.int_offenders(df, ["a"])) == [("a", 1)]


def test_to_int_refuses_text(spark):
    df = spark.createDataFrame([("x1",), ("99999999999999999999",), ("4",)], "a string")
    assert rows(clean.to_int_nullable(df, ["a"], "null")) == [(None,), (None,), (4,)]
    with pytest.raises(PySparkException, match="a is not an integer"):
        clean.to_int_nullable(df, ["a"]).collect()


def test_products_brand_filled(spark):
    df = spark.createDataFrame(
        [(1, "Apple"), (2, None), (3, "Samsung")], "product_id long, brand string"
    )
    assert rows(cleaning.process("products", df), "product_id") == [
        (1, "Apple"), (2, "Unknown"), (3, "Samsung"),
    ]


def test_other_tables_pass_through(spark):
    df = spark.createDataFrame([(1, None)], "payment_id long, note string")
    assert rows(cleaning.process("payments", df)) == [(1, None)]


def test_reviews(spark):
    df = spark.createDataFrame(
        [
            (1, 100, 5, 3, False, None, " Nice", "2026-01-01"),
            (1, 100, 5, 3, None, " Good product", "Nice", "2026-01-01"),
            (2, 200, 4, 2, True, "Average", None, "invalid-date"),
        ],
        "customer_id long, product_id long, rating long, helpful_votes long, "
        "verified_purchase boolean, review_text string, title string, created_at string",
    )
    out = cleaning.clean_reviews(df)
    types = dict(out.dtypes)
    assert types["created_at"] == "timestamp" and types["verified_purchase"] == "boolean"
    got = out.select("verified_purchase", "review_text", "title", F.isnull("created_at"))
    assert sorted(rows(got)) == [
        (False, "", "Nice", False), (False, "Good product", "Nice", False),
        (True, "Average", "", True),
    ]


def test_null_metrics_are_taken_before_the_fill(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "x boolean, y string")
    assert sorted(rows(clean.null_metrics(df))) == [("x", 2), ("y", 1)]


SESSION = (
    "session_id string, customer_id long, started_at string, ended_at string, "
    "device struct<type:string,os:string>, "
    "events array<struct<event_time:string,event_type:string,product_id:long,quantity:long>>"
)


def test_sessions(spark):
    view = ("2026-07-01 10:05:00", "view", 101, 1)
    cart = ("2026-07-01 10:10:00", "add_to_cart", 101, 1)
    buy = ("2026-07-02 09:05:00", "purchase", 202, 2)
    df = spark.createDataFrame(
        [
            ("S001", 1, "2026-07-01 10:00:00", "2026-07-01 10:30:00", ("Mobile", "Android"), [view, cart]),
            ("S002", 2, "2026-07-02 09:00:00", "2026-07-02 09:20:00", None, [buy, buy]),
        ],
        SESSION,
    )
    out = cleaning.clean_sessions(df)
    assert out.count() == 3
    assert not {"events", "device"} & set(out.columns)
    assert rows(out.select("session_id", "event_no", "device_os"), "session_id", "event_no") == [
        ("S001", 0, "Android"), ("S001", 1, "Android"), ("S002", 0, None),
    ]


def test_sessions_without_events_keep_a_row(spark):
    df = spark.createDataFrame([("S1", 1, None, None, None, []), ("S2", 1, None, None, None, None)], SESSION)
    assert rows(cleaning.clean_sessions(df).select("session_id", "event_type"), "session_id") == [
        ("S1", None), ("S2", None),
    ]


def test_fractional_product_id_stops_the_run(spark):
    df = spark.createDataFrame(
        [("S1", [(1.5,)])], "session_id string, events array<struct<product_id:double>>"
    )
    with pytest.raises(PySparkException, match="product_id is not an integer"):
        cleaning.clean_sessions(df).collect()


SHIPMENT = (
    "shipment_id string, order_id long, status string, shipped_at string, delivered_at string, "
    "updated_at string, delivery_address_extra string, "
    "events array<struct<event_time:string,event_type:string,location:string,metadata:map<string,string>>>"
)


def test_shipments(spark):
    second = (
        "SHP002", 1002, "In Transit", "2026-07-04 10:15:00", None, "2026-07-05 08:30:00", None,
        [("2026-07-04 10:30:00", "Picked Up", "Port Harcourt", {"a": "1"}),
         ("invalid-date", "Sorting Facility", "Benin", None)],
    )
    first = (
        "SHP001", 1001, "Delivered", "2026-07-01 09:00:00", "2026-07-03 16:45:00",
        "2026-07-03 16:50:00", "Apartment 3B",
        [("2026-07-01 09:05:00", "Picked Up", "Lagos", None),
         ("2026-07-02 14:20:00", "In Transit", "Ibadan", None),
         ("2026-07-03 16:45:00", "Delivered", "Abuja", None)],
    )
    out = cleaning.clean_shipments(spark.createDataFrame([first, second, second], SHIPMENT))
    assert out.count() == 5
    assert not {"events", "delivery_address_extra"} & set(out.columns)
    types = dict(out.dtypes)
    assert types["event_time"] == "timestamp" and types["metadata"] == "string"
    assert out.filter("event_time is null").count() == 1
    assert {r.metadata for r in out.collect()} == {None, '{"a":"1"}'}


def test_carriers_strip_after_dedup(spark):
    df = spark.createDataFrame(
        [(" CAR001", " DHL "), ("CAR002", " FedEx "), ("CAR002", " FedEx "), ("CAR002", "FedEx")],
        "carrier_id string, carrier_name string",
    )
    # The unpadded variant is a different row to the dedup, and equal only afterwards.
    assert sorted(rows(cleaning.clean_carriers(df))) == [
        ("CAR001", "DHL"), ("CAR002", "FedEx"), ("CAR002", "FedEx"),
    ]


def test_dedup_is_per_batch_and_null_equal(spark):
    df = spark.createDataFrame(
        [("b1", 1, None), ("b1", 1, None), ("b2", 1, None)], "batch_id string, a long, b string"
    )
    assert clean.dedup_full_row(df).count() == 2
    counted = clean.dedup_full_row(df, copies="n")
    assert rows(counted, "batch_id") == [("b1", 1, None, 2), ("b2", 1, None, 1)]


def test_dedup_metrics(spark):
    raw = spark.createDataFrame([("b", [1, 1, 2]), ("c", [5])], "batch_id string, e array<long>")
    exploded = raw.select("batch_id", F.explode_outer("e").alias("e"))
    assert rows(clean.dedup_metrics(raw, exploded), "batch_id") == [
        ("b", 1, 3, 1, 2), ("c", 1, 1, 0, 1),
    ]


def test_batch_names(spark):
    name = F.lit("orders_20260705_101500_123_2.parquet")
    assert one(spark, batch_id_from_name(name, "orders")) == "20260705_101500_123_2"
    ids = [(f"20260705_101500_123_{n}",) for n in (10, 2, 1)] + [("odd",)]
    df = spark.createDataFrame(ids, "batch_id string")
    ordered = [r[0] for r in df.orderBy(*batch_order(F.col("batch_id"))).collect()]
    assert [i.rsplit("_", 1)[-1] for i in ordered] == ["1", "2", "10", "odd"]


def test_casts_tell_why_a_row_should_be_rejected(spark):
    df = spark.createDataFrame(
        [("2025-01-01", "7", 2.0, ["old"]), ("noon", "2.7", 2.5, []), (None, None, None, []), ("nine", "x", 3.0, [])],
        "at string, n string, d double, reject_reasons array<string>",
    )
    got = clean.cast_with_reasons(df, ["at", "absent"], ["n", "d"])
    assert [(r.n, r.d, r.reject_reasons) for r in got.collect()] == [
        (7, 2, ["old"]),
        (None, None, ["unreadable:at=noon", "not_integer:n=2.7", "not_integer:d=2.5"]),
        (None, None, []),
        (None, 3, ["unreadable:at=nine", "not_integer:n=x"]),
    ]
    assert got.schema["at"].dataType.typeName() == "timestamp"
    assert got.filter("at IS NOT NULL").count() == 1
    # One projection over the input, whatever the number of columns.
    assert plan(got.drop("at")).count("Project") == 1
    plain = clean.cast_with_reasons(df.drop("reject_reasons"))
    assert {tuple(r.reject_reasons) for r in plain.collect()} == {()}


@pytest.mark.parametrize("most", [10_000, 0])
def test_dedup_by_hash_shuffles_only_rows_that_share_a_hash(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(clean, "REPEATED", most)
    some = [("a", None, 1), (None, "a", 2), ("a", None, 0), (None, None, 3), (None, None, 4), ("b", "c", 5)]
    df = spark.createDataFrame(some, "x string, y string, no long").unionByName(
        spark.range(1000).select(F.col("id").cast("string").alias("x"), F.lit("y").alias("y"), F.col("id").alias("no"))
    )
    for n, keep in enumerate(("no", None)):
        got = clean.dedup_by_hash(df, f"{tmp_path}/{n}", keep)
        want = clean.dedup_full_row(df, keep)
        assert got.columns == df.columns
        assert rows(got.select("x", "y", "no"), "x", "y", "no") == rows(want.select("x", "y", "no"), "x", "y", "no")
        text = plan(got)
        if most:
            # The rows with a hash of their own come from the branch that has no shuffle.
            assert "LeftAnti, BuildRight" in text and text.count("Exchange hashpartitioning") == 1
    maps = df.withColumn("m", F.create_map("no", "no"))
    assert clean.dedup_by_hash(maps, f"{tmp_path}/maps", "no").count() == clean.dedup_full_row(maps, "no").count()


def _shipment_documents(spark):
    """Copies of documents, in part or whole, and of events, also by another text of their time; most have none."""
    one, two = ("2026-07-04 10:30:00", "a", "x", {"k": "1"}), ("2026-07-04T10:30:00Z", "a", "x", {"k": "1"})
    other, bad, worse = ("2026-07-05", "b", None, None), ("noon", "a", "x", {}), ("one", "a", "x", {})
    events = [
        [one, two, other], [one, other], [one, other, other], [bad, worse], [bad, None, None], [None], [], None, [one], [two],
    ]
    docs = [(f"S{i}", 1, None, at, None, at, "extra", e) for i, e in enumerate(events) for at in ("2026-07-04", "2026-07-04T00:00:00Z")]
    docs += [("S1", 1, None, "2026-07-04 00:00", None, "2026-07-04", "none", [one, bad]), (None, None, *[None] * 5, [one]), (None, None, *[None] * 5, [two])]
    some = spark.createDataFrame(docs, SHIPMENT)
    many = spark.range(500).select(
        *[(F.concat(F.lit("T"), F.col("id")) if f.name == "shipment_id" else F.lit(None).cast(f.dataType)).alias(f.name)
          for f in some.schema if f.name != "events"],
        F.array(F.struct(*[F.lit(str(v)).alias(c) for c, v in (("event_time", "2026-07-04"), ("event_type", "a"), ("location", "x"))],
                         F.create_map(F.lit("k"), F.lit("1")).alias("metadata"))).alias("events"),
    )
    return some.unionByName(many)


@pytest.mark.parametrize("most", [10_000, 0])
def test_event_copies_are_found_by_their_documents(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(clean, "REPEATED", most)
    docs = _shipment_documents(spark)
    got = cleaning.clean_shipments(docs, dedup=partial(clean.dedup_by_hash, path=f"{tmp_path}/copies"))
    want = cleaning.clean_shipments(docs)
    assert sorted(got.columns) == sorted(want.columns)
    want = want.select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    if most:
        # Documents meet the hashes, so a document without copies is exploded and its events typed once, after that.
        text = plan(got)
        assert text.index("Generate") < text.index("LeftAnti") and spark.read.parquet(f"{tmp_path}/copies").count() < 40


def test_document_times_are_read_before_the_explode(spark):
    documents = _shipment_documents(spark)
    text = plan(cleaning.exploded_shipments(documents))
    above, below = text.split("Generate", 1)
    assert "shipped_at" in below and above.count("RLIKE") < below.count("RLIKE")


def test_documents_without_copies_meet_no_join(spark, tmp_path):
    df = _shipment_documents(spark).filter("shipment_id LIKE 'T%'")
    got = cleaning.clean_shipments(df, dedup=partial(clean.dedup_by_hash, path=f"{tmp_path}/copies"))
    assert "Join" not in plan(got) and "Exchange" not in plan(got) and got.count() == 500


def test_session_copies_are_found_by_their_documents(spark, tmp_path):
    fields = "event_type:string,event_time:string,product_id:string,quantity:string,by:struct<at:string,tags:map<string,string>>"
    kind = f"_id string, session_id string, started_at string, device struct<os:string>, events array<struct<{fields}>>"
    one = ("view", "2026-07-04T10:30:00Z", "5", None, ("u", {"a": "b"}))
    docs = [
        ("a", "s", "2026-07-04", ("x",), [one, ("view", "2026-07-04 10:30:00", "5.0", None, ("u", {"a": "b"})), ("buy", None, " 7 ", "1", None)]),
        ("a", "s", "2026-07-04T00:00:00Z", ("x",), [("buy", "noon", "7", "1.", (None, None)), one]),
        ("b", "s", "late", None, [one, one]), ("c", "s", "later", None, [one]), ("d", "s", None, None, None),
    ]
    df = spark.createDataFrame(docs, kind)
    got = cleaning.clean_sessions(df, dedup=partial(clean.dedup_by_hash, path=f"{tmp_path}/copies"))
    want = cleaning.clean_sessions(df).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() == 5
    assert spark.read.parquet(f"{tmp_path}/copies").count() == 2


def test_a_time_makes_little_code(spark, capsys):
    """The JVM compiles no method beyond 8,000 bytes, and a document has several times."""
    df = spark.range(10).select(F.col("id").cast("string").alias("t")).repartition(2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.select(parse_timestamp(F.col("t"))).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 2_500
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


@pytest.mark.parametrize("text", ["2025-03-01T08:00Z\n", "2025-03-01 08:00:00 Z\n", "2025-03-01T08:00\n", "2025-03-01T08:00:00Z\n"])
def test_a_line_end_after_a_time_is_no_matter(spark, text):
    """As it is to a cast."""
    assert one(spark, F.unix_micros(parse_timestamp(F.lit(text)))) == 1_740_816_000_000_000
