"""Whole runs over the smallest test tables: every stage, twice, with changes in between."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidewell.datasets import BY_NAME, DATASETS
from tidewell.operators import ledger, nested
from tidewell.operators.quality import ValidationFailed
from tidewell.plans import jobs, questions, schemas, seeds, star, views
from tidewell.session import shared_dir
from tidewell.plans.schemas import conform, processed_schema, source_schema
from tidewell.sources import layers
from tidewell.sources.layers import table_path


# Tables of every kind: with a mark, without one, documents, feed.
AGAIN = ("orders", "order_items", "product_reviews", "carriers")


@pytest.fixture(scope="module")
def loaded(spark):
    """A lake and warehouse after a run over all sources and a second one over some."""
    from conftest import SF_DIR

    root = shared_dir(spark, "jobs")
    inputs = seeds.source_tables(spark, SF_DIR)
    first = jobs.run(spark, root, inputs)
    counts = {d.name: jobs.warehouse_table(spark, root, d.name).count() for d in DATASETS}
    jobs.run(spark, root, {name: inputs[name] for name in AGAIN})
    return root, inputs, first, counts


def test_every_table_is_loaded_once(spark, loaded):
    root, inputs, _, counts = loaded
    for d in DATASETS:
        table = jobs.warehouse_table(spark, root, d.name)
        assert table.count() == counts[d.name] > 0, d.name
        assert table.count() == table.select(*d.primary_key).distinct().count(), d.name
    assert counts["customers"] == inputs["customers"].count()
    assert counts["order_items"] == inputs["order_items"].select("order_item_id").distinct().count()


def test_the_second_run_lands_only_tables_without_a_mark(spark, loaded):
    root = loaded[0]
    state = ledger.run_state(ledger.read_runs(spark, jobs.runs_path(root)))
    per_table = {r[0]: r[1] for r in rows(state.groupBy("pipeline_name").count())}
    for d in DATASETS:
        assert per_table[d.name] == (2 if d.mark is None and d.name in AGAIN else 1), d.name
    again = state.filter("records_loaded = 0")
    assert {r.pipeline_name for r in again.collect()} == {"order_items", "carriers"}
    assert state.filter("status <> 'success'").isEmpty()


def test_suites_ran_over_the_cleaned_rows(loaded):
    summaries = loaded[2]
    assert summaries["customer_sessions"]["success"] is True
    # Reviews with an empty title are planted, so the length check is the one that fails.
    assert summaries["product_reviews"]["failed"] == "length_between:title"
    assert summaries["orders"] is None


def test_declared_keys_keep_one_event_per_type(spark, loaded):
    root, inputs, *_ = loaded
    got = jobs.warehouse_table(spark, root, "customer_sessions").select("_id", "event_type", "event_no")
    want = (
        inputs["customer_sessions"]
        .select("_id", F.posexplode("events").alias("event_no", "e"))
        .groupBy("_id", F.col("e.event_type").alias("event_type"))
        .agg(F.min("event_no").alias("event_no"))
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_star_and_views_agree_over_the_warehouse(spark, loaded):
    tables = jobs.star(spark, loaded[0])
    assert set(tables) == {
        "dim_customer", "dim_product", "dim_date", "dim_carrier", "fact_orders", "fact_order_items",
        "fact_payments", "fact_customer_events", "fact_shipments", "fact_shipment_events",
        "fact_product_reviews",
    }
    for name, df in tables.items():
        assert not df.isEmpty(), name
    found = views.analytics_views(spark, tables)
    pairs = {
        "v_daily_sales": questions.daily_sales(tables["fact_orders"]),
        "v_cart_abandonment": questions.cart_abandonment(tables["fact_customer_events"]),
        "v_revenue_by_category": questions.revenue_by_category(
            tables["fact_order_items"], tables["dim_product"]),
        "v_late_delivery_rate": questions.late_delivery_rate(
            tables["fact_shipments"], tables["dim_carrier"]),
    }
    for name, df in pairs.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, found[name].collect())), name
    # The facts hold every event, not only the first of each type that the merge keeps.
    every = loaded[1]["customer_sessions"].agg(F.sum(F.size("events"))).first()[0]
    assert tables["fact_customer_events"].count() == every
    assert tables["fact_shipments"].count() == loaded[1]["shipments"].count()
    days = tables["dim_date"]
    assert days.count() == days.select("date_key").distinct().count()
    outside = tables["fact_orders"].join(
        days, F.col("order_date_key") == F.col("date_key"), "left_anti")
    assert outside.isEmpty()


ORDERS = (
    "order_id long, customer_id long, order_status string, order_date timestamp, currency string, "
    "subtotal long, shipping_fee long, discount_amount long, total_amount long, updated_at timestamp"
)


def order(spark, *states):
    values = [
        f"({i}L, 1L, '{status}', timestamp'2025-01-01', 'NGN', 1L, 0L, 0L, 1L, timestamp'{at}')"
        for i, status, at in states
    ]
    cols = [c.split()[0] for c in ORDERS.split(", ")]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS t({', '.join(cols)})")


def test_incremental_extract_moves_the_mark(spark, tmp_path):
    root, orders = str(tmp_path), BY_NAME["orders"]
    first = order(spark, (1, "pending", "2025-01-01 10:00:00"), (2, "pending", "2025-01-01 11:00:00.5"))
    assert jobs.extract(spark, root, orders, first)
    assert jobs.extract(spark, root, orders, first) is None
    second = order(spark, (1, "shipped", "2025-01-02 10:00:00"), (2, "pending", "2025-01-01 11:00:00.5"))
    batch = jobs.extract(spark, root, orders, second)
    assert batch.endswith("_2")
    raw = spark.read.parquet(f"{root}/raw/postgres/orders")
    assert rows(raw.groupBy("order_id").count(), "order_id") == [(1, 2), (2, 1)]
    with pytest.raises(ValueError, match="already landed"):
        jobs.extract(spark, root, orders, order(spark, (3, "x", "2026-01-01")), batch)


@pytest.mark.parametrize("mode, expected", [("first", "pending"), ("latest", "shipped")])
def test_a_changed_order(spark, tmp_path, mode, expected):
    root = str(tmp_path)
    for state in ((1, "pending", "2025-01-01"), (1, "shipped", "2025-01-02")):
        jobs.run_source(spark, root, "postgres", {"orders": order(spark, state)}, mode=mode)
    assert rows(jobs.warehouse_table(spark, root, "orders", mode).select("order_status")) == [(expected,)]


REVIEW = (
    "_id string, review_id string, product_id long, customer_id long, rating long, title string, "
    "review_text string, verified_purchase boolean, created_at string, helpful_votes long"
)


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(
        [
            ("01", "r1", 1, 1, 5, "Good", "x", True, "2025-01-01", 1),
            ("02", "r2", 1, 1, 5, None, "x", True, "2025-01-01", 1),
            ("03", "r3", 1, 1, 5, "Bad votes", "x", None, "2025-01-01", -1),
        ],
        REVIEW,
    )


def test_quarantine_keeps_bad_rows_out_of_the_warehouse(spark, tmp_path, reviews):
    root = str(tmp_path)
    summary = jobs.run(spark, root, {"product_reviews": reviews}, on_failure="quarantine")
    assert not summary["product_reviews"]["success"]
    table = jobs.warehouse_table(spark, root, "product_reviews")
    assert rows(table.select("review_id")) == [("r1",)]
    rejected = spark.read.parquet(f"{root}/rejected/mongodb/product_reviews")
    assert rows(rejected.select("review_id", "reject_reasons"), "review_id") == [
        ("r2", ["length_between:title"]), ("r3", ["between:helpful_votes"]),
    ]


def test_fail_stops_before_the_load(spark, tmp_path, reviews):
    root = str(tmp_path)
    with pytest.raises(ValidationFailed):
        jobs.run(spark, root, {"product_reviews": reviews}, on_failure="fail")
    assert ledger.read_runs(spark, jobs.runs_path(root)).isEmpty()


def test_warn_loads_everything(spark, tmp_path, reviews):
    root = str(tmp_path)
    jobs.run(spark, root, {"product_reviews": reviews})
    assert jobs.warehouse_table(spark, root, "product_reviews").count() == 3


def test_latest_customer_wins_in_the_dimension(spark):
    df = spark.createDataFrame(
        [(1, "A", "B", "e", None, "lagos", "L", "NG", "t", "2025-01-01"),
         (1, "A", "B", "e", None, "ABUJA", "F", "NG", "t", "2025-02-01")],
        "customer_id long, first_name string, last_name string, email string, phone string, city string, "
        "state string, country string, created_at string, updated_at string",
    )
    assert rows(star.dim_customer(df).select("full_name", "city")) == [("A B", "Abuja")]


def test_declared_types_go_by_name(spark):
    df = spark.sql(
        "SELECT named_struct('b', 2, 'a', '1') AS s, array(named_struct('y', '5', 'x', 'text')) AS l, "
        "CAST(NULL AS STRUCT<a: STRING>) AS none, 7 AS more"
    )
    schema = spark.sql(
        "SELECT named_struct('a', 1L, 'b', '', 'c', true) AS s, array(named_struct('x', '', 'y', 5L)) AS l, "
        "named_struct('a', 1L) AS none, 1.5D AS missing"
    ).schema
    (got,) = schemas.conform(df, schema).collect()
    assert got.asDict(True) == {
        "s": {"a": 1, "b": "2", "c": None}, "l": [{"x": "text", "y": 5}], "none": None, "missing": None, "more": 7,
    }


def test_no_run_merges_footers(spark, loaded):
    """Every layer is read by its declared schema, which the files have."""
    root = loaded[0]
    for d in DATASETS:
        for layer, schema in (("raw", schemas.raw_schema(d.name)), ("processed", schemas.processed_schema(d.name))):
            stored = spark.read.parquet(f"{root}/{layer}/{d.source}/{d.name}").schema
            assert {f.name: f.dataType for f in stored} == {f.name: f.dataType for f in schema}, (d.name, layer)


def test_committed_rows_are_read_by_their_folders(spark, loaded):
    root, sessions = loaded[0], BY_NAME["customer_sessions"]
    table = table_path(root, "processed", "mongodb", "customer_sessions")
    before = jobs.committed_rows(spark, root, sessions)
    text = plan(before)
    assert "Join" not in text and "Exchange" not in text
    n = before.count()
    late = before.limit(1)
    late.drop("batch_id").write.parquet(f"{table}/batch_id=29990101_000000_1")
    old = before.select("batch_id").first().batch_id
    late.drop("batch_id").write.mode("append").parquet(f"{table}/batch_id={old}")
    # Neither the uncommitted batch nor the late file of a committed one is opened.
    after = jobs.committed_rows(spark, root, sessions)
    assert after.count() == n
    assert not [f for f in after.inputFiles() if "2999" in f]


def test_quarantine_rejects_what_cannot_be_read(spark, tmp_path):
    root = str(tmp_path)
    found = spark.createDataFrame(
        [
            ("01", "r1", 1, 1.0, "5", "Good", "x", True, "2025-01-01", "1"),
            ("02", "r2", 1, 1.5, "5", "Good", "x", True, "2025-01-01", "1"),
            ("03", "r3", 1, 2e9, "five", "Good", "x", True, "half past two", "3"),
        ],
        "_id string, review_id string, product_id long, customer_id double, rating string, title string, "
        "review_text string, verified_purchase boolean, created_at string, helpful_votes string",
    )
    summary = jobs.run(spark, root, {"product_reviews": found}, on_failure="quarantine")["product_reviews"]
    assert not summary["success"]  # the rating that can't be read is missing
    kept = jobs.warehouse_table(spark, root, "product_reviews")
    assert rows(kept.select("review_id", "customer_id", "rating")) == [("r1", 1, 5)]
    rejected = spark.read.parquet(f"{root}/rejected/mongodb/product_reviews")
    assert {r.review_id: r.reject_reasons for r in rejected.collect()} == {
        "r2": ["not_integer:customer_id=1.5", "not_null:customer_id"],
        "r3": ["unreadable:created_at=half past two", "not_integer:rating=five", "not_null:rating"],
    }
    # The landed rows have what the source sent.
    raw = spark.read.parquet(f"{root}/raw/mongodb/product_reviews")
    assert rows(raw.select("customer_id", "rating"), "review_id") == [("1", "5"), ("1.5", "5"), ("2000000000", "five")]
    with pytest.raises(Exception, match="is not an integer"):
        jobs.run(spark, f"{root}/strict", {"product_reviews": found})


def test_a_late_raw_file_is_processed_and_loaded(spark, tmp_path):
    root, orders = str(tmp_path), BY_NAME["orders"]
    batch = jobs.extract(spark, root, orders, order(spark, (1, "pending", "2025-01-01 10:00:00")))
    jobs.process_dataset(spark, root, orders)
    assert jobs.load_dataset(spark, root, orders)
    late = schemas.conform(order(spark, (2, "shipped", "2025-01-01 09:00:00")), schemas.source_schema("orders"))
    late.write.mode("append").parquet(f"{root}/raw/postgres/orders/batch_id={batch}")
    for _ in range(2):
        jobs.process_dataset(spark, root, orders)
        jobs.load_dataset(spark, root, orders)
    assert rows(jobs.warehouse_table(spark, root, "orders").select("order_id", "order_status"), "order_id") == [
        (1, "pending"), (2, "shipped"),
    ]
    assert jobs.process_dataset(spark, root, orders) is None and jobs.load_dataset(spark, root, orders) is None
    assert spark.read.parquet(f"{root}/processed/postgres/orders").count() == 2


def test_datasets_side_by_side(spark, tmp_path):
    from conftest import SF_DIR

    root, inputs = str(tmp_path), seeds.source_tables(spark, SF_DIR)
    some = {n: inputs[n] for n in ("customers", "products", "orders", "carriers")}
    for _ in range(2):
        jobs.run(spark, root, some, workers=4)
    for name, df in some.items():
        assert jobs.warehouse_table(spark, root, name).count() == df.count()
    bad = {**some, "orders": some["orders"].withColumn("currency", F.raise_error(F.lit("no currency")).cast("string"))}
    with pytest.raises(Exception, match="no currency"):
        jobs.run(spark, f"{root}/bad", bad, workers=4)
    assert jobs.warehouse_table(spark, f"{root}/bad", "carriers").count() == some["carriers"].count()


def test_a_run_checks_what_it_loaded(spark, tmp_path):
    found = order(spark, (1, "pending", "2025-01-01"), (2, "lost", "2025-01-01")).withColumn(
        "currency", F.when(F.col("order_id") == 1, "EURO").otherwise("EUR")
    ).withColumn("total_amount", F.col("order_id") + 1)
    summary = jobs.run(spark, f"{tmp_path}/warn", {"orders": found}, integrity="warn")
    broken = {(b["table_name"], b["check"], b["column"]): b["rows"] for b in summary["integrity"]["broken"]}
    assert broken == {
        ("orders", "in_set", "order_status"): 1, ("orders", "length_between", "currency"): 1,
        ("orders", "amounts", "total_amount"): 2, ("orders", "foreign_key", "customer_id"): 2,
    }
    with pytest.raises(ValidationFailed, match="orders:in_set:order_status"):
        jobs.run(spark, f"{tmp_path}/fail", {"orders": found}, integrity="fail")
    assert jobs.run(spark, f"{tmp_path}/none", {}, integrity="fail")["integrity"]["success"]


def test_processing_does_not_shuffle_whole_rows(spark, tmp_path, monkeypatch):
    """Documents land once; their events are written by the tasks that read them."""
    written, land = [], jobs.land
    monkeypatch.setattr(jobs, "land", lambda df, *a, **k: written.append((df, k)) or land(df, *a, **k))
    schema = "shipment_id string, updated_at string, events array<struct<event_type:string,event_time:string>>"
    times = [f"2025-01-0{n}T00:00:00Z" for n in range(1, 4)]
    docs = [(f"s_{n}", times[0], [("a", t) for t in times] + [("a", times[0])]) for n in range(50)]
    dataset = BY_NAME["shipments"]
    for n, some in enumerate((docs[:30], docs[30:])):
        rows_of = conform(spark.createDataFrame(some, schema), source_schema("shipments"))
        layers.land(nested.flatten_struct(rows_of), str(tmp_path), "api", "shipments", f"b_{n}")
    jobs.process_dataset(spark, str(tmp_path), dataset)
    out = layers.scan_layer(spark, str(tmp_path), "processed", "api", "shipments", processed_schema("shipments"))
    assert out.count() == 150 and out.select("batch_id").distinct().count() == 2
    (frame, options), = written
    assert options["spread"] is False
    assert frame._jdf.queryExecution().logical().toString().count("Join LeftAnti") == 1
    assert not list(tmp_path.glob("staging/shipments/*"))
