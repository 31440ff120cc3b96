"""Plans hold at scale: early aggregation, pruned columns, split skew."""

import re

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tidewell.operators import feed, merge
from tidewell.plans import questions, seeds, star

QUERIES = queries()


def above(text: str, upper: str, lower: str) -> bool:
    """Plans print parents first: is some ``upper`` node printed before a ``lower`` one?"""
    return text.index(upper) < text.rindex(lower)


@pytest.mark.parametrize(
    "name", ["k02_revenue_by_category", "k05_purchase_frequency", "k08_average_review_score",
             "k10_late_delivery_rate", "k14_sales_by_city_state"],
)
def test_facts_are_aggregated_before_they_meet_a_dimension(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    join = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", text).start()
    assert "HashAggregate" in text[join:]


def test_columns_are_pruned(spark, sf_dir):
    text = plan(QUERIES["k02_revenue_by_category"](spark, sf_dir))
    line = re.search(r"lineitem.*?ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in line.split(",")} == {
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
    }


def test_top_products_are_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["k02_top_products"](spark, sf_dir))


def test_repeat_customers_keep_two_rows_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["k13_repeat_customers"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*row_number\(\), 2, Partial", text)


def test_sessions_fold_into_slots_before_the_window(spark, sf_dir):
    text = plan(QUERIES["k07_sessionize"](spark, sf_dir))
    assert "partial_min" in text and above(text, "Window", "partial_min")


@pytest.fixture
def no_broadcast(spark):
    """Force shuffled joins and treat small partitions as skewed."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_items(spark, n=60_000):
    """Items of which a third belong to one product and a third to one order."""
    third = F.col("id") % 3
    return spark.range(0, n, 1, 6).select(
        F.col("id").alias("order_item_id"),
        F.when(third == 0, 7).otherwise(F.col("id") % 5000).alias("order_id"),
        F.when(third == 1, 7).otherwise(F.col("id") % 400).alias("product_id"),
        F.lit(1).cast("long").alias("quantity"),
        F.lit(2).cast("decimal(12,2)").alias("unit_price"),
        F.lit(0).cast("decimal(12,2)").alias("discount_amount"),
        F.lit(2).cast("decimal(12,2)").alias("line_total"),
    )


def test_a_hot_product_and_order_are_split_in_the_fact_join(spark, sf_dir, no_broadcast):
    items = hot_items(spark)
    orders = seeds.seed_orders(seeds.read(spark, sf_dir, "orders"))
    products = seeds.seed_products(seeds.read(spark, sf_dir, "part"))
    fact = star.fact_order_items(items, orders, products)
    got = fact.collect()
    assert len(got) == items.count()
    assert plan(fact).count("skew=true") >= 1


def test_a_hot_product_is_one_row_per_task_in_the_aggregates(spark, sf_dir, no_broadcast):
    items = hot_items(spark)
    products = star.dim_product(seeds.seed_products(seeds.read(spark, sf_dir, "part")))
    found = questions.revenue_by_product(items, products)
    want = items.join(products.select("product_id"), "product_id").groupBy("product_id").agg(
        F.sum("line_total").alias("revenue"))
    assert sorted(rows(found.select("product_id", "revenue"))) == sorted(rows(want))


def test_a_hot_key_merges_to_one_row(spark):
    df = spark.range(50_000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    assert rows(merge.first_per_key(df, ["k"], [F.col("v")])) == [(1, 0)]


def test_sessionize_matches_the_row_by_row_rule(spark):
    """Brute force over a customer with dense, tied and exactly 30 minute apart events."""
    minutes = [0, 1, 1, 29, 59, 60, 90, 119.99, 150, 500, 529.5, 559.5, 559.6]
    data = [(1, m, "add_to_cart" if i % 4 == 0 else "product_view") for i, m in enumerate(minutes)]
    data += [(2, m * 7 % 1000, "purchase_completed") for m in range(200)]
    data = [(c, float(m), kind) for c, m, kind in data]
    df = spark.createDataFrame(data, "customer_id long, m double, event_type string").select(
        "customer_id", "event_type",
        F.timestamp_micros((F.col("m") * 60_000_000 + 1_700_000_123_000_000).cast("long")).alias("event_time"),
    )
    expected = []
    for customer in (1, 2):
        times = sorted(d[1] for d in data if d[0] == customer)
        sizes = [1]
        for a, b in zip(times, times[1:]):
            if round((b - a) * 60e6) >= 30 * 60e6:
                sizes.append(0)
            sizes[-1] += 1
        expected += [(customer, i + 1, n) for i, n in enumerate(sizes)]
    got = questions.sessionize(df).select("customer_id", "session_no", "events")
    assert sorted(rows(got)) == sorted(expected)


@pytest.mark.parametrize("name", ["h11_check_foreign_keys", "h12_check_unique_keys"])
def test_key_checks_share_their_scans_and_their_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"\bExchange |BroadcastExchange", text)) <= 8


def test_a_page_by_its_number_costs_a_page(spark):
    rows_of = spark.range(0, 30_000, numPartitions=8).select((F.col("id") * 7 % 30_000).alias("k"), F.lit("a").alias("v"))
    index = feed.page_index(rows_of, ["k"], 50)
    assert rows(index.agg(F.count(F.lit(1)), F.min("page"), F.max("page"))) == [(600, 1, 600)]
    for number in (1, 2, 317, 600):
        found, totals = feed.page(rows_of, ["k"], number, 50, index=index)
        assert [r[0] for r in rows(found)] == list(range((number - 1) * 50, number * 50))
        text = plan(feed.page(rows_of, ["k"], number, 50, index=index)[0])
        assert "TakeOrderedAndProject(limit=50," in text
        assert totals.first().total_pages == 600
    assert feed.page(rows_of, ["k"], 601, 50, index=index)[0].isEmpty()
    assert feed.page_index(rows_of.limit(0), ["k"], 50).isEmpty()
    text = spark.createDataFrame([(c, n) for c in "bca" for n in range(3)], "c string, n long")
    found, _ = feed.page(text, ["c", "n"], 2, 4, index=feed.page_index(text, ["c", "n"], 4))
    assert rows(found) == [("b", 1), ("b", 2), ("c", 0), ("c", 1)]


def test_seeds_make_no_interval_from_its_parts(spark, sf_dir):
    for name, df in seeds.source_tables(spark, sf_dir).items():
        assert "make_dt_interval" not in plan(df), name
