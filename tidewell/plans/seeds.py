"""Source tables of the shop, derived from a TPC-H-like warehouse plus events and documents.

Every function maps given rows to source rows, so the result grows with the input. Each
also plants the defects the checks must find, by rule on the row's id:
shared emails, null phones and brands, lower-case cities, wrong payment amounts, bad
timestamps, unknown products, ratings out of range and padded text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.nested import nest_events

# Names the seeds choose from by position.
PAYMENT_METHODS = ("card", "bank_transfer", "ussd", "wallet")
BROWSERS = ("Chrome", "Safari", "Edge", "Firefox")
DEVICES = (("phone", "Android"), ("laptop", "Linux"), ("tablet", "iPadOS"))
SERVICE_LEVELS = ("standard", "premium", "regional")
EVENT_TYPES = {
    "view": "product_view",
    "signup": "checkout_started",
    "click": "add_to_cart",
    "error": "remove_from_cart",
    "purchase": "purchase_completed",
}
ORDER_STATUS = {"F": "delivered", "O": "processing", "P": "cancelled"}
SCAN_TYPES = {"A": "picked_up", "N": "in_transit", "R": "out_for_delivery"}
UNKNOWN_PRODUCT = 9_999_999_999
PAGE_SIZE = 100


_SCHEMAS: dict[str, T.StructType] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table. Its schema is read from the file once per process."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def row_source(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``1..n`` with n the rows of ``df``, generated in parallel."""
    return spark.range(1, df.count() + 1).select(F.col("id").alias("n"))


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _map(values: dict[str, str], col: Column) -> Column:
    out = None
    for key, value in values.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out


def _pad(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def _money(col: Column) -> Column:
    return col.cast("decimal(12,2)")


def _one(unit: str) -> Column:
    """A multiple of a fixed interval costs far less than an interval made of its parts, which goes by decimals."""
    return F.expr(f"INTERVAL '1' {unit}")


def _days(start: str, days: Column) -> Column:
    return F.lit(start).cast("timestamp_ntz") + days.cast("int") * _one("DAY")


def _hours(col: Column, hours: Column) -> Column:
    return col + hours.cast("int") * _one("HOUR")


def iso(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def seed_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    city = F.initcap("n_name")
    joined = F.col("c_nationkey") * 31 + k % 300
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("customer_id"),
            F.split("c_name", "#")[0].alias("first_name"),
            F.split("c_name", "#")[1].alias("last_name"),
            F.concat(
                F.lit("buyer."), _pad(F.when(k % 64 == 63, k - 1).otherwise(k), 9), F.lit("@mail.test")
            ).alias("email"),
            # A balance in debt hides the phone; one segment writes its cities in lower case.
            F.when(
                F.col("c_acctbal") >= 0,
                F.concat(F.lit("00"), _pad(F.col("c_nationkey"), 2), _pad(k, 9)),
            ).alias("phone"),
            F.when(F.col("c_mktsegment") == "FURNITURE", F.lower(city)).otherwise(city).alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("country"),
            _days("1992-01-01 00:00:00", joined).alias("created_at"),
            _days("1992-01-01 00:00:00", joined + F.floor(F.abs("c_acctbal")) % 90).alias("updated_at"),
        )
    )


def seed_products(part: DataFrame) -> DataFrame:
    size = F.col("p_size")
    price = _money(F.col("p_retailprice"))
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(size % 12 != 5, F.col("p_brand")).alias("brand"),
        price.alias("unit_price"),
        _money(price - _money(size * 10)).alias("cost_price"),
        size.cast("long").alias("stock_quantity"),
        _days("1994-03-01 00:00:00", size * 9).alias("created_at"),
        _days("1994-03-01 00:00:00", size * 9 + F.floor("p_retailprice") % 40).alias("updated_at"),
    )


def seed_orders(orders: DataFrame) -> DataFrame:
    urgency = F.substring("o_orderpriority", 1, 1).cast("int")
    base = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _map(ORDER_STATUS, F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_date"),
        F.lit("USD").alias("currency"),
        _money(30 - urgency * 4).alias("shipping_fee"),
        _money(F.when(F.col("o_totalprice") > 200_000, 75).otherwise(0)).alias("discount_amount"),
        _money(F.col("o_totalprice")).alias("total_amount"),
        _hours(F.col("o_orderdate"), F.floor("o_totalprice") % 72).alias("updated_at"),
    )
    off = _money(F.when(F.col("order_id") % 1000 == 333, 1).otherwise(0))
    subtotal = F.col("total_amount") - F.col("shipping_fee") + F.col("discount_amount") + off
    return base.select(
        "order_id", "customer_id", "order_status", "order_date", "currency",
        _money(subtotal).alias("subtotal"),
        "shipping_fee", "discount_amount", "total_amount", "updated_at",
    )


def seed_order_items(lineitem: DataFrame) -> DataFrame:
    """Item ids repeat, as order and line number do not identify a line."""
    price = _money(F.col("l_extendedprice"))
    discount = _money(price * F.col("l_discount").cast("decimal(4,2)"))
    cents = (price * 100).cast("long")
    quantity = F.col("l_quantity").cast("long")
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        # Whole cents, so the price times the quantity may fall short by a remainder.
        _money(((cents - cents % quantity) / quantity).cast("decimal(20,0)") / F.lit(100)).alias(
            "unit_price"
        ),
        discount.alias("discount_amount"),
        _money(price - discount).alias("line_total"),
    )


def seed_order_lines(orders: DataFrame) -> DataFrame:
    """Two numbered lines per order: every order paired with every line number."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.explode(F.sequence(F.lit(1), F.lit(2))).alias("item_no"),
    ).select(
        (F.col("order_id") * 2 + F.col("item_no")).alias("order_item_id"),
        "order_id",
        F.col("item_no").cast("long").alias("item_no"),
        (F.col("order_id") % 5 + F.col("item_no")).alias("quantity"),
    )


def seed_payments(orders: DataFrame) -> DataFrame:
    """One payment per order, with the order's id. What goes wrong follows the whole amount."""
    k, whole = F.col("order_id"), F.floor("total_amount").cast("long")
    status = (
        F.when(whole % 16 == 3, "failed")
        .when(F.col("order_status") == "delivered", "successful")
        .when(F.col("order_status") == "processing", "pending")
        .otherwise("refunded")
    )
    off = F.when(whole % 128 == 1, 60).when(whole % 128 == 2, -40).otherwise(0)
    return seed_orders(orders).select(
        k.alias("payment_id"),
        "order_id",
        _pick(PAYMENT_METHODS, whole).alias("payment_method"),
        status.alias("payment_status"),
        _money(F.col("total_amount") + _money(off)).alias("amount"),
        F.concat(F.lit("ref/"), _pad(F.when(k % 256 == 255, k - 1).otherwise(k), 10)).alias(
            "transaction_reference"
        ),
        F.when(status != "failed", _hours(F.col("order_date"), whole % 30)).alias("paid_at"),
        _hours(F.col("updated_at"), whole % 48).alias("updated_at"),
    )


def _event_rows(events: DataFrame) -> DataFrame:
    k, user = F.col("event_id"), F.col("user_id")
    kind = _map(EVENT_TYPES, F.col("event_type"))
    product = F.get_json_object("props", "$.k").cast("long")
    product = F.when(k % 1009 == 500, F.lit(UNKNOWN_PRODUCT)).otherwise(product)
    rows = events.select(
        user.alias("user_id"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.floor(F.hour("ts") / 6).alias("slot"),
        F.when(k % 1009 == 10, F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
        .otherwise(iso(F.col("ts"))).alias("event_time"),
        kind.alias("event_type"),
        F.when(kind != "checkout_started", product).alias("product_id"),
        F.when(kind == "product_view", F.concat(F.lit("term "), (k % 5).cast("string"))).alias(
            "search_term"
        ),
        F.when(~kind.isin("checkout_started", "product_view"), k % 3 + 1).alias("quantity"),
        F.concat(F.lit("/products/"), product.cast("string")).alias("page_url"),
    )
    return rows.withColumn("part", F.col("slot") * 4 + _bucket("event_time", "event_type", "page_url"))


def _bucket(*cols: str) -> Column:
    """0 to 3 by the content of the columns, so that copies stay together."""
    digit = F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, 1)
    return (F.instr(F.lit("0123456789abcdef"), digit) - 1) % 4


EVENT_FIELDS = ["event_time", "event_type", "product_id", "search_term", "quantity", "page_url"]


def _session_columns(part: Column) -> dict[str, Column]:
    user, day = F.col("user_id"), F.col("day")
    at = F.to_timestamp_ntz("day", F.lit("yyyyMMdd"))
    return {
        "_id": F.concat(day, _pad(user, 12), _pad(part, 4)),
        "session_id": F.concat_ws("_", F.lit("sess"), user.cast("string"), day),
        "customer_id": F.when(user % 120 != 2, user),
        "started_at": F.when(user % 90 == 4, F.lit("15.04.2025 noon")).otherwise(iso(at)),
        "ended_at": iso(_hours(at, F.lit(23))),
        "browser": _pick(BROWSERS, user),
        "location": F.struct(
            F.concat(F.lit("City "), (user % 6).cast("string")).alias("city"),
            F.concat(F.lit("State "), (user % 3).cast("string")).alias("state"),
            F.lit("FR").alias("country"),
        ),
        "device": F.when(
            user % 45 != 6,
            F.struct(
                _pick(tuple(d[0] for d in DEVICES), user).alias("type"),
                _pick(tuple(d[1] for d in DEVICES), user).alias("os"),
            ),
        ),
    }


def seed_sessions(events: DataFrame) -> DataFrame:
    """Documents per user and day, with their events as an array sorted by time.

    A day comes in parts, one per six hours and content bucket, whatever the number of events.
    """
    docs = nest_events(_event_rows(events), ["user_id", "day"], EVENT_FIELDS, part=F.col("part"))
    cols = _session_columns(F.col("part"))
    return docs.select(*[c.alias(n) for n, c in cols.items()], "events")


def seed_customer_events(events: DataFrame) -> DataFrame:
    """The flat, typed event rows a recorded stream would hold, without nesting them first."""
    kind = _map(EVENT_TYPES, F.col("event_type"))
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.concat_ws("_", F.lit("sess"), F.col("user_id").cast("string"),
                    F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        kind.alias("event_type"),
        F.col("ts").alias("event_time"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
    )


def seed_reviews(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A review per document, the whole text as its body; unlabelled ones lack the verified flag."""
    k, n = F.col("doc_id"), F.col("n_chars")
    joined = documents.join(labels.select("doc_id", "quality"), "doc_id", "left")
    padded = F.concat(F.lit("\u00a0 "), F.col("text"), F.lit("\n\u3000"))
    rating = F.when(n % 97 == 4, 6).when(n % 97 == 8, 0).otherwise(n % 5 + 1)
    return joined.select(
        _pad(F.lower(F.hex("doc_id")), 24).alias("_id"),
        F.concat(F.lit("rev_"), _pad(k, 9)).alias("review_id"),
        F.when(n % 83 == 5, F.lit(UNKNOWN_PRODUCT)).otherwise(n % 200).alias("product_id"),
        (n % 150).alias("customer_id"),
        rating.cast("long").alias("rating"),
        F.when(k % 61 != 33, F.concat(F.lit("  Review "), k.cast("string"), F.lit("\t"))).alias("title"),
        F.when(n % 29 != 0, F.when(k % 3 == 0, padded).otherwise(F.col("text"))).alias("review_text"),
        (F.col("quality") == 1).alias("verified_purchase"),
        F.when(k % 50 == 21, F.lit("6 May, half past two"))
        .otherwise(iso(_days("2024-06-01 09:00:00", n % 90))).alias("created_at"),
        (n % 37).alias("helpful_votes"),
    )


def seed_carriers(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        F.concat(F.lit("car_"), k.cast("string")).alias("carrier_id"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit("\t")).alias("carrier_name"),
        _pick(SERVICE_LEVELS, k).alias("service_level"),
        F.concat(F.lit(" 0800 "), _pad(k, 7), F.lit(" ")).alias("support_phone"),
    )


def seed_shipment_heads(lineitem: DataFrame, typed: bool = False) -> DataFrame:
    """One shipment per order, without its events.

    Times are text, as the feed sends them, or ``typed``, as the processed layer holds them.
    """
    k = F.col("l_orderkey")
    stamp: Callable[[Column], Column] = (lambda c: c.cast("timestamp")) if typed else iso
    heads = lineitem.groupBy(k).agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_suppkey").alias("carrier"),
        F.bool_or(F.col("l_linestatus") == "F").alias("done"),
    )
    return heads.select(
        F.concat(F.lit("shp_"), _pad(k, 12)).alias("shipment_id"),
        k.alias("order_id"),
        F.concat(F.lit("car_"), F.col("carrier").cast("string")).alias("carrier_id"),
        F.concat(F.lit("trk-"), k.cast("string")).alias("tracking_number"),
        F.when(F.col("done"), "delivered").otherwise("in_transit").alias("shipment_status"),
        stamp(F.col("first_ship")).alias("shipped_at"),
        stamp(F.col("first_ship") + F.make_dt_interval(F.lit(45))).alias("estimated_delivery_at"),
        F.when(F.col("done"), stamp(F.col("last_ship"))).alias("delivered_at"),
        stamp(_hours(F.col("last_ship"), k % 24)).alias("updated_at"),
        F.struct(
            F.concat(F.lit("Street "), (k % 100).cast("string")).alias("street"),
            F.concat(F.lit("City "), (k % 6).cast("string")).alias("city"),
            F.concat(F.lit("State "), (k % 3).cast("string")).alias("state"),
            F.lit("FR").alias("country"),
            _pad(k % 1000, 6).alias("postal_code"),
        ).alias("delivery_address"),
    )


def seed_shipments(lineitem: DataFrame) -> DataFrame:
    """Shipment documents, one per order as in the feed: the head plus an array of scans."""
    line = F.col("l_linenumber")
    scans = lineitem.select(
        "l_orderkey",
        F.when((F.col("l_orderkey") % 97 == 5) & (line == 3), F.lit("invalid-date"))
        .otherwise(iso(_hours(F.col("l_shipdate"), line))).alias("event_time"),
        _map(SCAN_TYPES, F.col("l_returnflag")).alias("event_type"),
        F.concat(F.lit("hub_"), (F.col("l_suppkey") % 10).cast("string")).alias("location"),
        F.when(line == 7, F.lit("last line")).alias("notes"),
        line.cast("string").alias("line"),
    )
    docs = nest_events(
        scans, ["l_orderkey"], ["event_time", "event_type", "location", "notes", "line"]
    )
    with_map: Callable[[Column], Column] = lambda e: F.struct(
        e["event_type"].alias("event_type"),
        e["event_time"].alias("event_time"),
        e["location"].alias("location"),
        e["notes"].alias("notes"),
        F.create_map(F.lit("line"), e["line"]).alias("metadata"),
    )
    docs = docs.select("l_orderkey", F.transform("events", with_map).alias("events"))
    heads = seed_shipment_heads(lineitem)
    return heads.join(docs, F.col("order_id") == F.col("l_orderkey")).drop("l_orderkey")


def seed_pages(items: DataFrame, key: str, name: str = "shipments") -> DataFrame:
    """Page envelopes of at most ``PAGE_SIZE`` items, cut by ranges of a unique whole-number key."""
    page = F.floor(F.col(key) / PAGE_SIZE) + 1
    totals = items.agg(F.count(F.lit(1)).alias("n"), F.max(page).alias("pages")).first()
    total, pages = totals["n"], totals["pages"] or 0
    return items.groupBy(page.cast("long").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(key, *[c for c in items.columns if c != key]))).alias(name)
    ).select(
        "page",
        F.lit(PAGE_SIZE).cast("long").alias("limit"),
        F.lit(total).cast("long").alias("total"),
        F.lit(pages).cast("long").alias("total_pages"),
        F.when(F.col("page") < pages, F.col("page") + 1).alias("next_page"),
        name,
    )


def with_batches(df: DataFrame, key: str, batches: int = 4) -> DataFrame:
    """Spread rows over batches ``20260101_000000_<n>`` by key."""
    n = (F.pmod(F.col(key), F.lit(batches)) + 1).cast("string")
    return df.withColumn("batch_id", F.concat(F.lit("20260101_000000_"), n))


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All source tables by dataset name."""
    t = {n: read(spark, sf_dir, n) for n in (
        "customer", "nation", "region", "part", "orders", "lineitem", "supplier",
        "events", "documents", "labels",
    )}
    return {
        "customers": seed_customers(t["customer"], t["nation"], t["region"]),
        "products": seed_products(t["part"]),
        "orders": seed_orders(t["orders"]),
        "order_items": seed_order_items(t["lineitem"]),
        "payments": seed_payments(t["orders"]),
        "customer_sessions": seed_sessions(t["events"]),
        "product_reviews": seed_reviews(t["documents"], t["labels"]),
        "carriers": seed_carriers(t["supplier"]),
        "shipments": seed_shipments(t["lineitem"]),
    }
