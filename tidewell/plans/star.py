"""The star schema. Each table is a function of processed tables.

==================== =============================== ======================================
table                grain and key                   duplicates
==================== =============================== ======================================
dim_customer         customer_id                     latest by updated_at
dim_product          product_id                      unique after the key merge
dim_date             date_key, one per day           generated
dim_carrier          carrier_id                      unique after the key merge
fact_orders          order_id                        unique after the key merge
fact_order_items     order_item_id                   unique after the key merge
fact_payments        payment_id                      unique after the key merge
fact_customer_events session, type, time, product    first event of a document
fact_shipments       shipment_id                     latest by updated_at
fact_shipment_events shipment_id, event_time, type   exact copies dropped
fact_product_reviews review_id                       unique after the key merge
==================== =============================== ======================================

Assumptions: times are UTC; facts keep rows whose parent is missing (their parent columns
are null); a hot key on the fact side of a join is split by adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import normalize_case
from tidewell.operators.clean import dedup_full_row, fill_null, strip_strings, to_timestamp_coerce
from tidewell.operators.merge import first_per_key, row_order
from tidewell.plans.cleaning import BRAND_FILL


def date_key(col: Column) -> Column:
    """20250301 for the first of March 2025."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.day(col)


def dim_customer(customers: DataFrame) -> DataFrame:
    key = ["customer_id"]
    latest = first_per_key(customers, key, row_order(customers, key, F.desc("updated_at")))
    return latest.select(
        "customer_id",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "email",
        "phone",
        normalize_case(F.col("city")).alias("city"),
        "state",
        "country",
        "created_at",
        "updated_at",
    )


def dim_product(products: DataFrame) -> DataFrame:
    return fill_null(products, BRAND_FILL).select(
        "product_id", "product_name", "category", "brand",
        "unit_price", "cost_price", "stock_quantity",
    )


def dim_date(dates: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Every day from the first to the last date of the given fact columns."""
    bounds = None
    for df, col in dates:
        one = df.agg(
            F.min(F.to_date(col)).alias("first_day"), F.max(F.to_date(col)).alias("last_day")
        )
        bounds = one if bounds is None else bounds.unionByName(one)
    day = F.col("date")
    return (
        bounds.agg(F.min("first_day").alias("a"), F.max("last_day").alias("b"))
        .filter(F.col("a").isNotNull())
        .select(F.explode(F.sequence("a", "b")).alias("date"))
        .select(
            date_key(day).alias("date_key"),
            "date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.day(day).alias("day"),
            (F.weekday(day) + 1).alias("iso_weekday"),
            (F.weekday(day) >= 5).alias("is_weekend"),
        )
    )


def dim_carrier(carriers: DataFrame) -> DataFrame:
    return strip_strings(carriers).select(
        "carrier_id", "carrier_name", "service_level", "support_phone"
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    """Keys to the customer and date dimensions; no join is needed to carry them."""
    return orders.select(
        "order_id", "customer_id", "order_status", "order_date",
        date_key(F.col("order_date")).alias("order_date_key"),
        "currency", "subtotal", "shipping_fee", "discount_amount", "total_amount",
        (F.col("order_status") == "cancelled").alias("is_cancelled"),
    )


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    order_cols = orders.select(
        "order_id", "customer_id", "order_status",
        date_key(F.col("order_date")).alias("order_date_key"),
    )
    product_cols = products.select("product_id", "category", "cost_price")
    cost = F.col("quantity") * F.col("cost_price")
    return (
        items.join(product_cols, "product_id", "left")
        .join(order_cols, "order_id", "left")
        .select(
            "order_item_id", "order_id", "product_id", "customer_id", "order_date_key",
            "order_status", "category", "quantity", "unit_price", "discount_amount",
            "line_total", (F.col("line_total") - cost).alias("margin"),
        )
    )


def fact_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    order_cols = orders.select("order_id", "customer_id", "total_amount")
    return payments.join(order_cols, "order_id", "left").select(
        "payment_id", "order_id", "customer_id", "payment_method", "payment_status",
        "amount", (F.col("amount") - F.col("total_amount")).alias("amount_gap"),
        (F.col("payment_status") == "successful").alias("is_successful"),
        "transaction_reference", "paid_at", date_key(F.col("paid_at")).alias("paid_date_key"),
    )


def fact_customer_events(session_events: DataFrame) -> DataFrame:
    key = ["session_id", "event_type", "event_time", "product_id"]
    order = [F.col("event_no")] if "event_no" in session_events.columns else []
    return first_per_key(session_events, key, row_order(session_events, key, *order)).select(
        "session_id", "customer_id", "event_type", "event_time",
        date_key(F.col("event_time")).alias("event_date_key"),
        "product_id", "search_term", "quantity", "page_url", "browser",
        "device_type", "device_os",
    )


def fact_shipments(shipments: DataFrame) -> DataFrame:
    """From shipment documents or their exploded rows.

    Nested and event columns are left out before any shuffle.
    """
    times = ["shipped_at", "estimated_delivery_at", "delivered_at", "updated_at"]
    slim = to_timestamp_coerce(
        shipments.select("shipment_id", "order_id", "carrier_id", "shipment_status", *times), times
    )
    key = ["shipment_id"]
    latest = first_per_key(slim, key, row_order(slim, key, F.desc("updated_at")))
    seconds = F.timestamp_diff("SECOND", F.col("shipped_at"), F.col("delivered_at"))
    return latest.withColumns(
        {
            "delivery_hours": seconds / F.lit(3600.0),
            "is_late": F.col("delivered_at") > F.col("estimated_delivery_at"),
        }
    )


def fact_shipment_events(shipment_events: DataFrame) -> DataFrame:
    return dedup_full_row(
        shipment_events.filter(F.col("event_type").isNotNull()).select(
            "shipment_id", "order_id", "carrier_id", "event_type", "event_time",
            date_key(F.col("event_time")).alias("event_date_key"), "location", "notes", "metadata",
        )
    )


def fact_product_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id", "product_id", "customer_id", "rating", "title", "review_text",
        "verified_purchase", "helpful_votes", "created_at",
        date_key(F.col("created_at")).alias("created_date_key"),
    )


def build_star(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All star tables from processed tables by dataset name.

    ``shipments`` are the documents and ``shipment_events`` their exploded rows.
    """
    star = {
        "dim_customer": dim_customer(t["customers"]),
        "dim_product": dim_product(t["products"]),
        "dim_carrier": dim_carrier(t["carriers"]),
        "fact_orders": fact_orders(t["orders"]),
        "fact_order_items": fact_order_items(t["order_items"], t["orders"], t["products"]),
        "fact_payments": fact_payments(t["payments"], t["orders"]),
        "fact_customer_events": fact_customer_events(t["customer_sessions"]),
        "fact_shipments": fact_shipments(t["shipments"]),
        "fact_shipment_events": fact_shipment_events(t["shipment_events"]),
        "fact_product_reviews": fact_product_reviews(t["product_reviews"]),
    }
    star["dim_date"] = dim_date(
        [
            (star["fact_orders"], "order_date"),
            (star["fact_payments"], "paid_at"),
            (star["fact_customer_events"], "event_time"),
            (star["fact_shipments"], "shipped_at"),
            (star["fact_shipments"], "delivered_at"),
            (star["fact_shipment_events"], "event_time"),
            (star["fact_product_reviews"], "created_at"),
        ]
    )
    return star
