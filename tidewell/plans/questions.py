"""The business questions, as functions of star tables.

Facts are aggregated by join key before they meet a dimension: the shuffle then carries
one row per key and map task, and a key that holds a third of the fact is one row too.
Money is summed as decimal, so results do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _rate(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def _rows() -> Column:
    return F.count(F.lit(1))


def _sales(orders: DataFrame, period: Column, name: str) -> DataFrame:
    kept = F.when(~F.col("is_cancelled"), F.col("total_amount"))
    return orders.groupBy(period.alias(name)).agg(
        _rows().alias("orders"),
        F.sum("total_amount").alias("gross_sales"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("net_sales"),
    )


def daily_sales(fact_orders: DataFrame) -> DataFrame:
    """Orders and sales per day; net sales leave out cancelled orders."""
    return _sales(fact_orders, F.to_date("order_date"), "sales_date")


def monthly_sales(fact_orders: DataFrame) -> DataFrame:
    return _sales(fact_orders, F.trunc("order_date", "month"), "sales_month")


def _by_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum("line_total").alias("revenue"), F.sum("quantity").alias("units")
    )


def revenue_by_category(items: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (
        _by_product(items)
        .join(dim_product.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
    )


def revenue_by_product(items: DataFrame, dim_product: DataFrame, top: int | None = None) -> DataFrame:
    """Revenue of every product, or of the ``top`` best sellers."""
    totals = _by_product(items)
    if top is not None:
        # Rank before the join, so only the winners meet the dimension.
        known = totals.join(dim_product.select("product_id"), "product_id", "left_semi")
        totals = known.orderBy(F.desc("revenue"), "product_id").limit(top)
    return totals.join(
        dim_product.select("product_id", "product_name", "category"), "product_id"
    )


def average_order_value(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy(F.trunc("order_date", "month").alias("sales_month")).agg(
        _rows().alias("orders"),
        _rate(F.sum("total_amount"), _rows()).alias("average_order_value"),
    )


def payment_success_rate(fact_payments: DataFrame) -> DataFrame:
    """Share of all payment attempts that succeeded, by method."""
    ok = F.count_if("is_successful")
    return fact_payments.groupBy("payment_method").agg(
        _rows().alias("payments"), ok.alias("successful"), _rate(ok, _rows()).alias("success_rate")
    )


def purchase_frequency(dim_customer: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """How many customers placed n orders, n = 0 included."""
    per_customer = fact_orders.groupBy("customer_id").agg(_rows().alias("orders"))
    return (
        dim_customer.select("customer_id")
        .join(per_customer, "customer_id", "left")
        .groupBy(F.coalesce("orders", F.lit(0)).alias("orders"))
        .agg(_rows().alias("customers"))
    )


def view_to_purchase(events: DataFrame) -> DataFrame:
    """Per product: customers who viewed it, and who bought it at or after their first view."""
    kind, at = F.col("event_type"), F.col("event_time")
    return (
        events.filter(
            kind.isin("product_view", "purchase_completed")
            & F.col("product_id").isNotNull()
            & F.col("customer_id").isNotNull()
        )
        .groupBy("product_id", "customer_id")
        .agg(
            F.min(F.when(kind == "product_view", at)).alias("first_view"),
            F.max(F.when(kind == "purchase_completed", at)).alias("last_purchase"),
        )
        .filter(F.col("first_view").isNotNull())
        .groupBy("product_id")
        .agg(
            _rows().alias("viewers"),
            F.count_if(F.col("last_purchase") >= F.col("first_view")).alias("buyers"),
        )
        .withColumn("conversion_rate", _rate(F.col("buyers"), F.col("viewers")))
    )


def _abandonment(sessions: DataFrame) -> DataFrame:
    carts = F.count_if("has_cart")
    abandoned = F.count_if(F.col("has_cart") & ~F.col("has_purchase"))
    return sessions.agg(
        _rows().alias("sessions"),
        carts.alias("cart_sessions"),
        abandoned.alias("abandoned_sessions"),
        _rate(abandoned, carts).alias("abandonment_rate"),
    )


def _flags() -> list[Column]:
    kind = F.col("event_type")
    return [
        F.bool_or(kind == "add_to_cart").alias("has_cart"),
        F.bool_or(kind == "purchase_completed").alias("has_purchase"),
    ]


def cart_abandonment(events: DataFrame) -> DataFrame:
    """Share of sessions with a cart but no purchase, by recorded session id."""
    return _abandonment(events.groupBy("session_id").agg(*_flags()))


def sessionize(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Sessions per customer where no id was recorded; a pause of the full gap starts a new one.

    Events of one gap-long time slot always belong together, so they are first folded
    into one row per customer and slot. The window then sees at most one row per slot of
    elapsed time, however many events a customer has.
    """
    gap = gap_minutes * 60 * 1_000_000
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    slots = (
        events.filter(F.col("customer_id").isNotNull() & F.col("event_time").isNotNull())
        .groupBy("customer_id", F.floor(micros / gap).alias("slot"))
        .agg(
            F.min(micros).alias("first_at"), F.max(micros).alias("last_at"),
            _rows().alias("events"), *_flags(),
        )
    )
    by_time = Window.partitionBy("customer_id").orderBy("slot")
    pause = F.col("first_at") - F.lag("last_at").over(by_time)
    starts = F.when(pause.isNull() | (pause >= gap), 1).otherwise(0)
    return (
        slots.withColumn("_start", starts)
        .withColumn("session_no", F.sum("_start").over(by_time))
        .groupBy("customer_id", "session_no")
        .agg(
            F.timestamp_micros(F.min("first_at")).alias("started_at"),
            F.timestamp_micros(F.max("last_at")).alias("ended_at"),
            F.sum("events").alias("events"),
            F.bool_or("has_cart").alias("has_cart"),
            F.bool_or("has_purchase").alias("has_purchase"),
        )
    )


def cart_abandonment_by_gap(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    return _abandonment(sessionize(events, gap_minutes))


def average_review_score(reviews: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Mean rating per category; ratings outside 1..5 are left out."""
    per_product = (
        reviews.filter(F.col("rating").between(1, 5))
        .groupBy("product_id")
        .agg(F.sum("rating").alias("points"), _rows().alias("reviews"))
    )
    return (
        per_product.join(dim_product.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("reviews").alias("reviews"),
            _rate(F.sum("points"), F.sum("reviews")).alias("average_score"),
        )
    )


def average_delivery_time(fact_shipments: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Mean days from order to delivery, by month of the order; undelivered ones are left out."""
    delivered = fact_shipments.filter(F.col("delivered_at").isNotNull())
    days = F.date_diff(F.to_date("delivered_at"), F.to_date("order_date"))
    return (
        delivered.select("order_id", "delivered_at")
        .join(fact_orders.select("order_id", "order_date"), "order_id")
        .groupBy(F.trunc("order_date", "month").alias("sales_month"))
        .agg(_rows().alias("delivered"), _rate(F.sum(days), _rows()).alias("average_days"))
    )


def late_delivery_rate(fact_shipments: DataFrame, dim_carrier: DataFrame) -> DataFrame:
    """Share of delivered shipments that came after the estimate, by service level."""
    per_carrier = (
        fact_shipments.filter(F.col("delivered_at").isNotNull())
        .groupBy("carrier_id")
        .agg(_rows().alias("delivered"), F.count_if("is_late").alias("late"))
    )
    return (
        per_carrier.join(dim_carrier.select("carrier_id", "service_level"), "carrier_id")
        .groupBy("service_level")
        .agg(F.sum("delivered").alias("delivered"), F.sum("late").alias("late"))
        .withColumn("late_rate", _rate(F.col("late"), F.col("delivered")))
    )


def orders_without_shipments(fact_orders: DataFrame, fact_shipments: DataFrame) -> DataFrame:
    return fact_orders.select("order_id", "customer_id", "order_status", "total_amount").join(
        fact_shipments.select("order_id"), "order_id", "left_anti"
    )


def delivered_but_cancelled(fact_orders: DataFrame, fact_shipments: DataFrame) -> DataFrame:
    """Cancelled orders with a delivered shipment."""
    delivered = fact_shipments.filter(F.col("shipment_status") == "delivered")
    return (
        fact_orders.filter("is_cancelled")
        .select("order_id", "customer_id", "total_amount")
        .join(delivered.select("order_id"), "order_id", "left_semi")
    )


def repeat_customers(fact_orders: DataFrame) -> DataFrame:
    """Customers with two orders or more, and the days from the first to the second."""
    nth = F.row_number().over(Window.partitionBy("customer_id").orderBy("order_date", "order_id"))
    # Ranking <= 2 keeps two rows per customer and map task before the shuffle.
    first_two = (
        fact_orders.select("customer_id", "order_date", "order_id")
        .withColumn("nth", nth)
        .filter("nth <= 2")
        .groupBy("customer_id")
        .agg(
            F.min(F.when(F.col("nth") == 1, F.col("order_date"))).alias("first_order"),
            F.min(F.when(F.col("nth") == 2, F.col("order_date"))).alias("second_order"),
        )
        .filter(F.col("second_order").isNotNull())
    )
    counts = fact_orders.groupBy("customer_id").agg(_rows().alias("orders"))
    days = F.date_diff(F.to_date("second_order"), F.to_date("first_order"))
    return first_two.join(counts, "customer_id").select(
        "customer_id", "orders", "first_order", "second_order", days.alias("days_to_second")
    )


def sales_by_city_state(fact_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Sales per city, with subtotals per state and a grand total (``level`` 0, 1, 3)."""
    per_customer = fact_orders.groupBy("customer_id").agg(
        _rows().alias("orders"), F.sum("total_amount").alias("sales")
    )
    return (
        per_customer.join(dim_customer.select("customer_id", "state", "city"), "customer_id")
        .rollup("state", "city")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("orders").alias("orders"),
            F.sum("sales").alias("sales"),
        )
    )
