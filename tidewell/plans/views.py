"""The same questions as Spark SQL over temporary views of the star tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_daily_sales": """
        SELECT to_date(order_date) AS sales_date, count(*) AS orders,
               sum(total_amount) AS gross_sales,
               coalesce(sum(total_amount) FILTER (WHERE NOT is_cancelled), 0) AS net_sales
        FROM fact_orders GROUP BY to_date(order_date)""",
    "v_monthly_sales": """
        SELECT trunc(order_date, 'month') AS sales_month, count(*) AS orders,
               sum(total_amount) AS gross_sales,
               coalesce(sum(total_amount) FILTER (WHERE NOT is_cancelled), 0) AS net_sales
        FROM fact_orders GROUP BY trunc(order_date, 'month')""",
    "v_revenue_by_category": """
        WITH per_product AS (
            SELECT product_id, sum(line_total) AS revenue, sum(quantity) AS units
            FROM fact_order_items GROUP BY product_id)
        SELECT category, sum(revenue) AS revenue, sum(units) AS units
        FROM per_product JOIN dim_product USING (product_id) GROUP BY category""",
    "v_average_order_value": """
        SELECT trunc(order_date, 'month') AS sales_month, count(*) AS orders,
               try_divide(double(sum(total_amount)), double(count(*))) AS average_order_value
        FROM fact_orders GROUP BY trunc(order_date, 'month')""",
    "v_payment_success_rate": """
        SELECT payment_method, count(*) AS payments, count_if(is_successful) AS successful,
               try_divide(double(count_if(is_successful)), double(count(*))) AS success_rate
        FROM fact_payments GROUP BY payment_method""",
    "v_purchase_frequency": """
        WITH per_customer AS (
            SELECT customer_id, count(*) AS n FROM fact_orders GROUP BY customer_id)
        SELECT coalesce(n, 0) AS orders, count(*) AS customers
        FROM dim_customer LEFT JOIN per_customer USING (customer_id) GROUP BY coalesce(n, 0)""",
    "v_view_to_purchase": """
        WITH pairs AS (
            SELECT product_id, customer_id,
                   min(event_time) FILTER (WHERE event_type = 'product_view') AS first_view,
                   max(event_time) FILTER (WHERE event_type = 'purchase_completed') AS last_purchase
            FROM fact_customer_events
            WHERE product_id IS NOT NULL AND customer_id IS NOT NULL
            GROUP BY product_id, customer_id)
        SELECT product_id, count(*) AS viewers,
               count_if(last_purchase >= first_view) AS buyers,
               try_divide(double(count_if(last_purchase >= first_view)), double(count(*)))
                   AS conversion_rate
        FROM pairs WHERE first_view IS NOT NULL GROUP BY product_id""",
    "v_cart_abandonment": """
        WITH s AS (
            SELECT session_id, bool_or(event_type = 'add_to_cart') AS has_cart,
                   bool_or(event_type = 'purchase_completed') AS has_purchase
            FROM fact_customer_events GROUP BY session_id)
        SELECT count(*) AS sessions, count_if(has_cart) AS cart_sessions,
               count_if(has_cart AND NOT has_purchase) AS abandoned_sessions,
               try_divide(double(count_if(has_cart AND NOT has_purchase)),
                          double(count_if(has_cart))) AS abandonment_rate
        FROM s""",
    "v_average_review_score": """
        WITH per_product AS (
            SELECT product_id, sum(rating) AS points, count(*) AS reviews
            FROM fact_product_reviews WHERE rating BETWEEN 1 AND 5 GROUP BY product_id)
        SELECT category, sum(reviews) AS reviews,
               try_divide(double(sum(points)), double(sum(reviews))) AS average_score
        FROM per_product JOIN dim_product USING (product_id) GROUP BY category""",
    "v_average_delivery_time": """
        SELECT trunc(order_date, 'month') AS sales_month, count(*) AS delivered,
               try_divide(double(sum(date_diff(to_date(delivered_at), to_date(order_date)))),
                          double(count(*))) AS average_days
        FROM fact_shipments JOIN fact_orders USING (order_id)
        WHERE delivered_at IS NOT NULL GROUP BY trunc(order_date, 'month')""",
    "v_late_delivery_rate": """
        WITH per_carrier AS (
            SELECT carrier_id, count(*) AS delivered, count_if(is_late) AS late
            FROM fact_shipments WHERE delivered_at IS NOT NULL GROUP BY carrier_id)
        SELECT service_level, sum(delivered) AS delivered, sum(late) AS late,
               try_divide(double(sum(late)), double(sum(delivered))) AS late_rate
        FROM per_carrier JOIN dim_carrier USING (carrier_id) GROUP BY service_level""",
    "v_orders_without_shipments": """
        SELECT order_id, customer_id, order_status, total_amount
        FROM fact_orders LEFT ANTI JOIN fact_shipments USING (order_id)""",
    "v_delivered_but_cancelled": """
        SELECT order_id, customer_id, total_amount
        FROM (SELECT * FROM fact_orders WHERE is_cancelled)
        LEFT SEMI JOIN (SELECT * FROM fact_shipments WHERE shipment_status = 'delivered')
            USING (order_id)""",
    "v_repeat_customers": """
        WITH ranked AS (
            SELECT customer_id, order_date,
                   row_number() OVER (PARTITION BY customer_id
                                      ORDER BY order_date, order_id) AS nth
            FROM fact_orders),
        first_two AS (
            SELECT customer_id, min(order_date) FILTER (WHERE nth = 1) AS first_order,
                   min(order_date) FILTER (WHERE nth = 2) AS second_order
            FROM ranked WHERE nth <= 2 GROUP BY customer_id),
        counts AS (SELECT customer_id, count(*) AS orders FROM fact_orders GROUP BY customer_id)
        SELECT customer_id, orders, first_order, second_order,
               date_diff(to_date(second_order), to_date(first_order)) AS days_to_second
        FROM first_two JOIN counts USING (customer_id) WHERE second_order IS NOT NULL""",
    "v_sales_by_city_state": """
        WITH per_customer AS (
            SELECT customer_id, count(*) AS orders, sum(total_amount) AS sales
            FROM fact_orders GROUP BY customer_id)
        SELECT state, city, grouping_id() AS level, sum(orders) AS orders, sum(sales) AS sales
        FROM per_customer JOIN dim_customer USING (customer_id) GROUP BY ROLLUP (state, city)""",
}


def register_star(star: Mapping[str, DataFrame]) -> None:
    """Name the star tables for SQL."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)


def analytics_views(
    spark: SparkSession, star: Mapping[str, DataFrame], names: Iterable[str] = tuple(VIEWS)
) -> dict[str, DataFrame]:
    """Register the star and one view per question; returns the views."""
    register_star(star)
    out = {}
    for name in names:
        out[name] = spark.sql(VIEWS[name])
        out[name].createOrReplaceTempView(name)
    return out
