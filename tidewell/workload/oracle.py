"""The SQL each registered query must agree with, for DuckDB over the same tables.

The common table expressions restate the seeds; every query selects from those it needs.
Money leaves as DOUBLE and whole numbers as BIGINT, as on the Spark side.
"""

from __future__ import annotations

from tidewell.plans.suites import SUITES
from tidewell.operators.quality import Expectation
from tidewell.operators.checks import CONSTRAINTS, FOREIGN_KEYS, UNIQUE_KEYS
from tidewell.workload.queries import ID_MARK, ORDER_MARK, VIEW_OF

ORACLE: dict[str, str] = {}


def _iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def _pick(values: str, n: str) -> str:
    return f"([{values}])[1 + CAST({n} AS INTEGER)]"


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _pad(x: str, n: int) -> str:
    return f"lpad({_v(x)}, {n}, '0')"


def _batch(key: str, n: int = 4) -> str:
    return f"'20260101_000000_' || {_v(f'({key} % {n}) + 1')}"


# Text in the one form the seeds write well; everything else they write is malformed.
def _ts(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T') THEN "
        f"CAST(replace(replace({x}, 'T', ' '), 'Z', '') AS TIMESTAMP) END"
    )


_SPACE = (
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) "
    "|| chr(31) || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) "
    "|| chr(8195) || chr(8196) || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) "
    "|| chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)


def _strip(x: str) -> str:
    return f"trim({x}, {_SPACE})"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    _CTES[name] = (needs, sql)


_cte("customers", (), f"""
    SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name,
           'buyer.' || {_pad("CASE WHEN c_custkey % 64 = 63 THEN c_custkey - 1 ELSE c_custkey END", 9)}
               || '@mail.test' AS email,
           CASE WHEN c_acctbal >= 0 THEN '00' || {_pad("c_nationkey", 2)} || {_pad("c_custkey", 9)} END AS phone,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN lower(n_name)
                ELSE upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) END AS city,
           r_name AS state, n_name AS country,
           TIMESTAMP '1992-01-01' + to_days(CAST(c_nationkey * 31 + c_custkey % 300 AS INTEGER)) AS created_at,
           TIMESTAMP '1992-01-01' + to_days(CAST(c_nationkey * 31 + c_custkey % 300
               + CAST(floor(abs(c_acctbal)) AS BIGINT) % 90 AS INTEGER)) AS updated_at
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

_cte("products", (), """
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CASE WHEN p_size % 12 <> 5 THEN p_brand END AS brand,
           CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
           CAST(CAST(p_retailprice AS DECIMAL(12,2)) - p_size * 10 AS DECIMAL(12,2)) AS cost_price,
           CAST(p_size AS BIGINT) AS stock_quantity,
           TIMESTAMP '1994-03-01' + to_days(CAST(p_size * 9 AS INTEGER)) AS created_at,
           TIMESTAMP '1994-03-01'
               + to_days(CAST(p_size * 9 + CAST(floor(p_retailprice) AS BIGINT) % 40 AS INTEGER)) AS updated_at
    FROM part""")

_cte("shop_orders", (), """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing'
                WHEN 'P' THEN 'cancelled' END AS order_status,
           CAST(o_orderdate AS TIMESTAMP) AS order_date, 'USD' AS currency,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) - (30 - CAST(o_orderpriority[1] AS INTEGER) * 4)
                + CASE WHEN o_totalprice > 200000 THEN 75 ELSE 0 END
                + CASE WHEN o_orderkey % 1000 = 333 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS subtotal,
           CAST(30 - CAST(o_orderpriority[1] AS INTEGER) * 4 AS DECIMAL(12,2)) AS shipping_fee,
           CAST(CASE WHEN o_totalprice > 200000 THEN 75 ELSE 0 END AS DECIMAL(12,2)) AS discount_amount,
           CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
           CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(floor(o_totalprice) AS BIGINT) % 72) AS updated_at,
           CAST(floor(o_totalprice) AS BIGINT) AS whole,
           o_orderstatus = 'P' AS is_cancelled
    FROM orders""")

_cte("items", (), """
    SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
           l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
           CAST((CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                 // CAST(l_quantity AS BIGINT)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS unit_price,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                AS DECIMAL(12,2)) AS discount_amount,
           CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                - CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                       AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS line_total
    FROM lineitem""")

_cte("payments", ("shop_orders",), f"""
    SELECT order_id AS payment_id, order_id, customer_id, total_amount,
           {_pick("'card','bank_transfer','ussd','wallet'", "whole % 4")} AS payment_method,
           CASE WHEN whole % 16 = 3 THEN 'failed' WHEN order_status = 'delivered' THEN 'successful'
                WHEN order_status = 'processing' THEN 'pending' ELSE 'refunded' END AS payment_status,
           CAST(total_amount + CASE whole % 128 WHEN 1 THEN 60 WHEN 2 THEN -40 ELSE 0 END
                AS DECIMAL(12,2)) AS amount,
           'ref/' || {_pad("CASE WHEN order_id % 256 = 255 THEN order_id - 1 ELSE order_id END", 10)}
               AS transaction_reference,
           CASE WHEN whole % 16 <> 3 THEN order_date + to_hours(whole % 30) END AS paid_at,
           updated_at + to_hours(whole % 48) AS updated_at
    FROM shop_orders""")

_cte("event_rows", (), f"""
    SELECT *, slot * 4 + (strpos('0123456789abcdef',
                  md5(concat_ws('|', event_time, event_type, page_url))[1]) - 1) % 4 AS part FROM (
    SELECT user_id, CAST(hour(ts) // 6 AS BIGINT) AS slot, strftime(ts, '%Y%m%d') AS day, event_type AS raw_type, ts,
           CASE WHEN event_id % 1009 = 10 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
                ELSE {_iso("ts")} END AS event_time,
           kind AS event_type,
           CASE WHEN kind <> 'checkout_started' THEN product END AS product_id,
           CASE WHEN kind = 'product_view' THEN 'term ' || {_v("event_id % 5")} END AS search_term,
           CASE WHEN kind NOT IN ('checkout_started', 'product_view') THEN event_id % 3 + 1 END AS quantity,
           '/products/' || {_v("product")} AS page_url
    FROM (SELECT *, CASE event_type WHEN 'view' THEN 'product_view' WHEN 'signup' THEN 'checkout_started'
                 WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
                 WHEN 'purchase' THEN 'purchase_completed' END AS kind,
                 CASE WHEN event_id % 1009 = 500 THEN 9999999999
                      ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product
          FROM events))""")

_SESSION_HEAD = f"""
    day || {_pad("user_id", 12)} || {_pad("part", 4)} AS _id,
    'sess_' || {_v("user_id")} || '_' || day AS session_id,
    CASE WHEN user_id % 120 <> 2 THEN user_id END AS customer_id,
    CASE WHEN user_id % 90 = 4 THEN '15.04.2025 noon'
         ELSE substr(day, 1, 4) || '-' || substr(day, 5, 2) || '-' || substr(day, 7, 2) || 'T00:00:00.000Z'
    END AS started_at,
    substr(day, 1, 4) || '-' || substr(day, 5, 2) || '-' || substr(day, 7, 2) || 'T23:00:00.000Z' AS ended_at,
    {_pick("'Chrome','Safari','Edge','Firefox'", "user_id % 4")} AS browser,
    'City ' || {_v("user_id % 6")} AS location_city, 'State ' || {_v("user_id % 3")} AS location_state,
    'FR' AS location_country,
    CASE WHEN user_id % 45 <> 6 THEN {_pick("'phone','laptop','tablet'", "user_id % 3")} END AS device_type,
    CASE WHEN user_id % 45 <> 6 THEN {_pick("'Android','Linux','iPadOS'", "user_id % 3")} END AS device_os"""

_SESSION_COLS = (
    "_id, session_id, customer_id, started_at, ended_at, browser, location_city, location_state, "
    "location_country, device_type, device_os"
)

# Flattened documents, one row per user and day, with the number of events.
_cte("session_docs", ("event_rows",), f"""
    SELECT {_SESSION_HEAD}, n_events, first_time, first_type
    FROM (SELECT user_id, day, part, count(*) AS n_events,
                 arg_min(event_time, sort_key) AS first_time, arg_min(event_type, sort_key) AS first_type
          FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day, part
                    ORDER BY event_time, event_type, product_id NULLS FIRST, search_term NULLS FIRST,
                             quantity NULLS FIRST, page_url) AS sort_key FROM event_rows)
          GROUP BY user_id, day, part)""")

# Exploded rows, still as text.
_cte("session_text", ("event_rows",), f"""
    SELECT {_SESSION_HEAD}, event_time, event_type, product_id, search_term, quantity, page_url, user_id,
           row_number() OVER (PARTITION BY user_id, day, part
               ORDER BY event_time, event_type, product_id NULLS FIRST, search_term NULLS FIRST,
                        quantity NULLS FIRST, page_url) - 1 AS event_no
    FROM event_rows""")

_cte("session_typed", ("session_text",), f"""
    SELECT * REPLACE ({_ts("started_at")} AS started_at, {_ts("ended_at")} AS ended_at,
                      {_ts("event_time")} AS event_time)
    FROM session_text""")

_cte("session_rows", ("session_typed",), f"""
    SELECT {_SESSION_COLS}, event_time, event_type, product_id, search_term, quantity, page_url, user_id,
           min(event_no) AS event_no
    FROM session_typed GROUP BY ALL""")

_cte("shop_events", (), """
    SELECT user_id AS customer_id, 'sess_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
           CASE event_type WHEN 'view' THEN 'product_view' WHEN 'signup' THEN 'checkout_started'
                WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
                WHEN 'purchase' THEN 'purchase_completed' END AS event_type,
           ts AS event_time, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id
    FROM events""")

_cte("reviews", (), f"""
    SELECT lpad(lower(to_hex(doc_id)), 24, '0') AS _id, 'rev_' || {_pad("doc_id", 9)} AS review_id,
           CASE WHEN n_chars % 83 = 5 THEN 9999999999 ELSE n_chars % 200 END AS product_id,
           n_chars % 150 AS customer_id,
           CASE WHEN n_chars % 97 = 4 THEN 6 WHEN n_chars % 97 = 8 THEN 0 ELSE n_chars % 5 + 1 END AS rating,
           CASE WHEN doc_id % 61 <> 33 THEN '  Review ' || {_v("doc_id")} || chr(9) END AS title,
           CASE WHEN n_chars % 29 <> 0 THEN CASE WHEN doc_id % 3 = 0
                THEN chr(160) || ' ' || text || chr(10) || chr(12288) ELSE text END END AS review_text,
           quality = 1 AS verified_purchase,
           CASE WHEN doc_id % 50 = 21 THEN '6 May, half past two'
                ELSE {_iso("TIMESTAMP '2024-06-01 09:00:00' + to_days(CAST(n_chars % 90 AS INTEGER))")}
           END AS created_at,
           n_chars % 37 AS helpful_votes
    FROM documents LEFT JOIN labels USING (doc_id)""")

_cte("clean_reviews", ("reviews",), f"""
    SELECT DISTINCT _id, review_id, product_id, customer_id, rating,
           {_strip("coalesce(title, '')")} AS title, {_strip("coalesce(review_text, '')")} AS review_text,
           coalesce(verified_purchase, false) AS verified_purchase,
           {_ts("created_at")} AS created_at, helpful_votes
    FROM reviews""")

_cte("carriers", (), f"""
    SELECT 'car_' || {_v("s_suppkey")} AS carrier_id, ' ' || s_name || chr(9) AS carrier_name,
           {_pick("'standard','premium','regional'", "s_suppkey % 3")} AS service_level,
           ' 0800 ' || {_pad("s_suppkey", 7)} || ' ' AS support_phone
    FROM supplier""")

_cte("dim_carrier", ("carriers",), """
    SELECT carrier_id, trim(carrier_name, ' ' || chr(9)) AS carrier_name, service_level,
           trim(support_phone) AS support_phone FROM carriers""")

_cte("heads", (), f"""
    SELECT 'shp_' || {_pad("l_orderkey", 12)} AS shipment_id, l_orderkey AS order_id,
           'car_' || {_v("carrier")} AS carrier_id, 'trk-' || {_v("l_orderkey")} AS tracking_number,
           CASE WHEN done THEN 'delivered' ELSE 'in_transit' END AS shipment_status,
           {_iso("first_ship")} AS shipped_at, {_iso("first_ship + to_days(45)")} AS estimated_delivery_at,
           CASE WHEN done THEN {_iso("last_ship")} END AS delivered_at,
           {_iso("last_ship + to_hours(l_orderkey % 24)")} AS updated_at,
           'Street ' || {_v("l_orderkey % 100")} AS delivery_address_street,
           'City ' || {_v("l_orderkey % 6")} AS delivery_address_city,
           'State ' || {_v("l_orderkey % 3")} AS delivery_address_state, 'FR' AS delivery_address_country,
           {_pad("l_orderkey % 1000", 6)} AS delivery_address_postal_code
    FROM (SELECT l_orderkey, CAST(min(l_shipdate) AS TIMESTAMP) AS first_ship,
                 CAST(max(l_shipdate) AS TIMESTAMP) AS last_ship, min(l_suppkey) AS carrier,
                 bool_or(l_linestatus = 'F') AS done
          FROM lineitem GROUP BY l_orderkey)""")

_cte("shipment_facts", ("heads",), f"""
    SELECT shipment_id, order_id, carrier_id, shipment_status, {_ts("shipped_at")} AS shipped_at,
           {_ts("estimated_delivery_at")} AS estimated_delivery_at, {_ts("delivered_at")} AS delivered_at,
           {_ts("updated_at")} AS updated_at
    FROM heads""")

_cte("scans", (), f"""
    SELECT *, row_number() OVER (PARTITION BY order_id
               ORDER BY event_time, event_type, location, notes NULLS FIRST, line) - 1 AS event_no
    FROM (SELECT 'shp_' || {_pad("l_orderkey", 12)} AS shipment_id, l_orderkey AS order_id,
                 CASE WHEN l_orderkey % 97 = 5 AND l_linenumber = 3 THEN 'invalid-date'
                      ELSE {_iso("CAST(l_shipdate AS TIMESTAMP) + to_hours(l_linenumber)")} END AS event_time,
                 CASE l_returnflag WHEN 'A' THEN 'picked_up' WHEN 'N' THEN 'in_transit'
                      WHEN 'R' THEN 'out_for_delivery' END AS event_type,
                 'hub_' || {_v("l_suppkey % 10")} AS location,
                 CASE WHEN l_linenumber = 7 THEN 'last line' END AS notes,
                 {_v("l_linenumber")} AS line,
                 '{{"line":"' || {_v("l_linenumber")} || '"}}' AS metadata
          FROM lineitem)""")

_cte("dim_customer", ("customers",), """
    SELECT customer_id, first_name || ' ' || last_name AS full_name, email, phone,
           upper(substr(city, 1, 1)) || lower(substr(city, 2)) AS city, state, country, created_at, updated_at
    FROM customers""")

_cte("dim_product", ("products",), """
    SELECT product_id, product_name, category, coalesce(brand, 'Unknown') AS brand, unit_price,
           cost_price, stock_quantity FROM products""")


def _register(name: str, needs: tuple[str, ...] | str, sql: str) -> None:
    """Prefix the query with the expressions it needs, in dependency order."""
    order: list[str] = []

    def add(n: str) -> None:
        for dep in _CTES[n][0]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in (needs,) if isinstance(needs, str) else needs:
        add(n)
    head = ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in order)
    ORACLE[name] = (f"WITH {head}\n" if head else "") + sql.strip()


def _d(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def _key(x: str) -> str:
    return f"CAST(year({x}) * 10000 + month({x}) * 100 + day({x}) AS BIGINT)"


def _rate(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


_ITEM_COLS = f"order_item_id, order_id, product_id, quantity, {_d('unit_price', 'discount_amount', 'line_total')}"
_ITEM_ORDER = "order_item_id, order_id, product_id, quantity, unit_price, discount_amount, line_total"

# A

_register("a01_incremental_scan", (), f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '{ORDER_MARK}'""")
_register("a02_full_scan", "items", f"SELECT {_ITEM_COLS} FROM items")
_register("a03_id_cursor_scan", "reviews",
          f"SELECT _id, review_id, product_id FROM reviews WHERE _id > '{ID_MARK}'")
_register("a04_paged_source", "heads", "SELECT * FROM heads")
_register("a04_page_gaps", "heads", """
SELECT 'missing_page' AS issue, CAST(p AS BIGINT) AS page, CAST(NULL AS BIGINT) AS items
FROM generate_series(1, (SELECT max(order_id // 100 + 1) FROM heads)) AS t(p) WHERE p % 7 = 0
UNION ALL
SELECT 'item_count', NULL, count(*) FROM heads WHERE (order_id // 100 + 1) % 7 <> 0
HAVING count(*) <> (SELECT count(*) FROM heads)""")
_register("a05_unpaged_source", "carriers", "SELECT * FROM carriers")
_register("a06_land_raw", "shop_orders", f"""
SELECT {_batch("order_id")} AS batch_id, order_id, {_d("total_amount")}, updated_at FROM shop_orders""")
_register("a07_scan_layer", ("customers", "products"), f"""
SELECT 'customers' AS table_name, {_batch("customer_id")} AS batch_id, count(*) AS rows FROM customers GROUP BY ALL
UNION ALL
SELECT 'products', {_batch("product_id")} AS batch_id, count(*) FROM products GROUP BY ALL""")
_register("a07_flat_layout", "products", f"""
SELECT {_batch("product_id")} AS batch_id, 'products_' || {_batch("product_id")} || '.parquet' AS file,
       count(*) AS rows, NULL AS reason FROM products GROUP BY ALL
UNION ALL SELECT NULL, 'stray.parquet', NULL, 'path too short'""")
_register("a08_unknown_table_guard", "carriers", """
SELECT DISTINCT 'mongodb/suppliers' AS table_name, 'unknown table' AS reason FROM carriers""")
_register("a09_write_processed", "products", f"""
SELECT {_batch("product_id")} AS batch_id, product_id, coalesce(brand, 'Unknown') AS brand, {_d("unit_price")}
FROM products""")
_register("a10_csv_export", "reviews",
          "SELECT review_id, rating, title, review_text, verified_purchase FROM reviews")
_register("a11_corrupt_input_raises", (), "SELECT count(*) AS rows, true AS raised FROM part")
_register("a12_partitioned_parquet", "shop_orders", f"""
SELECT strftime(order_date, '%Y-%m') AS order_date_month, order_id, order_date, {_d("total_amount")}
FROM shop_orders""")

# B

_register("b01_project", "payments", f"""
SELECT payment_id, order_id, payment_method, payment_status, {_d("amount")}, transaction_reference,
       paid_at, updated_at FROM payments""")
_register("b02_feed_filter_status", "heads",
          "SELECT shipment_id, order_id FROM heads WHERE shipment_status = 'in_transit'")
_register("b03_feed_filter_updated_since", "heads", f"""
SELECT shipment_id, updated_at FROM heads WHERE {_ts("updated_at")} > TIMESTAMP '2000-06-01 11:00:00'""")
_register("b04_page", "heads",
          "SELECT shipment_id, order_id FROM heads ORDER BY shipment_id LIMIT 100 OFFSET 200")
_register("b04_page_index", "heads",
          "SELECT shipment_id, order_id FROM heads ORDER BY shipment_id LIMIT 100 OFFSET 1100")
_register("b04_page_totals", "heads", """
SELECT CAST(3 AS BIGINT) AS page, CAST(100 AS BIGINT) AS "limit", count(*) AS total,
       CAST(ceil(count(*) / 100.0) AS BIGINT) AS total_pages,
       CASE WHEN 3 < ceil(count(*) / 100.0) THEN CAST(4 AS BIGINT) END AS next_page FROM heads""")
_register("b05_lookup", "heads", """
SELECT shipment_id, order_id, shipment_status FROM heads WHERE shipment_id = 'shp_000000000042'""")
_register("b06_drop_if_exists", "carriers", "SELECT carrier_id, carrier_name, service_level FROM carriers")
_register("b07_drop_nested", "session_docs",
          "SELECT _id, session_id, customer_id, started_at, ended_at, browser FROM session_docs")
_register("b08_fill_null", "products",
          "SELECT product_id, coalesce(brand, 'Unknown') AS brand FROM products")
_register("b09_pass_through", "customers", "SELECT * FROM customers")

# C

_register("c01_flatten_struct", "session_docs", f"SELECT {_SESSION_COLS} FROM session_docs")
_register("c02_explode_events", "session_text", "SELECT session_id, event_time, event_type FROM session_text")
_register("c03_expand_event", "scans", """
SELECT shipment_id, event_no, event_type, event_time, location, notes, metadata FROM scans""")
_register("c04_zip_columns", "session_typed", """
SELECT _id, session_id, customer_id, event_no, event_time, event_type, product_id, quantity, device_os,
       location_city FROM session_typed""")
_register("c05_nest_events", "items", """
SELECT order_id, product_id % 2 AS part, count(*) AS n_lines,
       string_agg(CAST(order_item_id AS VARCHAR), ',' ORDER BY order_item_id, product_id, line_total) AS ids,
       CAST(first(line_total ORDER BY order_item_id, product_id, line_total) AS DOUBLE) AS first_total
FROM items GROUP BY order_id, product_id % 2""")

# D

_register("d01_to_timestamp_coerce", "session_typed",
          "SELECT _id, started_at, event_time, event_type FROM session_typed")
_register("d02_parse_iso", (), """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts)
    WHEN 1 THEN date_trunc('second', ts) - INTERVAL 1 HOUR
    WHEN 2 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS parsed FROM events""")
_register("d03_to_int_nullable", (), """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT) AS quantity,
       CASE WHEN l_tax = floor(l_tax) THEN CAST(l_tax AS BIGINT) END AS whole_tax, l_partkey AS part
FROM lineitem""")
_register("d03_int_offenders", (), """
SELECT c AS "column", CAST(n AS BIGINT) AS offenders FROM (
    SELECT 'l_quantity' AS c, count(*) FILTER (WHERE l_quantity <> floor(l_quantity)) AS n FROM lineitem
    UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax <> floor(l_tax)) FROM lineitem
    UNION ALL SELECT 'l_extendedprice',
        count(*) FILTER (WHERE l_extendedprice <> floor(l_extendedprice)) FROM lineitem)""")
_register("d04_to_bool_default_false", "reviews",
          "SELECT review_id, coalesce(verified_purchase, false) AS verified_purchase FROM reviews")
_register("d05_strip_all_strings", "carriers", f"""
SELECT carrier_id, {_strip("carrier_name")} AS carrier_name, service_level,
       {_strip("support_phone")} AS support_phone FROM carriers""")
_register("d06_strip_after_fill", "reviews", f"""
SELECT review_id, {_strip("coalesce(title, '')")} AS title,
       {_strip("coalesce(review_text, '')")} AS review_text FROM reviews""")
_register("d07_id_to_string", (), "SELECT CAST(doc_id AS VARCHAR) AS doc_id, n_chars FROM documents")
_register("d08_batch_id_from_name", "shop_orders", f"""
SELECT {_batch("order_id", 12)} AS batch_id, count(*) AS rows FROM shop_orders GROUP BY ALL""")

# E

_register("e01_dedup_full_row", (),
          f"SELECT DISTINCT {_batch('doc_id', 2)} AS batch_id, lang, text FROM documents")
_register("e01_dedup_session_events", "session_rows", f"""
SELECT {_batch("customer_id")} AS batch_id, _id, session_id, customer_id, started_at, event_no, event_time,
       event_type, product_id, search_term, quantity, page_url FROM session_rows""")
_register("e02_dedup_then_strip", "dim_carrier",
          "SELECT * FROM dim_carrier UNION ALL SELECT * FROM dim_carrier")
_register("e03_dedup_metrics", (), f"""
WITH raw AS (SELECT {_batch("doc_id", 2)} AS batch_id, lang, string_split(text, chr(10)) AS lines FROM documents),
     exploded AS (SELECT batch_id, lang, unnest(lines) AS line FROM raw),
     kept AS (SELECT DISTINCT * FROM exploded)
SELECT batch_id, rows_before, rows_after_explode, rows_after_explode - final_rows AS duplicates_removed, final_rows
FROM (SELECT batch_id, count(*) AS rows_before FROM raw GROUP BY 1)
JOIN (SELECT batch_id, count(*) AS rows_after_explode FROM exploded GROUP BY 1) USING (batch_id)
JOIN (SELECT batch_id, count(*) AS final_rows FROM kept GROUP BY 1) USING (batch_id)""")

# F


def _first_items(batch: str | None, n: int, cols: str = _ITEM_COLS) -> str:
    return f"""
SELECT {cols} FROM (
    SELECT *, {_batch("product_id", n)} AS batch_id,
           row_number() OVER (PARTITION BY order_item_id ORDER BY {batch or '1'}, {_ITEM_ORDER}) AS rn
    FROM items) WHERE rn = 1"""


_register("f01_merge_first_wins", "items", _first_items("product_id % 2", 2))
_register("f02_merge_latest_wins", "shop_orders", """
SELECT customer_id, order_id, order_status, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, order_id DESC) AS rn
    FROM shop_orders) WHERE rn = 1""")
ORACLE["f02_versioned_loads"] = ORACLE["f02_merge_latest_wins"]
_register("f03_stage_and_load", "items", _first_items("product_id % 4", 4, "batch_id, " + _ITEM_COLS))
_register("f04_skip_loaded_batches", "items", f"""
SELECT batch_id, count(*) AS rows, CAST(1 AS BIGINT) AS runs
FROM ({_first_items("product_id % 4", 4, "batch_id")}) GROUP BY batch_id""")
_register("f05_load_order", "items", _first_items("product_id % 12", 12, "batch_id, " + _ITEM_COLS))
_register("f06_null_key_rows", "scans", """
SELECT shipment_id, min(event_no) AS event_no, event_type, location, metadata FROM scans
WHERE event_time = 'invalid-date' GROUP BY shipment_id, event_type, location, notes, metadata""")
_register("f07_fail_batch", "items", f"""
SELECT DISTINCT {_batch("product_id")} AS batch_id, 'failed' AS status, true AS has_error,
       CAST(0 AS BIGINT) AS rows_visible FROM items""")

# G

_MARKS = f"""
    SELECT 'extract:orders' AS pipeline_name, order_status AS source_name, 'updated_at' AS watermark_column,
           CAST(max(updated_at) AS VARCHAR) AS watermark_value, order_id % 4 + 1 AS last_sequence
    FROM shop_orders GROUP BY order_status, order_id % 4"""
_register("g01_read_hwm", "shop_orders", f"""
SELECT mark, last_sequence,
       (SELECT count(*) FROM shop_orders WHERE order_status = 'delivered'
        AND updated_at > CAST(mark AS TIMESTAMP)) AS beyond
FROM (SELECT watermark_value AS mark, last_sequence FROM ({_MARKS}) WHERE source_name = 'delivered'
      ORDER BY watermark_value DESC, last_sequence DESC LIMIT 1)""")
_register("g02_write_hwm", "shop_orders", f"SELECT * FROM ({_MARKS})")
_register("g03_advance_hwm", "shop_orders", """
SELECT CAST(greatest(max(updated_at), TIMESTAMP '1999-01-01') AS VARCHAR) AS watermark_value FROM shop_orders""")
_register("g04_advance_id_mark", "reviews",
          f"SELECT greatest(max(_id), '{ID_MARK}') AS watermark_value FROM reviews")
_register("g05_start_run", "items", f"""
SELECT DISTINCT 'order_items' AS pipeline_name, 'postgres' AS source_name, 'started' AS status,
       {_batch("product_id")} AS watermark_value FROM items""")
_LOADED = f"""
    SELECT batch_id AS watermark_value, count(*) AS records_extracted,
           count(*) FILTER (WHERE rn = 1) AS records_loaded,
           count(*) FILTER (WHERE rn > 1) AS records_ignored
    FROM (SELECT {_batch("product_id")} AS batch_id,
                 row_number() OVER (PARTITION BY order_item_id ORDER BY product_id % 4, {_ITEM_ORDER}) AS rn
          FROM items) GROUP BY batch_id"""
_register("g06_mark_success", "items", f"SELECT * FROM ({_LOADED})")
_register("g07_mark_fail", "items", """
SELECT s AS status, count(DISTINCT product_id % 4) AS runs
FROM items, (VALUES ('started'), ('failed')) AS v(s) GROUP BY s""")
_register("g08_run_state", "items", f"""
SELECT watermark_value, 'success' AS status, records_extracted, records_loaded FROM ({_LOADED})""")
_register("g09_upsert_watermark", "items", f"""
SELECT 'order_items' AS pipeline_name, 'postgres' AS source_name, 'batch_id' AS watermark_column,
       max({_batch("product_id")}) AS watermark_value FROM items""")
_register("g09_latest_marks", "shop_orders", f"""
SELECT pipeline_name, source_name, watermark_column, watermark_value, last_sequence FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline_name, source_name
        ORDER BY watermark_value DESC, last_sequence DESC) AS rn FROM ({_MARKS})) WHERE rn = 1""")
_register("g10_recent_runs", "items", f"""
SELECT 'success' AS status, records_extracted FROM ({_LOADED}) ORDER BY watermark_value DESC LIMIT 2""")
_register("g11_extract_metrics", (), """
SELECT 'customer' AS table_name, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM customer
UNION ALL SELECT 'part', count(*), 1 FROM part
UNION ALL SELECT 'orders', count(*), 1 FROM orders
UNION ALL SELECT 'lineitem', count(*), 1 FROM lineitem
UNION ALL SELECT NULL, (SELECT count(*) FROM customer) + (SELECT count(*) FROM part)
    + (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem), 4""")


def _null_counts(table: str, cols: list[str], prefix: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT {prefix}'{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls FROM {table}"
        for c in cols
    )


_register("g12_null_metrics", "reviews",
          _null_counts("reviews", ["review_text", "title", "verified_purchase"]))

# H


def _check(e: Expectation, table: str, columns: set[str] | None = None, extra: str = "") -> str:
    """One expectation as SQL, written independently of the Spark expression."""
    c = f'"{e.column}"'
    n = "count(*)"
    missing = f"count(*) FILTER (WHERE {c} IS NULL)"
    null = "CAST(NULL AS BIGINT)"
    bad = None
    if e.kind == "row_count_between":
        tests = [f"{n} >= {e.low}" if e.low is not None else "true",
                 f"{n} <= {e.high}" if e.high is not None else "true"]
        stats = (" AND ".join(tests), null, null, "CAST(NULL AS DOUBLE)", "NULL", "NULL")
    elif e.kind == "column_to_exist":
        found = "true" if e.column in (columns or ()) else "false"
        stats = (found, null, null, "CAST(NULL AS DOUBLE)", "NULL", "NULL")
    else:
        if e.kind == "not_null":
            bad = f"{c} IS NULL"
        elif e.kind == "between":
            bad = f"({c} < {e.low if e.low is not None else c} OR {c} > {e.high if e.high is not None else c})"
        elif e.kind == "length_between":
            bad = f"NOT (length({c}) BETWEEN {e.low} AND {e.high})"
        elif e.kind == "in_set":
            values = ", ".join(str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in e.values)
            bad = f"{c} NOT IN ({values})"
        elif e.kind == "unique":
            bad = f"{c} IN (SELECT {c} FROM {table} GROUP BY 1 HAVING count(*) > 1)"
        u = f"count(*) FILTER (WHERE {bad})"
        judged = n if e.kind == "not_null" else f"count({c})"
        stats = (
            f"{u} = 0", missing, u, f"CASE WHEN {judged} <> 0 THEN {u} * 100.0::DOUBLE / {judged} END",
            f"CAST(min({c}) FILTER (WHERE {bad}) AS VARCHAR)",
            f"CAST(max({c}) FILTER (WHERE {bad}) AS VARCHAR)",
        )
    column = f"'{e.column}'" if e.column else "NULL"
    return f"""SELECT {extra}'{e.kind}' AS expectation, {column} AS "column", {stats[0]} AS success,
    {n} AS element_count, {stats[1]} AS missing_count, {stats[2]} AS unexpected_count,
    {stats[3]} AS unexpected_pct, {stats[4]} AS lowest_unexpected, {stats[5]} AS highest_unexpected,
    '{e.severity}' AS severity FROM {table}"""


def _checks(table: str, *es: Expectation, columns: set[str] | None = None) -> str:
    return "\nUNION ALL ".join(_check(e, table, columns) for e in es)


_E = Expectation
_register("h01_expect_row_count_between", (), _checks(
    "lineitem", _E("row_count_between", None, 1), _E("row_count_between", None, 0, 10)))
_register("h02_expect_column_to_exist", "session_docs", _checks(
    "session_docs", _E("column_to_exist", "device_os"), _E("column_to_exist", "device"),
    columns={"device_os"}))
_register("h03_expect_not_null", "reviews", _checks(
    "reviews", *[_E("not_null", c) for c in ("_id", "title", "review_text", "verified_purchase")]))
_register("h04_expect_between", "items", _checks(
    "items", _E("between", "quantity", 5, 45), _E("between", "quantity", 1)))
_register("h05_expect_in_set", "shop_orders", _checks(
    "shop_orders",
    _E("in_set", "order_status", values=("pending", "confirmed", "processing", "shipped", "delivered",
                                         "cancelled", "returned")),
    _E("in_set", "order_status", values=("pending", "delivered"))))
_register("h06_expect_unique", "payments", _checks(
    "payments", _E("unique", "payment_id"), _E("unique", "transaction_reference")))
_register("h06_expect_unique_text", (), """
SELECT 'unique' AS expectation, u = 0 AS success, n AS element_count, m AS missing_count, u AS unexpected_count
FROM (SELECT CAST(sum(c) AS BIGINT) AS n, CAST(coalesce(sum(c) FILTER (WHERE text IS NULL), 0) AS BIGINT) AS m,
             CAST(coalesce(sum(c) FILTER (WHERE c > 1 AND text IS NOT NULL), 0) AS BIGINT) AS u
      FROM (SELECT text, count(*) AS c FROM documents GROUP BY text))""")
_CTES["filled"] = (("reviews",), """
    SELECT * REPLACE (coalesce(title, '') AS title) FROM reviews""")
_register("h07_expect_length_between", "filled", _checks(
    "filled", _E("length_between", "title", 1, 255), _E("length_between", "review_id", 13, 13)))

_TABLE_OF = {"customer_sessions": "session_rows", "product_reviews": "clean_reviews"}
_SUITE_ROWS = "\nUNION ALL ".join(
    _check(e, _TABLE_OF[name], {"device_os"},
           extra=f"'{name}' AS suite, CAST({i} AS BIGINT) AS position, ")
    for name, suite in SUITES.items() for i, e in enumerate(suite)
)
_register("h08_run_suite", ("session_rows", "clean_reviews"), _SUITE_ROWS)
_register("h09_suite_summary", ("session_rows", "clean_reviews"), f"""
SELECT bool_and(success) AS success, count(*) AS evaluated,
       count(*) FILTER (WHERE success) AS successful,
       coalesce(string_agg(CASE WHEN NOT success THEN concat_ws(':', expectation, "column") END, ','
                ORDER BY concat_ws(':', expectation, "column")), '') AS failed
FROM ({_SUITE_ROWS})""")

# Checks restated here, not taken from the package. Reviews and sessions as the warehouse keeps them.
_CTES["kept_items"] = (("items",), f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY {_ITEM_ORDER}) AS rn FROM items)
    WHERE rn = 1""")
_CTES["kept_sessions"] = (("session_rows",), """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _id, event_type ORDER BY event_no) AS rn FROM session_rows
                   WHERE event_type IS NOT NULL) WHERE rn = 1""")
_INTEGRITY = [
    *[("products", "between", c, f"{c} < 0", "products") for c in ("unit_price", "cost_price", "stock_quantity")],
    *[("customers", "not_null", c, f"{c} IS NULL", "customers") for c in (
        "customer_id", "first_name", "last_name", "email", "city", "state", "country", "created_at", "updated_at")],
    *[("customers", "length_between", c, f"length({c}) > {n}", "customers") for c, n in (
        ("first_name", 80), ("last_name", 80), ("email", 160), ("phone", 40), ("city", 80), ("state", 80), ("country", 80))],
    *[("products", "not_null", c, f"{c} IS NULL", "products") for c in ("product_name", "category", "cost_price")],
    *[("products", "length_between", c, f"length({c}) > {n}", "products") for c, n in (
        ("product_name", 160), ("category", 80), ("brand", 80))],
    ("orders", "not_null", "order_status", "order_status IS NULL", "shop_orders"),
    ("orders", "in_set", "order_status", "order_status NOT IN ('pending', 'confirmed', 'processing', 'shipped', "
     "'delivered', 'cancelled', 'returned')", "shop_orders"),
    ("orders", "length_between", "currency", "length(currency) > 3", "shop_orders"),
    ("orders", "amounts", "total_amount", "total_amount <> subtotal + shipping_fee - discount_amount", "shop_orders"),
    ("order_items", "amounts", "line_total", "line_total <> quantity * unit_price - discount_amount", "kept_items"),
    ("order_items", "between", "quantity", "quantity < 1", "kept_items"),
    ("payments", "in_set", "payment_status", "payment_status NOT IN ('pending', 'successful', 'failed', 'refunded')", "payments"),
    ("payments", "amounts", "amount", "amount <> total_amount", "payments"),
    ("product_reviews", "between", "rating", "rating < 1 OR rating > 5", "clean_reviews"),
    ("product_reviews", "unreadable", "created_at", f"created_at IS NOT NULL AND ({_ts('created_at')}) IS NULL", "reviews"),
    *[("customer_sessions", "unreadable", c, f"{c} IS NOT NULL AND ({_ts(c)}) IS NULL", "session_docs")
      for c in ("started_at", "ended_at")],
    ("customer_sessions", "unreadable", "event_time", f"event_time IS NOT NULL AND ({_ts('event_time')}) IS NULL", "session_text"),
    ("shipments", "unreadable", "event_time", f"event_time IS NOT NULL AND ({_ts('event_time')}) IS NULL", "scans"),
    *[(t, "unique_key", c, f"{c} IN (SELECT {c} FROM {table} GROUP BY 1 HAVING count(*) > 1)", table) for t, c, table in (
        ("customers", "customer_id", "customers"), ("customers", "email", "customers"), ("products", "product_id", "products"),
        ("orders", "order_id", "shop_orders"), ("order_items", "order_item_id", "kept_items"),
        ("payments", "payment_id", "payments"), ("payments", "transaction_reference", "payments"))],
    *[(t, "foreign_key", c, f"{c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {parent})", table) for t, c, table, parent in (
        ("orders", "customer_id", "shop_orders", "customers"), ("order_items", "order_id", "kept_items", "shop_orders"),
        ("order_items", "product_id", "kept_items", "products"), ("payments", "order_id", "payments", "shop_orders"),
        ("customer_sessions", "product_id", "kept_sessions", "products"),
        ("product_reviews", "product_id", "clean_reviews", "products"))],
]
_register("h10_integrity_report", ("customers", "products", "shop_orders", "kept_items", "payments", "kept_sessions", "session_docs",
                                   "session_text", "scans", "reviews", "clean_reviews"), "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{check}' AS "check", '{column}' AS "column", count(*) AS rows
    FROM {table} WHERE {bad} HAVING count(*) > 0""" for t, check, column, bad, table in _INTEGRITY))

_SOURCE = {
    "customers": "customers", "products": "products", "orders": "shop_orders", "order_items": "items",
    "payments": "payments", "customer_sessions": "session_typed", "product_reviews": "reviews",
}
_register("h10_check_constraints", ("products", "shop_orders", "items", "payments"), "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, "column", success, element_count, unexpected_count
    FROM ({_check(e, _SOURCE[t])})"""
    for t, es in CONSTRAINTS.items() for e in es))
_register("h11_check_foreign_keys", tuple(_SOURCE.values()), "\nUNION ALL ".join(
    f"""SELECT '{child}' AS child, '{col}' AS "column", '{parent}' AS parent, {col} AS key, count(*) AS rows
    FROM {_SOURCE[child]} WHERE {col} IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM {_SOURCE[parent]} p WHERE p.{pcol} = {_SOURCE[child]}.{col}) GROUP BY {col}"""
    for child, col, parent, pcol in FOREIGN_KEYS))
_register("h11_orphan_rows", ("reviews", "products"), """
SELECT review_id, product_id, rating FROM reviews
WHERE product_id NOT IN (SELECT product_id FROM products)""")
_register("h12_check_unique_keys", ("customers", "products", "shop_orders", "items", "payments"),
          "\nUNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{",".join(key)}' AS key_columns,
    concat_ws(',', {", ".join(_v(k) for k in key)}) AS key, count(*) AS rows
    FROM {_SOURCE[t]} GROUP BY {", ".join(key)} HAVING count(*) > 1"""
    for t, key in UNIQUE_KEYS))
_register("h13_payment_gaps", "payments", f"""
SELECT payment_id, order_id, {_d("amount", "total_amount")}, CAST(amount - total_amount AS DOUBLE) AS gap
FROM payments WHERE amount <> total_amount""")
_register("h13_order_total_gaps", "shop_orders", f"""
SELECT order_id, {_d("total_amount")},
       CAST(total_amount - (subtotal + shipping_fee - discount_amount) AS DOUBLE) AS gap
FROM shop_orders WHERE total_amount <> subtotal + shipping_fee - discount_amount""")
_register("h13_line_total_gaps", "items", f"""
SELECT order_item_id, {_d("line_total")},
       CAST(line_total - (quantity * unit_price - discount_amount) AS DOUBLE) AS gap
FROM items WHERE line_total <> quantity * unit_price - discount_amount""")
_CTES["typed_reviews"] = (("reviews",), f"""
    SELECT review_id, rating, {_strip("coalesce(title, '')")} AS title FROM reviews""")
_register("h14_quarantine_clean", "typed_reviews", """
SELECT review_id, rating, title FROM typed_reviews
WHERE rating BETWEEN 1 AND 5 AND length(title) BETWEEN 1 AND 255""")
_register("h14_quarantine_rejected", "typed_reviews", """
SELECT review_id, concat_ws(',', CASE WHEN NOT rating BETWEEN 1 AND 5 THEN 'between:rating' END,
       CASE WHEN NOT length(title) BETWEEN 1 AND 255 THEN 'length_between:title' END) AS reasons
FROM typed_reviews WHERE NOT (rating BETWEEN 1 AND 5 AND length(title) BETWEEN 1 AND 255)""")
_register("h14_cast_rejects", "reviews", f"""
SELECT DISTINCT review_id, 'unreadable:created_at=' || created_at AS reason FROM reviews
WHERE ({_ts("created_at")}) IS NULL AND created_at IS NOT NULL
UNION ALL SELECT DISTINCT review_id, 'not_integer:helpful_votes=' || {_v("helpful_votes")} || '.5' FROM reviews
WHERE helpful_votes % 19 = 3""")
_register("h15_timestamp_rejects", ("session_text", "reviews"), "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS rows FROM {t}
    WHERE {c} IS NOT NULL AND ({_ts(c)}) IS NULL GROUP BY {c}"""
    for t, c in (("session_text", "started_at"), ("session_text", "ended_at"),
                 ("session_text", "event_time"), ("reviews", "created_at"))))
_register("h16_rating_range", "reviews",
          "SELECT review_id, rating FROM reviews WHERE rating < 1 OR rating > 5")
_register("h17_normalize_city_case", "customers", """
SELECT city, count(*) AS rows, upper(substr(city, 1, 1)) || lower(substr(city, 2)) AS normalized
FROM customers WHERE city <> upper(substr(city, 1, 1)) || lower(substr(city, 2)) GROUP BY city""")
_PROFILE = {
    "customers": ("customers", "customer_id first_name last_name email phone city state country "
                  "created_at updated_at"),
    "products": ("products", "product_id product_name category brand unit_price cost_price "
                 "stock_quantity created_at updated_at"),
    "payments": ("payments", "payment_id order_id payment_method payment_status amount "
                 "transaction_reference paid_at updated_at"),
    "customer_sessions": ("session_docs", "_id session_id customer_id started_at ended_at browser "
                          "location_city location_state location_country device_type device_os"),
    "product_reviews": ("reviews", "_id review_id product_id customer_id rating title review_text "
                        "verified_purchase created_at helpful_votes"),
}
_register("h18_null_profile", ("customers", "products", "payments", "session_docs", "reviews"),
          "\nUNION ALL ".join(
    [_null_counts(t, cols.split(), f"'{name}' AS \"table\", ") for name, (t, cols) in _PROFILE.items()]
    + ["SELECT 'customer_sessions', 'events', CAST(0 AS BIGINT) FROM (SELECT count(*) FROM session_docs)"]))
_register("h19_event_time_ties", "session_typed", """
SELECT session_id, date_trunc('hour', event_time) AS event_time, count(*) AS events FROM session_typed
WHERE event_time IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")

# I

_register("i01_row_source", (), "SELECT n FROM generate_series(1, (SELECT count(*) FROM orders)) AS t(n)")
_register("i02_cte_orders", "shop_orders", f"""
SELECT order_id, customer_id, order_status, order_date, currency,
       {_d("subtotal", "shipping_fee", "discount_amount", "total_amount")}, updated_at FROM shop_orders""")
_register("i03_numbered_lines", (), """
SELECT o_orderkey * 2 + n AS order_item_id, o_orderkey AS order_id, CAST(n AS BIGINT) AS item_no,
       o_orderkey % 5 + n AS quantity
FROM orders CROSS JOIN generate_series(1, 2) AS t(n)""")
_register("i04_payment_join", ("payments", "items"), f"""
SELECT payment_id, order_item_id, product_id, {_d("amount", "line_total")}
FROM payments JOIN items USING (order_id)""")
_register("i05_picked_by_position", "payments",
          "SELECT payment_method, count(*) AS rows FROM payments GROUP BY payment_method")
_register("i06_case_products", "products", f"""
SELECT product_id, product_name, category, brand, {_d("unit_price", "cost_price")}, stock_quantity,
       created_at, updated_at FROM products""")
_register("i07_money_items", "items", f"SELECT {_ITEM_COLS} FROM items")
_register("i08_text_customers", "customers", "SELECT * FROM customers")
_register("i09_interval_orders", "payments", "SELECT payment_id, paid_at, updated_at FROM payments")
_register("i10_session_documents", "session_docs", "SELECT * FROM session_docs")

# J

_register("j01_dim_customer", "dim_customer", "SELECT * FROM dim_customer")
_register("j02_dim_product", "dim_product", f"""
SELECT product_id, product_name, category, brand, {_d("unit_price", "cost_price")}, stock_quantity
FROM dim_product""")
_register("j03_dim_date", (
    "shop_orders", "payments", "shipment_facts", "session_typed", "scans", "clean_reviews"), f"""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key, CAST(d AS TIMESTAMP) AS date,
       year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
       isodow(d) AS iso_weekday, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(date_trunc('day', min(x)), date_trunc('day', max(x)), INTERVAL 1 DAY)) AS d
      FROM (SELECT order_date AS x FROM shop_orders UNION ALL SELECT paid_at FROM payments
            UNION ALL SELECT shipped_at FROM shipment_facts UNION ALL SELECT delivered_at FROM shipment_facts
            UNION ALL SELECT event_time FROM session_typed UNION ALL SELECT {_ts("event_time")} FROM scans
            UNION ALL SELECT created_at FROM clean_reviews))""")
_register("j04_dim_carrier", "dim_carrier", "SELECT * FROM dim_carrier")
_register("j05_fact_orders", "shop_orders", f"""
SELECT order_id, customer_id, order_status, order_date, {_key("order_date")} AS order_date_key, currency,
       {_d("subtotal", "shipping_fee", "discount_amount", "total_amount")}, is_cancelled FROM shop_orders""")
_register("j06_fact_order_items", ("items", "shop_orders", "products"), f"""
SELECT order_item_id, i.order_id, i.product_id, customer_id, {_key("order_date")} AS order_date_key,
       order_status, category, quantity, CAST(i.unit_price AS DOUBLE) AS unit_price,
       CAST(i.discount_amount AS DOUBLE) AS discount_amount, CAST(line_total AS DOUBLE) AS line_total,
       CAST(line_total - quantity * cost_price AS DOUBLE) AS margin
FROM items i LEFT JOIN shop_orders o ON i.order_id = o.order_id
LEFT JOIN products p ON i.product_id = p.product_id""")
_register("j07_fact_payments", "payments", f"""
SELECT payment_id, order_id, customer_id, payment_method, payment_status, {_d("amount")},
       CAST(amount - total_amount AS DOUBLE) AS amount_gap, payment_status = 'successful' AS is_successful,
       transaction_reference, paid_at, {_key("paid_at")} AS paid_date_key FROM payments""")
_register("j08_fact_customer_events", "session_rows", f"""
SELECT session_id, customer_id, event_type, event_time, {_key("event_time")} AS event_date_key, product_id,
       search_term, quantity, page_url, browser, device_type, device_os
FROM (SELECT *, row_number() OVER (PARTITION BY session_id, event_type, event_time, product_id
          ORDER BY event_no) AS rn FROM session_rows) WHERE rn = 1""")
_register("j09_fact_shipments", "shipment_facts", """
SELECT *, CAST(epoch(delivered_at) - epoch(shipped_at) AS DOUBLE) / 3600.0::DOUBLE AS delivery_hours,
       delivered_at > estimated_delivery_at AS is_late FROM shipment_facts""")
_register("j10_fact_shipment_events", ("scans", "heads"), f"""
SELECT DISTINCT shipment_id, order_id, carrier_id, event_type, event_time,
       {_key("event_time")} AS event_date_key, location, notes, metadata
FROM (SELECT s.shipment_id, s.order_id, h.carrier_id, s.event_type, {_ts("s.event_time")} AS event_time,
             s.location, s.notes, s.metadata FROM scans s JOIN heads h ON s.order_id = h.order_id)""")
ORACLE |= {
    "j08_star_customer_events": ORACLE["j08_fact_customer_events"],
    "j09_star_shipments": ORACLE["j09_fact_shipments"],
    "j10_star_shipment_events": ORACLE["j10_fact_shipment_events"],
}
_register("j11_fact_product_reviews", "clean_reviews", f"""
SELECT review_id, product_id, customer_id, rating, title, review_text, verified_purchase, helpful_votes,
       created_at, {_key("created_at")} AS created_date_key FROM clean_reviews""")

# K


def _sales(period: str, name: str) -> str:
    return f"""
SELECT CAST(date_trunc('{period}', order_date) AS TIMESTAMP) AS {name}, count(*) AS orders,
       CAST(sum(total_amount) AS DOUBLE) AS gross_sales,
       CAST(coalesce(sum(total_amount) FILTER (WHERE NOT is_cancelled), 0) AS DOUBLE) AS net_sales
FROM shop_orders GROUP BY 1"""


_register("k01_daily_sales", "shop_orders", _sales("day", "sales_date"))
_register("k01_monthly_sales", "shop_orders", _sales("month", "sales_month"))
_register("k02_revenue_by_category", ("items", "products"), """
SELECT category, CAST(sum(line_total) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS units
FROM items JOIN products USING (product_id) GROUP BY category""")
_BY_PRODUCT = """
SELECT product_id, product_name, category, CAST(sum(line_total) AS DOUBLE) AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units
FROM items JOIN products USING (product_id) GROUP BY product_id, product_name, category"""
_register("k02_revenue_by_product", ("items", "products"), _BY_PRODUCT)
_register("k02_top_products", ("items", "products"),
          _BY_PRODUCT + " ORDER BY sum(line_total) DESC, product_id LIMIT 10")
_register("k03_average_order_value", "shop_orders", f"""
SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS sales_month, count(*) AS orders,
       {_rate("sum(total_amount)", "count(*)")} AS average_order_value FROM shop_orders GROUP BY 1""")
_register("k04_payment_success_rate", "payments", f"""
SELECT payment_method, count(*) AS payments,
       count(*) FILTER (WHERE payment_status = 'successful') AS successful,
       {_rate("count(*) FILTER (WHERE payment_status = 'successful')", "count(*)")} AS success_rate
FROM payments GROUP BY payment_method""")
_register("k05_purchase_frequency", (), """
SELECT n AS orders, count(*) AS customers
FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey
      GROUP BY c_custkey) GROUP BY n""")
_register("k06_view_to_purchase", "shop_events", f"""
SELECT product_id, count(*) AS viewers, count(*) FILTER (WHERE bought >= viewed) AS buyers,
       {_rate("count(*) FILTER (WHERE bought >= viewed)", "count(*)")} AS conversion_rate
FROM (SELECT product_id, customer_id, min(event_time) FILTER (WHERE event_type = 'product_view') AS viewed,
             max(event_time) FILTER (WHERE event_type = 'purchase_completed') AS bought
      FROM shop_events GROUP BY product_id, customer_id)
WHERE viewed IS NOT NULL AND product_id IS NOT NULL GROUP BY product_id""")
_ABANDONED = f"""
SELECT count(*) AS sessions, count(*) FILTER (WHERE has_cart) AS cart_sessions,
       count(*) FILTER (WHERE has_cart AND NOT has_purchase) AS abandoned_sessions,
       {_rate("count(*) FILTER (WHERE has_cart AND NOT has_purchase)", "count(*) FILTER (WHERE has_cart)")}
           AS abandonment_rate FROM """
_register("k07_cart_abandonment", "shop_events", _ABANDONED + """
(SELECT session_id, bool_or(event_type = 'add_to_cart') AS has_cart,
        bool_or(event_type = 'purchase_completed') AS has_purchase FROM shop_events GROUP BY session_id)""")
# The classic form: a new session wherever the pause to the previous event is 30 minutes or more.
_GAPS = """
(SELECT customer_id, session_no, min(event_time) AS started_at, max(event_time) AS ended_at,
        count(*) AS events, bool_or(event_type = 'add_to_cart') AS has_cart,
        bool_or(event_type = 'purchase_completed') AS has_purchase
 FROM (SELECT *, CAST(sum(fresh) OVER (PARTITION BY customer_id ORDER BY event_time) AS BIGINT) AS session_no
       FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY customer_id ORDER BY event_time)
                            < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM shop_events))
 GROUP BY customer_id, session_no)"""
_register("k07_cart_abandonment_by_gap", "shop_events", _ABANDONED + _GAPS)
_register("k07_sessionize", "shop_events", f"SELECT * FROM {_GAPS}")
_register("k08_average_review_score", ("reviews", "products"), f"""
SELECT category, count(*) AS reviews, {_rate("sum(rating)", "count(*)")} AS average_score
FROM reviews JOIN products USING (product_id) WHERE rating BETWEEN 1 AND 5 GROUP BY category""")
_register("k08_label_score_by_source", (), """
SELECT source, lang, count(*) AS reviews, avg(quality) AS average_score
FROM documents JOIN labels USING (doc_id) GROUP BY source, lang""")
_register("k09_average_delivery_time", ("shipment_facts", "shop_orders"), f"""
SELECT CAST(date_trunc('month', order_date) AS TIMESTAMP) AS sales_month, count(*) AS delivered,
       {_rate("sum(date_diff('day', CAST(order_date AS DATE), CAST(delivered_at AS DATE)))", "count(*)")}
           AS average_days
FROM shipment_facts JOIN shop_orders USING (order_id) WHERE delivered_at IS NOT NULL GROUP BY 1""")
_register("k10_late_delivery_rate", ("shipment_facts", "carriers"), f"""
SELECT service_level, count(*) AS delivered,
       count(*) FILTER (WHERE delivered_at > estimated_delivery_at) AS late,
       {_rate("count(*) FILTER (WHERE delivered_at > estimated_delivery_at)", "count(*)")} AS late_rate
FROM shipment_facts JOIN carriers USING (carrier_id) WHERE delivered_at IS NOT NULL GROUP BY service_level""")
_register("k11_orders_without_shipments", "shop_orders", f"""
SELECT order_id, customer_id, order_status, {_d("total_amount")} FROM shop_orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = order_id)""")
_register("k12_delivered_but_cancelled", "shop_orders", f"""
SELECT order_id, customer_id, {_d("total_amount")} FROM shop_orders
WHERE is_cancelled AND order_id IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')""")
_register("k13_repeat_customers", "shop_orders", """
SELECT customer_id, count(*) AS orders, min(order_date) FILTER (WHERE nth = 1) AS first_order,
       min(order_date) FILTER (WHERE nth = 2) AS second_order,
       date_diff('day', min(order_date) FILTER (WHERE nth = 1), min(order_date) FILTER (WHERE nth = 2))
           AS days_to_second
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS nth
      FROM shop_orders) GROUP BY customer_id HAVING count(*) >= 2""")
_register("k14_sales_by_city_state", ("shop_orders", "dim_customer"), """
SELECT state, city, CAST(grouping(state, city) AS BIGINT) AS level, count(*) AS orders,
       CAST(sum(total_amount) AS DOUBLE) AS sales
FROM shop_orders JOIN dim_customer USING (customer_id) GROUP BY ROLLUP (state, city)""")

for _view, _query in VIEW_OF.items():
    ORACLE[f"k15_{_view}"] = ORACLE[_query]

# L

_register("l01_stream_processed", "clean_reviews", f"""
SELECT {_batch("customer_id", 2)} AS batch_id, review_id, rating, created_at, review_text FROM clean_reviews""")
_register("l02_stream_merge", "items", _first_items("product_id % 2", 2))
ORACLE["l02_late_files"] = ORACLE["l02_stream_merge"]
_register("l03_rerun_safety", ("items", "session_rows", "scans"), f"""
SELECT t AS table_name, n AS rows, CAST(1 AS BIGINT) AS batches FROM (
    SELECT 'customers' AS t, count(*) AS n FROM customer
    UNION ALL SELECT 'products', count(*) FROM part
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'order_items', count(DISTINCT order_item_id) FROM items
    UNION ALL SELECT 'payments', count(*) FROM orders
    UNION ALL SELECT 'customer_sessions', count(*) FROM (SELECT DISTINCT _id, event_type FROM session_rows WHERE event_type IS NOT NULL)
    UNION ALL SELECT 'product_reviews', count(*) FROM documents
    UNION ALL SELECT 'carriers', count(*) FROM supplier
    UNION ALL SELECT 'shipments', count(*) FROM (
        SELECT DISTINCT shipment_id, {_ts("event_time")} AS at FROM scans WHERE ({_ts("event_time")}) IS NOT NULL))""")
