"""The declared datasets: source, primary key, columns and how each is scanned."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Rows per landed file. Small files cost more than they save, so this is a
# ceiling for hot batches rather than a target.
MAX_ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Dataset:
    """``mark`` is the high-water column; ``None`` means every scan is a full one."""

    name: str
    source: str
    primary_key: tuple[str, ...]
    columns: tuple[str, ...] = ()
    mark: str | None = "updated_at"
    mark_type: str = "timestamp"


# Dataset names, keys and column lists of the source systems.
# Order matters: parents come before the tables that refer to them.
DATASETS = (
    Dataset(
        "customers", "postgres", ("customer_id",),
        ("customer_id", "first_name", "last_name", "email", "phone",
         "city", "state", "country", "created_at", "updated_at"),
    ),
    Dataset(
        "products", "postgres", ("product_id",),
        ("product_id", "product_name", "category", "brand", "unit_price",
         "cost_price", "stock_quantity", "created_at", "updated_at"),
    ),
    Dataset(
        "orders", "postgres", ("order_id",),
        ("order_id", "customer_id", "order_status", "order_date", "currency",
         "subtotal", "shipping_fee", "discount_amount", "total_amount", "updated_at"),
    ),
    Dataset(
        "order_items", "postgres", ("order_item_id",),
        ("order_item_id", "order_id", "product_id", "quantity",
         "unit_price", "discount_amount", "line_total"),
        mark=None,
    ),
    Dataset(
        "payments", "postgres", ("payment_id",),
        ("payment_id", "order_id", "payment_method", "payment_status",
         "amount", "transaction_reference", "paid_at", "updated_at"),
    ),
    Dataset("customer_sessions", "mongodb", ("_id", "event_type"), mark="_id", mark_type="string"),
    Dataset("product_reviews", "mongodb", ("_id", "product_id"), mark="_id", mark_type="string"),
    Dataset("carriers", "api", ("carrier_id",), mark=None),
    Dataset("shipments", "api", ("shipment_id", "event_time")),
)

BY_NAME = {d.name: d for d in DATASETS}

# States the source systems allow.
ORDER_STATUSES = (
    "pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "returned",
)
PAYMENT_STATUSES = ("pending", "successful", "failed", "refunded")
RUN_STATUSES = ("started", "success", "failed", "skipped")


def of_source(source: str) -> list[Dataset]:
    return [d for d in DATASETS if d.source == source]



_TEXT, _LONG, _BOOL = T.StringType(), T.LongType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return {name: _TEXT for name in names}


# Column types of the relational sources, in source order.
_MONEY, _TIME = T.DecimalType(12, 2), T.TimestampType()

CUSTOMER_SCHEMA = struct(
    customer_id=_LONG, **_texts("first_name", "last_name", "email", "phone", "city", "state", "country"),
    created_at=_TIME, updated_at=_TIME,
)

PRODUCT_SCHEMA = struct(
    product_id=_LONG, **_texts("product_name", "category", "brand"), unit_price=_MONEY, cost_price=_MONEY,
    stock_quantity=_LONG, created_at=_TIME, updated_at=_TIME,
)

ORDER_SCHEMA = struct(
    order_id=_LONG, customer_id=_LONG, order_status=_TEXT, order_date=_TIME, currency=_TEXT,
    subtotal=_MONEY, shipping_fee=_MONEY, discount_amount=_MONEY, total_amount=_MONEY, updated_at=_TIME,
)

ORDER_ITEM_SCHEMA = struct(
    order_item_id=_LONG, order_id=_LONG, product_id=_LONG, quantity=_LONG,
    unit_price=_MONEY, discount_amount=_MONEY, line_total=_MONEY,
)

PAYMENT_SCHEMA = struct(
    payment_id=_LONG, order_id=_LONG, payment_method=_TEXT, payment_status=_TEXT, amount=_MONEY,
    transaction_reference=_TEXT, paid_at=_TIME, updated_at=_TIME,
)

SESSION_SCHEMA = struct(
    _id=_TEXT, session_id=_TEXT, customer_id=_LONG, started_at=_TEXT, ended_at=_TEXT, browser=_TEXT,
    location=struct(**_texts("city", "state", "country")),
    device=struct(**_texts("type", "os")),
    events=T.ArrayType(
        struct(
            event_type=_TEXT, event_time=_TEXT, product_id=_LONG, search_term=_TEXT,
            quantity=_LONG, page_url=_TEXT,
        )
    ),
)

REVIEW_SCHEMA = struct(
    _id=_TEXT, review_id=_TEXT, product_id=_LONG, customer_id=_LONG, rating=_LONG, title=_TEXT,
    review_text=_TEXT, verified_purchase=_BOOL, created_at=_TEXT, helpful_votes=_LONG,
)

SHIPMENT_SCHEMA = struct(
    shipment_id=_TEXT, order_id=_LONG, carrier_id=_TEXT, tracking_number=_TEXT,
    shipment_status=_TEXT, shipped_at=_TEXT, estimated_delivery_at=_TEXT, delivered_at=_TEXT,
    updated_at=_TEXT,
    delivery_address=struct(**_texts("street", "city", "state", "country", "postal_code")),
    events=T.ArrayType(
        struct(
            **_texts("event_type", "event_time", "location", "notes"),
            metadata=T.MapType(_TEXT, _TEXT),
        )
    ),
)

CARRIER_SCHEMA = struct(**_texts("carrier_id", "carrier_name", "service_level", "support_phone"))

# What each source delivers. The layers' schemas follow from these (``plans.schemas``).
SOURCE_SCHEMAS = {
    "customers": CUSTOMER_SCHEMA,
    "products": PRODUCT_SCHEMA,
    "orders": ORDER_SCHEMA,
    "order_items": ORDER_ITEM_SCHEMA,
    "payments": PAYMENT_SCHEMA,
    "customer_sessions": SESSION_SCHEMA,
    "product_reviews": REVIEW_SCHEMA,
    "carriers": CARRIER_SCHEMA,
    "shipments": SHIPMENT_SCHEMA,
}
