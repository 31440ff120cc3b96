"""Raw to processed, one rule per dataset. Rows carry ``batch_id`` throughout."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.casts import parse_timestamp, to_int
from tidewell.operators.clean import (
    cast_with_reasons,
    dedup_full_row,
    drop_if_exists,
    fill_null,
    holds_map,
    pass_through,
    strip_strings,
    to_bool_default,
    to_int_nullable,
    to_timestamp_coerce,
)
from tidewell.operators.nested import expand_event, explode_events, flatten_struct

# Position of an event in its document; it orders merges but is not compared by the dedup.
EVENT_NO = "event_no"

# The columns each rule names and the values it fills in.
BRAND_FILL = {"brand": "Unknown"}
REVIEW_FILL = {"review_text": "", "title": ""}
SESSION_TIMES = ("started_at", "ended_at", "event_time")
SESSION_INTS = ("customer_id", "product_id", "quantity")
REVIEW_TIMES = ("created_at",)
REVIEW_INTS = ("customer_id", "product_id", "rating", "helpful_votes")
SHIPMENT_TIMES = (
    "shipped_at", "estimated_delivery_at", "delivered_at", "updated_at", "event_time",
)
SHIPMENT_INTS = ("order_id",)


# How a rule drops exact copies: as ``dedup_full_row`` does, or to the same end, then of documents before they are expanded.
Dedup = Callable[..., DataFrame]


def clean_products(raw: DataFrame) -> DataFrame:
    return fill_null(raw, BRAND_FILL)


def _typed(df: DataFrame, times: Sequence[str], ints: Sequence[str], reasons: bool) -> DataFrame:
    """A bad integer raises and an unreadable time becomes null, or both become reasons to reject the row."""
    if reasons:
        return cast_with_reasons(df, times, ints)
    return to_int_nullable(to_timestamp_coerce(df, times), ints)


def events_alike(documents: DataFrame, times: Sequence[str], ints: Sequence[str], col: str = "events") -> Column:
    """True where two events of a document have one hash once they are typed, as copies do.

    A document's rows differ only by its events, so no two rows of the others are copies. Values are typed only where
    two events agree in all those that need no typing.
    """

    def values_of(value: Column, dtype: T.StructType, typed: bool, prefix: str = "") -> list[Column]:
        values = []
        for f in dtype:
            name, field = prefix + f.name, value[f.name]
            if isinstance(f.dataType, T.StructType):
                values += values_of(field, f.dataType, typed, f"{name}_")
            elif isinstance(f.dataType, T.MapType):
                values += [F.to_json(field)] if typed else []
            elif name in times and isinstance(f.dataType, T.StringType):
                values += [parse_timestamp(field)] if typed else []
            elif name in ints:
                values += [to_int(field, f.dataType, "null")] if typed else []
            elif not holds_map(f.dataType):
                values.append(field)
        return values

    def some_equal(typed: bool) -> Column:
        event = documents.schema[col].dataType.elementType
        hashes = F.transform(col, lambda e: F.xxhash64(F.lit(0), *values_of(e, event, typed)))
        return F.size(F.array_distinct(hashes)) < F.size(col)

    return (F.size(col) > 1) & some_equal(False) & some_equal(True)


def session_documents(raw: DataFrame, reasons: bool = False) -> DataFrame:
    """Flat documents, their own columns typed once each; with ``reasons`` the rows are typed instead."""
    flat = drop_if_exists(flatten_struct(raw), "device")
    return flat if reasons else _typed(flat, SESSION_TIMES, SESSION_INTS, reasons)


def session_events(documents: DataFrame, reasons: bool = False) -> DataFrame:
    events = expand_event(explode_events(documents, position=EVENT_NO))
    return _typed(events, SESSION_TIMES, SESSION_INTS, reasons)


def exploded_sessions(raw: DataFrame, reasons: bool = False) -> DataFrame:
    """One typed row per event, before de-duplication."""
    return session_events(session_documents(raw, reasons), reasons)


def clean_sessions(raw: DataFrame, reasons: bool = False, dedup: Dedup = dedup_full_row) -> DataFrame:
    if reasons or dedup is dedup_full_row:
        return dedup(exploded_sessions(raw, reasons), keep_first=EVENT_NO)
    documents = session_documents(raw)
    alike = events_alike(documents, SESSION_TIMES, SESSION_INTS)
    return dedup(documents, keep_first=EVENT_NO, expand=session_events, alike=alike)


def typed_reviews(raw: DataFrame, reasons: bool = False) -> DataFrame:
    """Typed, filled and stripped rows, before de-duplication."""
    df = to_bool_default(_typed(raw, REVIEW_TIMES, REVIEW_INTS, reasons), ("verified_purchase",))
    return strip_strings(fill_null(df, REVIEW_FILL), ("review_text", "title"))


def clean_reviews(raw: DataFrame, reasons: bool = False, dedup: Dedup = dedup_full_row) -> DataFrame:
    return dedup(typed_reviews(raw, reasons))


def shipment_documents(raw: DataFrame, reasons: bool = False) -> DataFrame:
    """Flat documents, their own columns typed once each; with ``reasons`` the rows are typed instead."""
    flat = drop_if_exists(flatten_struct(raw), "delivery_address_extra")
    return flat if reasons else _typed(flat, SHIPMENT_TIMES, SHIPMENT_INTS, reasons)


def shipment_events(documents: DataFrame, reasons: bool = False) -> DataFrame:
    events = expand_event(explode_events(documents, position=EVENT_NO))
    return drop_if_exists(_typed(events, SHIPMENT_TIMES, SHIPMENT_INTS, reasons), "delivery_address_extra")


def exploded_shipments(raw: DataFrame, reasons: bool = False) -> DataFrame:
    return shipment_events(shipment_documents(raw, reasons), reasons)


def clean_shipments(raw: DataFrame, reasons: bool = False, dedup: Dedup = dedup_full_row) -> DataFrame:
    if reasons or dedup is dedup_full_row:
        return dedup(exploded_shipments(raw, reasons), keep_first=EVENT_NO)
    documents = shipment_documents(raw)
    alike = events_alike(documents, SHIPMENT_TIMES, SHIPMENT_INTS)
    return dedup(documents, keep_first=EVENT_NO, expand=shipment_events, alike=alike)


def clean_carriers(raw: DataFrame) -> DataFrame:
    """De-duplicated before stripping, so padded variants survive until the key merge."""
    batch = ["batch_id"] if "batch_id" in raw.columns else []
    text = [c for c in raw.columns if c not in batch]
    return strip_strings(dedup_full_row(raw), text)


RULES = {
    "products": clean_products,
    "customer_sessions": clean_sessions,
    "product_reviews": clean_reviews,
    "shipments": clean_shipments,
    "carriers": clean_carriers,
}


# The rules that cast, and so can say why a row should be rejected.
CASTING = ("customer_sessions", "product_reviews", "shipments")


def process(table: str, raw: DataFrame, reasons: bool = False, dedup: Dedup = dedup_full_row) -> DataFrame:
    """The cleaned rows; with ``reasons`` bad values are told in ``reject_reasons`` instead of raising."""
    if table in CASTING:
        return RULES[table](raw, reasons=reasons, dedup=dedup)
    return RULES.get(table, pass_through)(raw)
