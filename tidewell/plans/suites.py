"""The recorded expectation suites."""

from __future__ import annotations

from tidewell.operators.quality import (
    expect_between,
    expect_column_to_exist,
    expect_in_set,
    expect_length_between,
    expect_not_null,
    expect_row_count_between,
    expect_unique,
)

# The checks recorded for each collection, in recorded order.
CUSTOMER_SESSIONS = (
    expect_row_count_between(low=1),
    expect_column_to_exist("device_os"),
    expect_not_null("session_id"),
    expect_between("quantity", low=1),
)

PRODUCT_REVIEWS = (
    expect_not_null("_id"),
    expect_unique("_id"),
    expect_not_null("customer_id"),
    expect_not_null("product_id"),
    expect_not_null("rating"),
    expect_not_null("title"),
    expect_length_between("title", low=1, high=255),
    expect_not_null("review_text"),
    expect_in_set("verified_purchase", (True, False)),
    expect_not_null("helpful_votes"),
    expect_between("helpful_votes", low=0),
    expect_row_count_between(low=1),
)

SUITES = {"customer_sessions": CUSTOMER_SESSIONS, "product_reviews": PRODUCT_REVIEWS}
