"""Text expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space, plus the four
# ASCII separators, in code-point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Trim all Unicode white space; ``F.trim`` alone removes spaces only."""
    return F.btrim(col, F.lit(WHITESPACE))


def normalize_case(col: Column) -> Column:
    """``lagos`` and ``LAGOS`` both become ``Lagos``."""
    return F.initcap(col)


def batch_id_from_name(file_name: Column, table: str) -> Column:
    """``orders_20260705_101500_123_2.parquet`` -> ``20260705_101500_123_2``."""
    return F.regexp_replace(
        F.regexp_replace(file_name, r"\.parquet$", ""), f"^{table}_", ""
    )


def batch_order(batch_id: Column) -> tuple[Column, Column]:
    """Sort keys of a batch id ``<time>_<n>``: the time as text, ``n`` as a number.

    As text ``_10`` would sort before ``_2``. An id without a numeric tail sorts by itself.
    """
    tail = F.regexp_extract(batch_id, r"_(\d{1,18})$", 1)
    head = F.regexp_replace(batch_id, r"_\d{1,18}$", "")
    return head, F.when(tail != "", tail.cast("long")).otherwise(F.lit(0))
