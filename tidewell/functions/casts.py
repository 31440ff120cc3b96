"""Casts that say what happens to a bad value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted text forms, an ISO date with optional time and offset.
_DATE = r"^\d{4}-\d{2}-\d{2}"
_TIME = r"[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?"
ISO_TIMESTAMP = _DATE + r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|[+-]\d{2}:?\d{2}))?)?$"
_ZONE = r"(Z|[+-]\d{2}:\d{2})$"


def parse_timestamp(col: Column) -> Column:
    """ISO text to an instant; a value without an offset is UTC; anything else is null.

    ``try_cast`` alone is too lenient: it takes ``2025`` and turns ``12:00`` into today.
    The usual form is tested first, so most values cost one match and one cast. All forms share one cast: the
    JVM compiles no method as long as those that a cast for each makes of a few columns.
    """

    def utc(text: Column) -> Column:
        return F.concat(text, F.lit("Z"))

    # Rare forms: a space or no colon in the offset, no seconds in the time; then what has no offset gets one.
    full = F.regexp_replace(col, r" (Z|[+-]\d{2}:?\d{2})$", "$1")
    full = F.regexp_replace(full, r"([+-]\d{2})(\d{2})$", "$1:$2")
    full = F.regexp_replace(full, r"^(.{10}[T ]\d{2}:\d{2})($|(?=[Z+-]))", "$1:00")
    rare = F.regexp_replace(full, rf"(?s)^((?!.*{_ZONE}).*)\z", "$1Z")
    text = (
        F.when(col.rlike(_DATE + _TIME + _ZONE), col)
        .when(col.rlike(_DATE + _TIME + "$"), utc(col))
        .when(col.rlike(_DATE + "$"), utc(F.concat(col, F.lit("T00:00:00"))))
        .when(col.rlike(ISO_TIMESTAMP), rare)
    )
    return text.try_cast("timestamp")


def is_integral(col: Column, dtype: T.DataType) -> Column:
    """True where a non-null value has an exact 64-bit integer reading."""
    if isinstance(dtype, T.IntegralType):
        return F.lit(True)
    if isinstance(dtype, T.StringType):
        return col.rlike(r"^\s*[+-]?\d+(\.0*)?\s*$") & _integer_text(col).try_cast("long").isNotNull()
    return (col == F.floor(col)) & (F.abs(col) < F.lit(float(2**63)))


def _integer_text(col: Column) -> Column:
    return F.regexp_replace(F.trim(col), r"\.0*$", "")


def to_int(col: Column, dtype: T.DataType, on_bad: str = "raise", name: str = "value") -> Column:
    """Nullable 64-bit integer. A fractional or non-numeric value raises or becomes null.

    A plain cast would silently turn 2.7 into 2.
    """
    if isinstance(dtype, T.IntegralType):
        return col.cast("long")
    value = (_integer_text(col) if isinstance(dtype, T.StringType) else col).try_cast("long")
    checked = F.when(is_integral(col, dtype), value)
    if on_bad == "null":
        return checked
    message = F.concat(F.lit(f"{name} is not an integer: "), col.cast("string"))
    return F.when(col.isNull(), F.lit(None).cast("long")).otherwise(
        F.when(is_integral(col, dtype), value).otherwise(F.raise_error(message).cast("long"))
    )


def to_bool(col: Column, default: bool = False) -> Column:
    return F.coalesce(col.cast("boolean"), F.lit(default))
