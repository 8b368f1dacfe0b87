"""Casts that give NULL for bad input whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number, with the whitespace and control characters a cast ignores at both ends.
_EDGE = r"[\x00-\x20\x7f-\x9f]*"
_FRACTIONAL = rf"^{_EDGE}([+-]?)(\d*)\.\d*{_EDGE}$"


def int_or_null(c: Column) -> Column:
    """String to int; a fraction is cut off and anything else is NULL.

    The plain cast answers for whole numbers. Only rows it cannot read reach the
    regular expression, since ``coalesce`` stops at the first value. The sign, a zero
    and the digits before the point are kept, so that ".5" reads as 0.
    """
    whole = F.regexp_replace(c, _FRACTIONAL, "$10$2")
    return F.coalesce(c.try_cast("int"), whole.try_cast("int"))


def double_or_null(c: Column) -> Column:
    return c.try_cast("double")


def timestamp_or_null(c: Column) -> Column:
    return F.try_to_timestamp(c)


def trimmed(c: Column) -> Column:
    return F.trim(c)


def normalized(c: Column) -> Column:
    """Lower case without surrounding spaces, for categories such as country."""
    return F.trim(F.lower(c))


def below_infinity(c: Column) -> Column:
    """False for infinity and for NaN, which Spark orders above it."""
    return c < F.lit(float("inf"))


def timestamp_text(c: Column) -> Column:
    """Timestamp as text, with six fraction digits only where there is a fraction."""
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(micros.endswith(".000000"), whole).otherwise(micros)
