"""Number-to-text columns (F1-F3) and empty-value defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What counts as white space at the ends of a text.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clock(hour: Column) -> Column:
    """``8`` -> ``08:00``."""
    return F.concat(
        F.when(hour < 10, "0").otherwise(""), hour.cast("string"), F.lit(":00"))


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(WHITE_SPACE))


def percent(share: Column) -> Column:
    """Whole percent, halves to even."""
    return F.bround(share * 100).cast("int")


def fixed(value: Column, digits: int) -> Column:
    """Fixed decimals, rounded half-even on the binary value.

    ``format_string('%.1f')`` rounds halves up, ``format_number`` does not but
    groups thousands, so the group marks are removed.
    """
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def or_default(value: Column, default: str) -> Column:
    """NULL and empty text become the default."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))
