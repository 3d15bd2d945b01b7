"""Typed parsing of raw text: money, decimals, integers, dates.

Lenient by default: a value that does not parse becomes NULL instead of
failing the job, with ANSI mode on or off alike (traps T3, T5). ``strict``
gives the plain cast / ``to_date`` of the reference, which fails under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

# Fixed value: the characters stripped from money text before the cast.
MONEY_NOISE = "$,"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cast(col: Column, dtype, strict: bool) -> Column:
    return col.cast(dtype) if strict else col.try_cast(dtype)


def to_decimal(c, precision: int = 10, scale: int = 2, strict: bool = False) -> Column:
    """Cast to decimal(p,s); rounding is HALF_UP (C11)."""
    return _cast(_c(c), DecimalType(precision, scale), strict)


def to_int(c, strict: bool = False) -> Column:
    """Cast to a 32-bit integer."""
    return _cast(_c(c), IntegerType(), strict)


def money(c, precision: int = 10, scale: int = 2, strict: bool = False) -> Column:
    """Money text such as '$1,234.50' to decimal(p,s)."""
    cleaned = F.translate(_c(c).cast("string"), MONEY_NOISE, "")
    return _cast(cleaned, DecimalType(precision, scale), strict)


def to_date(c, fmt: str, strict: bool = False) -> Column:
    """Parse a date with a pattern after a cast to string.

    The cast makes integer-typed raw dates (20101229) parse as text; values
    such as '0' or month 13 give NULL unless ``strict``.
    """
    text = _c(c).cast("string")
    return F.to_date(text, fmt) if strict else F.try_to_date(text, fmt)
