"""Integer width conversions without ANSI overflow errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW32_MASK = 4294967295  # 2^32 - 1


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def narrow_to_int(col: Column | str) -> Column:
    """Java ``(int) longValue``: keep the low 32 bits, two's complement."""
    return F.shiftright(F.shiftleft(_c(col).cast("bigint"), 32), 32).cast("int")


def unsigned_widen(col: Column | str) -> Column:
    """Java ``Integer.toUnsignedLong`` / ``x & 0xFFFFFFFFL``."""
    return _c(col).cast("bigint").bitwiseAND(F.lit(LOW32_MASK))
