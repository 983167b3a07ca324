"""Epoch-millisecond time helpers with an explicit zone.

Times travel as epoch ms (``bigint``). Calendar work (day strings, start of
day) happens on ``timestamp_ntz`` wall-clock values in a named zone, so the
result does not depend on the session zone. All are JVM-side expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

# Output formats used by the jobs.
DAY_FORMAT = "yyyyMMdd"
SECOND_FORMAT = "yyyyMMddHHmmss"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ms_to_utc_ntz(ms: Column | str) -> Column:
    """Epoch ms -> UTC wall clock as ``timestamp_ntz`` (zone-free)."""
    return F.timestamp_add("MILLISECOND", _c(ms), _epoch_ntz())


def ms_to_local_ntz(ms: Column | str, zone: str) -> Column:
    utc = ms_to_utc_ntz(ms)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def utc_ntz_to_ms(ts: Column | str) -> Column:
    """UTC wall clock ``timestamp_ntz`` -> epoch ms (truncating sub-ms)."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _c(ts))


def local_ntz_to_ms(ts: Column | str, zone: str) -> Column:
    ts = _c(ts)
    return utc_ntz_to_ms(ts if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), ts))


def seconds_to_ms(s: Column | str) -> Column:
    return _c(s) * F.lit(1000)


def format_ms(ms: Column | str, pattern: str, zone: str) -> Column:
    """``DateFormatUtils.format(ms, pattern)`` in ``zone``."""
    return F.date_format(ms_to_local_ntz(ms, zone), pattern)


def day_string(ms: Column | str, zone: str) -> Column:
    return format_ms(ms, DAY_FORMAT, zone)


def day_start_ms(ms: Column | str, zone: str) -> Column:
    """Begin of the local calendar day holding ``ms`` (DST-aware)."""
    return local_ntz_to_ms(F.date_trunc("DAY", ms_to_local_ntz(ms, zone)), zone)


def next_day_start_ms(ms: Column | str, zone: str, days: int = 1) -> Column:
    """Begin of the local day ``days`` after the one holding ``ms``."""
    local_day = F.date_trunc("DAY", ms_to_local_ntz(ms, zone))
    return local_ntz_to_ms(F.timestamp_add("DAY", F.lit(days), local_day), zone)


def ms_to_ts(ms: Column | str) -> Column:
    """Epoch ms -> ``timestamp`` (an instant), for ``window``/``withWatermark``."""
    return F.timestamp_millis(_c(ms))


def ts_to_ms(ts: Column | str) -> Column:
    """``timestamp`` (instant) -> epoch ms."""
    return F.unix_millis(_c(ts))
