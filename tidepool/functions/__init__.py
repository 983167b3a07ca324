"""Column-level helpers (all JVM-side expressions)."""

from tidepool.functions.bits import narrow_to_int, unsigned_widen
from tidepool.functions.json import geocode_fields
from tidepool.functions.parse import (
    parse_behavior_csv, parse_event_line, parse_int, parse_long, parse_orders, parse_visits,
    parse_word_num,
)
from tidepool.functions.text import (
    equals_ignore_case, java_split, java_trim_is_empty, text_lines, tokens,
)
from tidepool.functions.timefmt import (
    day_start_ms, day_string, format_ms, ms_to_local_ntz, ms_to_ts, next_day_start_ms,
    seconds_to_ms, ts_to_ms, utc_ntz_to_ms,
)

__all__ = [
    "day_start_ms", "day_string", "equals_ignore_case", "format_ms", "geocode_fields", "java_split",
    "java_trim_is_empty", "ms_to_local_ntz", "ms_to_ts", "narrow_to_int", "next_day_start_ms",
    "parse_behavior_csv", "parse_event_line", "parse_int", "parse_long", "parse_orders", "parse_visits",
    "parse_word_num", "seconds_to_ms", "text_lines", "tokens", "ts_to_ms", "unsigned_widen",
    "utc_ntz_to_ms",
]
