"""Line splitting and tokenising with the semantics of Java's ``String.split``.

Spark's ``split`` keeps trailing empty tokens; Java drops them, returns
``[""]`` for an empty input and ``[]`` when the input is only separators.
All of it is built from JVM-side column expressions (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Java's ``\s`` class is exactly these six characters. Written as
# an explicit class so other regex dialects (RE2 lacks \x0B in \s) agree.
JAVA_WS_CHARS = " \t\n\x0b\f\r"
JAVA_WS_CLASS = "[ \\t\\n\\x0B\\f\\r]"

# Separator rules used by the jobs: name -> (split regex, trailing chars to strip)
SEPARATORS = {
    "ws_run": (JAVA_WS_CLASS + "+", JAVA_WS_CHARS),     # "\\s+"
    "ws_single": (JAVA_WS_CLASS, JAVA_WS_CHARS),        # "\\s"
    "space": (" ", " "),                                # literal space
    "comma": (",", ","),                                # CSV-ish lines
}


def _sep(rule: str) -> tuple[str, str]:
    try:
        return SEPARATORS[rule]
    except KeyError:
        raise ValueError(f"unknown separator rule {rule!r}; one of {sorted(SEPARATORS)}")


def java_split(col: Column | str, rule: str) -> Column:
    """``line.split(sep)`` as Java computes it, as an ``array<string>`` column.

    Every separator rule here matches single characters from a fixed set, so
    "drop trailing empty tokens" is the same as "strip trailing separator
    characters, then split keeping everything".
    """
    pattern, trailing = _sep(rule)
    c = F.col(col) if isinstance(col, str) else col
    stripped = F.rtrim(c, F.lit(trailing))
    return (
        F.when(c == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pattern, -1))
    )


def text_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per line of a text column, like reading the text as a file.

    A final newline closes the last line rather than opening an empty one, and
    a ``\\r`` before the newline is not part of the line. Output:
    ``(id_col, line_no, line)`` with ``line_no`` starting at 0.
    """
    body = F.regexp_replace(F.col(text_col), "\\n\\z", "")
    return (
        df.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
        .select(F.col(id_col), F.posexplode(F.split(body, "\\n", -1)).alias("line_no", "line"))
        .withColumn("line", without_cr("line"))
    )


def without_cr(col: Column | str) -> Column:
    """A line without the one ``\\r`` that may stand before its end."""
    return F.regexp_replace(col, "\\r\\z", "")


def tokens(lines: DataFrame, rule: str, line_col: str = "line",
           keep: tuple[str, ...] = (), drop_blank: bool = False) -> DataFrame:
    """flatMap a line column into ``(keep..., pos, word)`` rows.

    ``drop_blank`` applies the ``!word.trim().isEmpty()`` filter. Java's
    ``trim`` removes every char <= U+0020, so we test with the same rule.
    """
    out = lines.select(*keep, F.posexplode(java_split(line_col, rule)).alias("pos", "word"))
    if drop_blank:
        out = out.where(F.regexp_replace("word", "[\\x00-\\x20]", "") != F.lit(""))
    return out


def java_trim_is_empty(col: Column | str) -> Column:
    """``s.trim().isEmpty()``: true when every char is <= U+0020."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, "[\\x00-\\x20]", "") == F.lit("")


def equals_ignore_case(a: Column | str, b: Column | str) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.lit(b) if isinstance(b, str) else b
    return F.lower(a) == F.lower(b)
