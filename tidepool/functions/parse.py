"""Typed parsing of delimited text lines.

Two modes, as in the jobs being rebuilt:
* strict: a bad or missing field fails the job (``raise_error``), extra
  fields are ignored;
* tolerant: a bad row becomes a reject row and is kept apart.

``Integer.parseInt``/``Long.parseLong`` accept an optional sign and digits
only, so surrounding blanks are errors even though ``try_cast`` would trim
them; the digit pattern guards every cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import java_split

INT_PATTERN = "\\A[+-]?[0-9]+\\z"  # "$" would also match before a final line end


def parse_int(col: Column) -> Column:
    """Java ``parseInt``: null on any error, including 32-bit overflow."""
    return F.when(col.rlike(INT_PATTERN), col.try_cast("int"))


def parse_long(col: Column) -> Column:
    """Java ``parseLong``: null on any error, including 64-bit overflow."""
    return F.when(col.rlike(INT_PATTERN), col.try_cast("bigint"))


def _typed(fields: Column, idx: int, kind: str) -> Column:
    raw = F.get(fields, idx)  # null when the field is missing
    if kind == "int":
        return parse_int(raw)
    if kind == "long":
        return parse_long(raw)
    if kind == "string":
        return raw
    raise ValueError(kind)


def computed_once(df: DataFrame, keep: tuple[str, ...], /, **cols: Column) -> DataFrame:
    """``keep`` and ``cols`` of ``df``, each of ``cols`` computed once per row.

    A plain projection is copied into every filter and column above it: the
    check of a parsed line would make the line and split it again for each
    time that it names a field. The output of a generator is not copied.
    """
    return df.select(*keep, F.stack(F.lit(1), *cols.values()).alias(*cols))


def parse_fields(lines: DataFrame, spec: list[tuple[str, str]], line_col: str = "line",
                 keep: tuple[str, ...] = (), exact: bool = False) -> DataFrame:
    """Split on ``,`` and type fields; adds ``_ok`` (all fields parsed).

    ``exact`` demands exactly ``len(spec)`` fields, else extra fields are ignored.
    """
    split = computed_once(lines, (*keep, line_col), _fields=java_split(line_col, "comma"))
    cols = {name: _typed(F.col("_fields"), i, kind) for i, (name, kind) in enumerate(spec)}
    ok = F.lit(True)
    for name, _ in spec:
        ok = ok & F.col(name).isNotNull()
    if exact:
        ok = ok & (F.col("_n") == F.lit(len(spec)))
    return (
        computed_once(split, (*keep, line_col), _n=F.size("_fields"), **cols)
        .withColumn("_ok", F.coalesce(ok, F.lit(False)))
        .drop("_n")
    )


def strict(parsed: DataFrame, line_col: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Fail the job on the first bad row, like an uncaught parse exception.

    The fields come out of the check, so that no later filter on them (a time
    window adds one) drops a bad row before it is seen.
    """
    err = F.raise_error(F.concat(F.lit("bad input line: "), F.col(line_col)))
    ok = F.when(F.col("_ok"), F.lit(True)).otherwise(err.cast("boolean"))
    fields = {c: F.col(c) for c in parsed.columns if c not in (*keep, line_col, "_ok")}
    return computed_once(parsed, (*keep, line_col), _ok=ok, **fields).where("_ok").drop("_ok")


def tolerant(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (good rows, rejects): two lazy views of the same parse."""
    return parsed.where("_ok").drop("_ok"), parsed.where(~F.col("_ok")).drop("_ok")


def tagged(parsed: DataFrame, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Good rows and rejects in one pass: ``ok`` flag, fields null on rejects."""
    return parsed.select(*keep, F.col("_ok").alias("ok"),
                         *[F.when(F.col("_ok"), F.col(f)).alias(f) for f in fields])


# ---- the record formats of the jobs -----------------------------------------

BEHAVIOR_SPEC = [("user_id", "long"), ("item_id", "long"), ("category_id", "long"),
                 ("event_id", "string"), ("event_time", "long")]
ORDER_SPEC = [("order_id", "string"), ("user_id", "int"), ("money", "int"), ("pay_time", "long")]
VISIT_SPEC = [("app_id", "string"), ("uid", "long"), ("visit_time", "long")]
WORD_NUM_SPEC = [("word", "string"), ("num", "int")]


def parse_behavior_csv(lines: DataFrame, line_col: str = "line", keep=()) -> DataFrame:
    """Strict 5-field behaviour CSV (bad row fails the job)."""
    return strict(parse_fields(lines, BEHAVIOR_SPEC, line_col, keep), line_col, keep)


def parse_word_num(lines: DataFrame, line_col: str = "line", keep=()) -> DataFrame:
    """Strict ``word,num``."""
    return strict(parse_fields(lines, WORD_NUM_SPEC, line_col, keep), line_col, keep)


def parse_orders(lines: DataFrame, line_col: str = "line", keep=()) -> tuple[DataFrame, DataFrame]:
    """Tolerant Order parse: (orders, rejects); extra fields ignored."""
    return tolerant(parse_fields(lines, ORDER_SPEC, line_col, keep))


def parse_visits(lines: DataFrame, line_col: str = "line", keep=()) -> tuple[DataFrame, DataFrame]:
    """Tolerant visit parse: exactly three fields, uid and time must be longs."""
    return tolerant(parse_fields(lines, VISIT_SPEC, line_col, keep, exact=True))


def parse_orders_tagged(lines: DataFrame, line_col: str = "line", keep=()) -> DataFrame:
    """Tolerant Order parse as one tagged output (single pass over the input)."""
    return tagged(parse_fields(lines, ORDER_SPEC, line_col, keep), [n for n, _ in ORDER_SPEC], keep)


def parse_visits_tagged(lines: DataFrame, line_col: str = "line", keep=()) -> DataFrame:
    """Tolerant visit parse as one tagged output (single pass over the input)."""
    return tagged(parse_fields(lines, VISIT_SPEC, line_col, keep, exact=True), [n for n, _ in VISIT_SPEC], keep)


# Fixed value: the readable time format accepted by the event-line parser.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_TIME_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def parse_event_line(lines: DataFrame, line_col: str = "line", keep=(),
                     zone: str = "UTC") -> DataFrame:
    """Strict ``time,word,num`` where time is epoch ms or ``yyyy-MM-dd HH:mm:ss``.

    Readable times are local wall-clock times in ``zone``; output ``ts_ms`` is
    epoch milliseconds.
    """
    from tidepool.functions.timefmt import local_ntz_to_ms

    split = computed_once(lines, (*keep, line_col), _fields=java_split(line_col, "comma"))
    fields = F.col("_fields")
    t = F.get(fields, 0)
    as_ms = parse_long(t)
    as_text = local_ntz_to_ms(t.try_cast("timestamp_ntz"), zone)
    ts_ms = F.when(t.rlike(INT_PATTERN), as_ms).when(t.rlike(EVENT_TIME_PATTERN), as_text)
    word = F.get(fields, 1)
    num = parse_int(F.get(fields, 2))
    parsed = computed_once(split, (*keep, line_col), ts_ms=ts_ms, word=word, num=num)
    parsed = parsed.withColumn(
        "_ok", F.coalesce(F.col("ts_ms").isNotNull() & F.col("word").isNotNull() & F.col("num").isNotNull(),
                          F.lit(False)))
    return strict(parsed, line_col, keep)
