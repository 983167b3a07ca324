"""Tumbling windows with a bounded-lag watermark and a late-row side output.

Batch form of the streaming job: rows arrive in ``seq`` order; after each
row the watermark is ``max(time so far) - lag``. A row is late when its
window (plus allowed lateness) had already closed at its arrival:
``window_end + lateness <= running max - lag``. Late rows go to the side
output; every window emits the rows that were on time.

The running maximum over arrival order is global (one watermark for the
operator), which as a plain ordered window would be a single task. It is
computed with chunked prefix maxima instead (see ``operators.prefix``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.operators.prefix import running_agg
from tidepool.operators.windows import (
    format_order, records_text, sorted_records, tumbling_bounds, window_header,
)


def tag_late(orders: DataFrame, size_ms: int = 5000, lag_ms: int = 0, lateness_ms: int = 0,
             chunk_span: int | None = None) -> DataFrame:
    """Orders with ``window_start, window_end, late``."""
    w = orders.select("seq", "order_id", "user_id", "money", "pay_time", *tumbling_bounds("pay_time", size_ms))
    m = running_agg(w, [], ["seq"], "pay_time", "max", "_max_ts", chunk_span)
    late = (F.col("window_end") + F.lit(lateness_ms)) <= (F.col("_max_ts") - F.lit(lag_ms))
    return m.withColumn("late", late).drop("_max_ts")


def late_split(orders: DataFrame, size_ms: int = 5000, lag_ms: int = 0, lateness_ms: int = 0,
               zone: str = "UTC", chunk_span: int | None = None) -> DataFrame:
    """Windows and late rows in one tagged output.

    ``kind = 'window'``: one row per (user, window) of on-time rows, with the
    window text (rows in arrival order) and money total; ``kind = 'late'``: one
    row per late order. Split with ``where(kind = ...)``.
    Columns ``(kind, user_id, window_start, window_end, n_orders, money, info)``.
    """
    tagged = tag_late(orders, size_ms, lag_ms, lateness_ms, chunk_span)
    # One aggregation serves both outputs: a late row is a group of its own
    # (keyed by its seq), so the prefix-max lineage is evaluated once. Raw
    # fields are shuffled; the text is formatted after the aggregation.
    kind = F.when(F.col("late"), F.lit("late")).otherwise(F.lit("window"))
    grouped = tagged.groupBy(kind.alias("kind"), "user_id", "window_start", "window_end",
                             F.when(F.col("late"), F.col("seq")).alias("_late_seq")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("money").cast("bigint").alias("money"),
        sorted_records().alias("_recs"))
    info = F.when(F.col("kind") == "late", format_order(F.col("_recs")[0])).otherwise(
        F.concat(window_header("window_start", "window_end", zone), records_text("_recs")))
    return grouped.select("kind", "user_id", "window_start", "window_end", "n_orders", "money", info.alias("info"))
