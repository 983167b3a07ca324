"""Windowed page-view counts, top-N per window, latest-K keys per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.text import equals_ignore_case
from tidepool.functions.timefmt import seconds_to_ms
from tidepool.operators.windows import duration_ms, sliding_slot_agg, window_agg, with_event_ts


def filter_event(behaviours: DataFrame, kind: str = "pv") -> DataFrame:
    """Case-insensitive behaviour filter (pushed below any aggregation)."""
    return behaviours.where(equals_ignore_case("event_id", kind))


def pv_window_count(behaviours: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                    pre_aggregate: bool = False) -> DataFrame:
    """Page views per item on sliding windows: ``(item_id, window_end, pv)``.

    The count is incremental: partial counts per map task, merged after the
    shuffle on (item, window). ``pre_aggregate=True`` (batch only) counts per
    (item, slot) before expanding to windows, for dense inputs.
    """
    pv = filter_event(behaviours).withColumn("_ms", seconds_to_ms("event_time")).select("item_id", "_ms")
    if pre_aggregate and not pv.isStreaming:
        counted = sliding_slot_agg(pv, ["item_id"], "_ms", F.count(F.lit(1)), duration_ms(size),
                                   duration_ms(slide), "pv")
        return counted.select("item_id", "window_end", "pv")
    counted = window_agg(with_event_ts(pv, "_ms"), ["item_id"], "event_ts", size, slide,
                         [F.count(F.lit(1)).alias("pv")])
    return counted.select("item_id", "window_end", "pv")


def top_n_per_window(counts: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` items per window end by pv desc, ties by item id asc.

    ``row_number() <= n`` is planned with a window group limit, so each task
    keeps only its local top n per window before the shuffle.
    Output ``(window_end, rank, item_id, pv)``.
    """
    w = Window.partitionBy("window_end").orderBy(F.col("pv").desc(), F.col("item_id").asc())
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("window_end", F.col("rank").cast("int").alias("rank"), "item_id", "pv"))


def recent_keys(puts: DataFrame, user: str, key: str, value: str, seq: str, k: int = 3) -> DataFrame:
    """Per user, the ``k`` keys put most recently, each with its last value.

    The state an LRU cache of capacity ``k`` holds after a run of puts.
    Output ``(user, key, value, last_seq, recency)``; recency 1 = newest.
    """
    last = puts.groupBy(user, key).agg(F.max(seq).alias("last_seq"),
                                       F.max_by(value, seq).alias(value))
    w = Window.partitionBy(user).orderBy(F.col("last_seq").desc())
    return (last.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= k)
            .select(user, key, value, "last_seq", F.col("recency").cast("int")))
