"""Exact unique visitors per app and calendar day.

Skew: a single app may carry a third of all visits. Every plan here first
aggregates on keys that include the user id (or its bitmap bucket), so the
hot app is spread over many tasks; later stages work on per-second or
per-bucket summaries whose size no longer grows with the visit count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timefmt import day_start_ms, day_string
from tidepool.operators.prefix import running_agg


def with_day(visits: DataFrame, zone: str) -> DataFrame:
    return visits.withColumn("day", day_string("visit_time", zone))


def daily_uv(visits: DataFrame, zone: str = "UTC") -> DataFrame:
    """``(app_id, day, uv)`` with an exact distinct count."""
    v = with_day(visits, zone)
    return v.groupBy("app_id", "day").agg(F.count_distinct("uid").alias("uv"))


def uv_bitmap(visits: DataFrame, zone: str = "UTC") -> DataFrame:
    """Exact ``(app_id, day, uv)`` via per-bucket bitmaps.

    The bitmaps are mergeable (``bitmap_or_agg``), so daily results can be
    rolled up to weeks or months without revisiting visits. Buckets are
    disjoint, so the day total is the sum of bucket cardinalities.
    """
    v = with_day(visits, zone).select(
        "app_id", "day", F.bitmap_bucket_number("uid").alias("bucket"),
        F.bitmap_bit_position("uid").alias("pos"))
    # The bitmap buffer needs a sort-based aggregate; dedupe with a hash
    # aggregate first so only distinct (user, day) pairs are sorted.
    distinct = v.select("app_id", "day", "bucket", "pos").distinct()
    per_bucket = distinct.groupBy("app_id", "day", "bucket").agg(F.bitmap_construct_agg("pos").alias("bm"))
    return per_bucket.groupBy("app_id", "day").agg(F.sum(F.bitmap_count("bm")).cast("bigint").alias("uv"))


def daily_uv_cumulative(visits: DataFrame, zone: str = "UTC") -> DataFrame:
    """Per app and local day, every second with visits gets the day's running UV.

    Output ``(app_id, day, window_start, day_uv)``: one row per (app, day,
    1-second window holding at least one visit), ``day_uv`` = distinct users
    seen that day up to the end of that second.

    Plan: one scan and one aggregation over two grouping sets — the first
    visit second per (app, day, uid), shuffled on the user so a hot app
    spreads, and the active seconds per (app, day). Both become
    (app, day, second, new users) marks, summed per second with map-side
    combine; the running total is a window per (app, day) over at most 86,400
    seconds, whatever the visit volume.
    """
    v = with_day(visits, zone).withColumn(
        "sec", F.col("visit_time") - F.pmod(F.col("visit_time"), F.lit(1000)))
    g = v.groupingSets([["app_id", "day", "uid"], ["app_id", "day", "sec"]], "app_id", "day", "uid", "sec").agg(
        F.min("sec").alias("first_sec"), F.grouping("uid").alias("_by_sec"))
    marks = g.select("app_id", "day", F.col("first_sec").alias("sec"),
                     F.when(F.col("_by_sec") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("new_users"))
    per_sec = marks.groupBy("app_id", "day", "sec").agg(F.sum("new_users").alias("new_users"))
    w = Window.partitionBy("app_id", "day").orderBy("sec").rowsBetween(Window.unboundedPreceding, 0)
    return per_sec.select("app_id", "day", F.col("sec").alias("window_start"),
                          F.sum("new_users").over(w).cast("bigint").alias("day_uv"))


def uv_running(visits: DataFrame, zone: str = "UTC", chunk_span_ms: int = 1000) -> DataFrame:
    """Header variant: one row per first visit of a user in a local day, with
    the day start and the running distinct count ``(app_id, day_start, uid,
    first_visit, uv)``. Ties in time are ordered by uid.

    The running count is a chunked prefix count over time (1 s chunks: at
    most 86,400 chunk totals per day), so a hot (app, day) is spread over
    many tasks, each holding the users first seen in one second.
    """
    first = (visits.withColumn("day_start", day_start_ms("visit_time", zone))
             .groupBy("app_id", "day_start", "uid").agg(F.min("visit_time").alias("first_visit")))
    return running_agg(first, ["app_id", "day_start"], ["first_visit", "uid"], None, "count", "uv",
                       chunk_span_ms)


def uid_bucket(visits: DataFrame, buckets: int = 1000) -> DataFrame:
    """The hot-key spread key: ``uid % buckets`` with Java's sign rule."""
    return visits.withColumn("part_id", F.col("uid") % F.lit(buckets))
