"""Streaming forms of the jobs.

Where Structured Streaming supports the operators, the streaming job is the
batch function itself plus a watermark; otherwise a stateful processor from
``tidepool.streaming.processors`` does the per-key work. Every function takes
and returns streaming DataFrames; callers pick the sink, trigger and the
checkpoint location (under the shared ``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidepool.functions.timefmt import day_start_ms, next_day_start_ms
from tidepool.operators import wordcount
from tidepool.operators.topn import filter_event
from tidepool.operators.windows import window_agg, window_header, with_event_ts
from tidepool.session import ship_package, subdir
from tidepool.streaming.processors import (
    BufferProcessor, ClosingWindowProcessor, CountWindowProcessor, DayCountProcessor, DayTotalProcessor, FirstVisitProcessor,
    LateSplitProcessor, RunningCountProcessor, RunningMedianProcessor, TopNProcessor,
)


def word_count_stream(lines: DataFrame, rule: str = "ws_run") -> DataFrame:
    """Running word totals; run with ``outputMode("update")``."""
    return wordcount.word_count(lines, rule)


def tumbling_sum_stream(records: DataFrame, key: str, ms_col: str, value: str, size: str = "5 seconds",
                        lag: str = "0 seconds", lateness_ms: int = 0) -> DataFrame:
    """Event-time tumbling sums.

    ``append`` emits each window once it closes. With allowed lateness, the
    watermark trails by ``lag + lateness``: run in ``update`` mode to get an
    early result per window and a corrected row for every late arrival
    within the lateness; rows later than that are dropped.
    """
    from tidepool.operators.windows import duration_ms
    delay = duration_ms(lag) + lateness_ms
    df = with_event_ts(records, ms_col).withWatermark("event_ts", f"{delay} milliseconds")
    return window_agg(df, [key], "event_ts", size, None, [F.sum(value).cast("bigint").alias("total")])


TOP_SCHEMA = "window_end long, rank int, item_id long, pv long"


def top_n_stream(behaviours: DataFrame, n: int = 5, lag: str = "1 minute", size: str = "1 hour",
                 slide: str = "5 minutes", buckets: int = 16) -> DataFrame:
    """Hot items: sliding-window page views, then top ``n`` per window (``append``).
    Ties: pv desc, item id asc.

    The counts of a closed window go, by item hash, to ``buckets`` processors
    that keep the best ``n`` of what they see (state of ``n`` rows, emitted by
    a timer), and one processor per window does the same with their
    ``buckets * n`` candidates.
    """
    ship_package(behaviours.sparkSession)
    pv = (filter_event(behaviours).withColumn("event_ts", F.timestamp_seconds("event_time"))
          .withWatermark("event_ts", lag))
    counts = pv.groupBy(F.window("event_ts", size, slide).alias("window"), "item_id").agg(
        F.count(F.lit(1)).alias("pv"))
    counts = counts.select(F.unix_millis("window.end").alias("window_end"), F.col("item_id").cast("long").alias("item_id"), "pv",
                           F.pmod(F.xxhash64("item_id"), F.lit(buckets)).alias("bucket"))
    part = counts.groupBy("window_end", "bucket").transformWithStateInPandas(
        TopNProcessor(n), TOP_SCHEMA + ", et timestamp", "append", "EventTime", eventTimeColumnName="et")
    return part.select("window_end", "item_id", "pv").groupBy("window_end").transformWithStateInPandas(
        TopNProcessor(n, with_time=False), TOP_SCHEMA, "append", "EventTime")


def supervise(start, restarts: int = 1, delay_s: float = 10.0) -> int:
    """Run ``start()``'s query to its end; after a failure start it again from
    its checkpoint, ``restarts`` times at most, ``delay_s`` apart (a fixed-delay
    restart strategy). Returns the restarts used; the last failure is raised."""
    import time

    from pyspark.errors import StreamingQueryException
    for used in range(restarts + 1):
        try:
            start().awaitTermination()
            return used
        except StreamingQueryException:
            if used == restarts:
                raise
            time.sleep(delay_s)


def count_window_stream(records: DataFrame, key: str = "word", seq: str = "seq", value: str = "num",
                        n: int = 5) -> DataFrame:
    """Per-key count windows; ``records`` has ``key, seq, value``. Output
    ``(key, window_no, total)``, the key keeping its input type."""
    ship_package(records.sparkSession)
    schema = f"{key} {records.schema[key].dataType.simpleString()}, window_no long, total long"
    return records.select(key, seq, value).groupBy(key).transformWithStateInPandas(
        CountWindowProcessor(n, key, seq, value), schema, "append", "None")


def running_median_stream(records: DataFrame, key: str = "user_id", seq: str = "seq",
                          value: str = "value") -> DataFrame:
    """Running median per key after every row; ``append``. State per key is a
    tree of counted values. Key type is taken from the input."""
    ship_package(records.sparkSession)
    key_type = records.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, {seq} long, {value} double, median double"
    return records.select(key, F.col(seq).cast("long").alias(seq), F.col(value).cast("double").alias(value)) \
        .groupBy(key).transformWithStateInPandas(RunningMedianProcessor(key, seq, value), schema, "append", "None")


def running_count_stream(records: DataFrame, key: str = "word", seq: str = "seq", out: str = "cnt") -> DataFrame:
    """The count of each record's key up to it, one row per record (``append``):
    ``(key, seq, cnt)``. Inside a micro-batch records go by ``seq``; a record
    of a later batch counts after those of earlier ones."""
    ship_package(records.sparkSession)
    kinds = {c: records.schema[c].dataType.simpleString() for c in (key, seq)}
    return records.select(key, seq).groupBy(key).transformWithStateInPandas(
        RunningCountProcessor(key, seq, out), f"{key} {kinds[key]}, {seq} {kinds[seq]}, {out} long", "append", "None")


def with_heartbeat(rows: DataFrame) -> DataFrame:
    """``rows`` and a source that ticks once a second and adds none of its own: batches, and so timers, also run when
    a query starts again and finds no new input (Spark runs idle batches only after one with input)."""
    ticks = rows.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where(F.col("value") < 0)
    return rows.unionByName(ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]))


def closing_sum_stream(records: DataFrame, key: str = "word", value: str = "num", size: str = "5 seconds",
                       slide: str = "1 second", out: str = "total", heartbeat: bool = True) -> DataFrame:
    """Sums over sliding windows of processing time (``append``): each window is
    emitted once, at its end, whether or not new input comes:
    ``(key, window_start, window_end, total)``. ``heartbeat`` closes windows that
    a stopped query left open as soon as it runs again."""
    from tidepool.operators.windows import duration_ms
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if size_ms % slide_ms:
        raise ValueError("size must be a multiple of slide")
    ship_package(records.sparkSession)
    kind = records.schema[key].dataType.simpleString()
    read = records.select(key, F.coalesce(F.col(value).cast("long"), F.lit(0)).alias(value))
    return (with_heartbeat(read) if heartbeat else read).groupBy(key).transformWithStateInPandas(
        ClosingWindowProcessor(key, value, size_ms, slide_ms, out), f"{key} {kind}, window_start long, window_end long, {out} long",
        "append", "ProcessingTime")


def buffered_stream(rows: DataFrame, key: str, value: str, flush_rows: int = 1000, flush_ms: int = 10_000,
                    buffers: int = 16) -> DataFrame:
    """``(k, v)`` of every row, held in ``buffers`` buffers and let go
    ``flush_rows`` at a time or ``flush_ms`` after a buffer's first row
    (``append``). What is held is state: it outlives a restart, and goes out
    without new input. A key's rows share a buffer and keep their order of batches."""
    ship_package(rows.sparkSession)
    pairs = with_heartbeat(rows.select(F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v"))).withColumn(
        "buffer", F.pmod(F.xxhash64("k"), F.lit(buffers)))
    return pairs.groupBy("buffer").transformWithStateInPandas(
        BufferProcessor(flush_rows, flush_ms), "k string, v string", "append", "ProcessingTime")


LATE_SCHEMA = ("kind string, user_id int, window_start long, window_end long, n_orders long, money long, "
               "rows string, version long")


def late_split_stream(orders: DataFrame, size_ms: int = 5000, lag_ms: int = 0, lateness_ms: int = 0,
                      zone: str = "UTC") -> DataFrame:
    """Windows and late rows, tagged by ``kind`` (``window`` / ``late``).

    ``orders`` has ``seq, order_id, user_id, money, pay_time`` (epoch ms). A
    window is emitted once its end has passed (``version`` 1) and again, whole,
    for every row within ``lateness_ms`` after that (2, 3, ...): the largest
    version is its final content. Rows later than that are ``late`` (version 0).
    The watermark is declared on a timestamp column which is then dropped, so
    the processor — not Spark's row filter — decides lateness per window.
    """
    ship_package(orders.sparkSession)
    wm = with_event_ts(orders, "pay_time").withWatermark("event_ts", f"{lag_ms} milliseconds").drop("event_ts")
    out = wm.select("seq", "order_id", "user_id", "money", "pay_time").groupBy("user_id").transformWithStateInPandas(
        LateSplitProcessor(size_ms, lateness_ms), LATE_SCHEMA, "append", "EventTime")
    info = F.when(F.col("kind") == "window",
                  F.concat(window_header("window_start", "window_end", zone), F.col("rows"))).otherwise(F.col("rows"))
    return out.select("kind", "user_id", "window_start", "window_end", "n_orders", "money", info.alias("info"), "version")


def day_window_stream(records: DataFrame, key: str, ms_col: str, zone: str, lag: str = "0 seconds") -> DataFrame:
    """Calendar-day counts per key in ``zone`` (DST-aware) on a stream;
    each day is emitted once the watermark passes its end. Output
    ``(key, window_start, window_end, cnt)``. For fixed-offset zones
    ``streaming_day_window_col`` with a plain aggregation does the same."""
    ship_package(records.sparkSession)
    df = (with_event_ts(records, ms_col, "_et").withWatermark("_et", lag).drop("_et")
          .select(key, day_start_ms(ms_col, zone).alias("day_start"), next_day_start_ms(ms_col, zone).alias("day_end")))
    key_type = records.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, window_start long, window_end long, cnt long"
    return df.groupBy(key).transformWithStateInPandas(DayCountProcessor(key), schema, "append", "EventTime")


def daily_uv_stream(visits: DataFrame, lag: str = "1 minute", day_offset: str = "0 hours") -> DataFrame:
    """Exact UV per app and day on a stream (``append``: one row per closed day).

    Streaming rejects ``count(DISTINCT)``; bitmaps per (app, day, uid bucket)
    stream and merge exactly. ``day_offset`` aligns days to a fixed-offset
    zone (``"16 hours"`` for UTC+8). Output ``(app_id, day_start, uv)``.
    """
    from tidepool.operators.windows import streaming_day_window_col
    v = with_event_ts(visits, "visit_time", "vt").withWatermark("vt", lag)
    per_bucket = v.groupBy("app_id", streaming_day_window_col("vt", day_offset).alias("day"),
                           F.bitmap_bucket_number("uid").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("bm"))
    per_day = per_bucket.groupBy("app_id", "day").agg(F.sum(F.bitmap_count("bm")).cast("bigint").alias("uv"))
    return per_day.select("app_id", F.unix_millis("day.start").alias("day_start"), "uv")


FLAG_SCHEMA = "app_id string, day_start long, uid long, visit_time long, flag int, et timestamp"
TOTAL_SCHEMA = "app_id string, day_start long, window_start long, day_uv long"


def daily_uv_cumulative_stream(visits: DataFrame, zone: str = "UTC", lag: str = "1 second",
                               buckets: int = 1000) -> DataFrame:
    """Running daily UV per app at every closed 1 s window (three stages);
    days are those of ``zone``, by name or offset, DST included.

    1. first-visit flags keyed by ``(app_id, uid % buckets)`` — a hot app is
       spread over ``buckets`` state keys;
    2. 1 s event-time windows summing the flags per (app, day);
    3. per app, a running per-day total.
    The lag must be at least 1 s: with 0 s, visits whose time equals the
    maximum seen so far are filtered as late.
    """
    ship_package(visits.sparkSession)
    v = (with_event_ts(visits, "visit_time", "vt").withWatermark("vt", lag).drop("vt")
         .withColumn("part_id", F.col("uid") % F.lit(buckets)))
    days = [day_start_ms("visit_time", zone).alias("day_start"), next_day_start_ms("visit_time", zone).alias("day_end")]
    flags = v.select("app_id", "part_id", "uid", "visit_time", *days).groupBy("app_id", "part_id", "day_start", "day_end") \
        .transformWithStateInPandas(FirstVisitProcessor(), FLAG_SCHEMA, "append", "EventTime",
                                    eventTimeColumnName="et")
    per_sec = flags.groupBy("app_id", "day_start", F.window("et", "1 second").alias("w")).agg(
        F.sum("flag").cast("bigint").alias("new_users"))
    per_sec = per_sec.select("app_id", "day_start", F.unix_millis("w.start").alias("window_start"), "new_users")
    return per_sec.groupBy("app_id").transformWithStateInPandas(DayTotalProcessor(), TOTAL_SCHEMA, "append",
                                                                "EventTime")


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> StreamingQuery:
    """Start ``df`` into the in-memory sink (tests, notebooks)."""
    spark = df.sparkSession
    ckpt = checkpoint or subdir(spark, f"stream-{name}")
    return df.writeStream.format("memory").queryName(name).outputMode(mode).option(
        "checkpointLocation", ckpt).start()



def write_changes(path: str):
    """``foreachBatch`` function: each batch's changed rows as Parquet in a folder of its own, by the query's id (which
    a restart keeps) and the batch's. A retried batch overwrites itself; another query's rows stay."""
    def write(df: DataFrame, batch_id: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        df.write.mode("overwrite").parquet(f"{path}/query_id={query}/batch_id={batch_id}")
    return write


def enrich_each_batch(load_dim, key: str, value_cols: list[str], sink, default: object = "",
                      order_col: str | None = None):
    """``foreachBatch`` function: re-read the dimension for every micro-batch
    (``load_dim(spark)``, e.g. a JDBC read), left-join it, pass the enriched
    batch to ``sink(df, batch_id)``. Dimension changes show up at the next batch.
    """
    from tidepool.operators.enrich import dim_lookup

    def run(df: DataFrame, batch_id: int) -> None:
        dim = load_dim(df.sparkSession)
        sink(dim_lookup(df, dim, key, value_cols, default, order_col), batch_id)
    return run
