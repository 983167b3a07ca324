"""Streaming jobs driven by one file per micro-batch (deterministic batches)."""

import os
import uuid

from pyspark.sql import functions as F

from conftest import ORDER_TRACE, VISITS, rows
from tidepool.functions.parse import parse_orders, parse_visits, parse_word_num
from tidepool.operators.wordcount import word_count
from tidepool.sources.files import scan_text
from tidepool.streaming.jobs import (
    count_window_stream, daily_uv_cumulative_stream, late_split_stream, run_to_memory, top_n_stream,
    tumbling_sum_stream, word_count_stream,
)
from tidepool.functions.parse import parse_behavior_csv, parse_event_line

def _files(tmp_path, lines, per_file=1):
    d = tmp_path / f"in-{uuid.uuid4().hex[:6]}"
    d.mkdir()
    for n, i in enumerate(range(0, len(lines), per_file)):
        f = d / f"part-{i:05d}.txt"
        f.write_text("\n".join(lines[i:i + per_file]) + "\n")
        os.utime(f, (1_600_000_000 + n, 1_600_000_000 + n))  # the file source replays by mtime
    return str(d)


def _stream_lines(spark, path):
    return scan_text(spark, path, stream=True, max_files_per_trigger=1)


def _run(df, name, mode, tmp_path):
    q = run_to_memory(df, name, mode, checkpoint=str(tmp_path / f"ckpt-{name}"))
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_word_count_stream_equals_batch(spark, tmp_path):
    lines = ["flink spark", "hello world", "flink spark", "spark hbase hbase flink flink", "   hbase"]
    path = _files(tmp_path, lines, per_file=2)
    out = _run(word_count_stream(_stream_lines(spark, path)), "wc_stream", "update", tmp_path)
    latest = {}
    for r in out.collect():  # update mode: a later row per word carries the larger running total
        latest[r.word] = max(latest.get(r.word, 0), r.cnt)
    assert sorted(latest.items()) == rows(word_count(scan_text(spark, path)))


def test_late_split_stream_trace(spark, tmp_path):
    path = _files(tmp_path, ORDER_TRACE)
    orders, _ = parse_orders(_stream_lines(spark, path).withColumn("seq", F.lit(0).cast("long")), keep=("seq",))
    out = _run(late_split_stream(orders, 5000, 0, 0, "Asia/Shanghai"), "late_stream", "append", tmp_path)
    got = rows(out, "kind", "window_start", "money")
    assert got == [("late", 1634473760000, 20), ("window", 1634473760000, 60), ("window", 1634473765000, 30)]
    w1 = out.where("kind = 'window' AND window_start = 1634473760000").first().info
    assert w1.startswith("WindowInfo=[20211017202920,20211017202925),Order(orderId=o1,")
    assert [p.split(",")[0] for p in w1.split("Order(orderId=")[1:]] == ["o1", "o2", "o4"]
    w2 = out.where("kind = 'window' AND window_start = 1634473765000").first().info
    assert [p.split(",")[0] for p in w2.split("Order(orderId=")[1:]] == ["o6", "o5"]


def test_count_window_stream(spark, tmp_path):
    path = _files(tmp_path, [f"w,{i}" for i in range(12)], per_file=3)
    src = parse_word_num(_stream_lines(spark, path)).withColumn("seq", F.col("num").cast("long"))
    out = _run(count_window_stream(src, "word", "seq", "num", 5), "cw_stream", "append", tmp_path)
    assert rows(out, "window_no", "total") == [(0, 0 + 1 + 2 + 3 + 4), (1, 5 + 6 + 7 + 8 + 9)]


def test_running_median_stream_golden(spark, tmp_path):
    from tidepool.streaming.jobs import running_median_stream
    nums = [1, 6, 7, 8, 3, 4, 2, 10]
    path = _files(tmp_path, [f"{i},k,{n}" for i, n in enumerate(nums)], per_file=3)  # time = arrival order
    src = parse_event_line(_stream_lines(spark, path))
    out = _run(running_median_stream(src, "word", "ts_ms", "num"), "median_stream", "append", tmp_path)
    got = [r.median for r in out.orderBy("ts_ms").collect()]
    assert got == [1, 3.5, 6, 6.5, 6, 5, 4, 5]


def test_daily_uv_stream_trace(spark, tmp_path):
    path = _files(tmp_path, VISITS)
    visits, _ = parse_visits(_stream_lines(spark, path))
    out = _run(daily_uv_cumulative_stream(visits, "Asia/Shanghai", "1 second"), "uv_stream", "append", tmp_path)
    got = rows(out, "day_start", "window_start", "day_uv")
    # The last second stays open while the stream runs.
    assert got == [(1634400000000, 1634447599000, 1), (1634400000000, 1634451199000, 1),
                   (1634400000000, 1634483599000, 3), (1634400000000, 1634486359000, 3),
                   (1634486400000, 1634486400000, 1)]


def test_late_visits_at_the_boundary(spark, tmp_path):
    """With the maximum at 9000 and a lag of 2000, the rule's watermark is 6999:
    6998 (at or before it less 1 ms) is late; 6999 is not late by that rule, but
    its second has closed, so it goes without making its user seen."""
    base = 1_700_000_000_000
    late = [f"app1,{uid},{base + at}" for uid, at in ((2, 6998), (3, 6999), (4, 7000))]
    again = [f"app1,{uid},{base + 8000}" for uid in (2, 3, 4)]
    lines = [f"app1,1,{base + 9000}", f"app1,1,{base + 9000}", *late, *again, f"app1,1,{base + 60_000}", f"app1,1,{base + 60_000}"]
    visits, _ = parse_visits(_stream_lines(spark, _files(tmp_path, lines)))
    out = _run(daily_uv_cumulative_stream(visits, "UTC", "2 seconds"), "uv_late", "append", tmp_path)
    got = {(r.window_start - base): r.day_uv for r in out.collect()}
    assert got[7000] == 1 and got[8000] == 3 and got[9000] == 4  # user 4 at 7 s, users 2 and 3 only at 8 s


def test_uv_days_of_a_zone_with_dst(spark, tmp_path):
    """New York, 2024-03-10 has 23 hours: a visit just before and just after its end."""
    end = 1710129600000
    lines = [f"a,1,{end - 1000}", f"a,1,{end}", f"a,1,{end + 5000}", f"a,1,{end + 60_000}", f"a,1,{end + 60_000}"]
    visits, _ = parse_visits(_stream_lines(spark, _files(tmp_path, lines)))
    out = _run(daily_uv_cumulative_stream(visits, "America/New_York", "1 second"), "uv_dst", "append", tmp_path)
    assert rows(out.where(f"window_start <= {end + 5000}"), "day_start", "window_start", "day_uv") == [
        (1710046800000, end - 1000, 1), (end, end, 1), (end, end + 5000, 1)]


def test_top_n_stream_equals_batch_with_many_items(spark, tmp_path):
    from tidepool.operators.topn import pv_window_count, top_n_per_window
    beh = [f"{i % 50},{(i * 7919) % 400},1,pv,{100 + (i * 37) % 7000}" for i in range(3000)]
    last = ["1,1,1,pv,90000"]
    path = _files(tmp_path, beh + last, per_file=3000)
    top = _run(top_n_stream(parse_behavior_csv(_stream_lines(spark, path)), n=5, lag="0 seconds"), "top_many", "append", tmp_path)
    batch = top_n_per_window(pv_window_count(parse_behavior_csv(scan_text(spark, path))), 5)
    want = [r for r in rows(batch, "window_end", "rank", "item_id", "pv") if r[0] <= 86_000_000]
    got = [r for r in rows(top, "window_end", "rank", "item_id", "pv") if r[0] <= 86_000_000]
    assert got == want and len(want) > 100


def test_processing_time_sliding_stream(spark, tmp_path):
    """Windows of 5 s that slide by 1 s: every row is in five of them."""
    from tidepool.operators.windows import processing_time_sliding_sum
    path = _files(tmp_path, ["a,1", "a,2", "b,5"], per_file=3)
    out = _run(processing_time_sliding_sum(parse_word_num(_stream_lines(spark, path)), "word", "num"), "slide_pt", "update", tmp_path)
    got = rows(out, "word", "total")
    assert got == [("a", 3)] * 5 + [("b", 5)] * 5
    assert all((r.window_end - r.window_start) == 5000 for r in out.collect())


def test_supervise_restarts_from_the_checkpoint(spark, tmp_path):
    """A query that fails once is started again after the delay and loses nothing."""
    import pytest
    from pyspark.errors import StreamingQueryException
    from tidepool.streaming.jobs import supervise
    path = _files(tmp_path, ["1", "2", "3", "4"], per_file=1)
    seen, flag = [], tmp_path / "failed"

    def start(always=False):
        def write(df, n):
            if n == 2 and (always or not flag.exists()):
                flag.write_text("x")
                raise RuntimeError("lost")
            seen.extend(r.line for r in df.collect())
        return (_stream_lines(spark, path).writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / f"sup-{always}"))
                .trigger(availableNow=True).start())

    assert supervise(start, restarts=1, delay_s=0.1) == 1
    assert seen == ["1", "2", "3", "4"]
    with pytest.raises(StreamingQueryException):
        supervise(lambda: start(True), restarts=1, delay_s=0.1)


def test_lines_end_at_newlines_only(spark, tmp_path):
    (tmp_path / "cr").mkdir()
    (tmp_path / "cr" / "a.txt").write_bytes(b"a\rb c\nd\r\n")
    assert [r.line for r in scan_text(spark, str(tmp_path / "cr")).collect()] == ["a\rb c", "d"]


def test_day_window_stream_dst(spark, tmp_path):
    """New York, 2024-03-10 has 23 hours; the day closes when a later row
    moves the watermark past its end."""
    from tidepool.streaming.jobs import day_window_stream
    t = [1710086400000, 1710090000000, 1710180000000]  # two rows on Mar 10, one on Mar 11 (local)
    lines = [f"{ms},a,1" for ms in t]
    src = parse_event_line(_stream_lines(spark, _files(tmp_path, lines)))
    out = _run(day_window_stream(src, "word", "ts_ms", "America/New_York"), "day_dst", "append", tmp_path)
    assert rows(out, "window_start", "window_end", "cnt") == [(1710046800000, 1710129600000, 2)]


def test_allowed_lateness_updates_window(spark, tmp_path):
    """Lateness 5 s: a row 5 s behind the maximum still corrects its window
    (update mode); with no lateness its window was already evicted. (Spark
    applies the watermark at micro-batch grain: state is evicted at the end
    of the batch that ran with the advanced watermark, hence the extra row.)"""
    base = 1_700_000_000_000
    lines = [f"{base + d},a,1" for d in (0, 1000, 2000, 7000, 8000, 3000)]
    got = {}
    for lateness in (0, 5000):
        src = parse_event_line(_stream_lines(spark, _files(tmp_path, lines)))
        out = _run(tumbling_sum_stream(src, "word", "ts_ms", "num", "5 seconds", "0 seconds", lateness),
                   f"late_upd_{lateness}", "update", tmp_path)
        got[lateness] = max(r.total for r in out.where(f"window_start = {base}").collect())
    assert got == {0: 3, 5000: 4}


def test_daily_uv_bitmap_stream(spark, tmp_path):
    from tidepool.streaming.jobs import daily_uv_stream
    visits, _ = parse_visits(_stream_lines(spark, _files(tmp_path, VISITS)))
    out = _run(daily_uv_stream(visits, "1 second", "16 hours"), "uv_bitmap_stream", "append", tmp_path)
    assert rows(out, "day_start", "uv") == [(1634400000000, 3)]  # the second day is still open


def test_tumbling_and_top_n_streams(spark, tmp_path):
    ev = ["1997-01-01 12:00:00,flink,1", "1997-01-01 12:00:01,flink,1", "1997-01-01 12:00:02,flink,1",
          "1997-01-01 12:00:07,flink,1", "1997-01-01 12:00:08,flink,1", "1997-01-01 12:00:14,flink,1"]
    parsed = parse_event_line(_stream_lines(spark, _files(tmp_path, ev)), zone="Asia/Shanghai")
    out = _run(tumbling_sum_stream(parsed, "word", "ts_ms", "num"), "tumble_stream", "append", tmp_path)
    base = 852091200000
    assert rows(out, "window_start", "total") == [(base, 3), (base + 5000, 2)]  # last window still open

    beh = [f"{u},{item},1,pv,{t}" for u, item, t in
           [(1, 7, 100), (2, 7, 110), (3, 8, 120), (4, 9, 130), (5, 9, 140), (6, 9, 150), (7, 5, 9000)]]
    b = parse_behavior_csv(_stream_lines(spark, _files(tmp_path, beh, per_file=7)))
    top = _run(top_n_stream(b, n=2, lag="0 seconds"), "top_stream", "append", tmp_path)
    first = [r for r in rows(top, "window_end", "rank", "item_id", "pv") if r[0] == 300000]
    assert first == [(300000, 1, 9, 3), (300000, 2, 7, 2)]
    b2 = parse_behavior_csv(_stream_lines(spark, _files(tmp_path, beh, per_file=7)))
    top2 = _run(top_n_stream(b2, n=2, lag="0 seconds", buckets=3), "top_stream_b", "append", tmp_path)
    assert rows(top2) == rows(top)


def test_late_split_survives_restart(spark, tmp_path):
    """Stop mid-stream, restart from the checkpoint: state (open windows,
    timers) is restored and the file sink holds each result exactly once."""
    src = tmp_path / "restart-in"
    src.mkdir()
    out, ckpt = str(tmp_path / "restart-out"), str(tmp_path / "restart-ckpt")

    def add(i):
        f = src / f"part-{i:05d}.txt"
        f.write_text(ORDER_TRACE[i] + "\n")
        os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))

    def run_once():
        lines = scan_text(spark, str(src), stream=True, max_files_per_trigger=1)
        orders, _ = parse_orders(lines.withColumn("seq", F.lit(0).cast("long")), keep=("seq",))
        q = (late_split_stream(orders, 5000, 0, 0, "Asia/Shanghai").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).outputMode("append").start())
        q.processAllAvailable()
        q.stop()

    for i in range(3):
        add(i)
    run_once()
    for i in range(3, len(ORDER_TRACE)):
        add(i)
    run_once()
    got = rows(spark.read.parquet(out), "kind", "window_start", "money", "n_orders")
    assert got == [("late", 1634473760000, 20, 1), ("window", 1634473760000, 60, 3), ("window", 1634473765000, 30, 2)]


def test_count_window_stream_numeric_key(spark, tmp_path):
    from tidepool.streaming.jobs import count_window_stream
    path = _files(tmp_path, [f"{i},{i % 2},{i}" for i in range(10)], per_file=5)
    src = parse_event_line(_stream_lines(spark, path)).select(F.col("num").alias("k"), "ts_ms", "num")
    src = src.withColumn("k", F.col("k") % 2)
    out = _run(count_window_stream(src, "k", "ts_ms", "num", 5), "cw_numeric", "append", tmp_path)
    assert rows(out) == [(0, 0, 0 + 2 + 4 + 6 + 8), (1, 0, 1 + 3 + 5 + 7 + 9)]
