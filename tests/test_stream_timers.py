"""Streams with one row per record, corrected windows, and timers that need no new input."""

import functools
import os
import random
import statistics
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from stubs import FileKVClient
from test_streaming import _files, _run, _stream_lines
from tidepool.functions.parse import parse_orders, parse_word_num
from tidepool.functions.text import tokens
from tidepool.operators.wordcount import running_count
from tidepool.sinks import kv
from tidepool.sources.files import ARRIVAL, scan_text, with_seq
from tidepool.streaming import jobs


def wait_for(done, seconds=60):
    end = time.monotonic() + seconds
    while not done():
        assert time.monotonic() < end
        time.sleep(0.2)


def test_running_count_stream_equals_batch(spark, tmp_path):
    """One row per record; several files a batch and several batches."""
    pick = random.Random(1)
    path = _files(tmp_path, [" ".join(pick.choices(["a", "b", "c d", "e"], k=8)) for _ in range(20)], per_file=3)
    words = lambda lines: with_seq(tokens(lines, "space", keep=ARRIVAL), "pos").select("word", "seq")
    stream = words(scan_text(spark, path, stream=True, max_files_per_trigger=2, arrival=True))
    out = _run(jobs.running_count_stream(stream), "rc_stream", "append", tmp_path)
    batch = words(scan_text(spark, path, arrival=True))
    numbered = batch.withColumn("n", F.row_number().over(Window.orderBy("seq")))
    want = running_count(numbered.withColumn("n", F.col("n").cast("long")), "word", "n")
    key = lambda df: [(r.word, r.cnt) for r in df.collect()]
    assert key(out.orderBy("seq")) == key(want.orderBy("n"))


def test_arrival_order_of_a_file_read_in_blocks(spark, tmp_path):
    """A large file is read by several tasks, and its lines are in their order."""
    lines = [f"line {i} " + "x" * (i % 90) for i in range(40_000)]
    for k in (1, 0):
        (tmp_path / "big").mkdir(exist_ok=True)
        f = tmp_path / "big" / f"{k}.txt"
        f.write_text("\n".join(f"{k} {x}" for x in lines) + "\n")
        os.utime(f, (1_600_000_000 + k, 1_600_000_000 + k))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        read = scan_text(spark, str(tmp_path / "big"), arrival=True)
        assert read.rdd.getNumPartitions() > 4
        got = [r.line for r in with_seq(read).orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{k} {x}" for k in (0, 1) for x in lines]


def test_running_median_stream_of_many_values(spark, tmp_path):
    pick = random.Random(2)
    nums = [pick.choice([pick.randint(0, 5), pick.randint(0, 10 ** 6)]) for _ in range(900)]
    path = _files(tmp_path, [f"{i},k,{n}" for i, n in enumerate(nums)], per_file=300)
    from tidepool.functions.parse import parse_event_line
    src = parse_event_line(_stream_lines(spark, path))
    src = src.select("word", "ts_ms", F.when(F.col("ts_ms") != 7, F.col("num").cast("double")).alias("num"))
    out = _run(jobs.running_median_stream(src, "word", "ts_ms", "num"), "median_many", "append", tmp_path)
    got = [r.median for r in out.orderBy("ts_ms").collect()]
    seen = [n for i, n in enumerate(nums) if i != 7]
    assert got == [statistics.median(seen[:i + 1 - (i >= 7)]) for i in range(900)]


def test_windows_fire_at_their_end_and_for_each_late_row(spark, tmp_path):
    """First firing at the end, one corrected row per late arrival inside the lateness, the side output only beyond."""
    base = 1_634_473_760_000
    lines = [f"o{i},7,{m},{base + t}" for i, (m, t) in enumerate([
        (1, 1000), (2, 2000), (4, 6000),  # the watermark passes 5 s
        (8, 3000), (16, 4000),            # late, inside the lateness: firings 2 and 3
        (32, 8500),                       # the watermark passes 5 s + 3 s
        (64, 1500),                       # beyond it
        (128, 9000), (256, 30000), (512, 30001)])]
    path = _files(tmp_path, lines)
    orders, _ = parse_orders(_stream_lines(spark, path).withColumn("seq", F.lit(0).cast("long")), keep=("seq",))
    out = _run(jobs.late_split_stream(orders, 5000, 0, 3000), "late_fire", "append", tmp_path)
    got = rows(out.where(F.col("window_start") < base + 10_000), "kind", "window_start", "version", "n_orders", "money")
    assert got == [("late", base, 0, 1, 64), ("window", base, 1, 2, 3), ("window", base, 2, 3, 11), ("window", base, 3, 4, 27),
                   ("window", base + 5000, 1, 3, 164)]
    last = out.where(f"window_start = {base} and version = 3").first().info
    assert [p.split(",")[0] for p in last.split("Order(orderId=")[1:]] == ["o0", "o1", "o3", "o4"]


def test_processing_time_windows_close_by_themselves(spark, tmp_path):
    path = _files(tmp_path, ["a,1", "b,5", "a,2"], per_file=3)
    df = jobs.closing_sum_stream(parse_word_num(_stream_lines(spark, path)), size="3 seconds", slide="1 second")
    q = (df.writeStream.format("memory").queryName("closing").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "closing-ck")).trigger(processingTime="500 milliseconds").start())
    try:
        wait_for(lambda: spark.table("closing").count() >= 6)  # three windows a key, without further input
        time.sleep(2)
    finally:
        q.stop()
    got = spark.table("closing").collect()
    assert len(got) == 6 and {(r.word, r.total) for r in got} == {("a", 3), ("b", 5)}
    assert len({(r.word, r.window_start) for r in got}) == 6 and all(r.window_end - r.window_start == 3000 for r in got)


def test_buffer_goes_out_by_rows_and_by_time(spark, tmp_path):
    path = _files(tmp_path, [f"k{i},{i}" for i in range(25)], per_file=25)
    root = str(tmp_path / "kv")
    q = kv.buffered_to_kv(parse_word_num(_stream_lines(spark, path)), "word", "num", functools.partial(FileKVClient, root),
                          str(tmp_path / "kv-ck"), flush_rows=10, flush_ms=6000, buffers=1, trigger="500 milliseconds")
    written = lambda: FileKVClient.read_all(root)[0] if os.path.isdir(root) else {}
    try:
        wait_for(lambda: written())
        assert len(written()) == 20  # two whole buffers at once; five rows wait
        wait_for(lambda: len(written()) == 25)  # and go without new input
    finally:
        q.stop()
    assert written() == {f"k{i}": str(i) for i in range(25)}


def test_buffer_survives_a_restart(spark, tmp_path):
    path = _files(tmp_path, ["a,1", "b,2", "c,3"], per_file=3)
    root = str(tmp_path / "kv2")

    def start():
        return kv.buffered_to_kv(parse_word_num(_stream_lines(spark, path)), "word", "num", functools.partial(FileKVClient, root),
                                 str(tmp_path / "kv-ck2"), flush_rows=10, flush_ms=8000, buffers=2, trigger="500 milliseconds")
    written = lambda: FileKVClient.read_all(root)[0] if os.path.isdir(root) else {}
    q = start()
    wait_for(lambda: any(x["numInputRows"] == 3 for p in q.recentProgress for x in p["sources"] if "File" in x["description"]))
    q.stop()
    assert not written()
    q = start()  # nothing new to read
    try:
        wait_for(lambda: len(written()) == 3)
    finally:
        q.stop()
    assert written() == {"a": "1", "b": "2", "c": "3"}
