"""Property tests: Java split emulation; stream result equals batch result."""

import os
import re

from hypothesis import given, settings, strategies as st

from conftest import rows
from tidepool.functions.text import java_split

_RULES = {"ws_single": r"[ \t\n\x0b\f\r]", "ws_run": r"[ \t\n\x0b\f\r]+", "space": " "}


def java_split_reference(s: str, pattern: str) -> list[str]:
    """Java String.split(regex): split, then drop trailing empty strings;
    an input without any match is returned whole."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\x0b\n", max_size=8), min_size=1, max_size=12))
def test_java_split_matches_reference(spark, lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, s string")
    out = df.select("i", *[java_split("s", r).alias(r) for r in _RULES]).collect()
    for r in out:
        for rule, pat in _RULES.items():
            assert list(r[rule]) == java_split_reference(lines[r.i], pat), (lines[r.i], rule)


def test_tumbling_stream_equals_batch_on_events(spark, tmp_path):
    """Replay events (time-ordered) as one file per micro-batch; every window
    the stream closed equals the batch result for that window."""
    from pyspark.sql import functions as F
    from tidepool.functions.timefmt import utc_ntz_to_ms
    from tidepool.operators.windows import tumbling_sum
    from tidepool.streaming.jobs import run_to_memory, tumbling_sum_stream

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_id"), F.col("event_type").alias("word"), utc_ntz_to_ms("ts").alias("t"),
        F.get_json_object("props", "$.k").cast("bigint").alias("num"))
    src = tmp_path / "events-replay"
    n, per = 5, 200
    for i in range(n):  # events are time-ordered by event_id: 5 consecutive slices
        ev.where((F.col("event_id") >= i * per) & (F.col("event_id") < (i + 1) * per)).coalesce(1) \
            .write.parquet(str(src / f"b{i}"))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i in range(n):
        (f,) = (src / f"b{i}").glob("*.parquet")
        tgt = flat / f"{i:03d}.parquet"
        tgt.write_bytes(f.read_bytes())
        os.utime(tgt, (1_600_000_000 + i, 1_600_000_000 + i))  # replay order = mtime
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(flat))
    q = run_to_memory(tumbling_sum_stream(stream, "word", "t", "num", "1 hour", "0 seconds"), "ev_tumble",
                      checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    got = rows(spark.table("ev_tumble"))
    max_t = ev.agg(F.max("t")).first()[0]
    closed = [r for r in rows(tumbling_sum(ev, "word", "t", "num", "1 hour")) if r[2] <= max_t]
    assert got == closed and len(got) > 100


def test_daily_uv_stream_equals_batch_on_events(spark, tmp_path):
    """Three chained stateful stages (first-visit flags, 1 s windows, per-day
    totals) against the batch plan on the real events table."""
    from pyspark.sql import functions as F
    from tidepool.operators.uv import daily_uv_cumulative
    from tidepool.sources.tables import visits
    from tidepool.streaming.jobs import daily_uv_cumulative_stream, run_to_memory

    v = visits(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    flat = tmp_path / "visits"
    n, per = 5, 200
    for i in range(n):
        out = tmp_path / f"v{i}"
        v.where((F.col("seq") >= i * per) & (F.col("seq") < (i + 1) * per)).coalesce(1).write.parquet(str(out))
        (f,) = out.glob("*.parquet")
        flat.mkdir(exist_ok=True)
        tgt = flat / f"{i:03d}.parquet"
        tgt.write_bytes(f.read_bytes())
        os.utime(tgt, (1_600_000_000 + i, 1_600_000_000 + i))
    stream = spark.readStream.schema(v.schema).option("maxFilesPerTrigger", 1).parquet(str(flat))
    q = run_to_memory(daily_uv_cumulative_stream(stream, "UTC", "1 second"), "uv_replay", checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    got = rows(spark.table("uv_replay").select("app_id", "window_start", "day_uv"))
    max_t = v.agg(F.max("visit_time")).first()[0]
    batch = rows(daily_uv_cumulative(v, "UTC").where(F.col("window_start") + 1000 <= max_t - 1000)
                 .select("app_id", "window_start", "day_uv"))
    assert got == batch and len(got) > 500


def _replay_events(spark, tmp_path, n=5, per=200):
    from pyspark.sql import functions as F
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("word"), "user_id", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("num"))
    flat = tmp_path / "events-flat"
    flat.mkdir()
    for i in range(n):
        out = tmp_path / f"e{i}"
        ev.where((F.col("seq") >= i * per) & (F.col("seq") < (i + 1) * per)).coalesce(1).write.parquet(str(out))
        (f,) = out.glob("*.parquet")
        tgt = flat / f"{i:03d}.parquet"
        tgt.write_bytes(f.read_bytes())
        os.utime(tgt, (1_600_000_000 + i, 1_600_000_000 + i))
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(str(flat))
    return ev, stream


def test_count_window_and_running_median_streams_equal_batch(spark, tmp_path):
    from tidepool.operators.median import running_median
    from tidepool.operators.windows import count_window
    from tidepool.streaming.jobs import count_window_stream, run_to_memory, running_median_stream
    ev, stream = _replay_events(spark, tmp_path)
    q1 = run_to_memory(count_window_stream(stream, "word", "seq", "num", 5), "cw_replay",
                       checkpoint=str(tmp_path / "ck1"))
    q2 = run_to_memory(running_median_stream(stream, "user_id", "seq", "value"), "med_replay",
                       checkpoint=str(tmp_path / "ck2"))
    for q in (q1, q2):
        q.processAllAvailable()
        q.stop()
    assert rows(spark.table("cw_replay")) == rows(count_window(ev, "word", "seq", "num", 5))
    assert rows(spark.table("med_replay"), "user_id", "seq", "median") == \
        rows(running_median(ev, "user_id", "seq", "value"), "user_id", "seq", "median")


def test_results_depend_on_arrival_seq_not_physical_order(spark):
    """Seeded shuffles of the physical row order leave every order-dependent
    result unchanged: arrival is the ``seq`` column, never the row position."""
    from pyspark.sql import functions as F
    from tidepool.operators.late import late_split
    from tidepool.operators.median import running_median
    from tidepool.operators.windows import count_window
    from tidepool.operators.wordcount import running_count
    from tidepool.sources.tables import events_as_orders
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    orders = events_as_orders(ev)
    recs = ev.select(F.col("event_id").alias("seq"), F.col("event_type").alias("word"), "user_id", "value",
                     F.get_json_object("props", "$.k").cast("bigint").alias("num"))
    jobs = [
        lambda o, r: late_split(o, 60_000, 600_000, 0, chunk_span=1 << 26),
        lambda o, r: count_window(r, "word", "seq", "num", 5, chunk_span=64),
        lambda o, r: running_count(r, "word", "seq", chunk_span=64).select("seq", "word", "cnt"),
        lambda o, r: running_median(r, "user_id", "seq", "value").select("seq", "median"),
    ]
    base = [rows(job(orders, recs)) for job in jobs]
    for seed in (1, 2):
        o = orders.repartition(5).orderBy(F.rand(seed))
        r = recs.repartition(5).orderBy(F.rand(seed))
        assert [rows(job(o, r)) for job in jobs] == base


def test_late_split_batch_formula_equals_streaming(spark, tmp_path):
    """Seeded out-of-order orders, one row per micro-batch through the
    streaming processor (Spark's own watermark), against the batch formula:
    the same rows are late and every window the stream closed has the same
    content."""
    import random
    from pyspark.sql import functions as F
    from tidepool.functions.parse import parse_orders
    from tidepool.operators.late import late_split
    from tidepool.sources.files import scan_text
    from tidepool.streaming.jobs import late_split_stream, run_to_memory

    rnd = random.Random(23)
    base = 1_700_000_000_000
    times = sorted(base + rnd.randint(0, 40_000) for _ in range(14))
    arrival = times[:]
    for _ in range(6):  # local disorder
        i = rnd.randrange(len(arrival) - 2)
        arrival[i], arrival[i + 2] = arrival[i + 2], arrival[i]
    lines = [f"o{i},{rnd.choice([1, 2])},{rnd.randint(1, 50)},{t}" for i, t in enumerate(arrival)]
    src = tmp_path / "late-in"
    src.mkdir()
    for i, line in enumerate(lines):
        f = src / f"{i:03d}.txt"
        f.write_text(line + "\n")
        os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))
    stream_orders, _ = parse_orders(scan_text(spark, str(src), True, 1).withColumn("seq", F.lit(0).cast("long")),
                                    keep=("seq",))
    q = run_to_memory(late_split_stream(stream_orders, 5000, 2000, 0), "late_prop", checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    streamed = spark.table("late_prop")

    batch_lines = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "seq long, line string")
    batch_orders, _ = parse_orders(batch_lines, keep=("seq",))
    batch = late_split(batch_orders, 5000, 2000, 0, chunk_span=4)
    final_wm = max(arrival) - 2000
    cols = ("kind", "user_id", "window_start", "window_end", "n_orders", "money", "info")
    expect = rows(batch.where((F.col("kind") == "late") | (F.col("window_end") <= final_wm)), *cols)
    got = rows(streamed, *cols)
    assert got == expect
    assert any(r[0] == "late" for r in got) and any(r[0] == "window" for r in got)
