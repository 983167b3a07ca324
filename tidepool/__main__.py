"""Command line: run a registered query, or a streaming job over a directory.

  python -m tidepool list
  python -m tidepool run word_count --tables /data/tables --out /data/out/wc [--format parquet|text|print]
  python -m tidepool run word_count --tables /data/tables --format preview --limit 20
  python -m tidepool stream word_count --input /data/lines --out /data/out/wc --checkpoint /shared/ckpt/wc

On a cluster, submit with spark-submit; the session comes from the launcher
and streaming checkpoints default to a folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidepool.plans.catalog import REGISTRY
from tidepool.session import DEFAULT_CONF, shared_dir, subdir


def _session() -> SparkSession:
    # the UI is a static setting: switch it off before the context exists
    builder = SparkSession.builder.appName("tidepool").config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None and not k.startswith("spark.ui"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static confs are fixed at launch
                pass
    shared_dir(spark)
    return spark


def _run(args) -> None:
    spark = _session()
    df = REGISTRY[args.query].run(spark, args.tables)
    if args.format == "preview":
        df.show(args.limit, truncate=False)
    elif args.format == "print":
        for r in df.toLocalIterator():  # all rows, a partition at a time
            print(*r, sep=",")
    elif args.format == "text":
        from tidepool.sinks.text import write_text
        write_text(df, args.out)
    else:
        df.write.mode("overwrite").parquet(args.out)


STREAM_JOBS = ("word_count", "running_count", "closing_sum", "late_split", "count_window", "daily_uv_cumulative", "running_median", "top_n",
               "tumbling_sum", "sliding_sum", "day_window", "daily_uv")


def _stream(args) -> None:
    from pyspark.sql import functions as F

    from tidepool.functions.parse import (
        parse_behavior_csv, parse_event_line, parse_orders, parse_visits, parse_word_num,
    )
    from tidepool.functions.text import tokens
    from tidepool.operators.windows import processing_time_sliding_sum
    from tidepool.sinks.text import labelled_printer
    from tidepool.sources.files import ARRIVAL, scan_text, with_seq
    from tidepool.streaming import jobs

    spark = _session()
    lines = scan_text(spark, args.input, stream=True, max_files_per_trigger=args.files_per_batch,
                      arrival=args.job in ("late_split", "count_window", "running_count"))
    mode = "append"
    if args.job == "word_count":
        df, mode = jobs.word_count_stream(lines), "update"
    elif args.job == "late_split":
        orders, _ = parse_orders(with_seq(lines), keep=("seq",))
        df = jobs.late_split_stream(orders, 5000, args.lag_ms, args.lateness_ms, args.zone)
    elif args.job == "running_count":  # words split at single spaces, each with its count so far
        df = jobs.running_count_stream(with_seq(tokens(lines, "space", keep=ARRIVAL), "pos"))
    elif args.job == "closing_sum":  # word,num lines, processing-time 5 s windows sliding by 1 s, each once, at its end
        df = jobs.closing_sum_stream(parse_word_num(lines), heartbeat=not args.available_now)
    elif args.job == "count_window":  # words split at single spaces, in arrival order, five of a word per window
        words = with_seq(tokens(lines, "space", keep=ARRIVAL), "pos")
        df = jobs.count_window_stream(words.select("word", "seq", F.lit(1).cast("long").alias("num")), n=5)
    elif args.job == "daily_uv_cumulative":
        visits, _ = parse_visits(lines)
        df = jobs.daily_uv_cumulative_stream(visits, args.zone, f"{max(args.lag_ms, 1000)} milliseconds")
    elif args.job == "running_median":
        ev = parse_event_line(lines, zone=args.zone)
        df = jobs.running_median_stream(ev, "word", "ts_ms", "num")
    elif args.job == "top_n":  # behaviour CSV lines, 1 h windows sliding by 5 min
        df = jobs.top_n_stream(parse_behavior_csv(lines), 5, f"{args.lag_ms} milliseconds")
    elif args.job == "tumbling_sum":  # time,word,num lines
        ev = parse_event_line(lines, zone=args.zone)
        df = jobs.tumbling_sum_stream(ev, "word", "ts_ms", "num", "5 seconds", f"{args.lag_ms} milliseconds")
    elif args.job == "sliding_sum":  # word,num lines, processing-time 5 s windows sliding by 1 s
        df, mode = processing_time_sliding_sum(parse_word_num(lines), "word", "num"), "update"
    elif args.job == "day_window":  # time,word,num lines, calendar days in --zone
        ev = parse_event_line(lines, zone=args.zone)
        df = jobs.day_window_stream(ev, "word", "ts_ms", args.zone, f"{args.lag_ms} milliseconds")
    else:  # daily_uv: exact per app and day (bitmaps), one row per closed day
        visits, _ = parse_visits(lines)
        df = jobs.daily_uv_stream(visits, f"{max(args.lag_ms, 1000)} milliseconds",
                                  f"{args.zone_offset_ms // 1000} seconds")
    ckpt = args.checkpoint or subdir(spark, f"stream-{args.job}")

    def start():
        writer = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
        if args.out and mode == "append":
            writer = writer.format("parquet").option("path", args.out)
        elif args.out:
            writer = writer.foreachBatch(jobs.write_changes(args.out))
        else:
            writer = writer.foreachBatch(labelled_printer(args.job))
        return writer.start()

    if args.available_now:
        q = start()
        q.processAllAvailable()
        q.stop()
    else:
        jobs.supervise(start, args.restarts, args.restart_delay_s)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidepool")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    r = sub.add_parser("run", help="run a registered batch query")
    r.add_argument("query", choices=sorted(REGISTRY))
    r.add_argument("--tables", required=True, help="folder with <table>.parquet")
    r.add_argument("--out")
    r.add_argument("--format", choices=["parquet", "text", "print", "preview"], default="parquet")
    r.add_argument("--limit", type=int, default=20, help="rows of a preview")
    s = sub.add_parser("stream", help="run a streaming job over a directory of text files")
    s.add_argument("job", choices=STREAM_JOBS)
    s.add_argument("--input", required=True)
    s.add_argument("--out")
    s.add_argument("--checkpoint")
    s.add_argument("--files-per-batch", type=int, default=1)
    s.add_argument("--lag-ms", type=int, default=0)
    s.add_argument("--lateness-ms", type=int, default=0, help="late_split: how long a window takes late rows")
    s.add_argument("--zone", default="UTC")
    s.add_argument("--zone-offset-ms", type=int, default=0)
    s.add_argument("--restarts", type=int, default=1, help="restarts after a failure")
    s.add_argument("--restart-delay-s", type=float, default=10.0)
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    args = p.parse_args(argv)
    if args.cmd == "list":
        for name, q in REGISTRY.items():
            print(f"{name:22s} {q.doc.splitlines()[0] if q.doc else ''}")
        return 0
    if args.cmd == "run":
        if args.format in ("parquet", "text") and not args.out:
            p.error("--out is required for --format parquet and text")
        _run(args)
        return 0
    _stream(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
