"""Plan-shape tests: the scale properties the README claims, read from explain()."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        E.queries()[name](spark, SF).explain("formatted")
    return buf.getvalue()


def tree(p: str) -> str:
    return p.split("\n\n")[0]


def test_word_count_prunes_columns_and_combines_map_side(spark):
    p = plan(spark, "word_count")
    assert "ReadSchema: struct<text:string>" in p
    assert "partial_count" in p                      # map-side combine before the shuffle
    assert "PushedFilters: [IsNotNull(text)" in p


def test_cumulative_uv_single_scan_three_shuffles(spark):
    t = tree(plan(spark, "daily_uv_cumulative"))
    assert t.count("Scan parquet") == 1 and "Expand" in t
    assert len(re.findall(r"[+\- ]Exchange \(", t)) == 3


def test_top_n_limits_before_shuffle(spark):
    t = tree(plan(spark, "top_n_per_window"))
    assert t.count("WindowGroupLimit") == 2          # partial limit below the exchange, final above


@pytest.mark.parametrize("name,keys", [("running_count", "word"), ("count_window", "word"),
                                       ("uv_running", "app_id")])
def test_ordered_windows_partition_by_key_and_chunk(spark, name, keys):
    p = plan(spark, name)
    # the ordered window runs per (key, chunk), never per key alone
    assert re.search(rf"hashpartitioning\({keys}#\d+L?,( day_start#\d+L,)? _chunk#\d+L", p), p
    assert "Window" in p


def test_bitmap_uv_dedupes_before_sorting(spark):
    t = tree(plan(spark, "uv_bitmap"))
    lines = [ln.strip(" +-:|") for ln in t.splitlines()]
    sort_agg = max(i for i, ln in enumerate(lines) if ln.startswith("SortAggregate"))
    assert any(ln.startswith("HashAggregate") for ln in lines[sort_agg + 1:])


def test_no_forced_broadcast(spark):
    for name in ("join_dim_lookup", "enrich_lookup", "running_count", "late_split", "late_split_events",
                 "uv_running", "median_by_key"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            E.queries()[name](spark, SF).explain(True)
        assert "broadcast" not in buf.getvalue().split("== Optimized Logical Plan ==")[0].lower().replace(
            "broadcastexchange", "").replace("broadcasthashjoin", ""), name


def test_prefix_plans_have_no_join(spark):
    """Chunk offsets ride as marker rows in the ordered window: no join."""
    for name in ("running_count", "count_window", "late_split", "uv_running"):
        t = tree(plan(spark, name))
        assert "Join" not in t and "Union" in t, name


@pytest.mark.parametrize("seqs", [range(20_000), [i << 21 for i in range(20_000)],
                                  [10 ** 9 + i if i < 15_000 else i for i in range(20_000)]])
def test_chunks_follow_the_rows(spark, seqs):
    """Dense, sparse and bursty orders: rows per chunk and chunks per key stay bounded."""
    from pyspark.sql import functions as F

    from tidepool.operators.prefix import bucket_of, chunk_bounds, running_agg
    df = spark.createDataFrame([(q, i % 3) for i, q in enumerate(seqs)], "q long, k long")
    bounds = chunk_bounds(df, "q", 2000)
    per_chunk = [r["count"] for r in df.groupBy(bucket_of(F.col("q"), bounds).alias("c")).count().collect()]
    assert 8 <= len(per_chunk) <= 11 and max(per_chunk) <= 3000
    got = running_agg(df, ["k"], ["q"], None, "count", "c", chunk_rows=2000).orderBy("q").collect()
    seen = {}
    for r in got:
        seen[r.k] = seen.get(r.k, 0) + 1
        assert r.c == seen[r.k]


def test_registered_prefix_queries_run_many_chunks(spark):
    from tidepool.operators.prefix import chunk_bounds
    from tidepool.sources import tables as TB
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    assert len(chunk_bounds(events, "event_id", 2000)) >= 4
    assert len(chunk_bounds(TB.events_as_orders(events), "seq", 2000)) >= 4


@pytest.mark.parametrize("name", ["tumbling_sum", "parse_event_line", "parse_word_num", "scan_behavior_csv"])
def test_a_strict_check_makes_and_splits_its_line_once(spark, name):
    p = plan(spark, name)
    assert p.count("get_json_object(") == 1 and p.count("concat_ws(") == 1
    assert len(re.findall(r"(?<!_)split\(", p)) == 1
