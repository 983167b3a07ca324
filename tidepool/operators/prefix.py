"""Running (prefix) aggregates that stay parallel when one key is hot.

A window ``partitionBy(key).orderBy(seq)`` sends every row of a key to one
task. If one key holds a third of the data, that task holds a third of the
data. Instead the order is cut into chunks:

1. aggregate every (key, chunk) — partial aggregation, small output;
2. prefix over chunk totals per key — a window over the chunk totals only:
   the offset each chunk starts from;
3. add one marker row per (key, chunk) carrying that offset, ordered before
   the chunk's rows, and run the running aggregate inside each (key, chunk).

Step 3 is a union plus one ordered window: no join, no broadcast, and the big
side is shuffled exactly once, on (key, chunk). Null keys are a group of
their own, as in any window. With no keys the same plan gives a global prefix
(e.g. a running maximum over arrival order), where step 2 sees one row per
chunk.

Chunks are cut at approximate quantiles of the order column, so they hold about
``chunk_rows`` rows whether the order values are dense, sparse or bursty (rows
with one order value stay together). The cuts form a tree of two levels: at
most ``SEGMENTS`` segments of all rows, and where those would hold more than
``chunk_rows`` rows, as many chunks of each segment, cut at the segment's own
quantiles. The prefix over chunk totals follows the tree: over the chunks of a
segment, then over the segments, so no window has more than ``SEGMENTS`` rows
of a key. There is room for SEGMENTS * SEGMENTS chunks (four million); only
beyond that many times ``chunk_rows`` rows do chunks grow.

The quantiles come from a count and one pass over the order column when the
plan is built, as a range partitioning takes its bounds; they are fixed then,
so a task that runs again cuts alike. A caller that knows its order's density
gives ``chunk_span`` (order units per chunk) and saves these passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AGGS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


SEGMENTS = 2048


def cuts(n: int) -> list[float]:
    return [i / n for i in range(1, n)]


def chunk_bounds(df: DataFrame, order: str, chunk_rows: int, at_most: int = SEGMENTS, rows: int | None = None) -> list:
    """Ascending order values at which a new chunk starts, ``at_most`` chunks."""
    if rows is None:
        rows = df.agg(F.count(order)).first()[0]
    chunks = min(at_most, -(-rows // chunk_rows))
    if chunks < 2:
        return []
    found = df.agg(F.percentile_approx(order, cuts(chunks), max(100, 4 * chunks))).first()[0]
    return sorted(set(found))


def bucket_of(value: Column, bounds: list) -> Column:
    """How many of the ascending ``bounds`` are <= ``value`` (null: 0): a few by comparisons, many by binary search."""
    if not bounds:
        return F.lit(0).cast("bigint")
    if len(bounds) <= 64:
        return reduce(Column.__add__, [F.coalesce(value >= F.lit(b), F.lit(False)).cast("bigint") for b in bounds])
    return search(value, F.array(*[F.lit(b) for b in bounds]), len(bounds))


def search(value: Column, ascending: Column, at_most: int) -> Column:
    steps = [1 << k for k in reversed(range(at_most.bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda pos, step: pos + F.when(F.get(ascending, pos + step - 1) <= value, step).otherwise(0)).cast("bigint")


def with_chunks(df: DataFrame, order: str, out: str, chunk_rows: int, segments: int = SEGMENTS) -> tuple[DataFrame, bool]:
    """``df`` with its chunk in ``out`` (segment * ``segments`` + chunk in it), and whether segments have several."""
    rows = df.agg(F.count(order)).first()[0]
    bounds = chunk_bounds(df, order, chunk_rows, segments, rows)
    segment = bucket_of(F.col(order), bounds)
    each = min(segments, -(-rows // (chunk_rows * segments)))
    if each < 2:
        return df.withColumn(out, segment * F.lit(segments)), False
    # One row per segment, with its inner bounds: segments * segments values at most, taken once.
    kind = T.ArrayType(df.schema[order].dataType)
    inner = df.groupBy(segment.alias("_seg")).agg(F.percentile_approx(order, cuts(each), 4 * each).alias("_inner")).collect()
    table = df.sparkSession.createDataFrame([(r["_seg"], sorted(set(r["_inner"] or []))) for r in inner],
                                            T.StructType([T.StructField("_seg", T.LongType()), T.StructField("_inner", kind)]))
    cut = df.withColumn("_seg", segment).join(F.broadcast(table), "_seg")
    return cut.withColumn(out, F.col("_seg") * F.lit(segments) + search(F.col(order), F.col("_inner"), each)).drop("_seg", "_inner"), True


def before_chunks(totals: DataFrame, keys: list[str], chunk: str, agg_fn, how: str, segments: int, tree: bool) -> DataFrame:
    """``totals`` (keys, chunk, _total) with ``_v``, the aggregate over the key's earlier chunks, and ``_grand``, over all."""
    if not tree:
        every = Window.partitionBy(*keys)
        prior = every.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select("*", agg_fn("_total").over(prior).alias("_v"), agg_fn("_total").over(every).alias("_grand"))
    held = totals.withColumn("_seg", F.floor(F.col(chunk) / F.lit(segments)))
    inside = Window.partitionBy(*keys, "_seg").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_in", agg_fn("_total").over(inside))
    every = Window.partitionBy(*keys)
    earlier = every.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = held.groupBy(*keys, "_seg").agg(agg_fn("_total").alias("_all")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_seg").alias("_s"),
        agg_fn("_all").over(earlier).alias("_out"), agg_fn("_all").over(every).alias("_grand"))
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_seg") == F.col("_s"))
    a, b = F.col("_in"), F.col("_out")
    both = {"max": F.greatest(a, b), "min": F.least(a, b)}.get(how, F.coalesce(a + b, a, b))
    return held.join(segs, on).select(*keys, chunk, both.alias("_v"), "_grand")


def running_agg(df: DataFrame, keys: list[str], order_cols: list[str], value: Column | str | None,
                how: str, out: str, chunk_span: int | None = None, chunk_col: str | None = None,
                total_out: str | None = None, chunk_rows: int = 20_000, segments: int = SEGMENTS) -> DataFrame:
    """Add ``out`` = aggregate of ``value`` over rows with order <= this row's.

    ``order_cols[0]`` must be numeric (it defines the chunk); the rest break
    ties. ``how`` is one of sum, count, max, min; ``count`` ignores ``value``
    and numbers rows 1, 2, ... in order (row_number semantics). Nulls in
    ``value`` are skipped, as by the window aggregates. ``total_out`` adds the
    aggregate over the key's whole group (carried by the marker rows, so it
    costs no extra pass). ``chunk_col`` names a column that holds the chunk.
    """
    if how not in _AGGS:
        raise ValueError(how)
    agg_fn = _AGGS[how]
    v = F.lit(1).cast("bigint") if how == "count" else (F.col(value) if isinstance(value, str) else value)
    chunk, tree = chunk_col or "_chunk", False
    base = df.withColumn("_v", v)
    if chunk_col is None and chunk_span:
        base = base.withColumn(chunk, F.floor(F.col(order_cols[0]) / F.lit(chunk_span)).cast("bigint"))
    elif chunk_col is None:
        base, tree = with_chunks(base, order_cols[0], chunk, chunk_rows, segments)
    base = base.withColumn("_marker", F.lit(1))

    totals = base.groupBy(*keys, chunk).agg(agg_fn("_v").alias("_total"))
    markers = before_chunks(totals, keys, chunk, agg_fn, how, segments, tree).select(
        *keys, chunk, "_v", *(["_grand"] if total_out else [])).withColumn("_marker", F.lit(0))
    if not total_out:  # a marker is only needed where there is an offset
        markers = markers.where(F.col("_v").isNotNull())

    inner = (Window.partitionBy(*keys, chunk).orderBy("_marker", *order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = base.unionByName(markers, allowMissingColumns=True)
    out_df = both.withColumn(out, agg_fn("_v").over(inner))
    if total_out:  # same partitioning and order as ``inner``: no extra shuffle
        out_df = out_df.withColumn(total_out, F.max("_grand").over(
            Window.partitionBy(*keys, chunk).orderBy("_marker", *order_cols)
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    out_df = out_df.where(F.col("_marker") == 1).drop("_v", "_marker", "_grand")
    if chunk_col is None:
        out_df = out_df.drop(chunk)
    return out_df
