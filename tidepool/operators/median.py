"""Medians: per key, and running (after every insert) per key.

Odd counts give the middle value, even counts the mean of the two middle
values — the 0.5 percentile with linear interpolation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.order_stats import RunningMedian
from tidepool.operators.prefix import bucket_of, chunk_bounds


def median_by_key_builtin(df: DataFrame, key: str, value: str, out: str = "median") -> DataFrame:
    """Exact median per key with the built-in aggregate. Its buffer is a map
    of every distinct value of the key, merged in one task: fine for modest
    groups, unbounded for a hot key with many distinct values."""
    return df.groupBy(key).agg(F.median(value).alias(out))


def median_by_key(df: DataFrame, key: str, value: str, out: str = "median", accuracy: int = 2000) -> DataFrame:
    """Exact median per key without gathering a key's values in one task.

    1. Per key, a quantile summary (a sketch of fixed size, combined map-side)
       gives a bracket: its rank error is at most ``n / accuracy``, so the
       values two such errors left and right of the middle enclose the median
       (a key of up to ``4 * accuracy`` rows takes its whole range).
    2. Rows are counted below and above the bracket and, inside it, per
       (key, value) — shuffled on the value too, so a hot key spreads.
    3. Only the distinct values inside the bracket, about ``4 / accuracy`` of
       a hot key's rows, are ranked.
    Nulls are ignored and NaN is the largest value, as by ``median``.
    """
    x = F.col(value).cast("double")
    vals = df.select(F.col(key).alias("_k"), x.alias("_raw")).where(F.col("_raw").isNotNull()).select(
        "_k", F.isnan("_raw").alias("_nan"), F.when(F.isnan("_raw"), float("inf")).otherwise(F.col("_raw")).alias("_x"))
    margin = 2 / accuracy
    quantiles = F.percentile_approx("_x", [0.5 - margin, 0.5 + margin], accuracy)
    small = F.col("_n") <= 4 * accuracy
    brackets = vals.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
                                      quantiles.alias("_q")).select(
        F.col("_k").alias("_bk"), "_n", F.when(small, F.col("_lo")).otherwise(F.col("_q")[0]).alias("_from"),
        F.when(small, F.col("_hi")).otherwise(F.col("_q")[1]).alias("_to"))
    zone = F.when(F.col("_x") < F.col("_from"), -1).when(F.col("_x") > F.col("_to"), 1).otherwise(0)
    placed = vals.join(brackets, F.col("_k").eqNullSafe(F.col("_bk"))).withColumn("_zone", zone)
    inside = F.col("_zone") == 0
    counted = placed.groupBy("_k", "_n", "_zone", F.when(inside, F.col("_x")).alias("_v"),
                             F.when(inside, F.col("_nan")).alias("_vn")).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy("_k").orderBy("_zone", "_v", "_vn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_cum", F.sum("_c").over(upto))
    r_lo, r_hi = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    holds = lambda r: (F.col("_cum") - F.col("_c") < r) & (r <= F.col("_cum"))
    shown = F.when(F.col("_vn"), float("nan")).otherwise(F.col("_v"))
    picked = ranked.where(holds(r_lo) | holds(r_hi)).groupBy("_k").agg(
        F.max(F.when(holds(r_lo), shown)).alias("_lo"), F.max(F.when(holds(r_hi), shown)).alias("_hi"))
    return picked.select(F.col("_k").alias(key), ((F.col("_lo") + F.col("_hi")) / 2).alias(out))


def running_median_window(df: DataFrame, key: str, seq: str, value: str, out: str = "median") -> DataFrame:
    """Running median as a window aggregate (JVM only).

    ``percentile`` over a growing frame re-sorts its value-count map for every
    row, O(n * d log d) per key: fine for short keys or few distinct values,
    quadratic for a hot key with many distinct values. ``running_median`` is
    the general form.
    """
    w = Window.partitionBy(key).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.percentile(F.col(value), F.lit(0.5)).over(w))


def running_median(df: DataFrame, key: str, seq: str, value: str, out: str = "median",
                   hot_rows: int = 50_000, chunk_rows: int = 20_000) -> DataFrame:
    """Median of each key's values seen so far, one row per input row.

    Keys of up to ``hot_rows`` rows are sorted by ``seq`` within hash
    partitions and streamed through, one key's values at a time. A hotter key
    is cut into arrival chunks of about ``chunk_rows`` rows, which run side by
    side: inside a chunk the median moves by at most the chunk's rows, so a
    chunk needs, of the earlier values, only those that close to the median
    it starts from, and the counts below and above them. These values travel
    as (value, count), so equal ones cost one pair a chunk however many rows
    have them. Null and NaN values are ignored; a null key is a key; ``seq``
    orders the rows of a key.
    """
    from tidepool.session import ship_package

    ship_package(df.sparkSession)
    src = df.select(key, seq, F.col(value).cast("double").alias(value))
    hot = src.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows")).where(
        F.col("_rows") > hot_rows).select("_hot")
    if hot.isEmpty():
        return _streamed(_one_chunk(src, seq, value), key, seq, value, out, src.schema)
    on = F.col(key).eqNullSafe(F.col("_hot"))
    cold = _one_chunk(src.join(hot, on, "left_anti"), seq, value)
    return _streamed(cold.unionByName(_chunked(src.join(hot, on, "left_semi"), key, seq, value, chunk_rows)),
                     key, seq, value, out, src.schema)


def _one_chunk(src: DataFrame, seq: str, value: str) -> DataFrame:
    return src.select("*", F.lit(0).cast("bigint").alias("_chunk"), F.lit(1).alias("_kind"), F.col(seq).alias("_at"),
                      F.col(value).alias("_x"), F.lit(0).cast("bigint").alias("_n"), F.lit(0).cast("bigint").alias("_above"))


def _chunked(src: DataFrame, key: str, seq: str, value: str, chunk_rows: int) -> DataFrame:
    """The rows by chunk (kind 1), and before them what the chunk needs of earlier rows (kind 0: a value and its
    count ``_n``; -1: the counts ``_n`` below and ``_above``)."""
    x = F.when(~F.isnan(value), F.col(value))
    rows = src.withColumn("_x", x).withColumn("_chunk", bucket_of(F.col(seq), chunk_bounds(src, seq, chunk_rows)))
    rows = rows.withColumn("_vb", bucket_of(F.col("_x"), chunk_bounds(rows, "_x", chunk_rows)))
    counted = rows.where(F.col("_x").isNotNull()).groupBy(key, "_chunk", "_vb", "_x").agg(F.count(F.lit(1)).alias("_n"))
    # Earlier rows per (chunk, value bucket): the grid's running sums over chunks, SEGMENTS * SEGMENTS cells a key at most.
    grid = counted.groupBy(key, "_chunk", "_vb").agg(F.sum("_n").alias("_c"))
    chunks = rows.groupBy(key, "_chunk").agg(F.count("_x").alias("_own"))
    buckets = grid.select(F.col(key).alias("_bk"), "_vb").distinct()
    cells = chunks.join(buckets, F.col(key).eqNullSafe(F.col("_bk"))).drop("_bk")
    filled = cells.unionByName(grid, allowMissingColumns=True).groupBy(key, "_chunk", "_vb").agg(
        F.max("_own").alias("_own"), F.coalesce(F.max("_c"), F.lit(0)).alias("_c"))
    before = Window.partitionBy(key, "_vb").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    prior = filled.withColumn("_c", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    by_value = Window.partitionBy(key, "_chunk").orderBy("_vb")
    prior = prior.withColumn("_cum", F.sum("_c").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    prior = prior.withColumn("_all", F.sum("_c").over(Window.partitionBy(key, "_chunk")))
    reach = F.col("_own") + 2
    near = prior.where((F.col("_c") > 0) & (F.col("_cum") > F.col("_all") / 2 - reach)
                       & (F.col("_cum") - F.col("_c") < F.col("_all") / 2 + reach))
    sides = near.groupBy(key, "_chunk").agg(F.min(F.col("_cum") - F.col("_c")).alias("_n"),
                                            (F.max("_all") - F.max("_cum")).alias("_above"))
    wanted = near.select(F.col(key).alias("_wk"), F.col("_chunk").alias("_for"), F.col("_vb").alias("_wb"))
    context = counted.join(wanted, F.col(key).eqNullSafe(F.col("_wk")) & (F.col("_vb") == F.col("_wb"))
                           & (F.col("_chunk") < F.col("_for"))).groupBy(key, F.col("_for").alias("_chunk"), "_x").agg(F.sum("_n").alias("_n"))
    data = rows.select(key, seq, value, "_chunk", F.lit(1).alias("_kind"), F.col(seq).alias("_at"), "_x")
    parts = data.unionByName(context.withColumn("_kind", F.lit(0)), allowMissingColumns=True).unionByName(
        sides.withColumn("_kind", F.lit(-1)), allowMissingColumns=True)
    return parts.withColumn("_n", F.coalesce("_n", F.lit(0))).withColumn("_above", F.coalesce("_above", F.lit(0)))


def _streamed(rows: DataFrame, key: str, seq: str, value: str, out: str, schema: T.StructType) -> DataFrame:
    """Each (key, chunk) in order: counts, earlier values with theirs, then its rows with their medians."""
    import pyarrow as pa

    cols = [key, "_chunk", "_kind", "_x", "_n", "_above", seq, value]
    done = T.StructType([*schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches):
        current, med, context, sides = object(), None, [], (0, 0)
        for batch in batches:
            keep, medians = [], []
            where, kinds, xs = (batch.column(k).to_pylist() for k in (1, 2, 3))
            first = min(kinds, default=1)  # only what comes before rows has counts
            below, above = (batch.column(k).to_pylist() for k in (4, 5)) if first < 1 else ((), ())
            for i, k in enumerate(batch.column(0).to_pylist()):
                here = ("nan" if k != k else k, k is None, where[i])
                if here != current:
                    current, med, context, sides = here, None, [], (0, 0)
                if kinds[i] < 0:
                    sides = (below[i], above[i])
                elif kinds[i] == 0:
                    context.append((xs[i], below[i]))
                else:
                    if med is None:
                        med = RunningMedian(context, *sides)
                        last = med.median()
                    if xs[i] is not None and xs[i] == xs[i]:
                        last = med.add(xs[i])
                    keep.append(i)
                    medians.append(last)
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(6), kept.column(7), pa.array(medians, pa.float64())], [key, seq, value, out])

    # "_at" is the row's order (null for what comes before the rows), "_x" orders the earlier values.
    ordered = rows.repartition(key, "_chunk").sortWithinPartitions(key, "_chunk", "_kind", "_at", "_x")
    return ordered.select(*cols).mapInArrow(run, done)
