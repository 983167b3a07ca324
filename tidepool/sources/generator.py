"""Random order generator: ``(order_id, user_id, money, pay_time)``.

Streaming: the ``rate`` source drives ``rows_per_second`` rows in each of its
partitions (subtasks), with ``uuid()``, a user in 1..4, money in 1..100 and
the current time. Batch: one generated order per input row, from the md5 of
the seed and the row's key, so reruns (and retried tasks) give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The generator's ranges (inclusive).
USER_MIN, USER_MAX = 1, 4
MONEY_MIN, MONEY_MAX = 1, 100


def _uniform(hexed: F.Column, lo: int, hi: int) -> F.Column:
    return (F.conv(hexed, 16, 10).cast("bigint") % F.lit(hi - lo + 1) + F.lit(lo)).cast("int")


def gen_orders_batch(keys: DataFrame, key: str, time_ms: F.Column, seed: int = 42) -> DataFrame:
    """One order per row of ``keys``; the id is the md5 in UUID form, its first
    and last eight digits choose the user and the money."""
    md = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    order_id = F.concat_ws("-", *[F.substring(md, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return keys.select(order_id.alias("order_id"), _uniform(F.substring(md, 1, 8), USER_MIN, USER_MAX).alias("user_id"),
                       _uniform(F.substring(md, 25, 8), MONEY_MIN, MONEY_MAX).alias("money"), time_ms.alias("pay_time"))


def gen_orders_stream(spark: SparkSession, rows_per_second: int = 1, partitions: int | None = None,
                      micro_batch: bool = False) -> DataFrame:
    """Unbounded generated orders, ``rows_per_second`` in each of ``partitions``
    subtasks (``rate-micro-batch``, so many rows per batch, for deterministic tests)."""
    partitions = partitions or spark.sparkContext.defaultParallelism
    name, rate = ("rate-micro-batch", "rowsPerBatch") if micro_batch else ("rate", "rowsPerSecond")
    df = (spark.readStream.format(name).option(rate, rows_per_second * partitions)
          .option("numPartitions", partitions).load())
    return df.select(
        F.expr("uuid()").alias("order_id"),
        (F.floor(F.rand() * (USER_MAX - USER_MIN + 1)) + USER_MIN).cast("int").alias("user_id"),
        (F.floor(F.rand() * (MONEY_MAX - MONEY_MIN + 1)) + MONEY_MIN).cast("int").alias("money"),
        F.unix_millis(F.col("timestamp")).alias("pay_time"),
    )
