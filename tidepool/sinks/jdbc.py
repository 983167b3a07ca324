"""Batched JDBC insert that stays correct when a micro-batch is retried.

Rows are appended with a ``batch_id`` column; before a batch is written, any
rows a failed earlier attempt left under the same ``batch_id`` are deleted
(the delete runs as the JDBC ``sessionInitStatement`` of a zero-row read).
Inserts go in JDBC batches of ``batchsize`` rows from every partition in
parallel; a failed task is retried by Spark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the insert batch size of the orders sink.
BATCH_SIZE = 1000


def _opts(url: str, table: str, properties: dict | None) -> dict:
    o = {"url": url, "dbtable": table}
    o.update(properties or {})
    return o


def delete_batch(df: DataFrame, url: str, table: str, batch_id: int, properties: dict | None = None) -> None:
    """Remove rows of an earlier attempt of ``batch_id`` (no-op on a fresh batch)."""
    spark = df.sparkSession
    opts = _opts(url, table, properties)
    opts.pop("dbtable")
    (spark.read.format("jdbc").options(**opts)
     .option("sessionInitStatement", f'DELETE FROM {table} WHERE "batch_id" = {int(batch_id)}')
     .option("query", f'SELECT "batch_id" FROM {table} WHERE 1 = 0')
     .load().count())


def ensure_table(df: DataFrame, url: str, table: str, properties: dict | None = None) -> None:
    """Create the target table from the schema when it does not exist yet."""
    empty = df.withColumn("batch_id", F.lit(0).cast("bigint")).limit(0)
    empty.write.format("jdbc").options(**_opts(url, table, properties)).mode("append").save()


def write_batch(df: DataFrame, batch_id: int, url: str, table: str, properties: dict | None = None,
                batchsize: int = BATCH_SIZE) -> None:
    """Idempotently append ``df`` as batch ``batch_id``."""
    ensure_table(df, url, table, properties)
    delete_batch(df, url, table, batch_id, properties)
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.format("jdbc")
     .options(**_opts(url, table, properties)).option("batchsize", batchsize).mode("append").save())


def foreach_batch_writer(url: str, table: str, properties: dict | None = None,
                         batchsize: int = BATCH_SIZE) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each micro-batch idempotently."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, batch_id, url, table, properties, batchsize)
    return write
