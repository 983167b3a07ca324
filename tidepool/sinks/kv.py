"""Key-value sinks: running-count upserts and pipelined writes with expiry.

The client is supplied by the caller as a zero-argument factory, called once
per task (connections are not shipped from the driver). A client needs
``set_many(items, ttl_s)``, which writes ``(key, value)`` pairs in one round
trip (a pipeline) with an optional expiry, and, for hash upserts,
``hset_many(name, items)``, which sets fields of the hash ``name``.

Guarantee: at-least-once delivery of idempotent ``SET``s. A retried task or
micro-batch rewrites the same keys with the same values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Flush size, key expiry and longest wait of the pipeline sink.
FLUSH_ROWS = 1000
TTL_SECONDS = 2 * 24 * 3600
FLUSH_MS = 10_000
# Fixed value: the hash that the running word counts go to.
WORD_COUNT_HASH = "wordcnt_sink_redis_demo"


def _chunks(rows: Iterable, size: int) -> Iterator[list]:
    buf = []
    for r in rows:
        buf.append(r)
        if len(buf) >= size:
            yield buf
            buf = []
    if buf:
        yield buf


def write_kv(df: DataFrame, key: str, value: str, client_factory: Callable[[], object],
             flush_rows: int = FLUSH_ROWS, ttl_s: int | None = TTL_SECONDS, hash_name: str | None = None) -> None:
    """Write every row as ``SET key value [EX ttl]``, or as ``HSET hash_name
    key value`` where a hash is named, in pipelined chunks, all partitions in
    parallel."""
    pairs = df.select(F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v"))

    def run(rows: Iterator) -> None:
        client = client_factory()
        try:
            for chunk in _chunks(((r.k, r.v) for r in rows), flush_rows):
                if hash_name is None:
                    client.set_many(chunk, ttl_s)
                else:
                    client.hset_many(hash_name, chunk)
        finally:
            close = getattr(client, "close", None)
            if close:
                close()

    pairs.foreachPartition(run)


def latest_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value at the largest ``order`` (last write wins)."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def upsert_batch_writer(key: str, value: str, client_factory: Callable[[], object],
                        order: str | None = None, ttl_s: int | None = None,
                        flush_rows: int = FLUSH_ROWS, hash_name: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for running counts in ``update`` mode: the
    newest value of each changed key is written (hash-set semantics, into
    ``hash_name`` where one is given)."""
    def write(df: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(df, key, value, order) if order else df
        write_kv(rows, key, value, client_factory, flush_rows, ttl_s, hash_name)
    return write


def stream_to_kv(df: DataFrame, key: str, value: str, client_factory: Callable[[], object], checkpoint: str,
                 interval: str = "10 seconds", mode: str = "update", order: str | None = None,
                 ttl_s: int | None = TTL_SECONDS, flush_rows: int = FLUSH_ROWS, hash_name: str | None = None):
    """Start a stream into the KV store: every ``interval`` (the time-based
    flush) each micro-batch is written in ``flush_rows`` pipelines. Idle input
    leaves nothing buffered, since each batch is flushed whole. Small frequent
    batches go through ``buffered_to_kv`` instead."""
    writer = upsert_batch_writer(key, value, client_factory, order, ttl_s, flush_rows, hash_name)
    return (df.writeStream.outputMode(mode).foreachBatch(writer).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start())


def buffered_to_kv(df: DataFrame, key: str, value: str, client_factory: Callable[[], object], checkpoint: str,
                   flush_rows: int = FLUSH_ROWS, flush_ms: int = FLUSH_MS, ttl_s: int | None = TTL_SECONDS,
                   hash_name: str | None = None, buffers: int = 16, trigger: str = "1 second"):
    """Start an append stream into the KV store through a buffer that is state:
    rows go out ``flush_rows`` at a time, or ``flush_ms`` after a buffer's first
    row, also when no input comes; unsent rows come back after a restart."""
    from tidepool.streaming.jobs import buffered_stream

    due = buffered_stream(df, key, value, flush_rows, flush_ms, buffers)
    return (due.writeStream.outputMode("append")
            .foreachBatch(upsert_batch_writer("k", "v", client_factory, None, ttl_s, flush_rows, hash_name))
            .option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start())
