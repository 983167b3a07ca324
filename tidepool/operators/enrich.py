"""Enrichment: dimension lookup (equi-join) and external per-key lookups.

Dimension lookup is a left join. No side is forced into a broadcast: Spark
broadcasts the dimension only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime), and
falls back to a shuffle join otherwise, so a growing dimension stays safe.

External lookups call a caller-supplied function once per distinct key, with
a bounded thread pool per task, and join the replies back, so input rows are
kept 1:1 and each key is fetched once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.json import geocode_fields


def dim_lookup(facts: DataFrame, dim: DataFrame, key: str, value_cols: list[str],
               default: object = "", order_col: str | None = None, unique: bool = False) -> DataFrame:
    """Left join ``facts`` to ``dim`` on ``key``; misses get ``default``.

    When several dimension rows share a key, the one with the largest
    ``order_col`` wins (stated order instead of "last row read"); ties are
    broken by the values themselves, so a recomputed task (after an executor
    loss) picks the same row. Pass ``unique=True`` when the key is known
    unique to skip that reduction.
    """
    if not unique:
        order = F.struct(F.col(order_col or value_cols[0]), *[F.col(c) for c in value_cols])
        pick = F.max_by(F.struct(*value_cols), order)
        dim = dim.groupBy(key).agg(pick.alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])
    else:
        dim = dim.select(key, *value_cols)
    joined = facts.join(dim, on=key, how="left")
    return joined.select(*facts.columns, *[F.coalesce(F.col(c), F.lit(default)).alias(c) for c in value_cols])


# Lookups in flight per task and the per-call timeout.
IN_FLIGHT = 10
TIMEOUT_S = 3.0


# A service from which no call has come back for so many timeouts counts as hanging.
STALLED = 20


class Permits:
    """Of one worker: a permit for each call that may be alive, and when a call last began or ended."""

    def __init__(self, n: int):
        import threading

        self.free = threading.Semaphore(n)
        self.moved = 0.0


_PERMITS: dict[int, Permits] = {}  # by their number


def call_all(keys: list, lookup: Callable[[str], str | None], in_flight: int, timeout_s: float | None) -> dict:
    """``{key: reply}``; never more than ``in_flight`` calls are alive in this worker.

    A key's time starts with its call; no reply within ``timeout_s`` gives
    None. A call that is given up keeps its permit until it really ends, also
    beyond this batch, and the keys behind it wait for the permit. They give
    None, after ``timeout_s`` at least, once no call has begun or ended for
    ``STALLED`` timeouts: a service that hangs has ``in_flight`` calls and
    holds a batch up once.
    """
    import queue
    import threading
    import time
    from collections import deque

    permits = _PERMITS.setdefault(in_flight, Permits(in_flight))
    replies: dict = {}
    done: queue.Queue = queue.Queue()
    waiting, running = deque(keys), {}
    arrived = time.monotonic()

    def call(k: str) -> None:
        try:
            said = (k, lookup(k))
        except Exception:  # any failure becomes the default reply
            said = (k, None)
        permits.moved = time.monotonic()
        permits.free.release()
        done.put(said)

    while waiting or running:
        now = time.monotonic()
        while waiting and permits.free.acquire(blocking=False):
            k = waiting.popleft()
            running[k] = permits.moved = now
            threading.Thread(target=call, args=(k,), daemon=True).start()
        left = None if timeout_s is None or not running else max(0.0, min(running.values()) + timeout_s - now)
        if waiting:  # a permit may come back from a call of another batch
            left = 0.02 if left is None else min(left, 0.02)
        try:
            k, reply = done.get(timeout=left)
            if k in running:  # else its time was over before
                del running[k]
                replies[k] = reply
        except queue.Empty:
            if timeout_s is None:
                continue
            now = time.monotonic()
            for k in [k for k, began in running.items() if began + timeout_s <= now]:
                del running[k]
                replies[k] = None
            if now - arrived >= timeout_s and now - permits.moved >= STALLED * timeout_s:
                replies |= dict.fromkeys(waiting)
                waiting.clear()
    return replies


def fetch_replies(rows: DataFrame, key: str, lookup: Callable[[str], str | None],
                  in_flight: int = IN_FLIGHT, timeout_s: float | None = TIMEOUT_S) -> DataFrame:
    """``rows`` with a string column ``reply``, calling ``lookup`` on up to
    ``in_flight`` threads per task (the async-I/O capacity), once per distinct
    key of an Arrow batch. A call that fails or exceeds ``timeout_s`` gives a
    null reply (the default result), as does a null key, which is not called.
    Works on batch and streaming input."""
    from tidepool.session import ship_package

    ship_package(rows.sparkSession)
    schema = T.StructType([*rows.schema.fields, T.StructField("reply", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        at = rows_names.index(key)
        for batch in batches:
            keys = [None if k is None else str(k) for k in batch.column(at).to_pylist()]
            replies = call_all(list(dict.fromkeys(k for k in keys if k is not None)), lookup, in_flight, timeout_s)
            said = pa.array([replies.get(k) for k in keys], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, said], [*rows_names, "reply"])

    rows_names = rows.columns
    return rows.mapInArrow(run, schema)


def enrich_lookup(df: DataFrame, key: str, lookup: Callable[[str], str | None], in_flight: int = IN_FLIGHT,
                  partitions: int | None = None, timeout_s: float | None = TIMEOUT_S) -> DataFrame:
    """Add ``title, lng, lat`` from a geocoding ``lookup(address) -> json``.

    Bounded input: distinct keys are fetched once (spread over ``partitions``
    tasks) and joined back. A stream has no join to make: each row's task
    fetches its batch's distinct keys. Failures, bad JSON and missing fields
    give ``("", 0.0, 0.0)``.
    """
    if df.isStreaming:
        out = fetch_replies(df, key, lookup, in_flight, timeout_s).select(*df.columns, *geocode_fields("reply"))
    else:
        keys = df.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
        if partitions:
            keys = keys.repartition(partitions, key)
        parsed = fetch_replies(keys, key, lookup, in_flight, timeout_s).select(key, *geocode_fields("reply"))
        out = df.join(parsed, on=key, how="left")
    return out.select(*df.columns, F.coalesce("title", F.lit("")).alias("title"),
                      F.coalesce("lng", F.lit(0.0)).alias("lng"), F.coalesce("lat", F.lit(0.0)).alias("lat"))
