"""Driver tables and the adapters that turn them into the jobs' records.

Adapters are projections only, so Catalyst prunes the parquet scan to the
columns each job touches and pushes filters into it.

Record adapters (stated once, used everywhere):
* visits: ``app_id = event_type, uid = user_id, visit_time = ts`` (epoch ms),
  arrival order ``seq = event_id``;
* behaviours: ``item_id = props.k``, ``event_id = 'pv'`` for views (other
  event types keep their name), ``event_time = ts`` in epoch seconds,
  ``category_id = floor(value)``;
* orders: ``order_id = 'o' || o_orderkey, user_id = o_custkey,
  money = floor(o_totalprice), pay_time = o_orderdate`` (epoch ms), arrival
  order ``seq = o_orderkey``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.text import text_lines
from tidepool.functions.timefmt import format_ms, utc_ntz_to_ms

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- record adapters ----------------------------------------------------------

def doc_lines(documents: DataFrame) -> DataFrame:
    """``(doc_id, line_no, line)`` — the documents as text files."""
    return text_lines(documents.select("doc_id", "text"))


def event_ms(events: DataFrame) -> DataFrame:
    return events.withColumn("ts_ms", utc_ntz_to_ms("ts"))


def visits(events: DataFrame) -> DataFrame:
    """``(seq, app_id, uid, visit_time)``."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("app_id"),
        F.col("user_id").alias("uid"),
        utc_ntz_to_ms("ts").alias("visit_time"),
    )


def behaviours(events: DataFrame) -> DataFrame:
    """``(seq, user_id, item_id, category_id, event_id, event_time)``; time in s."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.floor("value").cast("bigint").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("event_id"),
        F.floor(utc_ntz_to_ms("ts") / 1000).cast("bigint").alias("event_time"),
    )


def orders_records(orders: DataFrame) -> DataFrame:
    """``(seq, order_id, user_id, money, pay_time)``."""
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        F.floor("o_totalprice").cast("int").alias("money"),
        utc_ntz_to_ms("o_orderdate").alias("pay_time"),
    )


def events_as_orders(events: DataFrame) -> DataFrame:
    """Events as payment records with an out-of-order arrival.

    Arrival ``event_id + (event_id * 37) % 50`` (ties broken by event_id)
    moves events up to 49 places, so a watermark sees some rows late while
    most arrive in time. ``seq`` packs both as ``arrival * 2^20 + event_id``:
    since ``arrival - event_id`` is in [0, 49], this is unique and sorts by
    (arrival, event_id) for any event id (no overflow below 2^43 arrivals).
    ``money = floor(value)``, ``pay_time = ts`` (epoch ms).
    """
    arrival = F.col("event_id") + F.pmod(F.col("event_id") * F.lit(37), F.lit(50))
    return events.select(
        (arrival * F.lit(1 << 20) + F.col("event_id")).alias("seq"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("order_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.floor("value").cast("int").alias("money"),
        utc_ntz_to_ms("ts").alias("pay_time"),
    )


# ---- text exports of the tables (inputs for the line parsers) ----------------

def behavior_lines(events: DataFrame) -> DataFrame:
    """``user,item,category,behaviour,epoch_s`` lines, keyed by ``seq``."""
    b = behaviours(events)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in
                              ("user_id", "item_id", "category_id", "event_id", "event_time")])
    return b.select("seq", line.alias("line"))


def word_num_lines(events: DataFrame) -> DataFrame:
    """``word,num`` lines: event type and ``props.k``."""
    line = F.concat_ws(",", F.col("event_type"), F.get_json_object("props", "$.k"))
    return events.select(F.col("event_id").alias("seq"), line.alias("line"))


def event_lines(events: DataFrame) -> DataFrame:
    """``time,word,num`` lines. Views and clicks carry epoch ms, the other types
    a readable UTC time (second precision), so both time forms are exercised."""
    ms = utc_ntz_to_ms("ts")
    t = F.when(F.col("event_type").isin("view", "click"), ms.cast("string")).otherwise(
        format_ms(ms, "yyyy-MM-dd HH:mm:ss", "UTC"))
    line = F.concat_ws(",", t, F.col("event_type"), F.get_json_object("props", "$.k"))
    return events.select(F.col("event_id").alias("seq"), line.alias("line"))


def order_lines(orders: DataFrame) -> DataFrame:
    """``order_id,user_id,money,pay_time,priority`` lines.

    Pending orders (status ``P``) export the price with its cents, which the
    integer money field rejects, so the tolerant parser sees bad rows. The
    trailing priority field is an extra field the parser ignores.
    """
    money = F.when(F.col("o_orderstatus") == "P", F.format_string("%.2f", "o_totalprice")).otherwise(
        F.floor("o_totalprice").cast("bigint").cast("string"))
    line = F.concat_ws(",", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")),
                       F.col("o_custkey").cast("string"), money,
                       utc_ntz_to_ms("o_orderdate").cast("string"), F.col("o_orderpriority"))
    return orders.select(F.col("o_orderkey").alias("seq"), line.alias("line"))


def visit_lines(events: DataFrame) -> DataFrame:
    """``app,uid,visit_ms`` lines; error events also carry their props as a
    fourth field, which the exact-arity visit parser rejects."""
    ms = utc_ntz_to_ms("ts").cast("string")
    base = F.concat_ws(",", F.col("event_type"), F.col("user_id").cast("string"), ms)
    line = F.when(F.col("event_type") == "error", F.concat_ws(",", base, F.col("props"))).otherwise(base)
    return events.select(F.col("event_id").alias("seq"), line.alias("line"))
