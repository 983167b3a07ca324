"""The registered queries: one Spark plan and one oracle SQL per key.

Every query reads the driver tables (or what Spark derives from them) in
full, so its work grows with the tables. Oracle SQL runs in DuckDB over the
same parquet files; columns are aliased identically on both sides, doubles
are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import (
    day_start_ms, day_string, equals_ignore_case, format_ms, geocode_fields, java_split,
    java_trim_is_empty, narrow_to_int, next_day_start_ms, seconds_to_ms, tokens, unsigned_widen,
    utc_ntz_to_ms,
)
from tidepool.functions.parse import (
    parse_behavior_csv, parse_event_line, parse_orders_tagged, parse_visits_tagged, parse_word_num,
)
from tidepool.functions.timefmt import SECOND_FORMAT
from tidepool.operators import enrich, late, median, topn, uv, windows, wordcount
from tidepool.plans import sqlbits as S
from tidepool.sources import generator, tables as TB
from tidepool.sources.lookup import table_geocoder


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table."""
    return TB.table(spark, sf, name)


# Fixed value: Asia/Shanghai is UTC+8 with no DST after 1991, so the oracle can
# shift by a constant over the driver data's years.
SHANGHAI = "Asia/Shanghai"
SHANGHAI_MS = 8 * 3600 * 1000

# ---------------------------------------------------------------------------
# Sources and parsing
# ---------------------------------------------------------------------------


@register("scan_text", f"WITH {S.LINES} SELECT doc_id, line_no, line FROM lines")
def q_scan_text(spark, sf):
    """Documents read as text files: one row per line."""
    return TB.doc_lines(_t(spark, sf, "documents"))


@register("scan_behavior_csv", f"""WITH {S.BEHAVIOURS}
SELECT seq, user_id, item_id, category_id, event_id, event_time FROM behaviours""")
def q_scan_behavior_csv(spark, sf):
    """Behaviour CSV lines exported from events, parsed strictly back to rows."""
    lines = TB.behavior_lines(_t(spark, sf, "events"))
    return parse_behavior_csv(lines, keep=("seq",)).drop("line")


@register("parse_word_num", f"SELECT event_id AS seq, event_type AS word, CAST({S.K} AS INTEGER) AS num FROM events")
def q_parse_word_num(spark, sf):
    """Strict ``word,num`` parse."""
    return parse_word_num(TB.word_num_lines(_t(spark, sf, "events")), keep=("seq",)).drop("line")


@register("parse_event_line", f"""SELECT event_id AS seq,
  CASE WHEN event_type IN ('view', 'click') THEN (epoch_us(ts) // 1000) ELSE epoch_ms(date_trunc('second', ts)) END AS ts_ms,
  event_type AS word, CAST({S.K} AS INTEGER) AS num FROM events""")
def q_parse_event_line(spark, sf):
    """Strict ``time,word,num`` with epoch-ms or readable times."""
    return parse_event_line(TB.event_lines(_t(spark, sf, "events")), keep=("seq",)).drop("line")


@register("parse_orders", f"""WITH {S.ORDERS}
SELECT o.seq, o_orderstatus <> 'P' AS ok,
  CASE WHEN o_orderstatus <> 'P' THEN order_id END AS order_id,
  CASE WHEN o_orderstatus <> 'P' THEN user_id END AS user_id,
  CASE WHEN o_orderstatus <> 'P' THEN money END AS money,
  CASE WHEN o_orderstatus <> 'P' THEN pay_time END AS pay_time
FROM o JOIN orders ON o.seq = orders.o_orderkey""")
def q_parse_orders(spark, sf):
    """Tolerant order parse: good rows and rejects, tagged by ``ok``."""
    return parse_orders_tagged(TB.order_lines(_t(spark, sf, "orders")), keep=("seq",))


@register("parse_visits", """SELECT event_id AS seq, event_type <> 'error' AS ok,
  CASE WHEN event_type <> 'error' THEN event_type END AS app_id,
  CASE WHEN event_type <> 'error' THEN user_id END AS uid,
  CASE WHEN event_type <> 'error' THEN (epoch_us(ts) // 1000) END AS visit_time FROM events""")
def q_parse_visits(spark, sf):
    """Tolerant exact-arity visit parse, tagged by ``ok``."""
    return parse_visits_tagged(TB.visit_lines(_t(spark, sf, "events")), keep=("seq",))


@register("gen_orders", """WITH g AS (SELECT md5('42:' || o_orderkey) AS m, o_orderdate FROM orders)
SELECT substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12) AS order_id,
  CAST(('0x' || substr(m, 1, 8))::BIGINT % 4 + 1 AS INTEGER) AS user_id,
  CAST(('0x' || substr(m, 25, 8))::BIGINT % 100 + 1 AS INTEGER) AS money, epoch_ms(o_orderdate) AS pay_time FROM g""")
def q_gen_orders(spark, sf):
    """Generated orders, one per order row, from the md5 of its key."""
    o = _t(spark, sf, "orders")
    return generator.gen_orders_batch(o, "o_orderkey", utc_ntz_to_ms("o_orderdate"))


# ---------------------------------------------------------------------------
# Tokenising and word counts
# ---------------------------------------------------------------------------


def _count_sql(rule: str, nonblank: bool = False) -> str:
    where = " WHERE regexp_replace(word, '[\\x00-\\x20]', '', 'g') <> ''" if nonblank else ""
    return f"WITH {S.tokens_cte(rule)} SELECT word, count(*) AS cnt FROM toks{where} GROUP BY word"


@register("word_count", _count_sql("ws_run"))
def q_word_count(spark, sf):
    """Word count over all document lines, ``\\s+`` separator."""
    return wordcount.word_count(TB.doc_lines(_t(spark, sf, "documents")), "ws_run")


@register("tokens_ws_run", f"WITH {S.tokens_cte('ws_run')} SELECT doc_id, line_no, pos, word FROM toks")
def q_tokens_ws_run(spark, sf):
    """The ``\\s+`` tokenizer's output rows (flatMap)."""
    return tokens(TB.doc_lines(_t(spark, sf, "documents")), "ws_run", keep=("doc_id", "line_no"))


@register("tokens_ws_single", _count_sql("ws_single"))
def q_tokens_ws_single(spark, sf):
    """Word count with the single ``\\s`` separator (empty tokens counted)."""
    return wordcount.word_count(TB.doc_lines(_t(spark, sf, "documents")), "ws_single")


@register("tokens_nonblank", _count_sql("ws_single", nonblank=True))
def q_tokens_nonblank(spark, sf):
    """Word count with ``\\s`` and blank tokens dropped."""
    lines = TB.doc_lines(_t(spark, sf, "documents"))
    return wordcount.word_count(lines, "ws_single", drop_blank=True)


@register("tokens_space", _count_sql("space"))
def q_tokens_space(spark, sf):
    """Word count with a literal space separator (tabs stay inside words)."""
    return wordcount.word_count(TB.doc_lines(_t(spark, sf, "documents")), "space")


@register("running_count", """SELECT event_id AS seq, event_type AS word,
  count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cnt FROM events""")
def q_running_count(spark, sf):
    """Per-record running count per word (changelog of a keyed sum)."""
    recs = _t(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("word"))
    return wordcount.running_count(recs, "word", "seq").select("seq", "word", "cnt")


# ---------------------------------------------------------------------------
# Projections, filters, scalar functions
# ---------------------------------------------------------------------------


@register("uid_bucket", f"""WITH {S.VISITS}
SELECT seq, app_id, uid, uid % 1000 AS part_id FROM visits""")
def q_uid_bucket(spark, sf):
    """Hot-key spread key ``uid % 1000``."""
    return uv.uid_bucket(TB.visits(_t(spark, sf, "events"))).select("seq", "app_id", "uid", "part_id")


@register("filter_event", f"""WITH {S.BEHAVIOURS}
SELECT seq, user_id, item_id, event_time FROM behaviours WHERE lower(event_id) = 'pv'""")
def q_filter_event(spark, sf):
    """Case-insensitive ``pv`` filter over behaviours."""
    return topn.filter_event(TB.behaviours(_t(spark, sf, "events"))).select("seq", "user_id", "item_id",
                                                                            "event_time")


@register("str_funcs", f"""WITH {S.LINES}
SELECT doc_id, line_no,
  regexp_replace(line, '[\\x00-\\x20]', '', 'g') = '' AS is_blank,
  {S.jsplit('line', 'ws_single')}[1] AS first_word,
  lower({S.jsplit('line', 'ws_single')}[1]) = lower('The') AS first_is_the,
  CAST(len({S.jsplit('line', 'ws_single')}) AS INTEGER) AS n_single,
  CAST(len({S.jsplit('line', 'space')}) AS INTEGER) AS n_space,
  printf('%d#%d', doc_id, line_no) AS tag
FROM lines""")
def q_str_funcs(spark, sf):
    """String helpers per document line: trim-empty test, Java split sizes,
    case-insensitive compare, formatting."""
    lines = TB.doc_lines(_t(spark, sf, "documents"))
    single = java_split("line", "ws_single")
    first = F.get(single, 0)
    return lines.select(
        "doc_id", "line_no", java_trim_is_empty("line").alias("is_blank"), first.alias("first_word"),
        equals_ignore_case(first, "The").alias("first_is_the"), F.size(single).alias("n_single"),
        F.size(java_split("line", "space")).alias("n_space"),
        F.format_string("%d#%d", "doc_id", "line_no").alias("tag"))


@register("time_funcs", f"""SELECT event_id AS seq, (epoch_us(ts) // 1000) AS ts_ms,
  CAST(floor((epoch_us(ts) // 1000) / 1000) AS BIGINT) * 1000 AS sec_ms,
  {S.fmt_ms('(epoch_us(ts) // 1000)', '%Y%m%d')} AS day_utc,
  {S.fmt_ms('(epoch_us(ts) // 1000)', '%Y%m%d%H%M%S')} AS stamp_utc,
  {S.fmt_ms('(epoch_us(ts) // 1000)', '%Y%m%d', SHANGHAI_MS)} AS day_cn,
  {S.fmt_ms('(epoch_us(ts) // 1000)', '%Y%m%d%H%M%S', SHANGHAI_MS)} AS stamp_cn,
  epoch_ms(date_trunc('day', ts)) AS day_start_utc,
  ((epoch_us(ts) // 1000) + {SHANGHAI_MS}) - (((epoch_us(ts) // 1000) + {SHANGHAI_MS}) % 86400000) - {SHANGHAI_MS} AS day_start_cn,
  ((epoch_us(ts) // 1000) + {SHANGHAI_MS}) - (((epoch_us(ts) // 1000) + {SHANGHAI_MS}) % 86400000) - {SHANGHAI_MS} + 86400000
    AS next_day_cn
FROM events""")
def q_time_funcs(spark, sf):
    """Epoch conversions, day/second strings and day bounds in UTC and UTC+8."""
    e = _t(spark, sf, "events").select(F.col("event_id").alias("seq"), utc_ntz_to_ms("ts").alias("ts_ms"))
    return e.select(
        "seq", "ts_ms", seconds_to_ms(F.floor(F.col("ts_ms") / 1000).cast("bigint")).alias("sec_ms"),
        day_string("ts_ms", "UTC").alias("day_utc"), format_ms("ts_ms", SECOND_FORMAT, "UTC").alias("stamp_utc"),
        day_string("ts_ms", SHANGHAI).alias("day_cn"),
        format_ms("ts_ms", SECOND_FORMAT, SHANGHAI).alias("stamp_cn"),
        day_start_ms("ts_ms", "UTC").alias("day_start_utc"), day_start_ms("ts_ms", SHANGHAI).alias("day_start_cn"),
        next_day_start_ms("ts_ms", SHANGHAI).alias("next_day_cn"))


@register("int_narrow", """WITH m AS (SELECT event_id AS seq, (epoch_us(ts) // 1000) AS ts_ms,
  (epoch_us(ts) // 1000) % 4294967296 AS low FROM events)
SELECT seq, ts_ms, CAST(CASE WHEN low >= 2147483648 THEN low - 4294967296 ELSE low END AS INTEGER) AS narrowed,
  low AS widened FROM m""")
def q_int_narrow(spark, sf):
    """Low-32-bit narrowing of epoch ms and its unsigned widening."""
    e = _t(spark, sf, "events").select(F.col("event_id").alias("seq"), utc_ntz_to_ms("ts").alias("ts_ms"))
    n = narrow_to_int("ts_ms")
    return e.select("seq", "ts_ms", n.alias("narrowed"), unsigned_widen(n).alias("widened"))


def _geocode_json():
    name = F.col("c_name")
    good = F.to_json(F.struct(F.lit(0).alias("status"), F.struct(
        name.alias("title"),
        F.struct(F.col("c_acctbal").alias("lng"), (F.col("c_nationkey") + F.lit(0.5)).alias("lat")).alias("location"),
    ).alias("result")))
    no_loc = F.to_json(F.struct(F.struct(name.alias("title")).alias("result")))
    return (F.when(F.col("c_nationkey") == 0, F.lit("not json {"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit('{"status": 1}'))
            .when(F.col("c_acctbal") < 0, no_loc).otherwise(good))


@register("json_geocode", """SELECT c_custkey,
  CASE WHEN c_nationkey = 0 OR c_mktsegment = 'AUTOMOBILE' OR c_acctbal < 0 THEN '' ELSE c_name END AS title,
  round(CASE WHEN c_nationkey = 0 OR c_mktsegment = 'AUTOMOBILE' OR c_acctbal < 0 THEN 0.0 ELSE c_acctbal END, 6) AS lng,
  round(CASE WHEN c_nationkey = 0 OR c_mktsegment = 'AUTOMOBILE' OR c_acctbal < 0 THEN 0.0
        ELSE c_nationkey + 0.5 END, 6) AS lat
FROM customer""")
def q_json_geocode(spark, sf):
    """Geocoding JSON replies (built from customers) parsed with defaults."""
    c = _t(spark, sf, "customer")
    parsed = c.select("c_custkey", _geocode_json().alias("reply")).select("c_custkey", *geocode_fields("reply"))
    return parsed.select("c_custkey", "title", F.round("lng", 6).alias("lng"), F.round("lat", 6).alias("lat"))


# ---------------------------------------------------------------------------
# Joins / enrichment
# ---------------------------------------------------------------------------


@register("join_dim_lookup", """SELECT o_orderkey, o_custkey, coalesce(c_name, '') AS c_name,
  coalesce(c_mktsegment, '') AS c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_join_dim_lookup(spark, sf):
    """Orders enriched with customer name and segment (left lookup, miss -> '')."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return enrich.dim_lookup(o, c, "o_custkey", ["c_name", "c_mktsegment"], default="")


@register("enrich_lookup", """WITH c AS (SELECT c_custkey, c_name, right(c_name, 1) AS last,
  coalesce(TRY_CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) % 90, 0) AS m FROM customer)
SELECT c_custkey, c_name,
  CASE WHEN last IN ('7', '3', '5') THEN '' ELSE upper(c_name) END AS title,
  round(CASE WHEN last IN ('7', '3', '5') THEN 0.0 ELSE 100 + length(c_name) / 100.0 END, 6) AS lng,
  round(CASE WHEN last IN ('7', '3', '5') THEN 0.0 ELSE m + 0.5 END, 6) AS lat
FROM c""")
def q_enrich_lookup(spark, sf):
    """Customers geocoded by address through a per-key lookup service (a stub: no service may be called here)."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    out = enrich.enrich_lookup(c, "c_name", table_geocoder)
    return out.select("c_custkey", "c_name", "title", F.round("lng", 6).alias("lng"), F.round("lat", 6).alias("lat"))


# ---------------------------------------------------------------------------
# Windows and windowed aggregates
# ---------------------------------------------------------------------------


@register("tumbling_sum", """WITH e AS (SELECT event_type AS word, CAST(json_extract_string(props, '$.k') AS INTEGER) AS num,
  CASE WHEN event_type IN ('view', 'click') THEN (epoch_us(ts) // 1000) ELSE epoch_ms(date_trunc('second', ts)) END AS t
  FROM events)
SELECT word, t - (t % 5000) AS window_start, t - (t % 5000) + 5000 AS window_end, CAST(sum(num) AS BIGINT) AS total
FROM e GROUP BY ALL""")
def q_tumbling_sum(spark, sf):
    """Event-time 5 s tumbling sums per word over parsed event lines."""
    parsed = parse_event_line(TB.event_lines(_t(spark, sf, "events")))
    return windows.tumbling_sum(parsed, "word", "ts_ms", "num", "5 seconds")


@register("sliding_sum", """WITH e AS (SELECT event_type AS word, CAST(json_extract_string(props, '$.k') AS BIGINT) AS num,
  (epoch_us(ts) // 1000) AS t FROM events),
w AS (SELECT word, num, t - (t % 1000) - 1000 * unnest(range(5)) AS window_start FROM e)
SELECT word, window_start, window_start + 5000 AS window_end, CAST(sum(num) AS BIGINT) AS total FROM w GROUP BY ALL""")
def q_sliding_sum(spark, sf):
    """Sliding 5 s / 1 s sums per word on event time."""
    e = _t(spark, sf, "events").select(
        F.col("event_type").alias("word"), utc_ntz_to_ms("ts").alias("t"),
        F.get_json_object("props", "$.k").cast("bigint").alias("num"))
    return windows.sliding_sum(e, "word", "t", "num", "5 seconds", "1 second")


@register("count_window", """WITH e AS (SELECT event_type AS word, CAST(json_extract_string(props, '$.k') AS BIGINT) AS num,
  row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
SELECT word, CAST((rn - 1) // 5 AS BIGINT) AS window_no, CAST(sum(num) AS BIGINT) AS total FROM e
GROUP BY ALL HAVING count(*) = 5""")
def q_count_window(spark, sf):
    """Count windows of 5 per word in arrival order; incomplete tails dropped."""
    e = _t(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("word"),
                                       F.get_json_object("props", "$.k").cast("bigint").alias("num"))
    return windows.count_window(e, "word", "seq", "num", 5)


@register("day_window", f"""WITH e AS (SELECT event_type, (epoch_us(ts) // 1000) + {SHANGHAI_MS} AS lt FROM events)
SELECT event_type, lt - (lt % 86400000) - {SHANGHAI_MS} AS window_start,
  lt - (lt % 86400000) - {SHANGHAI_MS} + 86400000 AS window_end, count(*) AS cnt FROM e GROUP BY ALL""")
def q_day_window(spark, sf):
    """Calendar-day windows in Asia/Shanghai, counts per event type."""
    e = _t(spark, sf, "events").select("event_type", utc_ntz_to_ms("ts").alias("t"))
    return windows.day_window(e, "event_type", "t", SHANGHAI)


@register("window_rows", f"""WITH {S.ORDERS},
w AS (SELECT *, pay_time - (pay_time % 5000) AS window_start, {S.ORDER_TEXT} AS txt FROM o)
SELECT user_id, window_start, window_start + 5000 AS window_end, count(*) AS n_orders,
  CAST(sum(money) AS BIGINT) AS money,
  printf('WindowInfo=[%s,%s),', {S.fmt_ms('window_start', '%Y%m%d%H%M%S')}, {S.fmt_ms('window_start + 5000', '%Y%m%d%H%M%S')})
    || string_agg(txt || ':', '' ORDER BY seq) AS info
FROM w GROUP BY user_id, window_start""")
def q_window_rows(spark, sf):
    """Per user and 5 s window: the rows as text in arrival order, and the money."""
    return windows.window_rows(TB.orders_records(_t(spark, sf, "orders")), 5000, "UTC")


@register("window_money", f"""WITH {S.ORDERS}
SELECT user_id, pay_time - (pay_time % 5000) AS window_start, pay_time - (pay_time % 5000) + 5000 AS window_end,
  CAST(sum(money) AS BIGINT) AS money FROM o GROUP BY ALL""")
def q_window_money(spark, sf):
    """Payment total per user and 5 s event-time window."""
    o = TB.orders_records(_t(spark, sf, "orders"))
    return windows.window_agg(windows.with_event_ts(o, "pay_time"), ["user_id"], "event_ts", "5 seconds", None,
                              [F.sum("money").cast("bigint").alias("money")])


@register("late_split", f"""WITH {S.ORDERS},
w AS (SELECT *, pay_time - (pay_time % 5000) AS window_start, pay_time - (pay_time % 5000) + 5000 AS window_end,
  max(pay_time) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS mx FROM o),
t AS (SELECT *, window_end <= mx AS late, {S.ORDER_TEXT} AS txt FROM w)
SELECT 'window' AS kind, user_id, window_start, window_end, count(*) AS n_orders, CAST(sum(money) AS BIGINT) AS money,
  printf('WindowInfo=[%s,%s),', {S.fmt_ms('window_start', '%Y%m%d%H%M%S')}, {S.fmt_ms('window_end', '%Y%m%d%H%M%S')})
    || string_agg(txt || ':', '' ORDER BY seq) AS info
FROM t WHERE NOT late GROUP BY user_id, window_start, window_end
UNION ALL
SELECT 'late' AS kind, user_id, window_start, window_end, CAST(1 AS BIGINT) AS n_orders, CAST(money AS BIGINT) AS money,
  txt AS info FROM t WHERE late""")
def q_late_split(spark, sf):
    """5 s windows with a 0 s watermark over arrival order; late rows tagged."""
    return late.late_split(TB.orders_records(_t(spark, sf, "orders")), 5000, 0, 0, "UTC")


@register("late_split_events", f"""WITH o AS (SELECT (event_id + (event_id * 37) % 50) * 1048576 + event_id AS seq,
    'e' || CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS INTEGER) AS user_id,
    CAST(floor(value) AS INTEGER) AS money, (epoch_us(ts) // 1000) AS pay_time FROM events),
w AS (SELECT *, pay_time - (pay_time % 60000) AS window_start, pay_time - (pay_time % 60000) + 60000 AS window_end,
  max(pay_time) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) AS mx FROM o),
t AS (SELECT *, window_end <= mx - 600000 AS late, {S.ORDER_TEXT} AS txt FROM w)
SELECT 'window' AS kind, user_id, window_start, window_end, count(*) AS n_orders, CAST(sum(money) AS BIGINT) AS money,
  printf('WindowInfo=[%s,%s),', {S.fmt_ms('window_start', '%Y%m%d%H%M%S')}, {S.fmt_ms('window_end', '%Y%m%d%H%M%S')})
    || string_agg(txt || ':', '' ORDER BY seq) AS info
FROM t WHERE NOT late GROUP BY user_id, window_start, window_end
UNION ALL
SELECT 'late' AS kind, user_id, window_start, window_end, CAST(1 AS BIGINT) AS n_orders, CAST(money AS BIGINT) AS money,
  txt AS info FROM t WHERE late""")
def q_late_split_events(spark, sf):
    """1 min windows, 10 min watermark lag, over events arriving out of order
    (derived arrival); only rows of already-closed windows are late."""
    return late.late_split(TB.events_as_orders(_t(spark, sf, "events")), 60_000, 600_000, 0, "UTC")


# ---------------------------------------------------------------------------
# Unique visitors
# ---------------------------------------------------------------------------

_DAY = S.fmt_ms("visit_time", "%Y%m%d")


@register("daily_uv", f"""WITH {S.VISITS}
SELECT app_id, {_DAY} AS day, count(DISTINCT uid) AS uv FROM visits GROUP BY ALL""")
def q_daily_uv(spark, sf):
    """Exact unique users per app and UTC day."""
    return uv.daily_uv(TB.visits(_t(spark, sf, "events")), "UTC")


@register("uv_bitmap", f"""WITH {S.VISITS}
SELECT app_id, {_DAY} AS day, count(DISTINCT uid) AS uv FROM visits GROUP BY ALL""")
def q_uv_bitmap(spark, sf):
    """Exact unique users per app and day from mergeable per-bucket bitmaps."""
    return uv.uv_bitmap(TB.visits(_t(spark, sf, "events")), "UTC")


@register("daily_uv_cumulative", f"""WITH {S.VISITS},
v AS (SELECT app_id, uid, {_DAY} AS day, visit_time - (visit_time % 1000) AS sec FROM visits),
f AS (SELECT app_id, day, min(sec) AS sec FROM v GROUP BY app_id, day, uid),
n AS (SELECT app_id, day, sec, count(*) AS nu FROM f GROUP BY ALL),
a AS (SELECT DISTINCT app_id, day, sec FROM v),
p AS (SELECT a.app_id, a.day, a.sec, coalesce(n.nu, 0) AS nu FROM a LEFT JOIN n USING (app_id, day, sec))
SELECT app_id, day, sec AS window_start,
  CAST(sum(nu) OVER (PARTITION BY app_id, day ORDER BY sec ROWS UNBOUNDED PRECEDING) AS BIGINT) AS day_uv FROM p""")
def q_daily_uv_cumulative(spark, sf):
    """Running daily UV per app at every 1 s window with visits (flagship)."""
    return uv.daily_uv_cumulative(TB.visits(_t(spark, sf, "events")), "UTC")


@register("uv_running", f"""WITH {S.VISITS},
f AS (SELECT app_id, epoch_ms(date_trunc('day', epoch_ms(visit_time))) AS day_start, uid,
  min(visit_time) AS first_visit FROM visits GROUP BY ALL)
SELECT app_id, day_start, uid, first_visit,
  row_number() OVER (PARTITION BY app_id, day_start ORDER BY first_visit, uid) AS uv FROM f""")
def q_uv_running(spark, sf):
    """Running distinct users per app and day, one row per first visit."""
    return uv.uv_running(TB.visits(_t(spark, sf, "events")), "UTC").select(
        "app_id", "day_start", "uid", "first_visit", "uv")


# ---------------------------------------------------------------------------
# Top-N, recency, medians
# ---------------------------------------------------------------------------

_PV = f"""WITH {S.BEHAVIOURS},
pv AS (SELECT item_id, event_time * 1000 AS t FROM behaviours WHERE lower(event_id) = 'pv'),
w AS (SELECT item_id, t - (t % 300000) - 300000 * unnest(range(12)) + 3600000 AS window_end FROM pv),
c AS (SELECT item_id, window_end, count(*) AS pv FROM w GROUP BY ALL)"""


@register("pv_window_count", _PV + " SELECT item_id, window_end, pv FROM c")
def q_pv_window_count(spark, sf):
    """Page views per item on 1 h windows sliding by 5 min."""
    return topn.pv_window_count(TB.behaviours(_t(spark, sf, "events")))


@register("top_n_per_window", _PV + """
SELECT window_end, CAST(rn AS INTEGER) AS rank, item_id, pv FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY pv DESC, item_id) AS rn FROM c) WHERE rn <= 5""")
def q_top_n_per_window(spark, sf):
    """Top 5 items per sliding window end."""
    return topn.top_n_per_window(topn.pv_window_count(TB.behaviours(_t(spark, sf, "events"))), 5)


@register("recent_keys", f"""WITH p AS (SELECT user_id, event_type, {S.K} AS k, event_id AS seq FROM events),
l AS (SELECT user_id, event_type, max(seq) AS last_seq, arg_max(k, seq) AS k FROM p GROUP BY ALL)
SELECT user_id, event_type, k, last_seq, CAST(recency AS INTEGER) AS recency FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_seq DESC) AS recency FROM l) WHERE recency <= 3""")
def q_recent_keys(spark, sf):
    """Per user, the 3 most recently put keys with their last value."""
    e = _t(spark, sf, "events").select("user_id", "event_type", F.col("event_id").alias("seq"),
                                       F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return topn.recent_keys(e, "user_id", "event_type", "k", "seq", 3)


@register("median_by_key", "SELECT user_id, round(median(value), 6) AS median FROM events GROUP BY user_id")
def q_median_by_key(spark, sf):
    """Exact median of event value per user."""
    m = median.median_by_key(_t(spark, sf, "events"), "user_id", "value")
    return m.select("user_id", F.round("median", 6).alias("median"))


@register("running_median", """SELECT event_id AS seq, user_id, value,
  round(median(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6)
  AS median FROM events""")
def q_running_median(spark, sf):
    """Median of each user's values so far, after every event."""
    e = _t(spark, sf, "events").select(F.col("event_id").alias("seq"), "user_id", "value")
    m = median.running_median(e, "user_id", "seq", "value")
    return m.select("seq", "user_id", "value", F.round("median", 6).alias("median"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}
