"""SQL fragments for the DuckDB oracle queries.

The oracle is independent of the Spark code: it recomputes each result from
the raw tables with plain SQL, so a shared bug cannot hide in both.
"""

from __future__ import annotations

WS = r"[ \t\n\x0B\f\r]"
WS_CHARS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

_RULES = {
    "ws_run": (WS + "+", WS_CHARS),
    "ws_single": (WS, WS_CHARS),
    "space": (" ", "' '"),
    "comma": (",", "','"),
}


def jsplit(s: str, rule: str) -> str:
    """Java ``String.split`` in DuckDB SQL."""
    pat, chars = _RULES[rule]
    return (f"(CASE WHEN {s} = '' THEN [''] WHEN rtrim({s}, {chars}) = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array(rtrim({s}, {chars}), '{pat}') END)")


LINES = r"""
d_ AS (SELECT doc_id, string_split(regexp_replace(text, '\n\z', ''), chr(10)) AS arr
       FROM documents WHERE text IS NOT NULL AND text <> ''),
i_ AS (SELECT doc_id, arr, unnest(range(len(arr))) AS ln FROM d_),
lines AS (SELECT doc_id, CAST(ln AS INTEGER) AS line_no, regexp_replace(arr[ln + 1], '\r\z', '') AS line FROM i_)
"""


def tokens_cte(rule: str) -> str:
    return LINES + f""",
t0_ AS (SELECT doc_id, line_no, {jsplit('line', rule)} AS toks FROM lines),
t1_ AS (SELECT doc_id, line_no, toks, unnest(range(len(toks))) AS p FROM t0_),
toks AS (SELECT doc_id, line_no, CAST(p AS INTEGER) AS pos, toks[p + 1] AS word FROM t1_)
"""


# events as visits / behaviours / keyed records
VISITS = """visits AS (SELECT event_id AS seq, event_type AS app_id, user_id AS uid,
                          (epoch_us(ts) // 1000) AS visit_time FROM events)"""
BEHAVIOURS = """behaviours AS (SELECT event_id AS seq, user_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
        CAST(floor(value) AS BIGINT) AS category_id,
        CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS event_id,
        CAST(floor((epoch_us(ts) // 1000) / 1000) AS BIGINT) AS event_time FROM events)"""
ORDERS = """o AS (SELECT o_orderkey AS seq, 'o' || CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(o_custkey AS INTEGER) AS user_id, CAST(floor(o_totalprice) AS INTEGER) AS money,
        (epoch_us(o_orderdate) // 1000) AS pay_time FROM orders)"""
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ORDER_TEXT = "printf('Order(orderId=%s, userId=%d, money=%d, payTime=%d)', order_id, user_id, money, pay_time)"


def fmt_ms(ms: str, pattern: str, offset_ms: int = 0) -> str:
    shifted = ms if not offset_ms else f"({ms} + {offset_ms})"
    return f"strftime(epoch_ms({shifted}), '{pattern}')"
