"""Word counts: batch totals, streaming running totals, per-record changelog.

One function serves bounded and unbounded input: on a batch DataFrame it
returns final counts; on a streaming DataFrame the same plan runs with
``outputMode("update")`` and emits running totals per micro-batch.
Counting is a partial + final hash aggregate, so a very frequent word is
collapsed map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import tokens
from tidepool.operators.prefix import running_agg


def word_count(lines: DataFrame, rule: str = "ws_run", line_col: str = "line",
               drop_blank: bool = False) -> DataFrame:
    """``(word, cnt)``; ``rule`` picks the separator (see functions.text)."""
    toks = tokens(lines, rule, line_col=line_col, drop_blank=drop_blank)
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_count(records: DataFrame, key: str, seq: str, out: str = "cnt",
                  chunk_span: int | None = None) -> DataFrame:
    """One row per input record with the key's count so far (a changelog).

    ``seq`` is the arrival order. Computed with chunked prefix sums, so a hot
    key is spread over many tasks.
    """
    return running_agg(records, [key], [seq], None, "count", out, chunk_span)
