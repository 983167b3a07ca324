"""Text and console sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def as_text(df: DataFrame, cols: list[str] | None = None, sep: str = ",") -> DataFrame:
    """One ``value`` column: the row's fields joined by ``sep``."""
    cols = cols or df.columns
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))


def write_text(df: DataFrame, path: str, cols: list[str] | None = None, sep: str = ",",
               mode: str = "overwrite") -> None:
    """Bounded result to text files (one part file per partition)."""
    as_text(df, cols, sep).write.mode(mode).text(path)


def stream_text(df: DataFrame, path: str, checkpoint: str, cols: list[str] | None = None,
                sep: str = ",") -> StreamingQuery:
    """Append-mode stream to text files (exactly-once via the file sink log)."""
    return as_text(df, cols, sep).writeStream.format("text").option("path", path).option(
        "checkpointLocation", checkpoint).outputMode("append").start()


def _stdout(partition: int):
    import sys
    return sys.stdout


def labelled_printer(label: str, open_out: Callable[[int], object] = _stdout) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` console printer with a label prefix, like ``print("result")``.

    Every row is printed by the task that holds it, as ``label:subtask> row``;
    ``open_out(subtask)`` gives the text file to print to (the task's standard
    output by default).
    """
    def show(df: DataFrame, batch_id: int) -> None:
        def write(rows) -> None:
            from pyspark import TaskContext
            part = TaskContext.get().partitionId()
            out = open_out(part)
            for r in rows:
                print(f"{label}:{part}> {tuple(r)}", file=out, flush=True)
        df.foreachPartition(write)
    return show


def context_printer(label: str, time_col: str, watermark: Callable[[], int | None],
                    open_out: Callable[[int], object] = _stdout) -> Callable[[DataFrame, int], None]:
    """As ``labelled_printer``, with each row's time context: its element time
    (``time_col``), the watermark when the batch began (``watermark()``, e.g.
    ``lambda: watermark_ms(query)``) and the subtask that holds it."""
    def show(df: DataFrame, batch_id: int) -> None:
        at = F.lit(watermark()).cast("long").alias("watermark")
        shown = with_task_context(df.select("*", F.col(time_col).alias("element_time"), at))
        labelled_printer(label, open_out)(shown, batch_id)
    return show


def watermark_ms(query: StreamingQuery) -> int | None:
    """The query's current event-time watermark (epoch ms) from its progress."""
    p = query.lastProgress
    wm = (p or {}).get("eventTime", {}).get("watermark")
    if not wm:
        return None
    import datetime as dt
    return int(dt.datetime.fromisoformat(wm.replace("Z", "+00:00")).timestamp() * 1000)


def with_task_context(df: DataFrame) -> DataFrame:
    """Attach the partition (subtask) id, for sinks that report it."""
    return df.withColumn("partition_id", F.spark_partition_id())
