"""File and socket sources, bounded or streaming.

Each returns a DataFrame with one ``line`` column (plus typed columns for the
CSV source), so the same job functions apply to either mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.parse import parse_behavior_csv
from tidepool.functions.text import without_cr
from tidepool.session import ship_package


def scan_text(spark: SparkSession, path: str, stream: bool = False,
              max_files_per_trigger: int | None = None, arrival: bool = False) -> DataFrame:
    """One row per line of a file or of every file in a directory.

    Lines end at ``\\n``; one ``\\r`` before it is not part of the line, a lone
    ``\\r`` inside a line is (the rule of ``functions.text.text_lines``).

    ``arrival`` adds what puts lines in order of arrival, for ``with_seq``:
    ``arrived``, the file's modification time (epoch ms), ``file``, a number
    that keeps files of one time apart, ``block``, the offset of the block of
    the file that the line was read with, and ``line_no``, which ascends with
    the lines of a block. A large file is read in blocks by several tasks.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("lineSep", "\n")
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path)
    line = without_cr("value").alias("line")
    if not arrival:
        return lines.select(line)
    placed = lines.select(line, F.unix_millis("_metadata.file_modification_time").alias("arrived"),
                          F.crc32(F.col("_metadata.file_path").cast("binary")).alias("file"),
                          F.col("_metadata.file_block_start").alias("block"))
    # A task reads a block's lines in their order, one after the other.
    return numbered(placed) if stream else placed.withColumn("line_no", F.monotonically_increasing_id())


def numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with ``line_no``, which counts the rows of a task (a stream has no built-in function for it)."""
    ship_package(lines.sparkSession)

    def count(batches):
        import pyarrow as pa
        n = 0
        for batch in batches:
            numbers = pa.array(range(n, n + batch.num_rows), pa.int64())
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, numbers], [*batch.schema.names, "line_no"])

    return lines.mapInArrow(count, T.StructType([*lines.schema.fields, T.StructField("line_no", T.LongType())]))


# What ``scan_text`` adds for the order of arrival.
ARRIVAL = ("arrived", "file", "block", "line_no")


def with_seq(rows: DataFrame, *within: str) -> DataFrame:
    """``rows`` of lines with the columns of ARRIVAL, or of what was made of them, with ``seq`` instead: a text that
    sorts in order of arrival, by file time, block, line and the columns ``within`` a line."""
    widths = [15, 10, 15, 19, *[9] * len(within)]
    return rows.withColumn("seq", F.format_string("-".join(f"%0{w}d" for w in widths), *ARRIVAL, *within)).drop(*ARRIVAL)


def scan_behavior_csv(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Typed behaviour CSV ``user,item,category,behaviour,epoch_s``.

    Strict: a bad or short row fails the job; extra fields are ignored (the
    CSV reader's FAILFAST would also reject extra fields, so we split lines).
    """
    return parse_behavior_csv(scan_text(spark, path, stream))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket line stream, for interactive demos only (no replay on failure)."""
    return (spark.readStream.format("socket").option("host", host).option("port", port).load()
            .withColumnRenamed("value", "line"))

