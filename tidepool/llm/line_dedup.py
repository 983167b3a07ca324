"""Line dedup: hashes ranged and sorted by document and position.

A line's key is the line without white space at both ends and with A-Z
lower-cased. Keys of at least ``min_chars`` code points that are found in at
least ``min_docs`` documents keep their lines in one document only, the one
with the largest doc_id; every other line stays.

Only hashes travel. Each (key, salt) range is sorted by document and position
and streamed: the first occurrence of a key in a document counts that
document. The salt is a hash of the document, so a line found in a third of
all documents is spread over ``salts`` ranges and meets again only as one
(count, largest id) row per range. The result is one row per document with
its keep bitmap, run-length compressed; the text is not moved to decide.

Edge cases: a null or empty text is one empty line; a null doc_id counts as
the smallest id; rows with one doc_id are one document for the count, and
each row is cut by its own lines; repeated rows get equal results; an empty
table gives an empty one; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import ascii_lower, digest128, row_key, sha256, stage

TRIMMED = " \t\n\x0b\x0c\r"
NO_ID = -(2 ** 63)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, salts: int = 32) -> DataFrame:
    """(row, doc_id, n_lines, dropped, keep_runs) of each document that loses a line.

    ``row`` is the row's key; ``keep_runs`` is the bitmap: (start, length) of
    each run of kept lines, positions from 0.
    """
    base = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       split_lines(F.col("text")).alias("lines"))
    lines = base.select("row", "doc", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    key = ascii_lower(F.trim(F.col("line"), F.lit(TRIMMED)))
    h1, h2 = digest128(F.col("key"))
    occurrences = stage(
        lines.select("row", "doc", "n_lines", "pos", key.alias("key")).where(F.length("key") >= min_chars)
        .select(h1.alias("h1"), h2.alias("h2"), "doc", "pos", "row", "n_lines",
                F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int").alias("salt")), "lines")

    # The window's clustering is met by the range partitioning: one shuffle, one sort.
    in_order = Window.partitionBy("h1", "h2", "salt").orderBy(F.col("doc").desc(), "pos")
    firsts = (
        occurrences.select("h1", "h2", "salt", "doc", "pos").repartitionByRange("h1", "h2", "salt")
        .withColumn("before", F.lag("doc").over(in_order))
        .where(F.col("before").isNull() | (F.col("before") != F.col("doc"))))
    # A repeated key comes back to its lines once per range that has it, so a common line's join is as spread as the line.
    ranged = firsts.groupBy("h1", "h2", "salt").agg(F.count("*").alias("n"), F.max("doc").alias("doc"))
    found = ranged.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"), F.max("doc").alias("keeper"), F.collect_list("salt").alias("salts"))
    repeated = found.where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper", F.explode("salts").alias("salt"))
    lost = occurrences.join(repeated, ["h1", "h2", "salt"]).where(F.col("doc") != F.col("keeper"))
    return (
        lost.groupBy("row", "doc").agg(F.first("n_lines").alias("n_lines"),
                                       F.sort_array(F.collect_set("pos")).alias("dropped"))
        .select("row", F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_lines", "dropped",
                keep_runs(F.col("dropped"), F.col("n_lines")).alias("keep_runs")))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The gaps between dropped positions, as (start, length)."""
    gaps = F.zip_with(F.concat(F.array(F.lit(-1)), dropped), F.concat(dropped, F.array(n_lines)),
                      lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(gaps, lambda g: g["length"] > 0)


def kept_lines(lines: Column, runs: Column) -> Column:
    return F.flatten(F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["length"])))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines in ``text``; a null text stays null.

    ``n_chars``, where there is such a column, follows the text.
    """
    cut = bitmaps.select(F.col("row").alias("_cut_row"), F.col("keep_runs").alias("_cut_runs"))
    packed = docs.select(F.struct("*").alias("_doc"), row_key(F.col("doc_id"), F.col("text")).alias("_row"))
    joined = packed.join(cut, F.col("_row") == F.col("_cut_row"), "left")
    text = F.when(F.col("_cut_runs").isNull(), F.col("_doc.text")).otherwise(
        F.array_join(kept_lines(split_lines(F.col("_doc.text")), F.col("_cut_runs")), "\n"))
    out = joined.select("_doc", text.alias("_text"))
    cols = []
    for f in docs.schema.fields:
        if f.name == "text":
            cols.append(F.col("_text").alias("text"))
        elif f.name == "n_chars":
            cols.append(F.length("_text").cast(f.dataType).alias("n_chars"))
        else:
            cols.append(F.col("_doc").getField(f.name).alias(f.name))
    return out.select(*cols)


def dedup_lines(docs: DataFrame, **params) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, **params))


def report(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row of ``docs``."""
    cut = keep_bitmaps(docs, **params).select(F.col("row"), F.col("keep_runs"), F.size("dropped").alias("n"))
    rows = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row"))
    lines = split_lines(F.col("text"))
    kept = F.when(F.col("keep_runs").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(kept_lines(lines, F.col("keep_runs")), "\n"))
    return rows.join(cut, "row", "left").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_dropped"), sha256(kept).alias("kept_sha256"))
