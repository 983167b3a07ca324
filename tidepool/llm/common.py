"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import shared_dir

# The separators of the "words" of the documents table.
SPACES = "[\\x20\\x09-\\x0D]"
NON_SPACES = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the file, it does not re-run
    what made it) and gives later plans the true size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change É or İ)."""
    # An all-ASCII text takes the byte-wise path; equal by definition there.
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower()))


def row_key(*cols: Column) -> Column:
    """Key of a row by its contents, for the trip through an explode and back.

    Repeated rows share it and get the same results; rows with one id but
    different texts do not mix; a null id or text is fine.
    """
    return F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols])


def digest128(col: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes: equal only for equal values, in practice."""
    return [F.xxhash64(col), F.xxhash64(F.lit("second seed"), col)]


def sha256(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)
