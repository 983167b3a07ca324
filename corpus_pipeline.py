"""The corpus pipeline: documents in, training order out.

Five stages, each on all that its predecessor kept:

1. quality classifier: documents that score under the threshold go;
2. line dedup: lines found in five documents or more stay in one;
3. n-gram Jaccard join: one document of each group of near-duplicates stays;
4. benchmark decontamination: documents that hold a benchmark window go;
5. mixing: each source's copies up to its target, in training order.

All stages but the last return the columns of documents. Each stage's result
is written to the shared folder and read back, so a lost executor costs tasks
of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontaminate, jaccard, line_dedup, mixing, quality
from tidepool.llm.common import stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: doc_id, source, size, copy, take, position."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("n-gram jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

# A trained compression model decides the first stage, which SQL cannot
# express; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
