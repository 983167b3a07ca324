"""Quality classifier: zstandard dictionaries of good and bad labelled text.

Two dictionaries are trained, one on pieces of labelled good texts and one on
bad ones. A text is cut into pieces of ``PIECE`` bytes and each piece is
compressed with either, so that the dictionaries, not the text's own past,
decide. What the bad dictionary needs beyond the good one, per byte of text,
is the normalised difference; logistic calibration on labelled rows, given
also the compressed size per byte and the length, turns it into the
probability of label 1.

Only rows whose crc32(doc_id as text) mod 4 is not ``HELD_OUT`` are learnt
from, at most ``sample_rows`` per class (those with the smallest hash of the
id): half of them for the dictionary, up to ``dict_source_bytes`` per class in
pieces from all over their texts (those with the smallest hash of id and piece number), and the other half, in their whole
length, for the calibration, weighted back to the class counts of all
labelled rows. Scoring reads every byte of every text.

Edge cases: null and empty texts are scored as empty; rows without a usable
label (null id or quality) are not learnt from; with one class only, or none,
the score is the class share (n1 + 1) / (n + 2); dictionaries too small to
train are taken as raw content; repeated rows get equal scores; an empty
table gives an empty one; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import stage
from tidepool.session import ship_package

PIECE = 512
LEVEL = 3
DICT_BYTES = 32 << 10
HELD_OUT = 2
THRESHOLD = 0.7


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train_dictionary(pieces: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b"".join(pieces)[-DICT_BYTES:]


class Sizes:
    """Features of texts from their compressed sizes under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        flags = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.by_dict = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), **flags)
                        for d in (good, bad)]

    def features(self, text: str | None) -> tuple[float, float, float]:
        blob = (text or "").encode("utf-8", "replace")
        good = bad = 0
        for i in range(0, len(blob), PIECE):
            piece = blob[i:i + PIECE]
            good += len(self.by_dict[0].compress(piece))
            bad += len(self.by_dict[1].compress(piece))
        n = len(blob) + 1
        return (bad - good) / n, good / n, float(np.log(n))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Intercept and slopes on the raw features (Newton, lightly regularised)."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hess, z.T @ (weight * (p - y)) + 1e-2 * w)
    slopes = w[1:] / spread
    return [float(w[0] - (slopes * mean).sum()), *map(float, slopes)]


def pieces_of(texts: DataFrame) -> DataFrame:
    """doc_id, quality, n, h, piece: the texts whole, cut into pieces of ``PIECE`` bytes; ``h`` hashes (doc_id, n)."""
    blobs = texts.select("doc_id", "quality", F.coalesce("text", F.lit("")).cast("binary").alias("blob"))
    count = F.ceil(F.octet_length("blob") / PIECE).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    cut = F.transform(numbers, lambda n: F.struct(n.alias("n"), F.substring(F.col("blob"), n * PIECE + 1, F.lit(PIECE)).alias("piece")))
    each = blobs.select("doc_id", "quality", F.explode(cut).alias("p"))
    return each.select("doc_id", "quality", "p.n", F.xxhash64("doc_id", "p.n").alias("h"), "p.piece")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, dict_source_bytes: int = 2 << 20) -> dict:
    """The model: dictionaries, calibration and class share."""
    ship_package(docs.sparkSession)
    usable = labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT)).select(
        "doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    model = {"share": share, "good": None}
    if len(counts) < 2:
        return model
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [usable.where(F.col("quality") == q).orderBy(*order).limit(sample_rows) for q in (0, 1)]
    picked = chosen[0].unionByName(chosen[1]).withColumn("part", F.pmod(F.shiftrightunsigned(F.xxhash64("doc_id"), 7), F.lit(2)))
    sample = stage(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), "labelled")  # 2 * sample_rows ids
    pieces = pieces_of(sample.where("part = 0"))
    most = max(1, dict_source_bytes // PIECE)
    by_class: dict[int, list[bytes]] = {
        q: [bytes(r["piece"]) for r in pieces.where(F.col("quality") == q).orderBy("h", "doc_id", "n", "piece").limit(most).collect()]
        for q in (0, 1)}
    if not all(b"".join(p) for p in by_class.values()):
        return model
    model |= {"good": train_dictionary(by_class[1]), "bad": train_dictionary(by_class[0])}
    rows = sample.where("part = 1").select("quality", features(model)(F.col("text")).alias("f")).collect()
    if len({r["quality"] for r in rows}) < 2:
        return model | {"good": None}
    rows.sort(key=lambda r: (r["quality"], r["f"]["diff"], r["f"]["ratio"], r["f"]["log_n"]))
    x = np.array([tuple(r["f"]) for r in rows], float)
    y = np.array([r["quality"] for r in rows], float)
    seen = {q: float((y == q).sum()) for q in (0, 1)}
    weight = np.array([counts[int(q)] / seen[int(q)] for q in y])
    return model | {"fit": fit_logistic(x, y, weight * len(y) / weight.sum())}


def features(model: dict):
    good, bad = model["good"], model["bad"]

    @F.pandas_udf("diff double, ratio double, log_n double")
    def of(texts: pd.Series) -> pd.DataFrame:
        sizes = Sizes(good, bad)
        return pd.DataFrame([sizes.features(t) for t in texts], columns=["diff", "ratio", "log_n"], dtype=float)

    return of


def score(docs: DataFrame, model: dict, out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``out``."""
    if model["good"] is None:
        return docs.withColumn(out, F.lit(float(model["share"])))
    ship_package(docs.sparkSession)
    good, bad, fit = model["good"], model["bad"], model["fit"]

    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        sizes = Sizes(good, bad)
        x = np.array([(1.0, *sizes.features(t)) for t in texts], float).reshape(-1, 4)
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(fit), -500, 500))))

    return docs.withColumn(out, probability(F.col("text")))


def report(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, **params))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **params) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, their columns unchanged."""
    model = train(docs, labels, **params)
    packed = docs.select(F.struct("*").alias("_doc"), F.col("text"))
    return score(packed, model, "_score").where(F.col("_score") >= threshold).select("_doc.*")
