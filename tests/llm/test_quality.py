"""Held-out accuracy, folds and edge cases of the quality classifier."""

import zlib

from tidepool.llm import quality

from .brute import docs_frame, prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.report(docs, labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_held_out_labels_are_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality")
    scores = lambda y: {r.doc_id: r.score for r in quality.report(docs, y).collect()}
    assert scores(labels) == scores(flipped)


def test_edges(spark):
    docs = docs_frame(spark)
    labels = spark.createDataFrame([(1, 1), (2, 1), (10, 0), (12, 0), (None, 1), (14, None), (11, 0), (200, 1), (201, 0)], "doc_id long, quality int")
    rows = quality.report(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1  # null as empty
    kept = quality.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_pieces_cover_whole_texts(spark):
    texts = ["", None, "é" * 3000, "x" * quality.PIECE, "y" * (quality.PIECE + 1)]
    frame = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, quality int")
    got = {}
    for r in sorted(quality.pieces_of(frame).collect(), key=lambda r: (r.doc_id, r.n)):
        assert 0 < len(r.piece) <= quality.PIECE
        got[r.doc_id] = got.get(r.doc_id, b"") + bytes(r.piece)
    assert got == {i: t.encode() for i, t in enumerate(texts) if t}


def test_what_is_bad_only_after_a_clean_lead_is_learnt(spark):
    """Long texts differ in their rest only; the dictionaries hold its markers."""
    clean = prose(1, 700)
    rows = [(i, clean + " " + " ".join(f"{'fine' if i % 2 else 'junk'}marker{(i * 7 + k) % 40}" for k in range(300)), "en", "s") for i in range(160)]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i, *_ in rows], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert b"junkmarker" in model["bad"] and b"finemarker" in model["good"]
    assert all(r.predicted == r.doc_id % 2 for r in quality.report(docs, labels).collect())
