"""WARC: exact round trip, revisits, the loser tree, ordered histories."""

import base64
import hashlib
import random

from tidepool.llm import warc


def rows():
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r\nWARC/1.1\r\n\r\n"
    return [(1, "http://b.example/x?q=1", "<p>é</p>"), (2, "http://a.example/", "<p>é</p>"), (3, None, None), (4, "http://a.example/", ""),
            (5, "line\r\nbreak", tricky), (6, "http://[bad", tricky), (None, "http://a.example/n", "only"), (None, "http://a.example/m", "<p>é</p>"),
            (7, "http://a.example/", "x" * 300_000), (8, "http://a.example/", "dup"), (8, "http://a.example/", "dup"), (9, "http://a.example/", "dup")]


def frame(spark, data):
    return spark.createDataFrame([(*r, 1, "x") for r in data], "page_id long, url string, html string, bytes int, digest string").repartition(4)


def test_round_trip(spark, tmp_path):
    got = warc.archive_and_index(frame(spark, rows()), str(tmp_path / "a"), archive_bytes=1000).collect()
    assert len(got) == len(rows())
    first = {}
    for page, _, html in rows():
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    want = []
    for page, url, html in rows():
        blob = (html or "").encode()
        lead = first.get(html or "")
        again = lead is not None and lead != page
        want.append((page, len(blob), base64.b32encode(hashlib.sha1(blob).digest()).decode(), "revisit" if again else "response", lead if again else None))
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    assert {r.url for r in got if r.page_id == 5} == {"line%0D%0Abreak"} and {r.url for r in got if r.page_id == 3} == {None}
    order = [(r.urlkey, r.timestamp, -1 if r.page_id is None else r.page_id) for r in got]
    assert order == sorted(order)  # collected partition after partition: globally ordered


def test_small_payloads_can_stay_responses(spark, tmp_path):
    got = warc.archive_and_index(frame(spark, rows()), str(tmp_path / "b"), min_revisit_bytes=5).collect()
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 5)
    assert any(r.record_type == "revisit" for r in got)


def test_empty(spark, tmp_path):
    assert warc.archive_and_index(frame(spark, rows()).limit(0), str(tmp_path / "c")).count() == 0


def test_loser_tree():
    rng = random.Random(5)
    for k in range(0, 20):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(30))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda v: v)) == sorted(v for r in runs for v in r)


def test_base32(spark):
    texts = ["", "a", "é" * 100]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.base32_sha1(warc.F.col("t")).alias("d")).collect()
    assert [r.d for r in got] == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]
