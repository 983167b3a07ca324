"""WARC: archives written and read on Spark, indexes merged externally.

``write_archives`` writes one WARC/1.1 record per page as Spark text output
(records end in the blank lines that the format asks for, so the file is the
archive; gzip-compressed as one member). The first capture of a payload, the
one with the smallest page_id, is a response; later ones are revisits that
carry the HTTP head only and refer to it.

``read_archives`` parses each archive in a task and yields its captures as a
run sorted by URL key and timestamp. ``merge_runs`` ranges the runs' entries
by (URL key, timestamp, page_id) and in each range merges the slices of the
runs with a loser tree: globally ordered capture histories. One URL with many
captures spreads over ranges, as the range key goes on to the page.

Edge cases: a null html is an empty payload; a null url is written without
target and comes first in the index; a null page_id is never the response of
a payload that a numbered page has; rows that share the smallest page_id and
the payload are responses alike; control characters in a url are
percent-encoded; payloads may hold anything, blank lines and WARC headers
too; an empty table gives an empty index; other columns are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import stage
from tidepool.session import ship_package

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: base32
CRLF = "\r\n"
FIRST_DATE = datetime(2024, 1, 1, tzinfo=timezone.utc)
INDEX = ("urlkey string, timestamp string, page_id long, url string, record_type string, payload_bytes long, "
         "payload_digest string, refers_to long, archive string, offset long, length long, run long")


def base32_sha1(col: Column) -> Column:
    """Bare upper-case base32 SHA-1: 4 times 40 bits, 8 letters each."""
    hexed = F.sha1(col.cast("binary"))
    parts = [F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 10).cast("long") for k in range(4)]
    letters = [F.substring(F.lit(ALPHABET), (F.shiftright(p, 5 * (7 - i)).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
               for p in parts for i in range(8)]
    return F.concat(*letters)


def captures(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, bytes, digest, first (the page that holds the payload's response)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("bytes"), base32_sha1(payload).alias("digest"))
    # One row per payload that more than one row has: staged, so that its true
    # size decides between a broadcast and a shuffled (skew-split) join.
    again = stage(rows.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest")
                  .agg(F.count("*").alias("rows"), F.min("page_id").alias("first"))
                  .where(F.col("rows") > 1).select("digest", "first"), "payloads")
    return rows.join(again, "digest", "left").select("page_id", "url", "payload", "bytes", "digest", "first")


def record(payload: Column, size: Column, digest: Column, first: Column) -> Column:
    """The text of a record, up to the blank lines that end it."""
    revisit = first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    size.cast("string"), F.lit(CRLF + CRLF))
    body = F.when(revisit, F.lit("")).otherwise(payload)
    md = F.md5(F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" "), digest).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(md, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    seconds = F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10 ** 9))
    date = F.date_format(F.timestamp_seconds(seconds + int(FIRST_DATE.timestamp())), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))), line("WARC-Target-URI", url),
        line("WARC-Date", date), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Refers-To-Page-ID", F.when(revisit, first.cast("string"))),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}Content-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit(CRLF + CRLF), http, body)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 16 << 20, min_revisit_bytes: int = 0) -> None:
    """Write the archives under ``path``; each holds about ``archive_bytes`` of average pages."""
    seen = pages.agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("bytes")).first()
    per_file = max(1, int(archive_bytes * seen["n"] // max(1, seen["bytes"] or 1)))
    rows = captures(pages, min_revisit_bytes)
    text = rows.select(record(F.col("payload"), F.col("bytes"), F.col("digest"), F.col("first")).alias("value"))
    (text.write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def url_key(url: str | None) -> str:
    """Reversed host, then path and query, lower-cased; '' for none."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    tail = parts.path + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){tail.lower() or '/'}" if host else url.lower()


HEAD_END = (CRLF * 2).encode()
FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\r\n")


def records(blob: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(header fields, block, offset, length) of each record of an archive."""
    at = 0
    while at < len(blob):
        end = blob.index(HEAD_END, at)
        if not blob.startswith(b"WARC/1.1\r\n", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.decode(): v.decode() for k, v in FIELD.findall(blob, at, end + 2)}
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if blob[stop:stop + 4] != HEAD_END:
            raise ValueError(f"record at byte {at} does not end where it says")
        yield fields, blob[start:stop], at, stop + 4 - at
        at = stop + 4


def parse_archive(name: str, blob: bytes) -> list[tuple]:
    """The archive's captures, sorted: one run of the index."""
    run = int.from_bytes(hashlib.sha1(name.encode()).digest()[:7], "big")
    out = []
    for fields, block, offset, length in records(blob):
        head, _, payload = block.partition(HEAD_END)
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response":
            if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload at byte {offset} of {name} is not what its header says")
        page, refers = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
        url = fields.get("WARC-Target-URI")
        out.append((url_key(url), re.sub(r"\D", "", fields["WARC-Date"]), None if page is None else int(page), url, fields["WARC-Type"],
                    size, digest, None if refers is None else int(refers), name, offset, length, run))
    return sorted(out, key=entry_key)


def entry_key(row: tuple) -> tuple:
    return row[0], row[1], -1 if row[2] is None else row[2], row[9]


def frame(rows: list[tuple]) -> pd.DataFrame:
    cols = [c.split()[0] for c in INDEX.split(", ")]
    out = pd.DataFrame.from_records(rows, columns=cols)
    return out.astype({c: "Int64" for c in ("page_id", "payload_bytes", "refers_to", "offset", "length", "run")})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The sorted runs of all archives under ``path``, one after another."""
    ship_package(spark)

    def parse(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = parse_archive(name, gzip.decompress(content))
                for i in range(0, len(rows), 10_000):
                    yield frame(rows[i:i + 10_000])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, INDEX)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its match, the root's winner is next."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, max(1, len(runs))
        self.at = [0] * self.k
        self.heads = [self._head(i) for i in range(self.k)]
        self.losers = [0] * self.k
        winners = [0] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _head(self, i: int):
        run = self.runs[i] if i < len(self.runs) else []
        return self.key(run[self.at[i]]) if self.at[i] < len(run) else None

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) < (y, b)

    def __iter__(self):
        while self.heads[self.winner] is not None:
            i = self.winner
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._head(i)
            node, best = (i + self.k) // 2, i
            while node >= 1:
                if self._before(self.losers[node], best):
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def merge_runs(runs: DataFrame, entries_per_range: int = 200_000) -> DataFrame:
    """The runs' entries in order of URL key, timestamp and page."""
    spark = runs.sparkSession
    ship_package(spark)
    n = max(spark.sparkContext.defaultParallelism, -(-runs.count() // entries_per_range))

    def merge(batches):
        slices: dict[int, list[tuple]] = {}
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            for row in batch.itertuples(index=False, name=None):
                slices.setdefault(row[11], []).append(row)
        for rows in slices.values():
            rows.sort(key=entry_key)  # a slice arrives sorted; blocks of a run may arrive in any order
        out = []
        for row in LoserTree([slices[r] for r in sorted(slices)], entry_key):
            out.append(row)
            if len(out) == 10_000:
                yield frame(out)
                out = []
        if out:
            yield frame(out)

    ranged = runs.repartitionByRange(n, "urlkey", "timestamp", "page_id", "archive", "offset")
    return ranged.mapInPandas(merge, INDEX)


def archive_and_index(pages: DataFrame, path: str, **params) -> DataFrame:
    """Write the archives, read them back, merge their runs into one index."""
    write_archives(pages, path, **params)
    return merge_runs(stage(read_archives(pages.sparkSession, path), "runs"))
