"""Substring dedup: a count-min prefilter, then exact grouping.

A window is ``n`` consecutive words. A word goes if it is in a window whose
word sequence also starts in a document with a smaller doc_id.

1. Every task counts its windows in a count-min sketch of two rows of 2-bit
   counters (0, 1, 2 or more), sent as sorted, compressed cell lists. The
   merged rows overestimate: a window found twice is at 2 in both rows.
2. A second pass takes only windows estimated repeated. In each chunk of a
   task, a window's occurrences after the chunk's smallest doc_id are settled
   at once; the others go, packed, to the task of their hash range, where
   windows are grouped exactly (128 bits) and held against the smallest
   doc_id. So a window found in a third of all documents sends one entry per
   chunk.
3. Repeated windows go, packed, to the task of their documents' range, which
   has each document's positions in order, a byte each; the words in them are
   removed.

The sketch has 2 * ``cells`` counters, from the bytes of the texts, at most
``max_cells`` per row; beyond that more windows go to the exact pass, none is
lost. The merged "2 or more" bits, ``max_cells`` / 4 bytes at most, are
broadcast under a name of the table's own. A shard's entries stay packed but for the
sub-range of the hash that is being grouped.

Edge cases: null, empty and short texts have no windows and lose nothing;
rows that share a doc_id never remove each other's words, so equal rows get
equal results; a null doc_id counts as smaller than all; an empty table gives
an empty one; other columns are never read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.blobs import packed, unpacked
from tidepool.llm.common import row_key, stage
from tidepool.llm.word_hash import U64, column_words, window_hashes
from tidepool.session import ship_package

NO_ID = -(2 ** 63)
PART_BITS = 22  # cells per part of a sketch row
FLUSH = 1_000_000  # windows held before a task sends them on


def sketch_bits(text_bytes: int, max_cells: int) -> int:
    """log2 of the cells per row: about four per window, at least one part."""
    want = max(1 << PART_BITS, min(max_cells, text_bytes // 2))
    return (want - 1).bit_length()


def cells_of(pair, bits: int):
    """A cell for each row of the sketch, by independent hashes."""
    return [(h >> U64(64 - bits)).astype(np.uint32) for h in pair]


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.cumsum(np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel(), dtype=dtype)


def sketch(docs: DataFrame, n: int, bits: int) -> bytes:
    """The bits of the cells counted twice or more, row after row."""
    parts = 1 << (bits - PART_BITS)
    width = 1 << PART_BITS

    def sent(held):
        ids, blobs = [], []
        for row in (0, 1):
            cells = np.sort(np.concatenate([c[row] for c in held]))
            third = np.zeros(len(cells), bool)
            third[2:] = cells[2:] == cells[:-2]  # two of a cell say enough
            cells = cells[~third]
            edges = np.searchsorted(cells, np.arange(parts + 1, dtype=np.uint64) << U64(PART_BITS))
            for p in range(parts):
                if edges[p] < edges[p + 1]:
                    ids.append(row * parts + p)
                    blobs.append(pack(cells[edges[p]:edges[p + 1]] - np.uint32(p << PART_BITS)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["part", "cells"])

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for words in column_words(batch.column(0)):
                pair, _, _ = window_hashes(words, n)
                held.append(cells_of(pair, bits))
                size += len(pair[0])
                if size >= FLUSH:
                    yield sent(held)
                    held, size = [], 0
        if size:
            yield sent(held)

    def merge(batches):
        at, counts = None, None
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != at:
                    if at is not None:
                        yield merged(at, counts)
                    at, counts = part, np.zeros(width, np.uint8)
                cells = unpack(blob, np.uint32)
                again = np.zeros(len(cells), bool)
                again[1:] = cells[1:] == cells[:-1]
                counts[cells[~again]] = np.minimum(counts[cells[~again]] + 1, 2)
                counts[cells[again]] = 2
        if at is not None:
            yield merged(at, counts)

    def merged(part, counts):
        blob = zstandard.ZstdCompressor(level=1).compress(np.packbits(counts >= 2).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["part", "bits"])

    counted = docs.select("text").mapInArrow(count, "part int, cells binary")
    done = counted.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, bits binary")
    size = width // 8
    whole = np.zeros(2 * parts * size, np.uint8)  # max_cells / 4 bytes at most
    for r in done.collect():
        whole[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(zstandard.decompress(bytes(r["bits"])), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(whole.tobytes())


_OPEN: dict[str, np.ndarray] = {}  # of this worker: the sketch that it reads, by its own name


def opened(shared) -> np.ndarray:
    name, blob = shared.value
    if name not in _OPEN:
        _OPEN.clear()
        _OPEN[name] = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return _OPEN[name]


def let_go() -> None:
    """A worker that scanned before has no use for the sketch; another scan opens it again."""
    _OPEN.clear()


def by_document(ids, rows, at):
    """(steps, ends, counts, ids, rows): each document's positions in order, as the steps between them, a byte each (255
    says that the step goes on); where its bytes end, how many positions they are."""
    order = np.lexsort((at, rows, ids))
    ids, rows, at = ids[order], rows[order], at[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(fresh)
    gaps = np.diff(at, prepend=0)
    gaps[first] = at[first]
    more = gaps // 255
    places = np.cumsum(more + 1)
    steps = np.full(int(places[-1]) if len(places) else 0, 255, np.uint8)
    steps[places - 1] = gaps % 255
    last = np.append(first[1:], len(ids))[:len(first)] - 1
    return steps, places[last], np.diff(np.append(first, len(ids))).astype(np.int32), ids[first], rows[first]


def positions_of(steps: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """The positions of one document, or of documents of ``counts`` positions each."""
    at = np.cumsum(steps, dtype=np.int64)[steps != 255]
    if counts is not None and len(counts) > 1:
        at = at - np.repeat(np.concatenate([[0], at[np.cumsum(counts)[:-1] - 1]]), counts)
    return at


def estimated_repeated(rows: np.ndarray, cells) -> np.ndarray:
    out = np.ones(len(cells[0]), bool)
    for bits, cell in zip(np.split(rows, 2), cells):
        out &= (bits[cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8)) & np.uint8(1) == 1
    return out


def smallest_of_groups(one, two, ids):
    """(order, group start flags, each entry's group's smallest id) by equal hash pairs."""
    order = np.lexsort((ids, two, one))
    a, b = one[order], two[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = ids[order][fresh][np.cumsum(fresh) - 1]
    return order, fresh, least


# A blob: steps between hashes, second hashes, local document and position of each; the documents' ids and rows.
ENTRY = (np.uint64, np.uint64, np.int32, np.int32, np.int64, np.int64)
# Repeated windows: steps between a document's positions, how many it has, the documents' ids and rows.
FOUND = (np.uint8, np.int32, np.int64, np.int64)
SUB_RANGE = 250_000  # entries, about, that are grouped at a time


def repeated_windows(docs: DataFrame, n: int, bits: int, shared, shards: int) -> DataFrame:
    """(id, row, windows): for each row with windows that also start in a document with a smaller id, the steps between
    their positions.

    ``shared``: the broadcast (name, sketch), the name being the table's own."""

    def found_blob(ids, rows, at) -> bytes:
        steps, _, counts, ids, rows = by_document(ids, rows, at)
        return packed([steps, counts, ids, rows])

    def opened_blob(blob: bytes):
        steps, counts, ids, rows = unpacked(blob, FOUND)
        return np.repeat(ids, counts), np.repeat(rows, counts), positions_of(steps, counts)

    def settle(held):
        """One chunk: what it can say alone, and the entries that go on, by shard."""
        one, two, ids, rows, at = (np.concatenate(c) for c in zip(*held))
        order, _, least = smallest_of_groups(one, two, ids)
        mine = ids[order] > least
        names, blobs = [], []
        if mine.any():
            done = order[mine]
            names.append(int(rows[done[0]] % shards))
            blobs.append(b"s" + found_blob(ids[done], rows[done], at[done]))
        left = order[~mine]  # in order of the first hash, so of the shard
        shard = ((one[left] >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
        edges = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(left))):
            part = left[a:b]
            who, first, local = np.unique(rows[part], return_index=True, return_inverse=True)
            names.append(int(shard[a]))
            blobs.append(b"e" + packed([np.diff(one[part], prepend=U64(0)), two[part], local.astype(np.int32), at[part].astype(np.int32), ids[part][first], who]))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "entries"])

    def scan(batches):
        rows_of_sketch = opened(shared)
        held, size, seen = [], 0, 0
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for words in column_words(batch.column(2)):
                pair, local, at = window_hashes(words, n)
                mask = estimated_repeated(rows_of_sketch, cells_of(pair, bits))
                if mask.any():
                    local = local[mask] + words.first_row
                    held.append((pair[0][mask], pair[1][mask], ids[local], keys[local], at[mask]))
                    size += int(mask.sum())
                if size >= FLUSH:
                    yield settle(held)
                    held, size = [], 0
        if size:
            yield settle(held)

    def group(batches):
        let_go()
        at, held, done = None, [], []
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard != at:
                    yield from sent_home(done + resolve(at, held))
                    at, held, done = shard, [], []
                blob = blob.as_py()
                if blob[:1] == b"s":
                    done.append(opened_blob(blob[1:]))
                else:
                    steps, *rest = unpacked(blob[1:], ENTRY)
                    held.append((np.cumsum(steps, dtype=U64), *rest))
        yield from sent_home(done + resolve(at, held))

    def resolve(shard, held):
        """Group a shard's entries, a sub-range of the hash at a time; equal windows are in one."""
        steps = -(-sum(len(h[0]) for h in held) // SUB_RANGE)
        low, width = (shard << 64) // shards if held else 0, (1 << 64) // shards + 1
        start, found = [0] * len(held), []
        for k in range(1, steps + 1):
            edge = U64(min(low + width * k // steps, 2 ** 64 - 1))
            stop = [len(h[0]) if k == steps else int(np.searchsorted(h[0], edge)) for h in held]
            part = [(h[0][a:b], h[1][a:b], h[4][h[2][a:b]], h[5][h[2][a:b]], h[3][a:b]) for h, a, b in zip(held, start, stop) if a < b]
            start = stop
            if part:
                one, two, ids, rows, at = (np.concatenate(c) for c in zip(*part))
                order, _, least = smallest_of_groups(one, two, ids)
                done = order[ids[order] > least]
                if len(done):
                    found.append((ids[done], rows[done], at[done].astype(np.int64)))
        held.clear()
        return found

    def sent_home(found):
        """A shard's repeated windows, one blob for each range of documents."""
        if not found:
            return
        ids, rows, at = (np.concatenate(c) for c in zip(*found))
        home = ((rows.view(np.uint64) >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        edges = np.flatnonzero(np.diff(home[order], prepend=-1))
        names, blobs = [], []
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            part = order[a:b]
            names.append(int(home[part[0]]))
            blobs.append(found_blob(ids[part], rows[part], at[part]))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["home", "found"])

    def gather(batches):
        at, held = None, []
        for batch in batches:
            for home, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if home != at:
                    yield from documents(held)
                    at, held = home, []
                held.append(opened_blob(blob.as_py()))
        yield from documents(held)

    def documents(held):
        if held:
            steps, ends, _, ids, rows = by_document(*(np.concatenate(c) for c in zip(*held)))
            offsets = np.concatenate([[0], ends]).astype(np.int64)
            windows = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(steps.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rows), windows.cast(pa.binary())], ["id", "row", "windows"])

    keyed = docs.select(*keys_of(), "text")
    entries = keyed.mapInArrow(scan, "shard int, entries binary")
    repeated = entries.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(group, "home int, found binary")
    return repeated.repartition(shards, "home").sortWithinPartitions("home").mapInArrow(gather, "id long, row long, windows binary")


def keys_of() -> list:
    """A row by its id and the hash of its text: two rows with both equal are equal."""
    return [row_key(F.col("text")).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id")]


def removed_windows(docs: DataFrame, n: int = 13, max_cells: int = 1 << 29, shard_bytes: int = 16 << 20) -> DataFrame:
    """(id, row, windows): for each row with repeated windows, the steps between their positions, staged."""
    spark = docs.sparkSession
    ship_package(spark)
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch_bits(text_bytes, max_cells)
    shards = max(spark.sparkContext.defaultParallelism, -(-text_bytes // shard_bytes))
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, sketch(docs, n, bits)))
    found = repeated_windows(docs, n, bits, shared, shards)
    done = stage(found, "windows")
    shared.destroy()  # what it told is written
    return done


def cut(docs: DataFrame, n: int = 13, **params) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words, joined by one space) of every row."""
    gone = removed_windows(docs, n, **params)
    texts = docs.select("doc_id", "text", *keys_of())

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2)):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                lost = 0
                if found.is_valid:
                    at = positions_of(np.frombuffer(found.as_py(), np.uint8))
                    change = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + n, minlength=len(words) + 1)
                    keep = np.cumsum(change[:-1]) == 0
                    lost = len(words) - int(keep.sum())
                    words = [words[i] for i in np.flatnonzero(keep)]
                n_words.append(len(words) + lost)
                n_removed.append(lost)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])

    joined = texts.join(gone, ["id", "row"], "left").select("doc_id", "text", "windows")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept string")


def report(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return cut(docs, **params).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
