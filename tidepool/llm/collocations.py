"""Phrase collocations: phrase counts from suffix subtrees, built group by group.

1. Words are hashed and counted per language; only words found ``min_count``
   times can be in a phrase found that often. Their hashes set bits in a map of
   fixed size (8 MB at most), which every later scan uses to end its suffixes.
2. Vertical partitioning: the suffixes that begin with one word form a subtree.
   A word that begins more suffixes than a group's memory budget is extended to
   two-word prefixes, these to three and four, by further scans that count only
   such words; prefixes within the budget go to groups by hash. A budget of
   ``budget`` suffixes leaves at most 2 * words / ``budget`` prefixes to extend.
3. Each task cuts its words to suffixes of at most ``longest`` words, counts
   equal ones and sends them, packed, to their prefix's group, where the subtree
   is built on its own: suffixes in order, every node's total the sum of its
   leaves. Totals of nodes above an extended prefix are summed over its groups.
4. Scores, the drop rule and the ranks are joins and aggregates on phrases.
   Parts found in over one in ``hot_share`` of all words are looked up in a
   broadcast (as few as that), others in a shuffled join, where a part found f
   times has at most f / ``min_count`` phrases of each shape.

Edge cases: null and empty texts have no words; a null lang is ``und``; repeated
rows count each time; ties go by count, then phrase; a null doc_id does not
matter; other columns are not read; an empty table gives an empty one; long
texts are read block by block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.blobs import packed, unpacked
from tidepool.llm.common import stage
from tidepool.llm.word_hash import U64, byte_words, column_bytes, mix
from tidepool.session import ship_package

# What ends a piece, and what parts its words.
IS_BREAK = np.zeros(256, bool)
IS_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
IS_GAP = IS_BREAK.copy()
IS_GAP[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

LONGEST = 4
FLUSH = 1_000_000  # words held before a task sends them on
MAP_BITS = 26
MAP_PART = 20
END = U64(0)  # in place of a word after the last
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def language_hashes(langs: list) -> list[tuple[int, int]]:
    """Two hashes of each language, to be mixed into those of its words."""
    out = []
    for lang in langs:
        raw = hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        out.append((int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:], "little")))
    return out


def chunks_of(batch: pa.RecordBatch):
    """(one, two, next, starts, ends, rows, bytes) of up to about FLUSH words of the columns lang, text: two hashes of
    (language, word), whether the next word is in the same piece, the word's place and row."""
    langs = batch.column(0).to_pylist()
    known = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
    salt = np.array(language_hashes(list(known)), U64).reshape(len(known), 2)
    code = np.array([known[lang] for lang in langs], np.int64)
    offsets, data = column_bytes(batch.column(1))
    held, size = [], 0
    for words in byte_words(offsets, data, True, IS_GAP):
        if not len(words.starts):
            continue
        rows = np.repeat(np.arange(len(words.counts)) + words.first_row, words.counts)
        lo, hi = int(words.starts[0]), int(words.ends[-1])
        piece = np.searchsorted(np.flatnonzero(IS_BREAK[data[lo:hi]]) + lo, words.starts)
        following = np.zeros(len(rows), bool)
        following[:-1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
        one, two = (mix(h ^ salt[code[rows], k]) for k, h in enumerate(words.hashes))
        one[one == END] = U64(1)
        held.append((one, two, following, words.starts, words.ends, rows))
        size += len(rows)
        if size >= FLUSH:
            yield (*map(np.concatenate, zip(*held)), data)
            held, size = [], 0
    if held:
        yield (*map(np.concatenate, zip(*held)), data)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def word_counts(docs: DataFrame, min_count: int) -> DataFrame:
    """(lang, word, one, two, f) of words found ``min_count`` times; with a null word, all words of a language. Staged."""
    def count(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for one, two, _, starts, ends, rows, data in chunks_of(batch):
                _, first, found = np.unique(one, return_index=True, return_counts=True)
                words = [LOWER[data[a:b]].tobytes() for a, b in zip(starts[first], ends[first])]
                total: dict[str, int] = {}
                for row, n in zip(*np.unique(rows, return_counts=True)):
                    total[langs[row]] = total.get(langs[row], 0) + int(n)
                none = [None] * len(total)
                yield pa.RecordBatch.from_arrays([
                    pa.array([langs[r] for r in rows[first]] + list(total), pa.string()),
                    pa.array(words + none, pa.binary()).cast(pa.string()),
                    pa.array(one[first].view(np.int64).tolist() + none, pa.int64()),
                    pa.array(two[first].view(np.int64).tolist() + none, pa.int64()),
                    pa.array(found.tolist() + list(total.values()), pa.int64())], ["lang", "word", "one", "two", "f"])

    each = texts_of(docs).mapInArrow(count, "lang string, word string, one long, two long, f long")
    summed = each.groupBy("lang", "word", "one", "two").agg(F.sum("f").alias("f"))
    return stage(summed.where(F.col("word").isNull() | (F.col("f") >= min_count)), "words")


def word_map(words: DataFrame) -> bytes:
    """Bits, compressed: the cells (by the second hash) of the words found often enough. Of a fixed size."""
    cell = F.shiftrightunsigned("two", 64 - MAP_BITS)
    width = 1 << MAP_PART

    def fill(batches):
        at, bits = None, None
        for batch in batches:
            parts, cells = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in np.unique(parts):
                if part != at:
                    if at is not None:
                        yield filled(at, bits)
                    at, bits = part, np.zeros(width, bool)
                bits[cells[parts == part] & (width - 1)] = True
        if at is not None:
            yield filled(at, bits)

    def filled(part, bits):
        blob = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([blob], pa.binary())], ["part", "bits"])

    cells = words.where(F.col("word").isNotNull()).select(F.shiftright(cell, MAP_PART).alias("part"), cell.alias("cell"))
    found = cells.repartition("part").sortWithinPartitions("part").mapInArrow(fill, "part long, bits binary").collect()
    whole = np.zeros((1 << MAP_BITS) // 8, np.uint8)  # the parts together: 8 MB
    size = width // 8
    for r in found:
        whole[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(zstandard.decompress(bytes(r["bits"])), np.uint8)
    return zstandard.ZstdCompressor(level=3).compress(whole.tobytes())


def frequent(bits: np.ndarray, two: np.ndarray) -> np.ndarray:
    cell = (two >> U64(64 - MAP_BITS)).astype(np.int64)
    return (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & np.uint8(1) == 1


def suffixes(one, ok, following) -> list[np.ndarray]:
    """For each word that begins a suffix of two words or more, its words, END after the last."""
    at = np.flatnonzero(ok[:-1] & following[:-1] & ok[1:])
    out = [one[at], one[at + 1]]
    alive = np.ones(len(at), bool)
    for k in range(2, LONGEST):
        there = np.minimum(at + k, len(one) - 1)
        alive &= (at + k < len(one)) & following[there - 1] & ok[there]
        out.append(np.where(alive, one[there], END))
    return out


def prefix_key(words: list[np.ndarray]) -> np.ndarray:
    key = words[0]
    for w in words[1:]:
        key = mix(key * U64(0x9E3779B97F4A7C15) + w)
    return key


def within(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def ascending(keys) -> np.ndarray:
    return np.sort(np.array([k % (1 << 64) for k in keys], U64))


def extended(rows: DataFrame, shared, hot: np.ndarray, depth: int, limit: int) -> np.ndarray:
    """The keys of prefixes of ``depth`` + 1 words found over ``limit`` times, of those that extend a ``hot`` one."""
    def count(batches):
        bits = opened(shared)
        for batch in batches:
            for one, two, following, *_ in chunks_of(batch):
                cut = suffixes(one, frequent(bits, two), following)
                more = within(prefix_key(cut[:depth]), hot) & (cut[depth] != END)
                key, found = np.unique(prefix_key([w[more] for w in cut[:depth + 1]]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(found.astype(np.int64))], ["key", "f"])

    found = rows.mapInArrow(count, "key long, f long").groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") > limit)
    return ascending(r["key"] for r in found.select("key").collect())  # at most words / limit keys


def opened(shared) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(shared.value), np.uint8)


ENTRY = (np.uint64, np.int32, np.int32, np.int32, np.int32, np.int64, np.int8)  # the words' hashes; indexes of four, count, prefix length


def phrase_counts(docs: DataFrame, words: DataFrame, min_count: int, budget: int) -> DataFrame:
    """(w1, w2, w3, w4, f): hashes of the words (0 after the last) of every phrase of 2 to 4 words found ``min_count`` times. Staged."""
    spark = docs.sparkSession
    rows = texts_of(docs)
    total = words.where(F.col("word").isNull()).agg(F.sum("f")).first()[0] or 0
    limit = max(1, budget // 2)
    shared = spark.sparkContext.broadcast(word_map(words))
    hot = [ascending(r["one"] for r in words.where(F.col("word").isNotNull() & (F.col("f") > limit)).select("one").collect())]  # at most total / limit
    for depth in range(1, LONGEST - 1):
        hot.append(extended(rows, shared, hot[-1], depth, limit) if len(hot[-1]) else hot[-1])
    groups = max(spark.sparkContext.defaultParallelism, -(-total // budget))

    def cut(batches):
        bits = opened(shared)
        for batch in batches:
            for one, two, following, *_ in chunks_of(batch):
                part = suffixes(one, frequent(bits, two), following)
                if len(part[0]):
                    yield sent(part)

    def sent(part):
        names, local = np.unique(np.concatenate(part), return_inverse=True)
        local = local.reshape(LONGEST, -1).astype(np.uint64)
        shift = U64(max(1, int(len(names)).bit_length()))
        left, right = (local[0] << shift) | local[1], (local[2] << shift) | local[3]
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        first = np.flatnonzero(fresh)
        found = np.diff(np.append(first, len(order)))
        local, part = local[:, order[first]], [w[order[first]] for w in part]
        # The prefix that a suffix goes by: the shortest that need not be extended (a suffix that ends before goes by all
        # it has, and counts as extended like the others of its prefix).
        key, depth, more = part[0], np.ones(len(first), np.int8), np.ones(len(first), bool)
        for k, keys in enumerate(hot):
            more = more & within(prefix_key(part[:k + 1]), keys)
            depth[more] += 1
            more &= part[k + 1] != END
            key = np.where(more, prefix_key(part[:k + 2]), key)
        group = ((mix(key) >> U64(32)) * U64(groups) >> U64(32)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        edges = np.flatnonzero(np.diff(group[order], prepend=-1))
        ids, blobs = [], []
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            mine = order[a:b]
            used, index = np.unique(local[:, mine], return_inverse=True)
            index = index.reshape(LONGEST, -1).astype(np.int32)
            ids.append(int(group[mine[0]]))
            blobs.append(packed([names[used.astype(np.int64)], *index, found[mine].astype(np.int64), depth[mine]]))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], ["group", "suffixes"])

    def build(batches):
        at, held = None, []
        for batch in batches:
            for group, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if group != at:
                    yield from subtree(held)
                    at, held = group, []
                held.append(unpacked(blob.as_py(), ENTRY))
        yield from subtree(held)

    def subtree(held):
        """Totals of the nodes of one group: those complete and frequent, and those above an extended prefix."""
        if not held:
            return
        names = np.unique(np.concatenate([[END], *(h[0] for h in held)]))  # END is the first
        local = [np.concatenate([np.searchsorted(names, h[0])[h[1 + k]] for h in held]).astype(np.uint64) for k in range(LONGEST)]
        found, depth = np.concatenate([h[5] for h in held]), np.concatenate([h[6] for h in held])
        held.clear()
        shift = U64(max(1, int(len(names)).bit_length()))
        left, right = (local[0] << shift) | local[1], (local[2] << shift) | local[3]
        order = np.lexsort((right, left))
        local = [w[order].astype(np.int64) for w in local]
        found, depth = found[order], depth[order]
        fresh = np.zeros(len(order), bool)
        fresh[0] = True
        fresh[1:] = local[0][1:] != local[0][:-1]
        for k in range(1, LONGEST):
            fresh[1:] |= local[k][1:] != local[k][:-1]
            first = np.flatnonzero(fresh)
            f = np.add.reduceat(found, first)
            keep = (local[k][first] != 0) & ((f >= min_count) | (depth[first] > k + 1))
            first, f = first[keep], f[keep]
            none = np.zeros(len(first), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(names[local[i][first]].view(np.int64) if i <= k else none) for i in range(LONGEST)), pa.array(f)], [*WORDS, "f"])

    sent_on = rows.mapInArrow(cut, "group int, suffixes binary")
    nodes = sent_on.repartition(groups, "group").sortWithinPartitions("group").mapInArrow(
        build, ", ".join(f"{w} long" for w in WORDS) + ", f long")
    return stage(nodes.groupBy(*WORDS).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count), "phrases")


def part_of(first: int, last: int) -> list[Column]:
    """The words ``first`` .. ``last`` (from 1) of a phrase, as a phrase."""
    return [(F.col(WORDS[first - 1 + i]) if first + i <= last else F.lit(0).cast("long")).alias(f"s{i + 1}") for i in range(LONGEST)]


def length_of() -> Column:
    return F.lit(1) + sum(((F.col(w) != 0).cast("int") for w in WORDS[1:]), F.lit(0))


def scored(phrases: DataFrame, words: DataFrame, hot_share: int) -> DataFrame:
    """w1 .. w4, a, lang, l, r, score: each phrase by its lowest-scoring cut."""
    zero = F.lit(0).cast("long")
    singles = words.where(F.col("word").isNotNull()).select(F.col("one").alias("s1"), *[zero.alias(f"s{i}") for i in range(2, LONGEST + 1)], "f", "lang")
    known = phrases.select(*[F.col(w).alias(f"s{i + 1}") for i, w in enumerate(WORDS)], "f", F.lit(None).cast("string").alias("lang")).unionByName(singles)
    total = words.where(F.col("word").isNull()).agg(F.sum("f")).first()[0] or 0
    hot = known.where(F.col("f") > total / hot_share)  # at most hot_share words, as many pairs, ...
    sized = phrases.withColumnRenamed("f", "a").withColumn("m", length_of())
    sides = []
    for m in range(2, LONGEST + 1):
        for k in range(1, m):
            for side, first, last in (("l", 1, k), ("r", k + 1, m)):
                sides.append(F.when(F.col("m") == m, F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), *part_of(first, last))))
    asked = sized.select(*WORDS, "a", F.explode(F.array_compact(F.array(*sides))).alias("c")).select(*WORDS, "a", "c.*")
    on = [f"s{i + 1}" for i in range(LONGEST)]
    told = asked.join(F.broadcast(hot), on).unionByName(
        asked.join(F.broadcast(hot.select(*on)), on, "left_anti").join(known.where(F.col("f") <= total / hot_share), on))
    cuts = told.groupBy(*WORDS, "a", "k").agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"),
                                              F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"), F.max("lang").alias("lang"))
    score = F.expr("CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))").cast("long")
    cut = F.struct(score.alias("score"), "k", "l", "r")
    return cuts.groupBy(*WORDS, "a").agg(F.max("lang").alias("lang"), F.min(cut).alias("cut")).select(
        *WORDS, "a", "lang", "cut.l", "cut.r", "cut.score")


def largest_longer(phrases: DataFrame) -> DataFrame:
    """w1 .. w4, longer: for each phrase inside longer ones, the largest count of these."""
    sized = phrases.withColumn("m", length_of()).where(F.col("m") > 2)
    inner = [F.when(F.col("m") == m, F.struct(*part_of(i, i + n - 1)))
             for m in range(3, LONGEST + 1) for n in range(2, m) for i in range(1, m - n + 2)]
    parts = sized.select("f", F.explode(F.array_compact(F.array(*inner))).alias("p")).select("f", "p.*")
    return parts.groupBy(*[F.col(f"s{i + 1}").alias(w) for i, w in enumerate(WORDS)]).agg(F.max("f").alias("longer"))


def report(docs: DataFrame, min_count: int = 30, top: int = 2000, drop_percent: int = 80, budget: int = 2_000_000,
           hot_share: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    ship_package(docs.sparkSession)
    words = word_counts(docs, min_count)
    phrases = phrase_counts(docs, words, min_count, budget)
    inside = scored(phrases, words, hot_share).join(largest_longer(phrases), WORDS, "left")
    stay = inside.where(F.col("longer").isNull() | (100 * F.col("longer") < drop_percent * F.col("a"))).drop("longer")
    by = Window.partitionBy("lang")
    first = stay.withColumn("place", F.rank().over(by.orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= top)
    first = stage(first, "first")  # with ties at the end; what follows is of this size
    spelt = words.where(F.col("word").isNotNull()).select(F.col("one").alias("w"), "word")
    each = first.select("*", F.posexplode(F.array(*WORDS)).alias("i", "w")).where(F.col("w") != 0).join(spelt, "w")
    named = each.groupBy("lang", *WORDS, "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = by.orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    n = words.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
