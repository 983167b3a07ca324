"""Spelling variants: a dictionary of trie-node pairs.

Two words are near if one inserted, deleted or replaced code point makes one
the other.

1. Words are counted in the JVM; each gets an integer id in sorted order.
2. The words, and the words read backwards, are range-sorted, and each range is
   read in order with the path of the word before: a word's new letters are
   new nodes of the trie. Nodes that several ranges share lie on the paths of
   the ranges' first and last words, which the driver numbers beforehand (two
   words a range). So every prefix and every suffix is one integer.
3. A word enters the dictionary under (node of its first i letters, node of what
   follows letter i + 1), a skip, and under (node of its first i letters, node
   of the rest), a gap. Equal pairs of two skips are a replaced letter, of a
   skip and a gap a deleted one; of a run of equal letters only the first is
   deleted, so a pair of words meets once. A pair leaves open one letter: no
   more words than letters (and one gap) can share it, whatever the text.
4. Each word takes the count and the best of its near words; forms are followed
   to their last by doubling, on integers.

Edge cases: null and empty texts have no words; a null doc_id is written as the
empty text; rows that are repeated are counted each time; ties of counts go to
the smallest word in code-point order; words of any length are numbered whole;
other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ascii_lower, stage
from tidepool.session import ship_package

RUN = "[a-z\\u00C0-\\u00FF]+"  # fixed value: letters, lower-cased
PART_BITS = 40  # nodes per range

SKIP, SKIP_FIRST, GAP = 0, 1, 2  # a letter left out; the first of its run; a place between letters


def letter_lost(word: Column, draw: Column, every: int) -> Column:
    """``word`` without its letter number ``draw`` % length, for one draw in ``every``."""
    at = (draw % F.length(word)).cast("int")
    return F.when(draw % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def counted_words(docs: DataFrame, min_chars: int = 6, min_count: int = 5, lost_every: int = 199) -> DataFrame:
    """(word, n): the words of ``docs`` with a letter lost in about one of ``lost_every`` (by the crc32 of document and word)."""
    run = F.col("run")
    draw = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.where(F.length(run) >= min_chars).select(letter_lost(run, draw, lost_every).alias("word")).where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def by_range(words: DataFrame, key: str) -> DataFrame:
    """``words`` sorted by ``key``, with ``at``, ascending in that order, and the number ``part`` of the range; staged."""
    ordered = words.repartitionByRange(key).sortWithinPartitions(key)
    return stage(ordered.select("*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part")), "ranges")


def shared_nodes(edges: list[str]) -> dict[tuple[int, str], int]:
    """The trie of the ranges' first and last words: (node, letter) -> node, the root being 0."""
    trie: dict[tuple[int, str], int] = {}
    for word in edges:
        at = 0
        for letter in word:
            at = trie.setdefault((at, letter), len(trie) + 1)
    return trie


def trie_paths(ranges: DataFrame, key: str) -> DataFrame:
    """(id, path): the nodes of the prefixes of ``key``, the empty one first; equal prefixes, and only these, are equal integers."""
    ends = ranges.groupBy("part").agg(F.min(key).alias("a"), F.max(key).alias("z")).collect()  # two words a range
    trie = ranges.sparkSession.sparkContext.broadcast(shared_nodes([w for r in ends for w in (r["a"], r["z"])]))

    def number(batches):
        shared = trie.value
        part, before, path, known, made = None, "", [0], [0], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows, paths = batch.slice(at, 1000), []
                for p, word in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                    if p != part:
                        part, before, path, known, made = p, "", [0], [0], 0
                    same = len(os.path.commonprefix((before, word)))
                    del path[same + 1:], known[same + 1:]
                    for letter in word[same:]:
                        node = shared.get((known[-1], letter), -1) if known[-1] >= 0 else -1
                        known.append(node)
                        if node < 0:
                            made += 1
                            node = ((p + 1) << PART_BITS) + made
                        path.append(node)
                    before = word
                    paths.append(path[:])
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(paths, pa.list_(pa.int64()))], ["id", "path"])

    ordered = ranges.select("id", "part", key).repartition("part").sortWithinPartitions("part", key)
    return ordered.mapInArrow(number, "id long, path array<long>")


def pair_dictionary(words: DataFrame) -> DataFrame:
    """(p, s, id, n, kind): every skip and gap of every word, as pairs of trie nodes. ``words`` has id, word, n, part."""
    backwards = by_range(words.select("id", F.reverse("word").alias("back")), "back")
    both = words.join(trie_paths(words, "word"), "id").join(trie_paths(backwards, "back").withColumnRenamed("path", "rest"), "id")
    rows = both.select("id", "n", "path", "rest", F.split("word", "").alias("letter"), F.length("word").alias("m"))
    node = lambda i, after: (F.get("path", i).alias("p"), F.get("rest", after).alias("s"))
    first = lambda i: (i == 0) | (F.get("letter", i) != F.get("letter", i - 1))
    skips = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: F.struct(
        *node(i, F.col("m") - 1 - i), F.when(first(i), SKIP_FIRST).otherwise(SKIP).alias("kind")))
    gaps = F.transform(F.sequence(F.lit(0), F.col("m")), lambda i: F.struct(*node(i, F.col("m") - i), F.lit(GAP).alias("kind")))
    return rows.select("id", "n", F.explode(F.concat(skips, gaps)).alias("e")).select("e.p", "e.s", "id", "n", "e.kind")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): per word with near words their number and the best of them, (n, -id)."""
    member = F.struct("id", "n", "kind")
    groups = pair_dictionary(words).groupBy("p", "s").agg(F.collect_list(member).alias("all")).where(F.size("all") > 1)
    one = F.col("one")
    meets = lambda x: (x["id"] != one["id"]) & F.when(one["kind"] == GAP, x["kind"] == SKIP_FIRST).when(
        x["kind"] == GAP, one["kind"] == SKIP_FIRST).otherwise(True)
    met = groups.select("all", F.explode("all").alias("one")).select(one["id"].alias("id"), F.filter("all", meets).alias("near"))
    best = F.array_max(F.transform("near", lambda x: F.struct(x["n"].alias("n"), (-x["id"]).alias("at"))))
    return met.where(F.size("near") > 0).select("id", F.size("near").alias("k"), best.alias("best")).groupBy("id").agg(
        F.sum("k").alias("n_near"), F.max("best").alias("best"))


def last_forms(forms: DataFrame) -> DataFrame:
    """(id, root): ``forms`` (id, form) followed to the end, by doubling. Each step multiplies n, so few rounds do."""
    roots = stage(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        after = stage(roots.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if after.where("moved").isEmpty():
            return after.select("id", "root")
        roots = after.select("id", "root")


def forms_of(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of each (word, n): the form is the near word of largest n (the smallest of
    equals), where that is ``ratio`` times the word's at least; the root the last that forms lead to."""
    ship_package(words.sparkSession)
    words = by_range(words, "word").withColumnRenamed("at", "id")
    near = near_words(words)
    known = stage(words.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best.n") >= F.col("n") * ratio, -F.col("best.at")).alias("form")), "near")
    roots = last_forms(known.where(F.col("form").isNotNull()))
    named = known.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    lasts = known.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    return known.join(roots, "id", "left").join(named, "form", "left").join(lasts, "root", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, lost_every: int = 199) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of ``docs``."""
    return forms_of(counted_words(docs, min_chars, min_count, lost_every), ratio)
