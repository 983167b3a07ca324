"""Benchmark decontamination: hashed item windows, broadcast, scanned, verified.

Words are runs of 0-9, a-z (A-Z lower-cased) and everything from U+0080 up. A
window is ``n`` consecutive words of a benchmark item, or the whole item when
it has fewer. Every window of every document is hashed and looked up in the
broadcast hash set of item windows; a hit is verified word by word, so hash
collisions never count. A document word inside any verified occurrence is
hit; the words, or the whole document, can then be removed.

The item windows are measured first, words and item ids alike, and broadcast
only up to ``max_broadcast_bytes``; a larger benchmark takes Spark's shuffled
join with the same rows.

Edge cases: null or wordless texts have no words, no windows, no hits; a
wordless item has no window; rows of one item_id are one item, a null item_id
hits words but is not listed; repeated document rows get equal results; rows
with one doc_id and different texts are judged apart; empty tables are fine;
other columns are never read.
"""

from __future__ import annotations

from string import ascii_letters, ascii_lowercase, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ascii_lower, row_key, sha256


def ascii_without(kept: str) -> str:
    """ASCII but ``kept``, to stand in a character class.

    The characters are named one by one: Java looks them up in one table,
    where a union of ranges is a chain of calls (ten times the time).
    """
    return "".join(f"\\x{c:02X}" for c in range(128) if chr(c) not in kept)


# What a word is made of, after A-Z are lower-cased; and before.
WORD = f"[^{ascii_without(digits + ascii_lowercase)}]+"
CASED_WORD = f"[^{ascii_without(digits + ascii_letters)}]+"
BETWEEN_WORDS = f"[{ascii_without(digits + ascii_letters)}]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def window_hash(word_list: Column, at: Column, n: int) -> Column:
    """The hash of the n words from ``at``: word by word, so that no slice is made and all of it is compiled."""
    return F.xxhash64(F.lit(n), *[F.get(word_list, at + k) for k in range(n)])


def scanned_windows(base: DataFrame, sizes: list[int]) -> DataFrame:
    """(row, w, at, size, h): the hash of each window of each of the ascending ``sizes``, in one pass."""
    starts = F.sequence(F.lit(0), F.size("w") - sizes[0])
    each = base.select("row", "w", F.explode(F.when(F.size("w") >= sizes[0], starts)).alias("at"))
    hashes = [F.struct(F.lit(n).alias("size"), window_hash(F.col("w"), F.col("at"), n).alias("h")) for n in sizes]
    if len(sizes) == 1:
        return each.select("row", "w", "at", hashes[0]["size"].alias("size"), hashes[0]["h"].alias("h"))
    # A window that would go over the end has no hash and finds nothing.
    inside = [F.when(F.size("w") - F.col("at") >= n, h) for n, h in zip(sizes, hashes)]
    return each.select("row", "w", "at", F.inline(F.array(*inside)))


def item_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """(len, window, items): the distinct windows and the items that have them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(n)))
    each = items.select("item", "len", "w", F.explode(F.expr("sequence(1, size(w) - len + 1)")).alias("at"))
    return (each.groupBy("len", F.slice("w", F.col("at"), F.col("len")).alias("window"))
            .agg(F.collect_set("item").alias("items")))


def occurrences(docs: DataFrame, benchmark: DataFrame, n: int = 10,
                max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(row, at, len, items): each verified occurrence of an item window; ``at`` counts words from 0."""
    windows = item_windows(benchmark, n)
    # What a window takes in memory: its words and ids, and 16 bytes for each string's place and padding.
    room = sum(F.octet_length(F.array_join(c, "")) + 16 * F.size(c) + 64 for c in ("window", "items"))
    lengths = {r["len"]: r["bytes"] for r in windows.groupBy("len").agg(F.sum(room).alias("bytes")).collect()}  # n rows at most
    small = sum(lengths.values()) <= max_broadcast_bytes
    base = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), words(F.col("text")).alias("w"))
    sizes = sorted(lengths) or [n]
    of_size = [F.when(F.col("len") == k, window_hash(F.col("window"), F.lit(0), k)) for k in sizes]
    windows = windows.withColumn("hash", F.coalesce(*of_size))
    scanned = scanned_windows(base, sizes)
    said = F.slice(F.col("w"), F.col("at") + 1, F.col("size"))
    if small:  # the words stay where they are; only hash hits are sliced and verified
        # As two inequalities the verification is no join key, which would be made for every window.
        same = (said >= F.col("window")) & (said <= F.col("window"))
        hits = scanned.join(F.broadcast(windows), (F.col("h") == F.col("hash")) & same)
    else:  # what travels is the window, not the whole text's words
        windowed = scanned.select("row", "at", "h", said.alias("said"))
        hits = windowed.join(windows, (F.col("h") == F.col("hash")) & (F.col("said") == F.col("window")))
    return hits.select("row", "at", "len", "items")


def hit_spans(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """(row, spans, items, n_hit) of each contaminated row.

    ``spans``: the occurrences as sorted (at, len); ``items``: the distinct
    item ids, sorted as strings.
    """
    by_row = occurrences(docs, benchmark, **params).groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("at", "len"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, s):
        end = s["at"] + s["len"]
        fresh = F.greatest(F.lit(0), end - F.greatest(s["at"], acc["end"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))

    return by_row.withColumn("n_hit", F.aggregate("spans", start, add, lambda acc: acc["n"]))


def report(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"),
                       F.size(words(F.col("text"))).cast("long").alias("n_words"))
    hits = hit_spans(docs, benchmark, **params)
    none = F.array().cast("array<string>")
    out = rows.join(hits, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("long").alias("n_items"),
        sha256(F.concat_ws(",", F.coalesce("items", none))).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows in which any item window occurs."""
    hit = occurrences(docs, benchmark, **params).select(F.col("row").alias("_hit_row")).distinct()
    packed = docs.select(F.struct("*").alias("_doc"), row_key(F.col("doc_id"), F.col("text")).alias("_row"))
    return packed.join(hit, F.col("_row") == F.col("_hit_row"), "left_anti").select("_doc.*")


def drop_spans(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``; what stands between words stays."""
    hits = hit_spans(docs, benchmark, **params).select(F.col("row").alias("_hit_row"), F.col("spans").alias("_spans"))
    packed = docs.select(F.struct("*").alias("_doc"), row_key(F.col("doc_id"), F.col("text")).alias("_row"))
    # Words and what separates them, in turn; hit positions become one list per row.
    pieces = F.regexp_extract_all(F.col("_doc.text"), F.lit(f"{CASED_WORD}|{BETWEEN_WORDS}"), F.lit(0))
    covered = F.array_distinct(F.flatten(F.transform("_spans", lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1))))
    joined = packed.join(hits, F.col("_row") == F.col("_hit_row"), "left").select(
        "_doc", "_spans", pieces.alias("_pieces"), covered.alias("_covered"))
    first_is_word = F.col("_pieces")[0].rlike(f"^{CASED_WORD}").cast("int")
    # Piece i is word (i + first - 1) / 2 when (i + first) is odd.
    word_at = F.transform("_covered", lambda c: c * 2 + (F.lit(1) - first_is_word))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_pieces") - 1), word_at)
    cut = F.array_join(F.transform(kept, lambda i: F.element_at(F.col("_pieces"), i + 1)), "")
    text = F.when(F.col("_spans").isNull(), F.col("_doc.text")).otherwise(cut)
    names = docs.columns
    out = joined.select("_doc", text.alias("_text"))
    return out.select(*[F.col("_text").alias("text") if c == "text" else F.col("_doc").getField(c).alias(c) for c in names])
