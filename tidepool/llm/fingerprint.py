"""Document fingerprints: SimHash with permuted block tables.

Terms are the words of the text. Each occurrence votes on 64 signed bits by
the bits of its hash, with the square of its length (16 at most) as weight:
long words say more about a text than the short ones that every text has. A
set bit won more than half of the weight. The votes are added up JVM-side, two
bits to a long, in one aggregate per document, where the words already are.

``near_pairs`` finds all fingerprints within a Hamming radius: 64 bits are cut
into blocks; two fingerprints that differ in at most ``radius`` bits agree in
all but ``radius`` blocks, so a table for each choice of the other blocks,
grouped by these blocks' bits, brings every such pair together once at least.
Equal fingerprints are one entry there; copies never make pairs.

Edge cases: a null text counts as empty; a text without words has fingerprint
0; equal texts have equal fingerprints; rows alike in doc_id and text are one
document for the order and get equal results; a null doc_id comes last; one
document alone is its own next; an empty table gives an empty one; other
columns are never read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import NON_SPACES, row_key, sha256, stage

BITS = 64
LANES = 0x0000000100000001
LOW = 0xFFFFFFFF
LONGEST = 16


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, hi, lo (32 bits each, as long) from ``keys`` and ``text``."""
    terms = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(NON_SPACES), F.lit(0))
    each = texts.select(*keys, F.explode_outer(terms).alias("term"))
    length = F.when(F.col("term").isNull(), 0).otherwise(F.least(F.length("term"), F.lit(LONGEST))).cast("long")
    votes = each.select(*keys, F.xxhash64("term").alias("h"), (length * length).alias("w"))
    lane = F.lit(LANES).cast("long")
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lane) * F.col("w")).alias(f"s{i}") for i in range(32)]
    summed = votes.groupBy(*keys).agg(F.sum("w").alias("all"), *sums)

    def won(votes_for: Column, i: int) -> Column:
        return F.when(votes_for * 2 > F.col("all"), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))

    def word(side) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            out = out.bitwiseOR(won(side(F.col(f"s{i}")), i))
        return out

    low = word(lambda s: s.bitwiseAND(F.lit(LOW).cast("long")))
    high = word(lambda s: F.shiftrightunsigned(s, 32))
    return summed.select(*keys, high.alias("hi"), low.alias("lo"))


def as_hex(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 8, "0"), F.lpad(F.hex(lo), 8, "0")))


def distance(hi: Column, lo: Column, hi2: Column, lo2: Column) -> Column:
    return F.bit_count(hi.bitwiseXOR(hi2)) + F.bit_count(lo.bitwiseXOR(lo2))


def likeness(*four: Column) -> Column:
    return 1 - distance(*four) / F.lit(float(BITS))


def near_pairs(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(hi_a, lo_a, hi_b, lo_b, distance) of all different fingerprints within ``radius``.

    ``prints``: hi, lo, any rows. Each table's key has about
    64 * (blocks - radius) / blocks bits. Membership (which documents have a
    fingerprint) is the caller's table of fingerprints.
    """
    distinct = prints.select("hi", "lo").distinct()
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in chosen)
        masks.append(F.struct(F.lit(len(masks)).alias("table"),
                              F.col("hi").bitwiseAND(F.lit(mask >> 32).cast("long")).alias("k_hi"),
                              F.col("lo").bitwiseAND(F.lit(mask & LOW).cast("long")).alias("k_lo")))
    rows = distinct.select("hi", "lo", F.explode(F.array(*masks)).alias("t")).select(
        "hi", "lo", "t.table", "t.k_hi", "t.k_lo")
    a = rows.select("table", "k_hi", "k_lo", F.col("hi").alias("hi_a"), F.col("lo").alias("lo_a"))
    b = rows.select("table", "k_hi", "k_lo", F.col("hi").alias("hi_b"), F.col("lo").alias("lo_b"))
    gap = distance(F.col("hi_a"), F.col("lo_a"), F.col("hi_b"), F.col("lo_b"))
    ordered = (F.col("hi_a") < F.col("hi_b")) | ((F.col("hi_a") == F.col("hi_b")) & (F.col("lo_a") < F.col("lo_b")))
    return (a.join(b, ["table", "k_hi", "k_lo"]).where(ordered & (gap <= radius))
            .select("hi_a", "lo_a", "hi_b", "lo_b", gap.alias("distance")).distinct())


def successors(docs: DataFrame, rows_per_bucket: int = 500_000) -> DataFrame:
    """(row, n, copies, next_row): each distinct document and the next by ascending doc_id.

    Only keys are ordered: ids are cut into ranges at approximate quantiles, as
    many as there are cores or more, each range is sorted in a task of its own, and the ranges' first rows (one
    each) close the gaps and the circle.
    """
    ids = stage(docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), F.col("doc_id").cast("long").alias("id"),
                            F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
                .groupBy("row").agg(F.first("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("copies")), "ids")
    parts = min(10_000, max(docs.sparkSession.sparkContext.defaultParallelism, ids.count() // rows_per_bucket))
    splits = []
    if parts > 1:
        found = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 100_000).alias("q")).first()["q"]
        splits = sorted(set(found or []))
    # A split is an id of the table and starts its range, so no range after the first is empty.
    bucket = F.lit(0)
    if splits:
        at = F.array(*[F.lit(s).cast("long") for s in splits])
        bucket = F.when(F.col("id").isNull(), F.lit(len(splits))).otherwise(F.size(F.filter(at, lambda s: s <= F.col("id"))))
    ranged = ids.withColumn("bucket", bucket)
    within = Window.partitionBy("bucket").orderBy(F.col("id").asc_nulls_last(), F.col("row"))
    linked = ranged.withColumn("next", F.lead("row").over(within))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
    in_turn = Window.orderBy("bucket")
    whole = in_turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = ranged.groupBy("bucket").agg(first.alias("h")).select(
        F.col("bucket"), F.coalesce(F.lead("h.row").over(in_turn), F.first("h.row").over(whole)).alias("after"))
    return linked.join(heads, "bucket").select("row", "n", "copies", F.coalesce("next", "after").alias("next_row"))


def with_edits(docs: DataFrame, turns: DataFrame) -> DataFrame:
    """(row, text, edited) of each distinct document.

    The edited text: the last floor(n / 2) code points give way to the first
    as many (or all) of the next document, whose head travels to it.
    """
    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    if turns.where(F.col("copies") > 1).limit(1).count():
        texts = texts.dropDuplicates(["row"])
    asked = turns.select(F.col("next_row").alias("row"), F.col("row").alias("asker"), (F.expr("n div 2")).cast("int").alias("half"))
    heads = texts.join(asked, "row").select(F.col("asker").alias("row"), F.substring("text", F.lit(1), F.col("half")).alias("head"))
    own = texts.join(turns.select("row", "n"), "row").join(heads, "row")
    return own.select("row", "text", F.concat(
        F.substring("text", F.lit(1), F.expr("cast(n - n div 2 as int)")), F.col("head")).alias("edited"))


def neighbours(prints: DataFrame) -> DataFrame:
    """(hi, lo, n_near): for each fingerprint that has any, the number of other fingerprints within the radius."""
    pairs = near_pairs(prints)
    ends = F.explode(F.array(F.struct(F.col("hi_a").alias("hi"), F.col("lo_a").alias("lo")),
                             F.struct(F.col("hi_b").alias("hi"), F.col("lo_b").alias("lo"))))
    return pairs.select(ends.alias("p")).groupBy("p.hi", "p.lo").agg(F.count("*").alias("n_near"))


def report(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near of every row."""
    turns = stage(successors(docs, **params), "turns")
    pair = with_edits(docs, turns).withColumn("sha", sha256(F.col("edited")))
    both = pair.select("row", "sha", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("v"))
    prints = stage(fingerprints(both.select("row", "sha", "v.which", "v.text"), ["row", "sha", "which"]), "prints")
    mine = prints.where("which = 0").select("row", "hi", "lo")
    mine = mine.join(stage(neighbours(mine), "neighbours"), ["hi", "lo"], "left").select("row", "hi", "lo", "n_near")
    edits = prints.where("which = 1").select("row", F.col("sha").alias("edited_sha256"), F.col("hi").alias("e_hi"), F.col("lo").alias("e_lo"))
    nexts = mine.select(F.col("row").alias("next_row"), F.col("hi").alias("n_hi"), F.col("lo").alias("n_lo"))
    done = mine.join(edits, "row").join(turns, "row").join(nexts, "next_row").select(
        "row", F.col("n").alias("n_chars"), "edited_sha256", as_hex(F.col("hi"), F.col("lo")).alias("fingerprint"),
        as_hex(F.col("e_hi"), F.col("e_lo")).alias("edited_fingerprint"),
        likeness(F.col("hi"), F.col("lo"), F.col("e_hi"), F.col("e_lo")).alias("near_edited"),
        likeness(F.col("hi"), F.col("lo"), F.col("n_hi"), F.col("n_lo")).alias("near_next"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"))
    return rows.join(done, "row").drop("row")
