"""Mixing sources to target weights: a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]: its base
weight times a piecewise-linear curve. The integral of the schedule is the
source's effective weight. The mix has ``share`` times the words of all
documents; no source gives more than ``max_repeat`` times its own words, and
what it cannot give is shared by weight among the others until none is above.

A source's documents lie, in the order of md5(doc_id), on a line of its words
that repeats ``max_repeat`` times; the mix takes the line up to the target, so
the last document is taken in part. The cumulative demand of the source at
time t is its target times the integrated schedule; inverting that curve at a
copy's midpoint gives the copy's training position, and the mix is ranged and
sorted by position.

The prefix sums run per (source, bucket of the md5), then over the buckets, so
that a source with a third of all words is spread over 4,096 windows. One row
per source meets in one task for the water level; sources are few by nature.

Edge cases: a null text has size 0 and is taken 0 times; a null source is a
source, ranked last; a null doc_id hashes as the empty string; ties in the
order are broken by doc_id and size, and rows alike in all three are
interchangeable; an empty table gives an empty mix; other columns are never
read. The same rows give the same mix in any order and partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.text import JAVA_WS_CHARS
from tidepool.llm.common import NON_SPACES, SPACES, stage

WEIGHTS = (5.0, 2.0, 1.0)
# Knots (t, factor of each weight class): heavy sources early, light ones late.
# Each class's curve integrates to 1, so the effective weights are the base ones.
CURRICULUM = ((0.0, (1.5, 1.0, 0.5)), (1.0, (0.5, 1.0, 1.5)))
BUCKET_DIGITS = 3


def curve(schedule, k: int) -> list[tuple[float, float, float, float, float]]:
    """Segments (t0, t1, m0, m1, area before) of class k's factor."""
    area, out = 0.0, []
    for (t0, a), (t1, b) in zip(schedule, schedule[1:]):
        out.append((t0, t1, a[k], b[k], area))
        area += (t1 - t0) * (a[k] + b[k]) / 2
    return out


def total(schedule, k: int) -> float:
    return sum((t1 - t0) * (a + b) / 2 for t0, t1, a, b, _ in curve(schedule, k))


def invert(schedule, k: int, q: Column) -> Column:
    """The time at which class k has met the part ``q`` (0 to 1) of its demand."""
    whole = total(schedule, k)
    out = F.lit(float(schedule[-1][0]))
    for t0, t1, a, b, before in reversed(curve(schedule, k)):
        if t1 <= t0 or a + b <= 0:
            continue
        need = F.greatest(F.lit(0.0), q * whole - before)
        slope = (b - a) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + 2 * slope * need))
        at = F.least(F.lit(float(t1)), t0 + F.when(F.lit(a) + root > 0, 2 * need / (F.lit(a) + root)).otherwise(F.lit(0.0)))
        after = before + (t1 - t0) * (a + b) / 2
        out = F.when(q * whole <= after, at).otherwise(out)
    return out


def n_words(text: Column) -> Column:
    """The number of ``NON_SPACES`` in ``text``, null as empty.

    Each word with the spaces behind it becomes one letter; ``regexp_count``
    would make an array of all the words first, many times the text's size.
    """
    begun = F.ltrim(F.coalesce(text, F.lit("")), F.lit(JAVA_WS_CHARS))
    return F.length(F.regexp_replace(begun, f"{NON_SPACES}{SPACES}*", "x")).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       order.alias("ord"), F.substring(order, 1, BUCKET_DIGITS).alias("bucket"))


def targets(by_source: DataFrame, weights: Sequence[float], share: float, max_repeat: int, schedule) -> DataFrame:
    """(source, source_size, class, target, goal) from (source, source_size)."""
    effective = [float(w) * total(schedule, k) for k, w in enumerate(weights)]
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = by_source.withColumn("class", (rank - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(w) for w in effective]), F.col("class") + 1)
    # Sources in the order in which they fill up; each is full if the level that
    # the sources from it on would share reaches its brim.
    by_brim = Window.orderBy(F.col("cap") / F.col("w"), "class", "cap", "source")
    every = Window.partitionBy()
    level = ranked.withColumn("w", weight).withColumn("cap", (max_repeat * F.col("source_size")).cast("double"))
    level = (level.withColumn("all", F.lit(float(share)) * F.sum("source_size").over(every))
             .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_brim.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             .withColumn("w_from", F.sum("w").over(by_brim.rowsBetween(0, Window.unboundedFollowing))))
    full = F.col("w") * (F.col("all") - F.col("cap_before")) >= F.col("cap") * F.col("w_from")
    level = (level.withColumn("full", full)
             .withColumn("full_caps", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(F.lit(0.0))).over(every))
             .withColumn("open_w", F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("w"))).over(every)))
    target = F.when(F.col("full"), F.col("cap")).otherwise(
        F.col("w") * (F.col("all") - F.col("full_caps")) / F.col("open_w"))
    return level.select("source", "source_size", "class", target.alias("target"),
                        F.floor(target + 0.5).cast("long").alias("goal"))


def assign(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, max_repeat: int = 2,
           schedule=CURRICULUM) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies.

    ``copies``: (copy, take, position) of each copy that the mix takes,
    ``take`` in words (under ``size`` only for a source's last document).
    """
    # A size is a few bytes: few files of many, whatever parts the texts lie in.
    sized = stage(sizes(docs).hint("rebalance"), "sizes")
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    by_source = buckets.groupBy("source").agg(F.sum("in_bucket").alias("source_size"))
    plan = targets(by_source, weights, share, max_repeat, schedule)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                            F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("start"))
    starts = starts.join(plan.withColumnRenamed("source", "p_source"), F.col("b_source").eqNullSafe(F.col("p_source")))
    within = Window.partitionBy("source", "bucket").orderBy("ord", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    lined = sized.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    lined = lined.join(starts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    lined = lined.withColumn("offset", F.col("start") + F.col("before"))

    def copy(e: int) -> Column:
        at = F.lit(e) * F.col("source_size") + F.col("offset")
        take = F.greatest(F.lit(0), F.least(F.col("size"), F.col("goal") - at)).cast("long")
        part = F.when(F.col("goal") > 0, (at + take / 2) / F.col("goal")).otherwise(F.lit(0.0))
        position = F.lit(0.0)
        for k in range(len(weights)):
            position = F.when(F.col("class") == k, invert(schedule, k, part)).otherwise(position)
        return F.struct(F.lit(e).alias("copy"), take.alias("take"), position.alias("position"))

    copies = F.filter(F.array(*[copy(e) for e in range(max_repeat)]), lambda c: c["take"] > 0)
    out = lined.withColumn("copies", copies)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda acc, c: acc + c["take"])
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies")


def report(docs: DataFrame, **params) -> DataFrame:
    """doc_id, size, source_size, target, taken, position, last_position of every row, in training order.

    ``position`` and ``last_position`` are the training positions (0 to 1) of
    the document's first and last copy; a document that the mix does not take
    has null in both and comes last.
    """
    first, last = F.get("copies", F.lit(0))["position"], F.get("copies", F.size("copies") - 1)["position"]
    return (assign(docs, **params).select("doc_id", "size", "source_size", "target", "taken",
                                          first.alias("position"), last.alias("last_position"))
            .orderBy(F.col("position").asc_nulls_last(), "doc_id"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """The training order: one row per copy, ranged and sorted by position."""
    each = assign(docs, **params).select("doc_id", "source", "size", F.explode("copies").alias("c"))
    return each.select("doc_id", "source", "size", "c.copy", "c.take", "c.position").orderBy("position", "doc_id", "copy")
