"""Mixing sources to target weights by fitting a subset-sum budget.

Each source has a target number of words.  It takes every document
``floor(target / size)`` times; the rest of its budget is a subset-sum over its
documents.  Documents count only by their exact length here: a histogram of
(source, length) is all that the fit sees.  The fit takes the same share of
every length, tops the budget up with the longest lengths that still fit, and
settles the remaining budget (at most ``DP_WORDS``) by bounded-knapsack dynamic
programming over what is left.  The result is a number of documents per
(source, length); which documents these are is decided by a seeded hash.

Only histograms are grouped: a source's histogram has a row per distinct
length, whatever its number of documents.  Choosing ``take`` of ``n`` documents
of one length ranks no large group: hash buckets of about ``BUCKET`` documents
are counted and ranked each on its own; the buckets before the cut are taken
whole.  The targets are computed on the table of sources (a row each).

Edge cases: a null or blank text has size 0 and is never taken; a null source
is a source of its own and comes last; repeated rows are documents of their
own; if all sizes are 0 all targets are 0; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD_CLASS, table, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20240607
# Largest budget, in words, settled by dynamic programming.
DP_WORDS = 1 << 16
# Documents of one length that are ranked together.
BUCKET = 4096


def size_of(text: Column) -> Column:
    """Number of runs of non-white-space; null is 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS)).cast("long")


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, size, draw) of every row, written to the shared folder.

    ``draw`` is a seeded hash of the document in [0, 2^62); ``row`` settles
    equal draws (repeated rows).
    """
    return written(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("source"),
            size_of(F.col("text")).alias("size"),
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.col("source")), 2).alias("draw"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target): the words each source should give.

    Weights repeat over the sources in code point order, null last.  A target
    stops at ``max_repeats`` times its source's size, the excess goes to the
    others by weight until none is above.  In closed form: order the sources by
    cap / weight; the first k are capped, and all others get weight x level,
    level = (total - caps so far) / (weights left), for the smallest k whose
    next source does not exceed its cap.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # A row per source: windows without a partition run over that short table.
    ordered = per_source.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("at") % len(weights) + 1).cast("int"))
    table_ = ordered.withColumn("w", w).withColumn("cap", F.col("source_size") * float(max_repeats))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "at")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    leveled = table_.withColumn("level", level)
    # The first source (in ratio order) that stays under its cap sets the level.
    free = F.when(F.col("cap") >= F.col("w") * F.col("level"), F.struct(F.col("cap") / F.col("w"), "at", "level"))
    water = F.min(free).over(everything)["level"]
    return leveled.select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.col("w") * F.coalesce(water, F.lit(float("inf")))).alias("target"),
    )


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, for a word sum near ``budget``.

    ``lengths`` are distinct and positive; never more than ``counts``; the sum
    misses the budget by as little as the knapsack finds.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    # The same share of every length.
    take = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    left = budget - int((take * lengths).sum())
    # Longest lengths first, down to what dynamic programming settles.
    for i in np.argsort(-lengths, kind="stable"):
        if left <= DP_WORDS:
            break
        n = min(int(counts[i] - take[i]), (left - DP_WORDS // 2) // int(lengths[i]))
        if n > 0:
            take[i] += n
            left -= n * int(lengths[i])
    return take + knapsack(lengths, counts - take, left)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: the reachable sum nearest to ``budget`` (the lower of two).

    Sums up to twice the budget count.  A length's copies are added in binary bundles.  For every sum the bundle
    that reached it first is kept, which is enough for the way back.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    limit = min(2 * budget, int((lengths * counts).sum()))
    first = np.full(limit + 1, -1, dtype=np.int32)  # -1: not reached
    first[0] = 0
    bundles = [(0, 0, 0)]
    for i in np.argsort(-lengths, kind="stable"):
        length, part = int(lengths[i]), 1
        n = min(int(counts[i]), limit // length)
        while n > 0 and (budget > limit or first[budget] < 0):
            part = min(part, n)
            words = part * length
            new = np.flatnonzero((first[: limit + 1 - words] >= 0) & (first[words:] < 0)) + words
            first[new] = len(bundles)
            bundles.append((int(i), part, words))
            n -= part
            part *= 2
    reached = np.flatnonzero(first >= 0)
    at = int(reached[np.argmin(np.abs(reached - budget))])
    while at:
        i, part, words = bundles[first[at]]
        take[i] += part
        at -= words
    return take


FIT_SCHEMA = "source string, size long, n long, repeats long, extra long"


def fit(histogram: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, size, n, repeats, extra): all documents ``repeats`` times,
    ``extra`` of the ``n`` documents of this length once more."""

    def one_source(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", kind="stable")
        lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        target, total = float(pdf["target"].iloc[0]), int((lengths * counts).sum())
        repeats = min(MAX_REPEATS, int(target // total)) if total else 0
        budget = round(target) - repeats * total if repeats < MAX_REPEATS else 0
        return pd.DataFrame(
            {"source": pdf["source"], "size": lengths, "n": counts, "repeats": repeats, "extra": fit_counts(lengths, counts, budget)}
        )

    with_goal = histogram.join(
        goals.select(F.col("source").alias("goal_source"), "target"), F.col("source").eqNullSafe(F.col("goal_source"))
    ).drop("goal_source")
    return with_goal.where("size > 0").groupBy("source").applyInPandas(one_source, FIT_SCHEMA)


def mix(docs: DataFrame, weights=WEIGHTS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken per row of ``docs``."""
    sizes = sized(docs, seed)
    # All-source table and histogram counts are written: every later join reads the same figures.
    goals = written(targets(sizes, weights), "targets")
    histogram = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    plan = written(fit(histogram, goals), "fit")

    # Buckets of the draw, about BUCKET documents each, in lengths that are cut.
    cut = plan.where("extra > 0 and extra < n").select(
        F.col("source").alias("c_source"), F.col("size").alias("c_size"), "extra", F.ceil(F.col("n") / BUCKET).cast("long").alias("buckets")
    )
    same = (F.col("source").eqNullSafe(F.col("c_source"))) & (F.col("size") == F.col("c_size"))
    bucket = F.floor(F.col("draw") / F.lit(float(2**62)) * F.col("buckets")).cast("long")
    partly = sizes.join(cut, same).select("row", "source", "size", "draw", "extra", bucket.alias("bucket"))
    counts = partly.groupBy("source", "size", "bucket", "extra").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    left = (
        counts.withColumn("left", F.col("extra") - F.coalesce(F.sum("n").over(running), F.lit(0)))
        .where("left > 0")
        .select(F.col("source").alias("b_source"), F.col("size").alias("b_size"), F.col("bucket").alias("b_bucket"), "left")
    )
    in_bucket = (
        F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size")) & (F.col("bucket") == F.col("b_bucket"))
    )
    draws = Window.partitionBy("source", "size", "bucket").orderBy("draw", "row")
    chosen = (
        partly.join(left, in_bucket)
        .select("row", "source", "size", "bucket", "draw", "left")
        .withColumn("k", F.row_number().over(draws))
        .where("k <= left")
        .select("row", F.lit(1).alias("one"))
    )

    everyone = (
        sizes.join(
            goals.select(F.col("source").alias("g_source"), "source_size", "target"), F.col("source").eqNullSafe(F.col("g_source"))
        )
        .join(
            plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "repeats", (F.col("extra") == F.col("n")).alias("all")),
            F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")),
            "left",
        )
        .join(chosen, "row", "left")
    )
    times = F.coalesce("repeats", F.lit(0)) + F.when(F.col("all"), 1).otherwise(F.coalesce("one", F.lit(0)))
    return everyone.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken")
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed by the weights 5, 2, 1."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
