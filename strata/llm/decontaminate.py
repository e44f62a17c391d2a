"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is a fixed mask over ``SPAN`` consecutive words: a 1 marks a word that
must agree, a 0 a word that may be anything.  Every position of every
benchmark item and of every document gives one hash per mask over the words
under its ones; a substituted word spoils only the masks that look at it.
Equal hashes are hits, and hits are merged by diagonal (place in the document minus
place in the item).  A diagonal is verified once: the whole item is laid beside
the document and compared word by word.  The item leaks into the document if some
``WINDOW`` consecutive places that hold a hit (or the whole item, if it is
shorter) agree in at least ``IDENTITY`` of them.  The leaked passage reaches from the
first to the last such window.  Items with fewer than ``SPAN`` words
have no room for a mask: the hash of all their words is looked up among the
windows of their length, one length at a time, and must agree word by word.

The benchmark side is small: its seed hashes are broadcast when there are at
most ``BROADCAST_SEEDS`` of them, and documents stream through the join without
a shuffle and without their texts; the few documents hit are fetched again.  A larger
benchmark is joined by shuffle on the seed, which the planner may split where it is
hot.  Long texts are cut into overlapping pieces of ``PIECE`` words before positions
are generated, so memory does not follow the length of a text.

Edge cases: null and empty texts, and items without words, have no seeds; repeated
rows share a verdict, as rows with the same id and text do; a null id is an id like
any other; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACE_CLASS, fresh, small, table, written

# Masks of 11 words with eight ones each (fixed values).
MASKS = ("11011011011", "11101010111", "10111101101", "10110111011")
SPAN = 11

WINDOW = 16
IDENTITY = 0.75
PIECE = 4096
# Rows of item seeds, and of documents hit, that are broadcast at most.
BROADCAST_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-cased words as 64-bit hashes; null and blank texts have none."""
    parts = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), f"{SPACE_CLASS}+"), lambda w: w != "")
    return F.transform(parts, lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, keep: list[str], masks: tuple[str, ...] = MASKS) -> DataFrame:
    """(keep.., at, seed) for every position of ``words`` and every mask; the masks have one length.

    A piece is zipped with shifted copies of itself, so each position is one
    generated row that holds the words under the masks, and hashing runs in
    generated code over plain columns.
    """
    span = len(masks[0])
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - span, F.lit(0)), F.lit(PIECE)),
        lambda lo: F.struct(lo.alias("lo"), F.slice("words", lo + 1, PIECE + span - 1).alias("part")),
    )
    cut = rows.where(F.size("words") >= span).select(*keep, F.inline(pieces).alias("lo", "part"))
    starts = F.size("part") - span + 1
    shifted = F.arrays_zip(*(F.slice("part", 1 + s, starts).alias(f"w{s}") for s in range(span)))
    at = cut.select(*keep, "lo", F.posexplode(shifted).alias("at", "w"))
    hashes = F.array(
        *(F.xxhash64(F.lit(k), *(F.col(f"w.w{s}") for s, bit in enumerate(mask) if bit == "1")) for k, mask in enumerate(masks))
    )
    return at.select(*keep, (F.col("lo") + F.col("at")).alias("at"), F.explode(hashes).alias("seed"))


def hits(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item, diagonal, places): places of the item that a seed has on each diagonal, for each document hit."""
    short = [r.n for r in items.where(F.size("words") < SPAN).select(F.size("words").alias("n")).distinct().collect()]  # at most SPAN - 1
    found = []
    for masks in (MASKS, *(("1" * n,) for n in sorted(short))):
        span = len(masks[0])
        of_size = items.where(F.size("words") >= SPAN) if masks is MASKS else items.where(F.size("words") == span)
        of_items = written(seeds(of_size, ["item"], masks).withColumnRenamed("at", "item_at"), "item-seeds")
        joined = seeds(rows, ["doc_id", "text_key"], masks).join(small(of_items, BROADCAST_SEEDS), "seed")
        found.append(joined.select("doc_id", "text_key", "item", (F.col("at") - F.col("item_at")).alias("diagonal"), "item_at"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("doc_id", "text_key", "item", "diagonal").agg(F.collect_set("item_at").alias("places"))


def _passages(laid: DataFrame) -> DataFrame:
    """The diagonals that leak, with the passage between their first and last good window.

    ``laid`` has words, item_words, diagonal and places.
    """
    begin = F.greatest(F.lit(0), -F.col("diagonal"))
    length = F.least(F.size("item_words"), F.size("words") - F.col("diagonal")) - begin
    same = F.zip_with(
        F.slice("words", F.col("diagonal") + begin + 1, length),
        F.slice("item_words", begin + 1, length),
        lambda a, b: (a == b).cast("int"),
    )
    size = F.least(F.lit(WINDOW), F.size("item_words"))
    span = F.least(F.lit(SPAN), F.size("item_words"))
    compared = laid.select("*", begin.alias("begin"), same.alias("same"), size.alias("size"), span.alias("span")).where(F.size("same") >= F.col("size"))
    # Windows that hold a hit's span: they start up to size - span words before it.
    starts = F.array_distinct(
        F.flatten(
            F.transform(
                "places",
                lambda p: F.filter(
                    F.sequence(p - F.col("begin") - (F.col("size") - F.col("span")), p - F.col("begin")),
                    lambda s: (s >= 0) & (s <= F.size("same") - F.col("size")),
                ),
            )
        )
    )
    agree = lambda lo, n: F.aggregate(F.slice("same", lo + 1, n), F.lit(0), lambda total, x: total + x)
    good = F.filter(starts, lambda s: agree(s, F.col("size")) >= F.col("size") * IDENTITY)
    first, last = F.array_min("good"), F.array_max("good") + F.col("size")
    inside = F.slice("same", first + 1, last - first)
    return (
        compared.withColumn("good", good)
        .where(F.size("good") > 0)
        .select(
            "doc_id",
            "text_key",
            "item",
            F.aggregate(inside, F.lit(0), lambda total, x: total + x).cast("long").alias("overlap"),
            (F.col("diagonal") + F.col("begin") + first + F.array_position(inside, 1) - 1).cast("long").alias("first_word"),
        )
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, overlap, first_word): items found in documents.

    ``overlap`` is the number of agreeing words in the leaked passage, ``first_word`` the
    document's word where it begins, both of the diagonal with the largest overlap (the
    first one on ties); ``text_key`` hashes the text.
    """
    # Items go by a plain number, so that a null item id is an id too.
    items = written(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("item", F.xxhash64(F.lit(0), "item_id", "words")),
        "items",
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text"
    )
    found = written(hits(rows.select("doc_id", "text_key", words_of(F.col("text")).alias("words")), items), "item-hits")
    named = found.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text")).distinct()
    wanted = rows.join(
        small(written(named, "documents-hit"), BROADCAST_SEEDS),
        F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_text")),
        "left_semi",
    )
    again = wanted.dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text"), words_of(F.col("text")).alias("words")
    )
    laid = found.join(again, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_text"))).join(
        items.select("item", F.col("words").alias("item_words")).dropDuplicates(["item"]), "item"
    )
    best = F.max(F.struct("overlap", (-F.col("first_word")).alias("early")))
    passages = _passages(laid).groupBy("doc_id", "text_key", "item").agg(best.alias("best"))
    return (
        passages.join(items.select("item", "item_id").distinct(), "item")
        .groupBy("doc_id", "text_key", "item_id")
        .agg(F.max("best").alias("best"))
        .select("doc_id", "text_key", "item_id", F.col("best.overlap").alias("overlap"), (-F.col("best.early")).alias("first_word"))
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, all columns as they were."""
    of_id, of_text = fresh(docs.columns, "__id", "__key")
    bad = written(leaks(docs, benchmark).select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_text)).distinct(), "leaky")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(of_id)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(of_text))
    return docs.join(small(bad), same, "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` found in ``documents``, one row per pair."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "overlap", "first_word")
