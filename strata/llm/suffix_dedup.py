"""Repeated passages by a sparse suffix array.

Suffixes are kept only at minimiser positions: of every ``WINDOW`` consecutive
grams of ``GRAM`` words the one of smallest hash, so every passage of
``PASSAGE`` words holds a kept position chosen by its own words alone.  Grams that
one document alone has are dropped first.  A kept suffix carries the
words after its gram and, reversed, the words before it, up to ``SIDE`` each;
suffixes with equal words all around are one row.  The rows are sorted by range, so
a frequent gram is split by what surrounds it; sorted neighbours from different
documents are compared and the match is extended right and left.  A second sort
by the words before the gram finds the neighbours on that side.  The rows at the
edges of the range partitions are compared across them in a second step, so the
result does not depend on the number of partitions.  Matches of
``PASSAGE`` words and more, merged where they overlap in a document, are the
repeated passages.

Only neighbours are compared (and the last row of another document), which is
linear however often a passage occurs.  A match seen by neither sort, because
longer matches on each side alone stand between, is left to the other kept
positions of the same passage.

Words are compared with A-Z lower-cased.  Edge cases: null, empty and short
texts have no suffix; a document that repeats its own words alone is not
reported; rows that repeat id and text are one document; a null ``doc_id`` is an
id like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import grams, shuffle_parts, steps, table, text_buffers, words_of, written

PASSAGE = 50
GRAM = 25
WINDOW = PASSAGE - GRAM + 1
SIDE = PASSAGE - GRAM
BYTES = 4  # of a word's hash in a suffix


def kept_positions(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, gram hash) of the minimisers of all texts of one step."""
    g = grams(words, GRAM)
    n = len(g) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    text = np.searchsorted(first, np.arange(n), side="right") - 1
    inside = np.flatnonzero(np.arange(n) + PASSAGE <= first[text + 1])
    views = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    at = np.unique(np.concatenate([[], *(part + np.argmin(views[part], axis=1) for part in np.array_split(inside, len(inside) // 65536 + 1))]).astype(np.int64))
    return at, g[at]


def _identified(docs: DataFrame) -> DataFrame:
    """(doc, doc_id, text): ``doc`` names a row by its id and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(F.lit(3), "doc_id", F.xxhash64(text)).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _steps(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_buffers(texts)
    for lo, hi in steps(offsets):
        yield lo, hi, *words_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def positions(docs: DataFrame) -> DataFrame:
    """(gram, doc, at) of every kept suffix."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            for lo, _, words, first in _steps(batch.column("text")):
                at, g = kept_positions(words, first)
                text = np.searchsorted(first, at, side="right") - 1
                columns = [g.view(np.int64), doc[lo + text], (at - first[text]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "doc", "at"])

    return docs.select("doc", "text").mapInArrow(rows, "gram long, doc long, at int")


def suffixes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(gram, doc, at, ahead, behind) of the positions ``kept`` (doc, ats)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, ats = batch.column("doc").to_pylist(), batch.column("ats")
            for lo, hi, words, first in _steps(batch.column("text")):
                g = grams(words, GRAM)
                short = (words >> np.uint64(32)).astype(">u4")
                out: list[tuple] = []
                for i in range(lo, hi):
                    start, end = first[i - lo], first[i - lo + 1]
                    for at in ats[i].as_py():
                        p = start + at
                        behind = short[max(start, p - SIDE) : p][::-1].tobytes()
                        ahead = short[p + GRAM : min(end, p + GRAM + SIDE)].tobytes()
                        out.append((int(g[p].view(np.int64)), doc[i], at, ahead, behind))
                if out:
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["gram", "doc", "at", "ahead", "behind"])

    return docs.select("doc", "text").dropDuplicates(["doc"]).join(kept, "doc").mapInArrow(
        rows, "gram long, doc long, at int, ahead binary, behind binary"
    )


def _same(a: bytes, b: bytes) -> int:
    """Words that two contexts have in common from their start."""
    n = min(len(a), len(b)) // BYTES
    if a[: n * BYTES] == b[: n * BYTES]:
        return n
    return next(k for k in range(n) if a[k * BYTES : (k + 1) * BYTES] != b[k * BYTES : (k + 1) * BYTES])


def _matches(row: tuple, nears: tuple) -> list[tuple]:
    """(ctx, back, ahead) of both sides of each long enough match of different documents."""
    out = []
    for near in nears:
        if near is not None and near[0] == row[0] and not near[2] == near[3] == row[2] == row[3]:
            right, left = _same(near[4], row[4]), _same(near[5], row[5])
            if left + GRAM + right >= PASSAGE:
                out += [(row[1], left, right), (near[1], left, right)]
    return out


ROW = ("gram", "ctx", "lo", "hi", "ahead", "behind")
_ROW_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
SPAN = "ctx long, back int, ahead int"
# Rows at the edges of a range partition: those that may match rows before it, then the two it hands on.
HEAD, OTHER, LAST = 0, 1, 2


def _spans(found: set[tuple]) -> list[pa.Array]:
    columns = zip(*found, strict=True) if found else [[], [], []]
    return [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of sorted neighbours of different documents, and the partition's edge rows as ``edge``."""
    part = TaskContext.get().partitionId()
    first = last = other = None  # the first and the previous row, and the latest one before it of another document
    edge_type = pa.struct([("part", pa.int32()), ("kind", pa.int32()), ("at", pa.int64()), *zip(ROW, _ROW_TYPES, strict=True)])

    def made(found: set[tuple], edges: list[tuple]) -> pa.RecordBatch:
        names = [f.name for f in edge_type]
        spans = [pa.concat_arrays([c, pa.nulls(len(edges), c.type)]) for c in _spans(found)]
        edge = pa.array([None] * len(found) + [dict(zip(names, e, strict=True)) for e in edges], edge_type)
        return pa.RecordBatch.from_arrays([*spans, edge], names=["ctx", "back", "ahead", "edge"])

    at = 0
    for batch in batches:
        found, edges = set(), []
        for row in zip(*(batch.column(c).to_pylist() for c in ROW), strict=True):
            first = first or row
            found.update(_matches(row, (last, other)))
            if other is None and row[0] == first[0]:
                edges.append((part, HEAD, at, *row))
            if last is not None and (last[2], last[3]) != (row[2], row[3]):
                other = last
            last = row
            at += 1
        yield made(found, edges)
    yield made(set(), [(part, kind, at, *row) for kind, row in ((OTHER, other), (LAST, last)) if row is not None])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches over the bounds of the partitions, from all edge rows in order."""
    last = other = None
    for batch in batches:
        found = set()
        for kind, at, *row in zip(*(batch.column(c).to_pylist() for c in ("kind", "at", *ROW)), strict=True):
            if kind == OTHER:
                other = row
            elif kind == LAST:
                last = row
            else:
                # The previous row of all but the first is in the partition.
                found.update(_matches(row, (other,) if at else (last, other)))
                if last is not None and (last[2], last[3]) != (row[2], row[3]):
                    other = last
                last = row
        yield pa.RecordBatch.from_arrays(_spans(found), names=["ctx", "back", "ahead"])


def neighbour_spans(distinct: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(ctx, back, ahead) of the matches of neighbours in ``order``, the same for any number of partitions."""
    ranged = distinct.repartitionByRange(shuffle_parts(distinct.sparkSession), *order).sortWithinPartitions(*order)
    edge = f"edge struct<part int, kind int, at long, {', '.join(f'{c} {t}' for c, t in zip(ROW, ('long',) * 4 + ('binary',) * 2, strict=True))}>"
    # Written, as the bounds are drawn anew when the rows are dealt out again.
    seen = written(ranged.mapInArrow(_neighbours, f"{SPAN}, {edge}"), "neighbours")
    # A few rows a partition.
    edges = seen.where("edge is not null").select("edge.*").repartition(1).sortWithinPartitions("part", "kind", "at")
    return seen.where("edge is null").select("ctx", "back", "ahead").unionByName(edges.mapInArrow(_across, SPAN))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, first_word, n_words): passages of ``PASSAGE`` words or more that another document has too."""
    docs = _identified(docs)
    every = written(positions(docs), "positions")
    shared = every.groupBy("gram").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo != hi").select("gram")
    # A document's positions are as many as its length allows.
    kept = written(every.join(shared, "gram").groupBy("doc").agg(F.collect_set("at").alias("ats")), "kept")
    context = F.xxhash64("gram", "ahead", "behind").alias("ctx")
    array = written(suffixes(docs, kept).select("*", context), "suffixes")
    distinct = written(
        array.groupBy("ctx", "gram", "ahead", "behind").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")), "contexts"
    )
    spans = distinct.where("lo != hi").select(
        "ctx", (F.length("behind") / BYTES).cast("int").alias("back"), (F.length("ahead") / BYTES).cast("int").alias("ahead")
    ).where(F.col("back") + F.col("ahead") + GRAM >= PASSAGE)
    for order in (("gram", "ahead", "behind"), ("gram", "behind", "ahead")):
        spans = spans.unionByName(neighbour_spans(distinct, order))
    best = spans.distinct()
    found = array.select("ctx", "doc", "at").join(best, "ctx").select(
        "doc", (F.col("at") - F.col("back")).alias("start"), (F.col("at") + GRAM + F.col("ahead")).alias("end")
    ).distinct()
    # Overlapping spans of a document are one passage.
    by_start = Window.partitionBy("doc").orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("new", F.when(reach >= F.col("start"), 0).otherwise(1)).withColumn("island", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy("doc", "island").agg(F.min("start").cast("long").alias("first_word"), (F.max("end") - F.min("start")).cast("long").alias("n_words"))
    names = docs.select("doc", "doc_id").distinct()
    return merged.join(names, "doc").select("doc_id", "first_word", "n_words")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all ``documents`` that repeat across documents."""
    return repeated_passages(table(spark, sf_dir, "documents"))
