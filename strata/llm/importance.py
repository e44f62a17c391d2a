"""Target-distribution importance resampling by segment deduplication.

Every document gets a weight that says how much more its features belong to a
target corpus than to the documents themselves, and a seeded draw takes the
documents of highest weight plus Gumbel noise (sampling without replacement in
proportion to the weights).  A feature is a run of 1 to ``runs`` consecutive
words, hashed into ``buckets`` buckets.

Line feeds separate words, so they cut a text into lines, and a line's features
do not depend on where it stands.  Lines that repeat across the corpus (boiler
plate, copies) are collapsed first, combined before the shuffle; each distinct
line's words are found and hashed once and kept as a list of buckets.  Corpus
counts are those lists times the line's occurrences.  Once the gains are known a
distinct line's weight is a sum over its list, and a document's weight is the sum
over its lines.  Runs that cross a line feed belong to a document, not to a line:
they are counted separately, from whole texts (runs of one word never do, so
then no text is read for them).

Only the two bucket counts (``buckets`` numbers each) reach the driver.  Ranks
come from a range partitioning by score with one count per partition.

Edge cases: null and blank texts have no features, weight 0; a null ``doc_id``
draws its noise with an empty id and comes last among equal scores; rows that
repeat a ``doc_id`` are ranked each for itself, of equal scores the one with fewer
features first; an empty table gives an empty result; without target texts every
document is weighed against an empty target; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import shuffle_parts, steps, table, text_buffers, written

RUNS = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PER_CENT = 10

# Features of more bytes are hashed one by one instead of byte column by byte column.
LONG_BYTES = 48


def _crc_table() -> np.ndarray:
    """The 256 steps of CRC-32 (reversed polynomial EDB88320)."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


_CRC = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[0x80:] = True


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``: one step per byte column over all spans that reach it."""
    out = np.zeros(len(starts), dtype=np.uint32)
    size = ends - starts
    for i in np.flatnonzero(size > LONG_BYTES):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= LONG_BYTES]
    if len(order):
        at, length = starts[order], size[order]
        crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
        for k in range(int(length[0])):
            m = int(np.searchsorted(-length, -k, side="left"))
            crc[:m] = _CRC[(crc[:m] ^ data[at[:m] + k]) & 255] ^ (crc[:m] >> 8)
        out[order] = ~crc
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, text of each word)."""
    low = _LOWER[data]
    inside = np.zeros(len(low) + 2, dtype=bool)
    inside[1:-1] = _IN_WORD[low]
    cut = np.zeros(len(low) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def feature_buckets(
    data: np.ndarray, offsets: np.ndarray, runs: int, buckets: int, crossing: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text of each feature, words of each text) of texts in one buffer, in text order.

    ``crossing`` gives only the runs whose first and last word lie on different lines.
    """
    low, starts, ends, owner = word_spans(data, offsets)
    words = np.bincount(owner, minlength=len(offsets) - 1).astype(np.int64)
    if runs > 1 and len(starts):
        # Words joined by one space: a run is then one span.
        line = np.searchsorted(np.flatnonzero(low == 10), starts)
        size = ends - starts
        at = np.cumsum(size + 1) - size - 1
        joined = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        joined[np.repeat(at, size) + step] = low[np.repeat(starts, size) + step]
        low, starts, ends = joined, at, at + size
    spans = []
    for k in range(1, runs + 1):
        n = len(starts) - k + 1
        if n <= 0:
            break
        ok = owner[:n] == owner[k - 1 :]
        if crossing:
            ok &= line[:n] != line[k - 1 :] if runs > 1 else False
        first = np.flatnonzero(ok)
        spans.append((starts[first], ends[first + k - 1], owner[first]))
    if not spans:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), words
    s, e, o = (np.concatenate(x) for x in zip(*spans, strict=True))
    order = np.argsort(o, kind="stable")
    return (crc32_of(low, s, e) % np.uint32(buckets)).astype(np.int64)[order], o[order], words


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """One binary value (32-bit numbers) per text."""
    ends = np.cumsum(np.bincount(owner, minlength=n)) * 4
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(values.astype("<u4"))])


def hashed(texts: DataFrame, runs: int, buckets: int, crossing: bool = False) -> DataFrame:
    """The rows of ``texts`` with n_words, and the buckets of the features of column ``text`` in place of it."""
    rest = [c for c in texts.columns if c != "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for lo, hi in steps(offsets):
                part = offsets[lo : hi + 1] - offsets[lo]
                found, owner, words = feature_buckets(data[offsets[lo] : offsets[hi]], part, runs, buckets, crossing)
                kept = [batch.column(c).slice(lo, hi - lo) for c in rest]
                yield _batch([*kept, words, _lists(found, owner, hi - lo)], [*rest, "n_words", "buckets"])

    types = {c: t for c, t in texts.dtypes}
    return texts.mapInArrow(rows, ", ".join([*(f"{c} {types[c]}" for c in rest), "n_words long, buckets binary"]))


def _buckets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all buckets, features per row) of a column of bucket lists."""
    data, offsets = text_buffers(column.cast(pa.binary()))
    return data.view("<u4").astype(np.int64), np.diff(offsets) // 4


def bucket_counts(lists: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): features per bucket of lists that occur ``times`` times; a task sends each bucket once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            found, sizes = _buckets_of(batch.column("buckets"))
            np.add.at(total, found, np.repeat(batch.column("times").to_numpy(zero_copy_only=False), sizes))
        at = np.flatnonzero(total)
        yield _batch([at, total[at]], ["bucket", "n"])

    parts = lists.select("buckets", F.col("times").cast("long").alias("times")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for row in counts.collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains_of(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares in the target and in the documents."""
    n, big_s, big_t = len(s), float(s.sum()), float(t.sum())
    ratio = (t + 1.0) * (big_s + n) / ((s + 1.0) * (big_t + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(lists: DataFrame, gains: np.ndarray) -> DataFrame:
    """The rows of ``lists`` with n_features and weight in place of ``buckets``."""
    rest = [c for c in lists.columns if c != "buckets"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = _buckets_of(batch.column("buckets"))
            sums = np.concatenate([[0], np.cumsum(gains[found])])
            ends = np.cumsum(sizes)
            yield _batch([*(batch.column(c) for c in rest), sizes, sums[ends] - sums[ends - sizes]], [*rest, "n_features", "weight"])

    types = {c: t for c, t in lists.dtypes}
    return lists.mapInArrow(rows, ", ".join([*(f"{c} {types[c]}" for c in rest), "n_features long, weight long"]))


def _line_key(line: Column) -> list[Column]:
    """A line's name: two hashes of 64 bits."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def weights(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """row, doc_id, n_words, n_features, weight of every row of ``docs``; ``row`` numbers them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.transform(lines, lambda line: F.struct(*_line_key(line))).alias("lines"),
        ),
        "importance-rows",
    )
    distinct = docs.select(F.explode(lines).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("times"))
    lists = written(
        hashed(distinct.select(*_line_key(F.col("text")), "times", "text"), runs, buckets).where("n_words > 0"), "importance-lines"
    )
    counted = lists.select("buckets", "times")
    if runs > 1:
        # Same split of the same scan as above, so the row numbers agree.
        numbered = docs.select(F.monotonically_increasing_id().alias("row"), text.alias("text"))
        crossing = written(hashed(numbered, runs, buckets, crossing=True).where("length(buckets) > 0"), "importance-crossing")
        counted = counted.unionByName(crossing.select("buckets", F.lit(1).cast("long").alias("times")))
    wanted = hashed(target.select(F.coalesce(F.col("text"), F.lit("")).alias("text")), runs, buckets)
    s = _dense(bucket_counts(counted, buckets), buckets)
    t = _dense(bucket_counts(wanted.withColumn("times", F.lit(1)), buckets), buckets)
    gains = gains_of(s, t)
    measured = weighed(lists.drop("times"), gains)
    parts = rows.select("row", "doc_id", F.explode_outer("lines").alias("line")).select(
        "row", "doc_id", F.col("line.h1").alias("h1"), F.col("line.h2").alias("h2")
    )
    parts = parts.join(measured, ["h1", "h2"], "left").select("row", "doc_id", "n_words", "n_features", "weight")
    if runs > 1:
        extra = weighed(crossing.drop("n_words"), gains).join(rows.select("row", "doc_id"), "row")
        parts = parts.unionByName(extra.select("row", "doc_id", F.lit(0).cast("long").alias("n_words"), "n_features", "weight"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n_features", "weight")]
    return parts.groupBy("row", "doc_id").agg(*sums)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of Gumbel noise from the id's SHA-256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, per_cent: int = PER_CENT
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) of every row of ``docs``.

    Of the N rows with at least ``min_words`` words, the floor(per_cent * N / 100) of highest score are drawn.
    """
    spark = docs.sparkSession
    scored = written(
        weights(docs, target, runs, buckets).select(
            "row", "doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), (F.col("n_words") >= min_words).alias("fit")
        ),
        "importance-scores",
    )
    order = [F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    # Place within the partition below bit 33, the partition's number above it.
    placed = written(
        scored.repartitionByRange(shuffle_parts(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
        .drop("row"),
        "importance-places",
    )
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("fit"), 1)).alias("fit"))
    found = {r.part: r for r in sizes.collect()}  # one row per partition
    before, total = [], 0
    for i in range(max(found, default=-1) + 1):
        before.append(total)
        total += found[i].n if i in found else 0
    drawn = per_cent * sum(r.fit for r in found.values()) // 100
    base = F.array(*(F.lit(b).cast("long") for b in before)) if before else F.array(F.lit(0).cast("long"))
    rank = F.get(base, part.cast("int")) + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.select("doc_id", "n_features", "weight", "score", F.when(F.col("fit") & (rank <= drawn), rank).alias("rank"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` drawn towards the ``benchmark`` texts."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# CRC-32 byte by byte over the hex digits of each distinct word.
OP12_SQL = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
), wanted AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), counted AS (
  SELECT word, sum(s) AS s, sum(t) AS t FROM (
    SELECT word, count(*) AS s, 0 AS t FROM words GROUP BY word UNION ALL SELECT word, 0, count(*) FROM wanted GROUP BY word) GROUP BY word
), bytes AS (
  SELECT word, s, t, list_transform(range(CAST(length(hex(encode(word))) // 2 AS BIGINT)),
    lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)) AS b FROM counted
), hashed AS (
  SELECT word, s, t, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b),
    lambda c, x: xor(crc[1 + (xor(c, x) & 255)], c >> 8)), 4294967295) % 10000 AS bucket FROM bytes, steps
), totals AS (SELECT CAST(sum(s) AS DOUBLE) AS big_s, CAST(sum(t) AS DOUBLE) AS big_t FROM hashed),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((sum(t) + 1.0::DOUBLE) * (any_value(big_s) + 10000) / ((sum(s) + 1.0::DOUBLE) * (any_value(big_t) + 10000)))) AS BIGINT) AS gain
  FROM hashed, totals GROUP BY bucket
), sums AS (
  SELECT w.doc_id, count(*) AS n_features, CAST(sum(g.gain) AS BIGINT) AS weight
  FROM words w JOIN hashed h USING (word) JOIN gains g USING (bucket) GROUP BY w.doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN sums USING (doc_id)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k,
         count(*) FILTER (n_features >= 20) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM ranked
"""
