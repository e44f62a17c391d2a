"""Exact dedup: a tree-merge of sorted digest runs.

Every text gets a SHA-256 digest of its normalised form.  Each input partition
sorts its digests into a run, one entry per distinct digest.  The runs are
then merged in rounds along a binomial tree: the 2^b partitions that differ in
b bits of their number exchange runs, each keeping the digests that agree with
its own bits, so a round of b bits is b binomial rounds done at once and a
2^b-way merge.  At every level the entries of one digest collapse into one,
which retains the best row (most code points, then smallest id) and the number
of rows.  After all bits are spent a partition holds all entries of its share
of the digests and no digest is in two places.  A digest that occurs in a third
of all rows is one entry per run from the first level on.

Runs travel as packed blocks (a binary column): sorted by the first eight
digest bytes, and verified on the other 24 at each merge, so two texts that
only share the short digest stay apart.  A merge holds one block of each of
its runs in memory.

Edge cases: a null text counts as empty, all empty texts are one group; a null
``doc_id`` loses against any other; of repeated rows (same id, same text) one
stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACES, fresh, shuffle_parts, small, table, whole_row, written

# Entries in one packed block of a run.
BLOCK = 4096
# Bits of the partition number spent in one round at most (a 16-way merge).
ROUND_BITS = 4

# One entry of a run.  key: first eight digest bytes; tail: the other 24;
# points, doc, nodoc, row: the best row so far; rows: rows of the group.
ENTRY = np.dtype(
    [("key", "<u8"), ("t0", "<u8"), ("t1", "<u8"), ("t2", "<u8"), ("points", "<i8"), ("nodoc", "<i8"), ("doc", "<i8"), ("row", "<i8"), ("rows", "<i8")]
)
RUN_SCHEMA = "target int, first long, run int, block int, entries binary"


def normalised(text: Column) -> Column:
    """The text without the six ASCII white-space characters; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, points, sha) of every row, written to the shared folder.

    ``row`` numbers the rows of this table, so repeated rows differ.
    """
    sha = F.unhex(F.sha2(normalised(F.col("text")), 256))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        sha.alias("sha"),
    )
    return written(narrow, "digests")


def collapse(e: np.ndarray) -> np.ndarray:
    """Entries sorted by digest, one per verified digest: best row, summed rows."""
    if len(e) == 0:
        return e
    order = np.lexsort((e["row"], e["doc"], e["nodoc"], -e["points"], e["t2"], e["t1"], e["t0"], e["key"]))
    e = e[order]
    new = np.ones(len(e), dtype=bool)
    same = e["key"][1:] == e["key"][:-1]
    for tail in ("t0", "t1", "t2"):
        same &= e[tail][1:] == e[tail][:-1]
    new[1:] = ~same
    at = np.flatnonzero(new)
    best = e[at].copy()
    best["rows"] = np.add.reduceat(e["rows"], at)
    return best


def _entries(batch: pa.RecordBatch) -> np.ndarray:
    n = batch.num_rows
    out = np.zeros(n, dtype=ENTRY)
    sha = batch.column("sha")
    raw = np.frombuffer(b"".join(sha.to_pylist()), dtype=">u8").reshape(n, 4) if n else np.zeros((0, 4), dtype="<u8")
    for i, name in enumerate(("key", "t0", "t1", "t2")):
        out[name] = raw[:, i]
    doc = batch.column("doc_id")
    out["nodoc"] = np.asarray(doc.is_null())
    out["doc"] = doc.fill_null(0).to_numpy(zero_copy_only=False)
    for name, column in (("points", "points"), ("row", "row")):
        out[name] = batch.column(column).to_numpy(zero_copy_only=False)
    out["rows"] = 1
    return out


def _packed(e: np.ndarray, run: int, shift: int, bits: int, block: int) -> tuple[list, int]:
    """Blocks of a sorted piece for the partitions of the next round.

    The target has the run's number with the bits at ``shift`` taken from the
    digest.  ``first`` orders the blocks of a target (offset to signed).
    """
    out = []
    mask = (1 << bits) - 1
    digit = (e["key"] >> np.uint64(shift)).astype(np.int64) & mask
    for d in range(mask + 1):
        piece = e[digit == d]
        target = (run & ~(mask << shift)) | (d << shift)
        for lo in range(0, len(piece), BLOCK):
            part = piece[lo : lo + BLOCK]
            out.append((target, int(part["key"][0]) - 2**63, run, block, part.tobytes()))
            block += 1
    return out, block


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["target", "first", "run", "block", "entries"]
    )


def _merged(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Multiway merge of blocks that arrive by first key: pieces in digest order.

    Everything below the next block's first key is complete.  An open block
    of each run at most is held back.
    """
    held: list[np.ndarray] = []
    for block in blocks:
        first = block["key"][0]
        if held and sum(len(h) for h in held) >= BLOCK:
            done = [h[: np.searchsorted(h["key"], first, side="left")] for h in held]
            held = [h[len(d) :] for h, d in zip(held, done, strict=True) if len(h) > len(d)]
            piece = collapse(np.concatenate(done))
            if len(piece):
                yield piece
        held.append(block)
    if held:
        yield collapse(np.concatenate(held))


def tree_merge(rows: DataFrame) -> DataFrame:
    """(sha, keep_row, keep_id, group_size), one row per distinct digest."""
    bits = max(1, (shuffle_parts(rows.sparkSession) - 1).bit_length())
    rounds = []
    while sum(rounds) < bits:
        rounds.append(min(ROUND_BITS, bits - sum(rounds)))

    def first_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() & ((1 << bits) - 1)
        block = 0
        for batch in batches:
            if batch.num_rows:
                out, block = _packed(collapse(_entries(batch)), run, 0, rounds[0], block)
                yield _batch(out)

    def level(shift: int, next_bits: int):
        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = {"run": 0}

            def blocks() -> Iterator[np.ndarray]:
                for batch in batches:
                    for target, raw in zip(batch.column("target").to_pylist(), batch.column("entries"), strict=True):
                        state["run"] = target
                        yield np.frombuffer(raw.as_buffer(), dtype=ENTRY)

            block = 0
            for piece in _merged(blocks()):
                out, block = _packed(piece, state["run"], shift, next_bits, block)
                yield _batch(out)

        return merge

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[np.ndarray]:
            for batch in batches:
                for raw in batch.column("entries"):
                    yield np.frombuffer(raw.as_buffer(), dtype=ENTRY)

        for e in _merged(blocks()):
            sha = np.stack([e[k] for k in ("key", "t0", "t1", "t2")], axis=1).astype(">u8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sha[i : i + 32] for i in range(0, len(sha), 32)], pa.binary()),
                    pa.array(e["row"]),
                    pa.array(e["doc"], mask=e["nodoc"].astype(bool)),
                    pa.array(e["rows"]),
                ],
                names=["sha", "keep_row", "keep_id", "group_size"],
            )

    def exchanged(runs: DataFrame) -> DataFrame:
        return runs.repartitionById(1 << bits, F.col("target")).sortWithinPartitions("first", "run", "block")

    runs = rows.mapInArrow(first_run, RUN_SCHEMA)
    shift = 0
    for i, spent in enumerate(rounds[:-1]):
        shift += spent
        runs = exchanged(runs).mapInArrow(level(shift, rounds[i + 1]), RUN_SCHEMA)
    return exchanged(runs).mapInArrow(unpack, "sha binary, keep_row long, keep_id long, group_size long")


def dedup_decisions(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, points."""
    rows = digests(docs)
    # A digest alone in its group needs no partner: only groups of two rows
    # and more meet their rows again.  A hot digest is one row on the group
    # side, so the planner may split its rows freely (AQE skew join).
    groups = tree_merge(rows).where("group_size > 1")
    joined = rows.join(groups, "sha", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "points",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    A row is named by (id, code points, digest).  Rows of a name that is not kept
    go; of several rows of a kept name the one whose columns have the smallest
    hash stays.
    """
    n1, n2, stays = fresh(docs.columns, "__n1", "__n2", "__stays")
    marked = written(
        dedup_decisions(docs)
        .where("group_size > 1")
        .groupBy(*_name(F.col("doc_id"), F.col("points"), F.col("text_sha256"), n1, n2))
        .agg(F.max("kept").alias(stays), F.count(F.lit(1)).alias("n"))
        .where(f"not `{stays}` or n > 1")
        .drop("n"),
        "dedup-marked",
    )
    text = F.coalesce(docs["text"], F.lit(""))
    named = docs.select("*", *_name(docs["doc_id"].cast("long"), F.char_length(text).cast("long"), F.sha2(normalised(docs["text"]), 256), n1, n2))
    row = whole_row(docs.columns)
    picked = (
        named.join(small(marked.where(stays)), [n1, n2])
        .groupBy(n1, n2)
        .agg(F.min_by(row, F.xxhash64(row)).alias("row"))
        .select("row.*")
    )
    return named.join(small(marked), [n1, n2], "left_anti").drop(n1, n2).unionByName(picked)


def _name(doc_id: Column, points: Column, sha: Column, *names: str) -> list[Column]:
    """Two 64-bit hashes that name a row."""
    return [F.xxhash64(F.lit(k), F.coalesce(doc_id.cast("string"), F.lit("null")), points, sha).alias(n) for k, n in enumerate(names)]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact groups of all ``documents``, white space aside."""
    return dedup_decisions(table(spark, sf_dir, "documents"))


_NORMAL_SQL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, sha256({_NORMAL_SQL}) AS text_sha256, length(coalesce(text, '')) AS points FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS k,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256, points FROM r
"""
