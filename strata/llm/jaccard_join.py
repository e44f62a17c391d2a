"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct five-word shingles.  Sets of a and b
shingles with a Jaccard similarity of 0.8 or more differ in at most
(a + b) / 9 shingles.  A parity sketch has one bit per hash cell, flipped by
every shingle that falls there (XOR), so the Hamming distance of two sketches
is at most the size of the symmetric difference.  Sets are dealt into size
bands; in a band, sketches are cut into more blocks than the largest difference
allowed there, so two sketches that link agree in whole blocks (pigeonhole).

A row of the join is (hash of band, block and block content, set).  Blocks
without a bit say nothing and are left out where the set has enough others; a
set that has not enough of them sends its empty blocks too, so no link is lost.
A set goes to its own band and, if a partner may be larger than that band, to
the next one.

Sets with equal keys are candidates.  A pair whose small whole sketches differ
in more bits than its sets may differ in shingles is out; the others are
verified by the exact intersection.  In the first round a set meets the
smallest sets of its keys (the hubs), a linear number of pairs, and is verified
against one of them; the links give provisional components.  In the second
round only keys whose sets are still in different components bring the pairs
across them.  Links inside a component change nothing, so components are exact
without all pairs of a group of near copies.  Equal sets are one set throughout.

Blocks of a passage that many texts share would bring all pairs of those texts.
Sets that link differ in at most d blocks, so of the blocks of each, put in one order
for all sets, the first d + 1 hold a common one.  That order ends with the most
frequent mixed keys: in the last round a set leaves as many of its mixed keys out
as it has blocks beyond d + 1, the most frequent first, and keeps those that it
cannot spare.  Before, each popular mixed key has a second hub, the set that meets
most others.  In both rounds with hubs a set meets ``TRIES`` of them at most, those of
most of its keys; what that leaves apart is in mixed keys, so the last round has it.

Edge cases: null and blank texts are empty sets, linked with nothing, their own
component; a null ``doc_id`` takes part, and a component of such rows alone has
a null id; rows that repeat a ``doc_id`` are one node, reachable from each
other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import distinct_pairs, fresh, mix64, shingle_rows, shuffle_parts, small, steps, table, text_buffers, whole_row, words_of, written
from strata.llm.components import components

SHINGLE = 5
# A link: 100 * intersection >= 80 * union, so difference <= (a + b) / 9, larger <= 1.25 * smaller.
PER_CENT = 80
BAND_RATIO = 1.4
# Cells of the sketch in one block; with few of them, blocks of one or two shingles agree by chance.
CELLS = 1 << 30
# Bytes of a shingle's hash that verification compares, and partners of a set in one part.
BYTES = 8
PART = 256
# Numbers (64 cells each) of the short sketch that rows of the second round carry, for large sets beside a wide one.
FOLD = 8
SHORT = [f"f{k}" for k in range(FOLD)]
# Of a set's bands of even and odd number: keys that it can spare, and its sketch where 64 * FOLD cells are too few.
SPARE = ["spare_0", "spare_1"]
WIDE = ["wide_0", "wide_1"]
# Sets of a mixed key beyond which it gets a second hub.
POPULAR = 16
# Hubs that a set meets in a round before the last: those of most of its keys.
TRIES = 3
# Nodes of rows without an id lie above all ids.
NO_ID = 1 << 62


def _bands() -> np.ndarray:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return np.array(edges, dtype=np.int64)


BANDS = _bands()  # band i holds sizes BANDS[i] up to BANDS[i + 1] - 1


def largest_difference(size: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Shingles in which a set of ``size`` may differ from a linked set of at most ``high``, no smaller one."""
    return (size + np.maximum(size, np.minimum(size * 5 // 4, high))) // 9


def blocks_of(band: np.ndarray) -> np.ndarray:
    """Blocks of a band's sketches: more than the largest difference, with room for empty ones."""
    need = 2 * (BANDS[band + 1] - 1) // 9 + 1
    return need + need // 12 + 2


def _blocks(hashes: np.ndarray, owner: np.ndarray, sizes: np.ndarray, up: int) -> tuple[np.ndarray, ...]:
    """The sketch blocks of all sets in their own band, or with ``up`` in the next: (band, first block, content).

    Rows are (hash, owner), distinct; a set that sends nothing to the band has no blocks.
    """
    band = np.searchsorted(BANDS, sizes, side="right") - 1 + up
    sends = (sizes > 0) & (sizes * 5 // 4 >= BANDS[band]) if up else sizes > 0
    count = np.where(sends, blocks_of(band), 0)
    first = np.concatenate([[0], np.cumsum(count)])
    rows = sends[owner]
    of = owner[rows]
    # The block by the upper 32 bits, the cell by the lowest bits.
    block = ((hashes[rows] >> np.uint64(32)) * count[of].astype(np.uint64)) >> np.uint64(32)
    cell = mix64((hashes[rows] & np.uint64(CELLS - 1)) + np.uint64(1))
    sketch = np.zeros(first[-1], dtype=np.uint64)
    np.bitwise_xor.at(sketch, first[of] + block.astype(np.int64), cell)
    return band, first, sketch


def _full(band: np.ndarray, first: np.ndarray, sketch: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Blocks with a bit, of each set, beyond the largest difference from a linked set; at most 0: too few."""
    whose = np.repeat(np.arange(len(sizes)), np.diff(first))
    return np.bincount(whose, weights=sketch != 0, minlength=len(sizes)).astype(np.int64) - largest_difference(sizes, BANDS[band + 1] - 1)


def block_keys(hashes: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, owner) of all sketch blocks that the sets send; rows are (hash, owner), distinct.

    The lowest bit of a key is that of its band's number, which tells a set's two bands apart.
    """
    keys, owners = [], []
    for up in (0, 1):
        band, first, sketch = _blocks(hashes, owner, sizes, up)
        whose = np.repeat(np.arange(len(sizes)), np.diff(first))
        number = np.arange(first[-1]) - first[whose]
        enough = _full(band, first, sketch, sizes) > 0
        sent = (sketch != 0) | ~enough[whose]
        place = mix64((band[whose].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + np.uint64(1))
        key = mix64(sketch ^ place) & ~np.uint64(1) | (band[whose] & 1).astype(np.uint64)
        keys.append(key[sent])
        owners.append(whose[sent])
    return np.concatenate(keys), np.concatenate(owners)


def spare_keys(hashes: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(2, sets): keys that a set can leave out in its band of even and of odd number, and still meet all its links."""
    out = np.zeros((2, len(sizes)), dtype=np.int32)
    for up in (0, 1):
        band, first, sketch = _blocks(hashes, owner, sizes, up)
        out[band & 1, np.arange(len(sizes))] = np.maximum(_full(band, first, sketch, sizes) - 1, 0)
    return out


def _sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(from, to, hashes, owner, sizes, sid, check) of the texts' sets, a step at a time."""
    data, offsets = text_buffers(texts)
    for lo, hi in steps(offsets):
        part = offsets[lo : hi + 1] - offsets[lo]
        words, first = words_of(data[offsets[lo] : offsets[hi]], part)
        h, o = distinct_pairs(*shingle_rows(words, first, SHINGLE))
        sizes = np.bincount(o, minlength=hi - lo).astype(np.int64)
        sid, check = np.zeros(hi - lo, dtype=np.uint64), np.zeros(hi - lo, dtype=np.uint64)
        if len(h):
            at = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
            sid[o[at]] = mix64(np.add.reduceat(mix64(h), at))
            check[o[at]] = mix64(np.add.reduceat(mix64(h ^ np.uint64(0x5851F42D4C957F2D)), at))
        yield lo, hi, h, o, sizes, sid, check


def _arrow(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def whole_sketches(h: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A parity sketch per set, of two to four bits per shingle (64 * FOLD at least)."""
    width = np.maximum(64 * FOLD, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))
    ends = np.cumsum(width)
    bits = np.zeros(ends[-1] if len(ends) else 0, dtype=np.uint8)
    cell = (h >> np.uint64(8)).astype(np.int64) & (width[owner] - 1)
    np.bitwise_xor.at(bits, (ends - width)[owner] + cell, np.uint8(1))
    offsets = np.concatenate([[0], ends // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.packbits(bits, bitorder="little"))])


def folded(sketches: pa.Array) -> np.ndarray:
    """(sets, FOLD) numbers: each sketch folded by XOR to 64 * FOLD cells, none has fewer."""
    out = np.zeros((len(sketches), FOLD), dtype=np.uint64)
    for i, raw in enumerate(sketches):
        x = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
        while len(x) > FOLD:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out[i] = x
    return out


def wide_sketches(sketches: pa.Array, sizes: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The sketches for a set's band of even and of odd number, folded to as many cells as all sets have that send to the band.

    They are twice the smallest such set's shingles or more; null where that is no more than the short sketch.
    """
    home = np.searchsorted(BANDS, sizes, side="right") - 1
    out: tuple[list, list] = ([], [])
    for raw, size, band in zip(sketches, sizes.tolist(), home.tolist(), strict=True):
        x = np.frombuffer(raw.as_buffer(), dtype=np.int64)
        for b in (band, band + 1):
            width = 1 << int(2 * BANDS[max(b - 1, 0)] - 1).bit_length()
            y = x if size and width > 64 * FOLD else None
            while y is not None and 64 * len(y) > width:
                y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            out[b & 1].append(y)
    return tuple(pa.array(column, pa.list_(pa.int64())) for column in out)


def may_link(a: bytes, a_size: int, b: bytes, b_size: int) -> bool:
    """Whether two sets can link, by their sizes and the Hamming distance of their sketches."""
    if 4 * max(a_size, b_size) > 5 * min(a_size, b_size):
        return False
    x, y = sorted((np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)), key=len)
    while len(y) > len(x):  # a sketch of half the cells is the XOR of the halves
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) <= (a_size + b_size) // 9


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, sid, check, spare keys, wide sketches, sketch, short sketch) of every row; (sid, check) names the set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, o, sizes, sid, check in _sets(batch.column("text")):
                sketches = whole_sketches(h, o, sizes)
                short = folded(sketches).view(np.int64)
                yield _arrow(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("text_key").slice(lo, hi - lo),
                        sizes,
                        sid.view(np.int64),
                        check.view(np.int64),
                        *spare_keys(h, o, sizes),
                        *wide_sketches(sketches, sizes),
                        sketches,
                        *(np.ascontiguousarray(short[:, k]) for k in range(FOLD)),
                    ],
                    ["doc_id", "text_key", "n_shingles", "sid", "check", *SPARE, *WIDE, "sketch", *SHORT],
                )

    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    return keyed.mapInArrow(rows, "doc_id long, text_key long, n_shingles long, sid long, check long, spare_0 int, spare_1 int, wide_0 array<long>, wide_1 array<long>, sketch binary, " + ", ".join(f"{c} long" for c in SHORT))


def sketch_keys(docs: DataFrame) -> DataFrame:
    """(key, sid): the sketch blocks of every set, equal sets of one task once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, _, h, o, sizes, sid, _ in _sets(batch.column("text")):
                new = np.zeros(len(sizes), dtype=bool)
                for i, s in enumerate(sid.tolist()):
                    if sizes[i] and s not in seen:
                        seen.add(s)
                        new[i] = True
                keep = new[o]
                keys, owner = block_keys(h[keep], o[keep], np.where(new, sizes, 0))
                yield _arrow([keys.view(np.int64), sid[owner].view(np.int64)], ["key", "sid"])

    return docs.select("text").mapInArrow(rows, "key long, sid long")


def near_enough(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of set numbers that pass ``may_link``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("a_sketch", "a_size", "b_sketch", "b_size"))
            ok = [may_link(x.as_buffer(), n.as_py(), y.as_buffer(), m.as_py()) for x, n, y, m in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    for side in ("b", "a"):
        of_side = sketches.select(
            F.col("sid").alias(side), F.col("size").alias(f"{side}_size"), F.col("sketch").alias(f"{side}_sketch")
        )
        pairs = pairs.join(of_side, side)
    return pairs.mapInArrow(rows, "a long, b long").distinct()


def _packed(h: np.ndarray) -> bytes:
    """The lowest ``BYTES`` bytes of each hash."""
    return h.view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def _unpacked(raw) -> np.ndarray:
    out = np.zeros((len(raw) // BYTES, 8), dtype=np.uint8)
    out[:, :BYTES] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, BYTES)
    return out.view(np.uint64).ravel()


def is_link(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * both >= PER_CENT * (len(a) + len(b) - both)


def verified(pairs: DataFrame, docs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) of set numbers whose sets are similar enough, by exact intersection.

    Pairs are grouped by a, in parts of about ``PART`` partners; a's set goes
    to each of its parts ahead of the partners' sets, and a part is read as a
    stream.  Sets are made from the one text that stands for them.
    """
    pairs = written(pairs, "pairs")  # read twice here, and costly to make
    parts = F.ceil(F.col("n") / PART).cast("long")
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    dealt = written(pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), parts).alias("part")), "dealt")
    asks = dealt.select(F.col("b").alias("sid"), "a", "part", F.lit(1).alias("role")).unionByName(
        dealt.select(F.col("a").alias("sid"), "a", "part", F.lit(0).alias("role")).distinct()
    )
    full = known.where("n_shingles > 0").select("sid", "check", F.struct("doc_id", "text_key").alias("one"))
    rep = full.join(asks.select("sid").distinct(), "sid", "left_semi").groupBy("sid", "check").agg(F.min("one").alias("one"))
    wanted = written(
        rep.select("sid", F.col("one.doc_id").alias("of_id"), F.col("one.text_key").alias("of_text")).join(asks, "sid"), "wanted"
    )
    texts = docs.join(
        small(wanted), F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("of_text"))
    ).select("text", "sid", "a", "part", "role")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("sid").to_numpy(zero_copy_only=False)
            rest = batch.drop_columns(["text"])
            for lo, hi, h, _, sizes, sid, _ in _sets(batch.column("text")):
                ends = np.cumsum(sizes)
                mine = np.flatnonzero(sid.view(np.int64) == asked[lo:hi])
                raw = pa.array([_packed(h[ends[i] - sizes[i] : ends[i]]) for i in mine], pa.binary())
                yield rest.slice(lo, hi - lo).take(pa.array(mine)).append_column("hashes", raw)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, heads = None, []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("a", "part", "role", "sid"))
            for a, part, role, sid, raw in zip(*columns, batch.column("hashes"), strict=True):
                if (a, part) != group:
                    group, heads = (a, part), []
                h = _unpacked(raw.as_buffer())
                if role == 0:
                    heads.append(h)
                elif any(is_link(x, h) for x in heads):
                    out.append((a, sid))
            yield _arrow([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    made = texts.mapInArrow(sets, "sid long, a long, part long, role int, hashes binary")
    dealt_out = made.repartition(shuffle_parts(docs.sparkSession), "a", "part").sortWithinPartitions("a", "part", "role")
    return dealt_out.mapInArrow(compared, "a long, b long").distinct()


def met_most(pairs: DataFrame) -> DataFrame:
    """(a, b) of ``TRIES`` hubs a of each set b at most: those that share most keys with it.

    ``pairs`` has a row per key.  What is left out here lies in mixed keys, so the last round has it.
    """
    best = Window.partitionBy("b").orderBy(F.col("keys").desc(), "a")
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("keys"))
    return counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= TRIES).select("a", "b")


def without_spared(mixed: DataFrame, sketches: DataFrame) -> DataFrame:
    """(key, sid, label) of ``mixed`` (with n, the sets of the key), without the keys that a set can spare.

    A set leaves its most frequent keys out first, equal ones by their number, so all sets use one order.
    """
    band = F.col("key").bitwiseAND(F.lit(1))
    last = Window.partitionBy("sid", band).orderBy(F.col("n").desc(), "key")
    placed = mixed.withColumn("place", F.row_number().over(last)).join(sketches.select("sid", *SPARE), "sid")
    return placed.where(F.col("place") > F.when(band == 0, F.col(SPARE[0])).otherwise(F.col(SPARE[1]))).select("key", "sid", "label")


def mixed_keys(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, sid, label, n) of the keys whose sets, n of them, lie in different components; written."""
    whole = Window.partitionBy("key")
    labelled = rows.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("key", "sid", F.coalesce("root", "sid").alias("label"))
    spans = labelled.withColumn("lo", F.min("label").over(whole)).withColumn("hi", F.max("label").over(whole))
    return written(spans.withColumn("n", F.count(F.lit(1)).over(whole)).where("lo != hi").select("key", "sid", "label", "n"), "mixed")


def similar_sets(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b) over set numbers: verified links that join every component, not all of its pairs."""
    sketches = known.where("n_shingles > 0").select("sid", "check", F.col("n_shingles").alias("size"), *SPARE, *WIDE, "sketch", *SHORT)
    sketches = written(sketches.dropDuplicates(["sid", "check"]), "sketches")
    # Rows of a key in order: the running minimum is the hub, nothing is held in memory.
    ordered = Window.partitionBy("key").orderBy("sid")
    members = written(sketch_keys(docs).withColumn("hub", F.min("sid").over(ordered)).where("sid != hub"), "members")
    stars = near_enough(met_most(members.select(F.col("hub").alias("a"), F.col("sid").alias("b"))), sketches)
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = written(verified(first, docs, known), "links")
    labels = components(links)

    # Keys whose sets (hub included) still lie in different components bring the pairs across them.
    everyone = members.select("key", "sid").unionByName(members.select("key", F.col("hub").alias("sid"))).distinct()
    mixed = mixed_keys(everyone, components(links))
    # A second hub in each popular one joins what the smallest hubs left apart, again a linear number of pairs: the
    # set that meets most others over all its mixed keys, as the middle of a group of copies does.
    meets = mixed.groupBy("sid").agg(F.sum("n").alias("meets"))
    middle = F.struct((-F.col("meets")).alias("at"), F.col("sid").alias("a"), F.col("label").alias("a_label"))
    popular = mixed.where(F.col("n") > POPULAR).join(meets, "sid")
    again = popular.withColumn("hub", F.min(middle).over(Window.partitionBy("key"))).where("hub.a_label != label")
    again = met_most(again.select(F.col("hub.a").alias("a"), F.col("sid").alias("b")))
    again = again.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = written(links.unionByName(verified(near_enough(again, sketches), docs, known)), "links")
    mixed = mixed_keys(mixed.select("key", "sid"), components(links))
    # Sketches of the band's width travel with the rows, so most pairs end inside the join.
    wide = F.when(F.col("key").bitwiseAND(F.lit(1)) == 0, F.col(WIDE[0])).otherwise(F.col(WIDE[1])).alias("wide")
    columns = ("sid", "label", "size", "wide", *SHORT)
    rows = written(
        without_spared(mixed, sketches).join(sketches.select("sid", "size", *WIDE, *SHORT), "sid").select("key", "sid", "label", "size", wide, *SHORT),
        "mixed-sketches",
    )
    left, right = (rows.select("key", *(F.col(c).alias(f"{side}_{c}") for c in columns)) for side in ("a", "b"))
    differ = lambda x, y: F.bit_count(x.bitwiseXOR(y))
    distance = sum((differ(F.col(f"a_{c}"), F.col(f"b_{c}")) for c in SHORT), F.lit(0))
    wide_distance = F.aggregate(F.zip_with("a_wide", "b_wide", differ), F.lit(0), lambda n, x: n + x)
    passes = (
        (F.col("a_sid") < F.col("b_sid"))
        & (F.col("a_label") != F.col("b_label"))
        & (F.greatest("a_size", "b_size") * 4 <= F.least("a_size", "b_size") * 5)
        & (distance * 9 <= F.col("a_size") + F.col("b_size"))
        & (F.coalesce(wide_distance, F.lit(0)) * 9 <= F.col("a_size") + F.col("b_size"))
    )
    rest = left.join(right, "key").where(passes).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b")).distinct()
    return links.unionByName(verified(near_enough(rest, sketches), docs, known))


def linked(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    node: Column = F.coalesce("doc_id", F.lit(NO_ID).bitwiseOR(F.shiftrightunsigned(F.col("sid"), 3)))
    known = written(profiles(docs).withColumn("node", node), "profiles")
    full = known.where("n_shingles > 0")
    # A set is named by the smallest node that has it.
    classes = written(full.groupBy("sid", "check").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("rows")), "classes")
    copies = full.join(classes.where("rows > 1"), ["sid", "check"]).where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = similar_sets(docs, known)
    for side in ("a", "b"):
        of_side = classes.select(F.col("sid").alias(side), F.col("first").alias(f"{side}_node"))
        links = links.join(of_side, side)
    roots = components(copies.unionByName(links.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))))
    return known.join(roots, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.coalesce("root", "node") < NO_ID, F.coalesce("root", "node")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of similar texts, all columns as they were.

    Components are those of the texts, whatever ids they have: rows that repeat
    an id are decided each by its own text.  The row of the smallest id stays,
    rows without an id come last, then the smallest text hash; of rows that
    agree in id and text one stays.  Rows with null and blank texts all stay.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = written(profiles(plain), "profiles")
    roots = components(similar_sets(plain, known)).select(F.col("node").alias("sid"), "root")
    rows = known.where("n_shingles > 0").groupBy("doc_id", "text_key", "sid").agg(F.count(F.lit(1)).alias("copies"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key").alias("row")
    labelled = written(
        rows.join(roots, "sid", "left").select(row, "copies", F.coalesce("root", "sid").alias("component")), "labelled"
    )
    least = labelled.groupBy("component").agg(F.min("row").alias("first"), F.sum("copies").alias("n")).where("n > 1")
    # Rows to drop; of a row that stays and is there several times, one is picked.
    of_id, of_text, stays = fresh(docs.columns, "__id", "__key", "__stays")
    marked = labelled.join(least, "component").where((F.col("row") != F.col("first")) | (F.col("copies") > 1)).select(
        F.col("row.doc_id").alias(of_id), F.col("row.text_key").alias(of_text), (F.col("row") == F.col("first")).alias(stays)
    )
    marked = written(marked, "marked")
    text_key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(of_id)) & (text_key == F.col(of_text))
    columns = whole_row(docs.columns)
    picked = (
        docs.join(small(marked.where(stays)), same)
        .groupBy(of_id, of_text)
        .agg(F.min_by(columns, F.xxhash64(columns)).alias("row"))
        .select("row.*")
    )
    return docs.join(small(marked.drop(stays)), same, "left_anti").unionByName(picked)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of similar texts in all ``documents``."""
    return linked(table(spark, sf_dir, "documents"))
