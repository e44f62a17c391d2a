"""Helpers shared by the corpus operators.

Tables are read with Spark's own readers, work tables go to the shared folder
(``spark.checkpoint.dir``), and the numpy tokeniser below turns an Arrow
string column into word and shingle hashes without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import work_dir

# The six ASCII white-space characters 0x20, 0x09-0x0D, and their regex class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Bytes of text handled by one numpy step; a longer document is one step.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a work table to the shared folder and read it back.

    Cuts the lineage at a replicated store, so a lost executor costs only the
    running stage and later stages never recompute the texts.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Column names like ``names`` that are not among ``columns``."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def whole_row(columns: list[str]) -> Column:
    """All columns as one struct, whatever characters their names hold."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in columns))


def small(df: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """A written table with a broadcast hint if it has at most ``rows`` rows; beyond that the planner joins it by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------------------
# hashing

_GOLD = 0x9E3779B97F4A7C15
# Odd multipliers of the word positions of a shingle (from the golden ratio).
_POSITION = np.array([(_GOLD * (2 * k + 3)) % 2**64 | 1 for k in range(64)], dtype=np.uint64)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse mod 2**64
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64, public domain)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLD))
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """Powers of the base and of its inverse, grown to the longest step seen."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps))
        return cls.up[:n], cls.down[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(offs) == 0 or offs[-1] == offs[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def steps(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of each text) of texts in one byte buffer.

    Words are runs of non-white-space, compared with A-Z lower-cased.  A
    word's hash is a polynomial over its bytes (prefix sums, no loop),
    finalised by ``mix64`` together with its length.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    inside = ~_IS_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    up, down = _Powers.to(n)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = mix64(hashes + (ends - starts).astype(np.uint64) * np.uint64(_GOLD))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (position-weighted, finalised)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:n] * _POSITION[0]
    for k in range(1, size):
        out = out + words[k : k + n] * _POSITION[k]
    return mix64(out)


def shingle_rows(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, text number) of all texts of one step.

    A text with fewer words than ``size`` has one shingle, its whole word
    sequence; a text without words has none.
    """
    counts = np.diff(first)
    whole = grams(words, size)
    starts = np.arange(len(whole))
    owner = np.repeat(np.arange(len(counts)), counts)[: len(whole)]
    ok = starts + size <= first[1:][owner] if len(whole) else np.zeros(0, dtype=bool)
    hashes, owners = [whole[ok]], [owner[ok]]
    short = np.flatnonzero((counts > 0) & (counts < size))
    for length in range(1, size):
        rows = short[counts[short] == length]
        if len(rows):
            at = first[rows]
            h = np.full(len(rows), length, dtype=np.uint64) * np.uint64(_GOLD)
            for k in range(length):
                h = h + words[at + k] * _POSITION[k]
            hashes.append(mix64(h))
            owners.append(rows)
    return np.concatenate(hashes), np.concatenate(owners)


def distinct_pairs(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, hash), sorted by owner, then hash."""
    if len(hashes) == 0:
        return hashes, owners
    order = np.lexsort((hashes, owners))
    h, o = hashes[order], owners[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], o[new]
