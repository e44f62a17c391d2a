"""Token counts of byte-level BPE without producing token ids.

A word's symbols start as its bytes.  A heap holds every adjacent pair that
has a merge rank; the lowest rank (leftmost on ties) is popped again and
again, the pair becomes one symbol in a doubly linked list, and its two new
neighbour pairs are pushed.  Each merge removes one symbol, so the word's
token count is its number of bytes minus the number of merges.  No id is
looked up or emitted.

Texts are split into words by the tokenizer's pattern; special strings (such
as ``<|endoftext|>``) found in a text are one token each, as the tokenizer
library does by default.  Counting is a map over the rows: no shuffle.  Each
Python worker keeps a bounded memory of words it has already counted.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are
counted one by one; a word of any length is merged whole (n log n).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table

# The split pattern of byte-level BPE (public; fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Words remembered by a worker; the oldest half goes when it is full.
MEMORY_WORDS = 1 << 20
# Longer words are counted without being remembered.
MEMORY_BYTES = 64

LIMIT = 1024


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shift = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(shift)) for b in range(256)]


class Counter:
    """Merge ranks of one vocabulary file and the counts of words seen."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        # Symbols are numbered as they appear: first the 256 bytes, then each
        # merge's result; (left number, right number) -> (rank, number).
        number = {s: i for i, s in enumerate(_byte_symbols())}
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            joined = number.setdefault(left + right, len(number))
            self.merges.setdefault(number[left] << 20 | number[right], (rank, joined))
        self.words = regex.compile(PATTERN)
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.seen: dict[str, int] = {}

    def tokens_of_word(self, raw: bytes) -> int:
        """Initial symbols minus merges."""
        n = len(raw)
        if n < 2:
            return n
        merges = self.merges
        symbol = list(raw)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            hit = merges.get(symbol[i] << 20 | symbol[i + 1])
            if hit:
                heap.append((hit[0], i, hit[1], symbol[i], symbol[i + 1]))
        heapify(heap)
        left = n
        while heap:
            _, i, joined, a, b = heappop(heap)
            j = after[i]
            # Stale: one of the two symbols has gone or changed meanwhile.
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue
            symbol[i], symbol[j] = joined, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                hit = merges.get(joined << 20 | symbol[k])
                if hit:
                    heappush(heap, (hit[0], i, hit[1], joined, symbol[k]))
            h = before[i]
            if h >= 0:
                hit = merges.get(symbol[h] << 20 | joined)
                if hit:
                    heappush(heap, (hit[0], h, hit[1], symbol[h], joined))
        return left

    def tokens_of_text(self, text: str) -> int:
        total = 0
        if self.split is not None and self.split.search(text):
            parts = self.split.split(text)
            total += len(parts) - 1
        else:
            parts = [text]
        seen = self.seen
        for part in parts:
            for word in self.words.findall(part):
                n = seen.get(word)
                if n is None:
                    raw = word.encode("utf-8")
                    n = self.tokens_of_word(raw)
                    if len(raw) <= MEMORY_BYTES:
                        if len(seen) >= MEMORY_WORDS:
                            for old in list(seen)[: MEMORY_WORDS // 2]:
                                del seen[old]
                        seen[word] = n
                total += n
        return total


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per vocabulary file and Python worker."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of ``docs``.

    ``path`` names the vocabulary file; every executor must have it there.
    """

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in batches:
            yield pd.Series([c.tokens_of_text(t) for t in texts], dtype="int64")

    counted = F.pandas_udf(count, "long")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), counted("text").alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of ``documents`` under byte_bpe_50k."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
