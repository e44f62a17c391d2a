"""Suffix-array dedup: a hot gram whose suffixes lie in many range partitions."""

import random

import numpy as np

from strata.llm import suffix_dedup as sd
from strata.llm.common import grams, words_of
from test_suffix_dedup import _brute


def _hash(words):
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return int(grams(words_of(data, np.array([0, len(data)]))[0], sd.GRAM)[0])


def _hot_rows(pairs=80):
    """Pairs of documents with a passage of 50 words: a gram that all have, then 25 words (in
    every second pair before it)."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    # A small hash is the minimum of its windows.
    hot = min((words(sd.GRAM) for _ in range(3000)), key=_hash)
    rows = []
    for p in range(pairs):
        own = words(sd.SIDE)
        for _ in range(2):
            body = own + hot + words(30) if p % 2 else words(30) + hot + own
            rows.append((len(rows), " ".join(words(3) + body + words(3))))
    return rows


def test_pairs_cut_by_partition_bounds(spark):
    rows = _hot_rows()
    want = _brute(rows)
    assert len({d for d, _ in want}) == len(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in (1, 61):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
            results.append(sorted(map(tuple, got)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
    assert {(d, k) for d, first, n in results[1] for k in range(first, first + n)} == want


def _frame(spark, rng, n):
    """Contexts of few grams, words and documents: long runs of one document, equal sides."""
    word = lambda: bytes([0, 0, 0, rng.randrange(2)])
    side = lambda: b"".join(word() for _ in range(rng.choice([3, 20, 25]))) if rng.random() < 0.5 else bytes(100)
    keys = sorted({(rng.randrange(3), side(), side()) for _ in range(n)})
    rows = []
    for ctx, (gram, ahead, behind) in enumerate(keys):
        doc = rng.choice([1, 1, 1, 1, 2, 3])
        rows.append((ctx, gram, ahead, behind, doc, rng.choice([doc, doc, doc, 4])))
    return spark.createDataFrame(rows, "ctx long, gram long, ahead binary, behind binary, lo long, hi long")


def test_neighbours_are_the_same_for_any_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    frame = _frame(spark, random.Random(2), 300).cache()
    try:
        for order in (("gram", "ahead", "behind"), ("gram", "behind", "ahead")):
            got = []
            for parts in (1, 7, 150):
                spark.conf.set("spark.sql.shuffle.partitions", str(parts))
                got.append({tuple(r) for r in sd.neighbour_spans(frame, order).collect()})
            assert got[0] and got[0] == got[1] == got[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        frame.unpersist()
