"""Importance resampling: SQL, brute force with runs over lines, hostile rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle import compare, duck

from strata.llm import importance as im

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row string, buckets int, weight string, `a.b` string"


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) >= 128 else " " for c in low).split(" ")


def _features(text, runs):
    words = [w for w in _words(text) if w]
    return [" ".join(words[i : i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)]


def _brute(rows, target, runs, buckets, min_words, per_cent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in _features(text, runs))
    t = Counter(bucket(f) for text in target for f in _features(text, runs))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets))))
    out = []
    for doc_id, text in rows:
        found = _features(text, runs)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, weight + noise, None, len([w for w in _words(text) if w])])
    fit = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(fit[: per_cent * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_equals_brute_force(spark, runs):
    rng = random.Random(runs)
    bits = ["the", "The", "cat", "\n", "\n\n", " ", "-", "é", "42", "...", "ümlaut", "\r\n", "x" * 60, "\t"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(0, 60))) for _ in range(60)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (3, "other"), (99, None), (98, "")]
    rows += [(100, "word " * 5000 + "\nlast"), (101, "y" * 100_000), (None, None)]
    target = ["the cat\nthe ümlaut 42", None, "", "cat x"]
    docs = spark.createDataFrame([(*r, "a", 1, "b", "c") for r in rows], DOCS)
    wanted = spark.createDataFrame([(1, t) for t in target], "doc_id long, text string")
    got = im.resampled(docs, wanted, runs=runs, buckets=97, min_words=5, per_cent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = _brute(rows, target, runs, 97, 5, 30)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_crc_of_spans_is_crc32():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4800, 300)
    ends = starts + rng.integers(0, 200, 300)
    assert im.crc32_of(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert im.resampled(none, none).collect() == []
    docs = spark.createDataFrame([(i, "a b c " * 10) for i in range(20)], "doc_id long, text string")
    assert sorted(r.rank for r in im.resampled(docs, none).collect() if r.rank) == [1, 2]


def test_a_line_of_a_third_of_all_rows(spark):
    rows = [(i, "shared line\n" * 50 + f"own {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = im.resampled(docs, docs.limit(1), min_words=1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(rows, [docs.first().text], 1, 10_000, 1, 10)


def test_query_equals_sql(spark):
    ok, why = compare(im.op12_importance(spark, SMALL), duck(SMALL), im.OP12_SQL)
    assert ok, why
