"""Exact dedup: brute force over hostile rows, merge levels, deduplicated rows."""

import hashlib
import random

import numpy as np
import pytest
from oracle import compare, duck

from strata.llm import exact_dedup as ed

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, sha string, points string"


def _norm(t):
    return "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")


def _rows(seed, n=400):
    rng = random.Random(seed)
    texts = ["", None, "a b", "ab", " a\tb\x0b", "é x", "\xa0", "z" * 50000, "z" * 49999 + " z"] + [f"t{i} u" for i in range(60)]
    rows = [(i, rng.choice(texts), None, "clash") for i in range(n)]
    rows += [(1000 + i, "hot  copy" if i % 2 else "hot copy", None, None) for i in range(200)]
    return rows + rows[:30] + [(None, "ab", None, None), (None, "only null id", None, None), (None, "only null id", None, None)]


def _brute(rows):
    groups = {}
    for i, (doc, text, _, _) in enumerate(rows):
        key = (-len(text or ""), doc is None, doc or 0, i)
        groups.setdefault(_norm(text), []).append(key)
    out = []
    for text, keys in groups.items():
        best = min(keys)
        sha = hashlib.sha256(text.encode()).hexdigest()
        keep = None if best[1] else best[2]
        out += [(None if k[1] else k[2], keep, len(keys), k == best, sha, -k[0]) for k in keys]
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 2, 8, 40])
def test_decisions_match_brute_force(spark, parts):
    rows = _rows(parts)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, DOCS).repartition(5)
        got = sorted((tuple(r) for r in ed.dedup_decisions(df).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == _brute(rows)


def test_deduplicated_keeps_columns_and_one_row_of_each_group(spark):
    rows = _rows(9)
    df = spark.createDataFrame(rows, DOCS)
    got = ed.deduplicated(df)
    assert got.columns == df.columns
    kept = sorted((r.doc_id for r in got.collect()), key=repr)
    assert kept == sorted((r[0] for r in _brute(rows) if r[3]), key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert ed.dedup_decisions(df).count() == 0 and ed.deduplicated(df).count() == 0


def test_short_digest_collision_stays_apart():
    e = np.zeros(4, dtype=ed.ENTRY)
    e["key"], e["t2"], e["doc"], e["rows"] = 7, [1, 2, 1, 2], [4, 3, 2, 9], 1
    got = ed.collapse(e)
    assert [(int(r["t2"]), int(r["doc"]), int(r["rows"])) for r in got] == [(1, 2, 2), (2, 3, 2)]


def test_multiway_merge_in_small_blocks(monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 8)
    rng = np.random.default_rng(2)
    blocks = []
    for run in range(5):
        e = np.zeros(100, dtype=ed.ENTRY)
        e["key"], e["doc"], e["rows"] = np.sort(rng.integers(0, 60, 100)), np.arange(100) + 100 * run, 1
        blocks += [e[i : i + 8] for i in range(0, 100, 8)]
    blocks.sort(key=lambda b: b["key"][0])
    got = np.concatenate(list(ed._merged(iter(blocks))))
    want = ed.collapse(np.concatenate(blocks))
    assert got.tobytes() == want.tobytes() and got["rows"].sum() == 500


def test_query(spark):
    ok, why = compare(ed.op1_exact_dedup(spark, SMALL), duck(SMALL), ed.OP1_SQL)
    assert ok, why
