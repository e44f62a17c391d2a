"""Mixing: targets by brute-force resharing, knapsack by enumeration, whole query."""

import random
import re
from itertools import product

import numpy as np
import pytest

from strata.llm import mix_sources as mx

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, size string, target string"


def _targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, goal, free = sum(sizes.values()), {}, set(order)
    rest = float(total)
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > 3 * sizes[s]}
        if not over:
            goal.update({s: weight[s] * unit for s in free})
            break
        for s in over:
            goal[s] = 3.0 * sizes[s]
            rest -= goal[s]
        free -= over
    return goal


def _check(rows, got):
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken = _targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert r.taken in {r["size"] * k for k in range(4)}
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(3, 0.02 * want[s]), (s, taken[s], want[s])


def test_knapsack_is_the_best_reachable_sum():
    rng = random.Random(4)
    for _ in range(60):
        lengths = np.array(rng.sample(range(1, 30), rng.randrange(1, 4)))
        counts = np.array([rng.randrange(0, 4) for _ in lengths])
        budget = rng.randrange(0, 80)
        sums = {sum(a * b for a, b in zip(c, lengths, strict=True)) for c in product(*(range(n + 1) for n in counts))}
        best = min((s for s in sums if s <= 2 * budget), key=lambda s: (abs(s - budget), s))
        take = mx.knapsack(lengths, counts, budget)
        assert (take <= counts).all() and int((take * lengths).sum()) == best


def test_large_budget_is_met_exactly():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 5000, 800))
    counts = rng.integers(1, 10**6, len(lengths))
    budget = int((lengths * counts).sum()) * 2 // 5
    take = mx.fit_counts(lengths, counts, budget)
    assert (take <= counts).all() and (take >= 0).all() and int((take * lengths).sum()) == budget


def test_hostile_rows(spark, monkeypatch):
    monkeypatch.setattr(mx, "BUCKET", 16)
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "b", "é", "Z", None]), None, None) for i in range(500)]
    rows += [(1000 + i, "one length only", "hot", None, None) for i in range(700)]
    rows += [(None, None, "a", None, None), (None, " \t", None, None, None), (2000, "x" * 100000, "b", None, None), (2001, "\xa0 \x0b\xa0", "tiny", None, None)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, DOCS)
    got = mx.mix(df).collect()
    _check(rows, got)
    again = mx.mix(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_empty_and_blank(spark):
    assert mx.mix(spark.createDataFrame([], DOCS)).count() == 0
    got = mx.mix(spark.createDataFrame([(1, None, "a", None, None), (2, " ", None, None, None)], DOCS)).collect()
    assert [(r.source_size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    _check(rows, mx.op4_mix_sources(spark, SMALL).collect())
