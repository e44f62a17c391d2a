"""Spaced seeds: brute-force diagonals, substitutions, hostile rows, both join forms, native plan."""

import random
import re

import pytest

from strata.llm import decontaminate as dc

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, item_id string, at string, words string, seed string"
ITEMS = "item_id long, text string, doc_id string"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def _brute(docs, items):
    """Every diagonal: good windows that hold a mask hit, and the passage between the first and the last one."""
    out = {}
    masks = [[i for i, b in enumerate(m) if b == "1"] for m in dc.MASKS]
    for doc_id, text, *_ in docs:
        d = _words(text)
        for item_id, item_text, *_ in items:
            b = _words(item_text)
            if not b or not set(d) & set(b):
                continue
            size, span = min(dc.WINDOW, len(b)), min(dc.SPAN, len(b))
            looks = masks if len(b) >= dc.SPAN else [range(len(b))]
            for shift in range(-len(b), len(d)):
                lo, hi = max(0, -shift), min(len(b), len(d) - shift)
                same = {j: d[j + shift] == b[j] for j in range(lo, hi)}
                good = set()
                for q in range(len(b) - span + 1):
                    if q not in same or q + span - 1 not in same or not any(all(same[q + o] for o in m) for m in looks):
                        continue
                    for s in range(q + span - size, q + 1):
                        if s in same and s + size - 1 in same and sum(same[s + k] for k in range(size)) >= size * dc.IDENTITY:
                            good.add(s)
                if good:
                    inside = [j for j in range(min(good), max(good) + size) if same[j]]
                    new = (len(inside), -(inside[0] + shift))
                    out[doc_id, item_id] = max(new, out.get((doc_id, item_id), new))
    return {(d, i, n, -early) for (d, i), (n, early) in out.items()}


def _case(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    words = lambda n: rng.choices(vocab, k=n)
    items = [(i, " ".join(words(rng.choice([11, 12, 14, 20, 40]))), "x") for i in range(12)]
    items += [(None, " ".join(words(20)), None), (90, None, None), (91, "", None), (92, "too short an item", None), (94, "w7", None), (95, " ".join(words(10)), None), (96, " ".join(words(400)), None), (93, items[0][1], None)]
    docs = []
    for i in range(80):
        body = words(rng.randrange(0, 60))
        if i % 2:
            part = _words(rng.choice(items[:13])[1])
            for k in range(len(part)):
                if rng.random() < 0.12 * (i % 4):
                    part[k] = "sub"
            body = body + [w.upper() if i % 3 else w for w in part[rng.randrange(0, 4) :]] + words(rng.randrange(0, 10))
        docs.append((i, rng.choice([" ", "\t", " \n"]).join(body), "c", "c", "c", "c"))
    whole = dict((i, t) for i, t, _ in items)
    for i, item in enumerate((92, 95, 96, 96)):
        part = whole[item].split()
        if i == 3:
            part[150:153] = ["other"] * 3
        docs.append((210 + i, " ".join(words(5) + part + words(7)), *"cccc"))
    docs += [(200, None, *"cccc"), (201, " \x0b", *"cccc"), (None, items[3][1], *"cccc"), docs[1], docs[1]]
    docs.append((300, " ".join(words(9000)) + " " + items[5][1] + " " + " ".join(words(9000)), *"cccc"))
    return docs, items


@pytest.mark.parametrize("bound", [dc.BROADCAST_SEEDS, 0])
def test_leaks_match_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(dc, "BROADCAST_SEEDS", bound)
    docs, items = _case()
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = [(r.doc_id, r.item_id, r.overlap, r.first_word) for r in dc.leaks(d, b).collect()]
    want = _brute(docs, items)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    # items of 4, 10 and 400 words, the last one also with three words replaced
    assert {(210, 92, 4, 5), (211, 95, 10, 5), (212, 96, 400, 5), (213, 96, 397, 5)} <= want
    clean = dc.decontaminated(d, b)
    assert clean.columns == d.columns
    bad = {i for i, *_ in want}
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((r[0] for r in docs if r[0] not in bad), key=repr)


def test_pieces_overlap(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE", 7)
    docs, items = _case(5)
    leaks = dc.leaks(spark.createDataFrame(docs[:60], DOCS), spark.createDataFrame(items, ITEMS))
    got = {(r.doc_id, r.item_id, r.overlap, r.first_word) for r in leaks.collect()}
    assert got == _brute(docs[:60], items)


def test_empty_tables(spark):
    docs, items = _case()
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert dc.leaks(d.limit(0), b).count() == 0 and dc.leaks(d, b.limit(0)).count() == 0
    assert dc.decontaminated(d, b.limit(0)).count() == len(docs)


def test_query_finds_every_verbatim_item(spark):
    docs = [(r.doc_id, " ".join(_words(r.text))) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, " ".join(_words(r.text))) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = {(r.doc_id, r.item_id) for r in dc.op8_decontaminate(spark, SMALL).collect()}
    whole = {(d, b) for d, t in docs for b, x in items if f" {x} " in f" {t} "}
    assert whole and whole <= found
    # Nothing without a long common run of words is accused.
    text, item = dict(docs), dict(items)
    for d, b in found - whole:
        w, t = item[b].split(), f" {text[d]} "
        assert any(f" {' '.join(w[i : i + 5])} " in t for i in range(len(w) - 4))


def test_plan_is_native(spark):
    df = dc.op8_decontaminate(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan and "Cartesian" not in plan
