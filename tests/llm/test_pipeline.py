"""The pipeline's stages against brute force on the small tables."""

import re

import corpus_pipeline
from strata.llm import toxicity

SMALL = "/root/testdata/sf0.001"


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def _components(sets):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d in ids}


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.op2_toxicity(spark, SMALL).where("predicted = 1").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert all(before[d] == r for d, r in kept[name].items())
    assert set(kept["toxicity"]) == set(before) - toxic

    groups = {}
    for d, r in kept["toxicity"].items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append((-len(r.text or ""), d))
    assert set(kept["exact_dedup"]) == {min(g)[1] for g in groups.values()}

    sets = {d: _shingles(r.text) for d, r in kept["exact_dedup"].items()}
    assert set(kept["jaccard_join"]) == {d for d, root in _components(sets).items() if d == root}

    items = [_shingles(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    whole = {d for d, r in kept["jaccard_join"].items() if any(len(i) >= 7 and i <= _shingles(r.text) for i in items)}
    assert not whole & set(kept["decontaminate"]) and set(kept["decontaminate"]) <= set(kept["jaccard_join"])

    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in mixed) == sorted(kept["decontaminate"])
    assert abs(sum(r.taken for r in mixed) - sum(r["size"] for r in mixed)) <= 0.05 * sum(r["size"] for r in mixed)


def test_stages_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, SMALL).count() == 0
