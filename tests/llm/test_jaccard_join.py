"""N-gram Jaccard join: brute-force components, sketch bounds, hostile rows."""

import random
import re

import numpy as np

from strata.llm import jaccard_join as jj

SCHEMA = "doc_id long, text string, sid string, node string, key string"


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _brute(rows):
    sets = [(doc_id, _set(text)) for doc_id, text, *_ in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted((d, len(s), find(d)) for d, s in sets)


def _rows(seed=5):
    rng = random.Random(seed)
    words = lambda n: [f"W{rng.randrange(300)}" for _ in range(n)]
    passage = words(60)
    texts = [None, "", "  \n", "one", "ONE", "a b c d", "a b c d e", "x " * 4000]
    for n in (5, 8, 9, 12, 20, 40, 90, 300):
        base = words(n)
        for _ in range(8):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, n // 60 + 1])):
                text[rng.randrange(n)] = words(1)[0]
            texts.append(" ".join(text))
            texts.append(" ".join(text + words(rng.choice([0, 1, n // 10]))))
        texts.append(" ".join(passage + base))
    rng.shuffle(texts)
    rows = [(i, t, "x", None, "k") for i, t in enumerate(texts)]
    return rows + rows[3:6]


def test_components_match_brute_force(spark):
    rows = _rows()
    got = jj.linked(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == _brute(rows)


def test_one_of_each_keeps_columns_and_roots(spark):
    rows = [r for r in _rows(6)]
    kept = jj.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert {r.doc_id for r in kept.collect()} == {root for _, _, root in _brute(rows)}


def test_null_ids_and_empty_table(spark):
    text = "a b c d e f g h i j"
    got = jj.linked(spark.createDataFrame([(None, text), (None, text), (7, text), (None, "p q r"), (None, None)], "doc_id long, text string"))
    assert sorted((r.n_shingles, r.component_id or -1) for r in got.collect()) == [(0, -1), (1, -1), (6, 7), (6, 7), (6, 7)]
    assert jj.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_sets_share_a_sketch_block():
    rng = np.random.default_rng(2)
    for size in [1, 4, 5, 8, 9, 10, 13, 20, 50, 200, 1000]:
        for _ in range(40):
            a = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            apart = size * 2 // 9
            gone = int(rng.integers(0, apart + 1))
            b = np.concatenate([a[gone:], rng.integers(0, 2**63, apart - gone, dtype=np.uint64)])
            both = size - gone
            if not len(b) or 100 * both < 80 * (size + apart - gone):
                continue
            h, o = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
            sizes = np.array([len(a), len(b)])
            keys, owner = jj.block_keys(h, o, sizes)
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())
            x, y = (s.as_buffer() for s in jj.whole_sketches(h, o, sizes))
            assert jj.may_link(x, len(a), y, len(b))


def _spread_copies():
    """A large group of copies of one text, from a few to a third of the words changed."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(600)]
    texts = []
    for i in range(240):
        text = list(base)
        for _ in range(rng.choice([2, 6, 12, 18, 22, 26, 40, 60, 80])):
            text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(text), "x", None, "k"))
    return texts


def test_a_group_of_spread_copies_brings_no_square_of_pairs(spark, monkeypatch):
    rows, counts, plain = _spread_copies(), [], jj.near_enough

    def counted(pairs, sketches):
        counts.append(pairs.count())
        return plain(pairs, sketches)

    monkeypatch.setattr(jj, "near_enough", counted)
    got = jj.linked(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, got.collect())) == _brute(rows)
    assert counts[-1] <= 2 * len(rows)  # pairs of the last round, all pairs across components


def test_rounds_with_hubs_bring_a_few_pairs_a_set_and_make_them_once(spark, monkeypatch):
    rows, counts, asked, plain, compare = _spread_copies(), [], [], jj.near_enough, jj.verified

    def counted(pairs, sketches):
        counts.append(pairs.count())
        return plain(pairs, sketches)

    def compared(pairs, docs, known):
        runs = spark.sparkContext.accumulator(0)

        def seen(batches):
            for batch in batches:
                runs.add(batch.num_rows)
                yield batch

        out = compare(pairs.mapInArrow(seen, "a long, b long"), docs, known)
        out.count()
        asked.append((runs.value, pairs.count()))
        return out

    monkeypatch.setattr(jj, "near_enough", counted)
    monkeypatch.setattr(jj, "verified", compared)
    got = jj.linked(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, got.collect())) == _brute(rows)
    assert len(counts) == 3 and max(counts[:2]) <= jj.TRIES * len(rows)
    assert asked[0][1] and all(made == pairs for made, pairs in asked)


def test_linked_sets_share_a_key_that_neither_leaves_out():
    rng = np.random.default_rng(4)
    for size in [5, 12, 40, 100, 300, 900]:
        for _ in range(30):
            a = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            gone = int(rng.integers(0, size // 9 + 1))
            b = np.concatenate([a[gone:], rng.integers(0, 2**63, size // 9 - gone, dtype=np.uint64)])
            if 100 * (size - gone) < 80 * (size + size // 9 - gone):
                continue
            h, o = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
            sizes = np.array([len(a), len(b)])
            keys, owner = jj.block_keys(h, o, sizes)
            spare = jj.spare_keys(h, o, sizes)
            order = {k: rng.random() for k in sorted(set(keys.tolist()))}
            kept = []
            for i in (0, 1):
                mine = [sorted((k for k in keys[owner == i].tolist() if k & 1 == band), key=order.get) for band in (0, 1)]
                kept.append({k for band, ks in enumerate(mine) for k in ks[: len(ks) - int(spare[band][i])]})
            assert kept[0] & kept[1]
            wide = jj.wide_sketches(jj.whole_sketches(h, o, sizes), sizes)
            for band in (0, 1):
                x, y = wide[band].to_pylist()
                if x and y and len(x) == len(y):
                    apart = sum((p ^ q if p ^ q >= 0 else (p ^ q) + 2**64).bit_count() for p, q in zip(x, y, strict=True))
                    assert apart <= (len(a) + len(b)) // 9
