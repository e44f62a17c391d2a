"""One row of each component of similar texts where ids are null or repeated."""

import random
from collections import Counter

from strata.llm import jaccard_join as jj
from test_jaccard_join import _set

SCHEMA = "doc_id long, text string, note string"


def _near(rng, base, n):
    """Texts that differ from ``base`` in their last word."""
    return [" ".join([*base[:-1], f"z{i}{rng.randrange(99)}"]) for i in range(n)]


def _case():
    rng = random.Random(8)
    base = lambda: [f"w{rng.randrange(10**6)}" for _ in range(60)]
    a, b, c, d, e = (_near(rng, base(), 4) for _ in range(5))
    alone = " ".join(base())
    rows = [(None, a[0]), (7, a[1]), (None, a[2]), (9, a[3])]  # ids before null ids
    rows += [(None, t) for t in b] + [(None, b[0])]  # null ids alone: one stays
    rows += [(20, c[0]), (20, c[1])]  # near-equal texts of one id
    rows += [(30, d[0]), (31, d[1]), (31, alone)]  # a text of its own stays, whatever its id
    rows += [(40, e[0])] * 3 + [(41, e[1])]  # equal rows
    rows += [(None, None), (None, ""), (50, " "), (50, " "), (51, None)]  # no words: all stay
    return [(i, t, "n") for i, t in rows]


def _brute(rows):
    """Components of the rows' texts, as lists of rows."""
    sets = [_set(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for k in range(i):
            if x and 100 * len(x & sets[k]) >= 80 * len(x | sets[k]):
                root[find(i)] = find(k)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    return list(groups.values())


def test_null_and_repeated_ids(spark):
    rows = _case()
    random.Random(1).shuffle(rows)
    kept = [tuple(r) for r in jj.one_of_each(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()]
    assert not Counter(kept) - Counter(rows)
    groups = _brute(rows)
    assert len(kept) == len(groups)
    left = Counter(kept)
    for group in groups:
        ids = [i for i, *_ in group if i is not None]
        best = {r for r in group if r[0] == (min(ids) if ids else None)}
        stayed = [r for r in set(group) if left[r]]
        assert len(stayed) == 1 and stayed[0] in best
    assert jj.one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0
