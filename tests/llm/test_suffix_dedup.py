"""Suffix-array dedup: planted passages against brute force, clean documents, hostile rows."""

import random
import re

from strata.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, doc string, at string, gram string"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def _brute(rows):
    where = {}
    for doc_id, text, *_ in rows:
        w = _words(text)
        for i in range(len(w) - sd.PASSAGE + 1):
            where.setdefault(tuple(w[i : i + sd.PASSAGE]), set()).add((doc_id, i))
    return {
        (d, k) for places in where.values() if len({d for d, _ in places}) > 1 for d, i in places for k in range(i, i + sd.PASSAGE)
    }


def test_passages_match_brute_force(spark):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    common, rare, own, below = words(80), words(51), words(70), words(49)
    rows = [(i, " ".join(words(rng.randrange(200)) + common + words(rng.randrange(90))), "x", None, "g") for i in range(40)]
    rows += [(100 + i, " ".join(words(30 + i) + rare + words(40)).upper(), None, "a", None) for i in range(2)]
    rows += [(200, " ".join(own + words(9) + own), "", "", ""), (201, " ".join(below + words(60)), "", "", ""), (202, " ".join(words(7) + below), "", "", "")]
    rows += [(300, None, None, None, None), (301, "", None, None, None), (302, " ".join(words(6000)), None, None, None), rows[0]]
    got = sd.repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    covered = {(r.doc_id, k) for r in got for k in range(r.first_word, r.first_word + r.n_words)}
    assert covered == _brute(rows)
    assert not {200, 201, 202, 302} & {r.doc_id for r in got}


def test_null_id_and_empty_table(spark):
    text = " ".join(f"v{i}" for i in range(60))
    got = sd.repeated_passages(spark.createDataFrame([(None, text), (1, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.first_word, r.n_words) for r in got) == [(0, 0, 60), (1, 0, 60)]
    assert sd.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
