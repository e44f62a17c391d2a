"""Toxicity: the folded machine against a naive kernel, held-out accuracy, hostile rows."""

import random
import tracemalloc
from itertools import accumulate, product

import numpy as np
import pytest

from strata.llm import toxicity as tx

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, toxic string, score string, lang string"


def _naive(word):
    """Subsequences of a word with a start mark, by enumeration."""
    chars = [c for c in tx.classes_of(word) if c not in (0, tx._JOINED)]
    chars = [tx._START, *chars]
    out = {}
    for steps in product(range(1, tx.SKIPS + 2), repeat=tx.P - 1):
        if sum(steps) > tx.P - 1 + tx.SKIPS:
            continue
        for first in range(len(chars) - sum(steps)):
            at = [first, *(first + s for s in accumulate(steps))]
            key = tuple(int(chars[i]) for i in at)
            out[key] = out.get(key, 0.0) + tx.DECAY ** (at[-1] - at[0] - tx.P + 1)
    return out, tx.norm_of(np.array([len(chars)]))[0]


def _kernel(a, b):
    (fa, na), (fb, nb) = _naive(a), _naive(b)
    return sum(v * fb.get(k, 0.0) for k, v in fa.items()) / (na * nb)


def test_kernel_with_landmarks_is_the_subsequence_kernel():
    words = ["stupid", "stxupid", "st.upid", "s t u p i d", "vequta", "chónñ", "of", "a", "thing's", "banana"]
    marks = tx.Landmarks(["stupid", "vequ", "bananas", "chónada"])
    want = [[_kernel(w, m) for m in ("stupid", "vequ", "bananas", "chónada")] for w in words]
    assert np.allclose(marks.kernel(words), want, atol=1e-4)


def test_folded_machine_equals_kernel_expansion():
    rng = np.random.default_rng(0)
    landmarks = ["stupid", "worthless", "lowei", "vequ"]
    marks = tx.Landmarks(landmarks)
    w = rng.normal(size=marks.whiten.shape[1] + 1)
    model = marks.folded(w)
    beta = marks.whiten @ w[:-1]
    texts = ["a stupid  thing", "s t u p i d", "", " \t ", "x y z worth-less", "vequta\nlowei ü", "w" * 300]
    for text, got in zip(texts, model.margins(texts), strict=True):
        words = [x.replace("\x1f", " ") for x in tx._unit_words(text)]
        best = max((sum(b * _kernel(x, m) for b, m in zip(beta, landmarks, strict=True)) for x in words), default=0.0)
        assert got == pytest.approx(best + w[-1], abs=1e-4)


def test_long_texts_score_as_whole_texts(monkeypatch):
    model = tx.Landmarks(["stupid", "worth"]).folded(np.array([2.0, -1.0, 0.1]))
    model.slope, model.shift = 1.0, 0.0
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["s", "t", "stupid", "thing", "a", "worth.", "\n"], k=rng.randrange(1, 400))) for _ in range(30)]
    whole = model.scores(texts)
    monkeypatch.setattr(tx, "CHUNK_CHARS", 40)
    assert np.allclose(model.scores(texts), whole, atol=1e-6)


@pytest.fixture(scope="module")
def medium(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    return docs, labels, tx.train(*tx.labelled_sample(docs, labels))


def test_held_out_accuracy(spark, medium):
    labels = medium[1]
    got = tx.op2_toxicity(spark, MEDIUM).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    assert ((got.score >= 0) & (got.score <= 1)).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert len(got) > 50 and (got.predicted == got.toxic).mean() >= 0.95
    rank = got.score.rank()
    n1, n0 = (got.toxic == 1).sum(), (got.toxic == 0).sum()
    assert (rank[got.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) >= 0.95


def test_insults_with_gaps_and_insertions_stay_toxic(medium):
    model, clean = medium[2], "of the thing that {} and on"
    base = model.margins([clean.format("theering")])[0]
    for word in ("stupid", "worthless", "pathetic", "idiot", "disgusting"):
        plain = model.margins([clean.format(word)])[0]
        for shape in (" ".join(word), ".".join(word), word[:3] + "*" + word[3:], word[:2] + word[1:], word[:3] + "x" + word[3:]):
            got = model.margins([clean.format(shape)])[0]
            assert got > base + 0.25 * (plain - base), (word, shape, got, plain, base)


def test_hostile_rows(spark, medium):
    model = medium[2]
    rows = [(1, None, *"abc"), (2, "", *"abc"), (3, " \n\t", *"abc"), (4, "stupid worthless idiot", *"abc"), (4, "stupid worthless idiot", *"abc")]
    rows += [(None, "x " * 400_000 + "stupid idiot", *"abc"), (6, "\x00🙂 é" * 10, *"abc"), (7, "y" * 700_000, *"abc")]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.s for r in df.select("doc_id", tx.scored(df, model).alias("s")).collect()}
    assert got[1] == got[2] == got[3] < 0.5 and got[4] > 0.5 and got[None] > 0.5 and got[6] < 0.5 and got[7] < 0.5
    labels = medium[1]
    kept = tx.not_toxic(df, labels, documents=medium[0])
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6, 7]


def test_labels_without_two_classes(spark):
    docs = spark.createDataFrame([(1, "stupid", *"abc"), (2, "thing", *"abc")], DOCS)
    for rows in ([], [(1, 1, 1)], [(None, 1, 1), (1, 1, None), (2, 1, 7)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        model = tx.train(*tx.labelled_sample(docs, labels))
        assert [r.s for r in docs.select(tx.scored(docs, model).alias("s")).collect()] == [0.0, 0.0]
    assert tx.not_toxic(docs.limit(0), labels).count() == 0


def test_training_never_sees_held_out_rows_and_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    held = {r.text for r in docs.where(tx.held_out(docs["doc_id"])).collect()}
    free = {r.text for r in docs.where(~tx.held_out(docs["doc_id"])).collect()}
    toxic, clean = tx.labelled_sample(docs, labels)
    assert clean and not ((held - free) & set(toxic + clean))
    assert all(len(x) <= 3 for x in tx.labelled_sample(docs, labels, {1: 3, 0: 3}))


def test_kernel_values_take_little_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=12)) for _ in range(2000)]
    marks = tx.Landmarks(words[: tx.LANDMARKS])
    tracemalloc.start()
    marks.kernel(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
