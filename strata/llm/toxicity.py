"""Toxicity by a subsequence string kernel, a support vector machine and Nyström landmarks.

The kernel compares two words by their common subsequences of ``P`` characters;
a subsequence counts ``DECAY`` for every character that it skips, at most
``SKIPS`` of them, so an insult still matches itself with gaps or inserted
characters (``stxuupid``).  Separators inside a word (``id-i.ot``) are skipped
at no charge, and runs of single characters (``i d i o t``) are one word.  A
word starts with a mark, so prefixes count.  Kernel values are divided
by a length norm.

The machine is trained on labelled texts through their words, as in
multiple-instance learning: a clean text's words are all clean, of a toxic text
only some are toxic.  Words and stems (first four to nine letters) that lean to
toxic texts by their odds give the first positive examples; a stem counts once
for every different word of a text that has it, so an insult that is inflected or
glued to other syllables shows in few texts already.  Training then alternates:
the best words of toxic texts that score above what clean texts reach are added as
positive examples, the highest-scoring words of clean texts as negative ones.
Positive examples are also shown with characters inserted.  Words are mapped to
their kernel values with ``LANDMARKS`` landmark words and whitened by the landmarks'
own kernel matrix (Nyström); the machine is linear there, with squared hinge
loss.  A text is judged by its ``TOP`` best words together, since a clean text may
hold one word that resembles an insult by chance: a logistic curve over their
margins, fitted to the labelled texts, gives the score.  An insult split into
pieces of several characters (``stu pid``) or made of words that clean texts use
too is not found.

As the machine is linear in the kernel values with the landmarks, and each of
these is linear in a word's subsequences, the whole machine folds into one
weight per subsequence.  Scoring is a map over the rows with table look-ups in
numpy: no shuffle, and whole texts.

Bounds of the fit (parameters): ``SAMPLE`` labelled documents by class, those
of smallest hash, with at most ``SAMPLE_CHARS`` characters each and ``SAMPLE_TOTAL`` by
class together.  The fit is one task over this sample; the driver gets the
folded weights alone.

Edge cases: null and blank texts have no words and get the score of words
without any known subsequence; without labels of both classes every score is
exactly 0; contradictory labels of a document count as toxic, null labels are left out;
a null ``doc_id`` counts as held out; repeated rows get equal scores.
"""

from __future__ import annotations

import os
import pickle
import re
import subprocess
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table

P = 4
SKIPS = 3
DECAY = 0.8
NORM_CHARS = 8  # the length norm stops growing here
LANDMARKS = 256
SAMPLE = {1: 2000, 0: 5000}
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = {1: 4_000_000, 0: 8_000_000}
ROUNDS = 4
# Best words of a text that its score weighs.
TOP = 3
# Letters of a stem, and the words of one text that a stem may count.
STEM = range(4, 10)
STEM_WORDS = 4
# A word is a positive example from this odds ratio, and from this log odds times root of its count.
CLEAR = 10.0
COST = 8.0
CHUNK_CHARS = 1 << 17
# Words whose kernel values are worked out at a time, a row of landmarks for each of their subsequences.
STRETCH = 64

# Character classes: 0 white space, 1-26 letters, 27 digits, 28 separators
# (other ASCII, blanks between single characters), 29-38 other characters by code point, 39 start of a word.
CLASSES = 40
_JOINED, _START = 28, 39
# Steps between the characters of a subsequence.
STEPS = [
    (a, b, c) for a in range(1, SKIPS + 2) for b in range(1, SKIPS + 2) for c in range(1, SKIPS + 2) if a + b + c <= P - 1 + SKIPS
]


def _class_table() -> np.ndarray:
    out = np.zeros(1 << 16, dtype=np.uint8)
    for code in range(1 << 16):
        ch = chr(code).lower()[:1] or chr(code)
        if "a" <= ch <= "z":
            out[code] = ord(ch) - 96
        elif ch.isspace():
            out[code] = 0
        elif code < 128:
            out[code] = 27 if ch.isdigit() else 28
        else:
            out[code] = 29 + ord(ch) % 10
    return out


_TABLE: list[np.ndarray] = []


def classes_of(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_class_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _TABLE[0][points & 0xFFFF]


@dataclass
class Units:
    """Words of several texts: classes per character, first character, owner."""

    codes: np.ndarray  # int32, the mark of a word at its first place
    unit: np.ndarray  # word number per character
    first: np.ndarray  # place of each word's mark
    size: np.ndarray  # characters of each word, mark included
    text: np.ndarray  # text number of each word


def units_of(texts: list[str]) -> Units:
    """Words of the texts; a blank between two single characters joins them."""
    codes = classes_of(" " + " ".join(texts)).astype(np.int32)
    begins = np.zeros(len(texts), dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=begins[1:])
    space = codes == 0
    left = np.concatenate([[True], space[:-1]])
    right = np.concatenate([space[1:], [True]])
    starts, ends = np.flatnonzero(~space & left), np.flatnonzero(~space & right) + 1
    if len(starts) > 1:
        single = ends - starts == 1
        join = single[:-1] & single[1:] & (starts[1:] - ends[:-1] == 1)
        blanks = ends[:-1][join]
        blanks = blanks[~np.isin(blanks, begins)]
        codes[blanks] = _JOINED
        gone = np.isin(starts, blanks + 1)
        keep_end = ~np.isin(ends, blanks)
        starts, ends = starts[~gone], ends[keep_end]
    marks = starts - 1
    codes[marks] = _START
    # Separators inside and around words are skipped at no charge.
    stays = codes != _JOINED
    moved = np.cumsum(stays) - 1
    codes, marks, ends, begins = codes[stays], moved[marks], moved[ends - 1] + 1, moved[begins]
    number = np.zeros(len(codes), dtype=np.int32)
    number[marks] = 1
    return Units(codes, np.cumsum(number), marks, ends - marks, np.searchsorted(begins, marks, side="right") - 1)


def _norms() -> np.ndarray:
    """Length norm: root of the squared weights of all subsequences of a word."""
    out = np.ones(NORM_CHARS + 1)
    for n in range(P, NORM_CHARS + 1):
        out[n] = np.sqrt(sum(max(0, n - sum(s)) * DECAY ** (2 * (sum(s) - P + 1)) for s in STEPS))
    return out


NORMS = _norms()


def norm_of(size: np.ndarray) -> np.ndarray:
    return NORMS[np.minimum(size, NORM_CHARS)]


def _places(u: Units) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(subsequence code, inside one word, weight) per place, for each step triple."""
    n = len(u.codes)
    pair = {d: u.codes[: n - d] * CLASSES + u.codes[d:] for d in range(1, SKIPS + 2) if n > d}
    high = {d: p * (CLASSES * CLASSES) for d, p in pair.items()}
    for a, b, c in STEPS:
        m = n - a - b - c
        if m > 0:
            yield high[a][:m] + pair[c][a + b : a + b + m], u.unit[:m] == u.unit[a + b + c :], DECAY ** (a + b + c - P + 1)


def occurrences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence, weight) of words, each taken as one unit."""
    u = units_of(words)
    owners, codes, weights = [], [], []
    for code, inside, weight in _places(u):
        rest = code % CLASSES**3  # the mark may only come first, white space never
        ok = inside & (code >= CLASSES**3) & (rest >= CLASSES**2) & (rest % CLASSES**2 >= CLASSES) & (rest % CLASSES > 0)
        at = np.flatnonzero(ok)
        unit = u.unit[at] - 1
        owners.append(u.text[unit])
        codes.append(code[at])
        weights.append(weight / norm_of(u.size[unit]))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return owner[order], np.concatenate(codes)[order], np.concatenate(weights)[order].astype(np.float32)


@dataclass
class Model:
    """The folded machine: a weight per subsequence, a bias, a logistic curve."""

    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))
    bias: float = 0.0
    slope: float = 0.0  # 0: no labels of both classes, every score is 0
    shift: float = 0.0
    share: tuple[float, ...] = (1.0, 0.0, 0.0)  # weight of the best word, the second best, ..
    _dense: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "_dense": None}

    def dense(self) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros(CLASSES**P, dtype=np.float32)
            self._dense[self.codes] = self.weights
        return self._dense

    def word_margins(self, u: Units) -> np.ndarray:
        sums = np.zeros(len(u.codes), dtype=np.float32)
        dense = self.dense()
        for code, inside, weight in _places(u):
            got = dense[code]
            got *= inside
            got *= np.float32(weight)
            sums[: len(got)] += got
        if not len(u.first):
            return np.zeros(0)
        return np.add.reduceat(sums, u.first) / norm_of(u.size) + self.bias

    def margins(self, texts: list[str]) -> np.ndarray:
        """The best word of each text; a text without words has the bias alone."""
        out = np.full(len(texts), self.bias)
        for lo, hi in _runs(texts):
            u = units_of(texts[lo:hi])
            if len(u.first):
                owners, at = np.unique(u.text, return_index=True)
                out[lo + owners] = np.maximum.reduceat(self.word_margins(u), at)
        return out

    def tops(self, texts: list[str]) -> np.ndarray:
        """The margins of the ``TOP`` best words of each text; missing words have the bias alone."""
        out = np.full((len(texts), TOP), self.bias)
        for lo, hi in _runs(texts):
            u = units_of(texts[lo:hi])
            if len(u.first):
                margins = self.word_margins(u)
                order = np.lexsort((-margins, u.text))
                owner = u.text[order]
                first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                place = np.arange(len(owner)) - np.repeat(first, np.diff([*first, len(owner)]))
                best = place < TOP
                out[lo + owner[best], place[best]] = margins[order][best]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.slope == 0:
            return np.zeros(len(texts))
        tops = np.empty((len(texts), TOP))
        short = [i for i, t in enumerate(texts) if len(t) <= CHUNK_CHARS]
        tops[short] = self.tops([texts[i] for i in short])
        for i, t in enumerate(texts):
            if len(t) > CHUNK_CHARS:
                tops[i] = -np.sort(-np.concatenate([self.tops([piece])[0] for piece in pieces_of(t)]))[:TOP]
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (tops @ np.array(self.share)) + self.shift, -700, 700)))


_CUT = re.compile(r"\S\S\s")


def pieces_of(text: str) -> list[str]:
    """A long text cut behind words of two characters and more, so that no unit is torn."""
    out, lo = [], 0
    while len(text) - lo > CHUNK_CHARS:
        hit = _CUT.search(text, lo + CHUNK_CHARS)
        if not hit:
            break
        out.append(text[lo : hit.end()])
        lo = hit.end()
    return [*out, text[lo:]]


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > CHUNK_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


# ---------------------------------------------------------------------------
# training (on the driver, over the bounded sample)


def _unit_words(text: str) -> list[str]:
    """The words of one text as strings, split as ``units_of`` splits them."""
    joined = re.sub(r"(?:(?<=\s)|^)(\S)\s(?=\S(?:\s|$))", "\\1\x1f", text.replace("\x1f", " "))
    return re.findall(r"[\S\x1f]+", joined)


def _stems(words: list[str]) -> Counter:
    """How many of the words have each stem; a word is its own stem."""
    out = Counter()
    for word in words:
        plain = word.strip(".,;:!?|()[]\"'")
        if len(plain) >= STEM[0]:
            out.update({plain, *(plain[:k] for k in STEM if k < len(plain))})
    return out


def inserted(word: str) -> list[str]:
    """Variants of an insult: blanks between all letters, a letter struck out, doubled or put in."""
    word = word.replace("\x1f", "")
    half = (len(word) + 1) // 2
    head, tail = word[:half], word[half:]
    return [" ".join(word), head[:-1] + "*" + tail, head + head[-1:] + tail, head + "x" + tail, word[:1] + "x" + word[1:]]


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared hinge, primal Newton; the last column of ``z`` is the bias.

    ``z`` is in single precision; sums over it are taken in double precision, a stretch of rows at a time.
    """
    d = z.shape[1]
    w = np.zeros(d)
    ridge = np.ones(d)
    ridge[-1] = 1e-3
    stretches = [slice(lo, lo + 2048) for lo in range(0, len(z), 2048)]

    def slack_of(v: np.ndarray) -> np.ndarray:
        return 1 - y * np.concatenate([z[at].astype(float) @ v for at in stretches])

    def loss(v: np.ndarray, slack: np.ndarray) -> float:
        return 0.5 * float(ridge @ (v * v)) + COST * float(weight @ np.maximum(0, slack) ** 2)

    slack = slack_of(w)
    now = loss(w, slack)
    for _ in range(40):
        grad, hess = ridge * w, np.diag(ridge)
        for at in stretches:
            on = slack[at] > 0
            za, ca = z[at][on].astype(float), weight[at][on]
            grad -= 2 * COST * za.T @ (ca * y[at][on] * slack[at][on])
            hess += 2 * COST * (za * ca[:, None]).T @ za
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while (after := loss(w - size * step, slack := slack_of(w - size * step))) > now and size > 1e-4:
            size /= 2
        if now - after < 1e-7 * now:
            break
        w, now = w - size * step, after
    return w


class Landmarks:
    """Nyström map of words: kernel values with the landmarks, whitened."""

    def __init__(self, words: list[str]):
        owner, codes, weights = occurrences(words)
        self.codes, row = np.unique(codes, return_inverse=True)
        self.matrix = np.zeros((len(self.codes), len(words)), dtype=np.float32)
        np.add.at(self.matrix, (row, owner), weights)
        kernel = (self.matrix.T @ self.matrix).astype(float)
        values, vectors = np.linalg.eigh(kernel)
        keep = values > 1e-6 * values[-1]
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel values (words x landmarks)."""
        out = np.zeros((len(words), self.matrix.shape[1]), dtype=np.float32)
        for lo in range(0, len(words), STRETCH):
            owner, codes, weights = occurrences(words[lo : lo + STRETCH])
            at = np.searchsorted(self.codes, codes)
            at[at == len(self.codes)] = 0
            known = self.codes[at] == codes
            owner, at, weights = owner[known], at[known], weights[known]
            if len(owner):
                first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                out[lo + owner[first]] = np.add.reduceat(self.matrix[at] * weights[:, None], first, axis=0)
        return out

    def map(self, words: list[str]) -> np.ndarray:
        out = np.ones((len(words), self.whiten.shape[1] + 1), dtype=np.float32)
        for lo in range(0, len(words), 2048):
            out[lo : lo + 2048, :-1] = self.kernel(words[lo : lo + 2048]) @ self.whiten
        return out

    def folded(self, w: np.ndarray) -> Model:
        return Model(self.codes.astype(np.int32), (self.matrix @ (self.whiten @ w[:-1])).astype(np.float32), float(w[-1]))


def _words_of(texts: list[str]) -> list[list[str]]:
    """The different words of each text; equal words are one object."""
    return [[sys.intern(w) for w in sorted(set(_unit_words(t.lower())))] for t in texts]


def _leaning(toxic_words: list[list[str]], clean_words: list[list[str]]) -> tuple[dict[str, float], set[str], list[str]]:
    """(strength, clear ones, best ones) of words and stems by their odds between the classes."""
    counts, wanted = [], None
    for group in (toxic_words, clean_words):
        total = Counter()
        for words in group:
            total.update({stem: min(n, STEM_WORDS) for stem, n in _stems(words).items() if wanted is None or stem in wanted})
        counts.append(total)
        if wanted is None:
            wanted = {stem for stem, n in total.items() if n > 1}
    toxic, clean = counts
    lean = {
        x: np.log((toxic[x] + 0.2) / (len(toxic_words) + 1)) - np.log((clean[x] + 0.2) / (len(clean_words) + 1)) for x in wanted
    }
    strength = {x: v * np.sqrt(toxic[x]) for x, v in lean.items()}
    clear = {x for x, v in strength.items() if v > CLEAR and lean[x] > np.log(CLEAR)}
    # Of a word and its stems that are equally strong, the longest.
    best, covered = [], set()
    for x in sorted(strength, key=lambda x: (-round(strength[x], 6), -len(x), x)):
        if x not in covered:
            best.append(x)
            covered.update(x[:k] for k in STEM)
        if len(best) >= LANDMARKS:
            break
    return strength, clear, best


def train(toxic: list[str], clean: list[str], rounds: int = ROUNDS) -> Model:
    """Fit the machine to whole texts of toxic and of clean documents."""
    if not toxic or not clean:
        return Model()
    toxic_words, clean_words = _words_of(toxic), _words_of(clean)
    strength, clear, best = _leaning(toxic_words, clean_words)
    in_clean = Counter(w for ws in clean_words for w in ws)
    del clean_words
    has_clear = {w: any(x in clear for x in _stems([w])) for ws in toxic_words for w in ws}
    frequent = [w for w, _ in sorted(in_clean.items(), key=lambda x: (-x[1], x[0])) if len(w) + 1 >= P]
    words = list(dict.fromkeys([*best[: LANDMARKS * 3 // 4], *frequent[: LANDMARKS // 4]]))
    if not words:
        return Model()
    marks = Landmarks(words)

    # First round: the words that clearly lean to toxic texts (the strongest one where
    # none does); frequent clean words against them.
    positive = Counter()
    for ws in toxic_words:
        strongest = [max(ws, key=lambda w: (strength.get(w, 0.0), w))] if ws else []
        positive.update([w for w in ws if has_clear[w]] or strongest)
    # A clean text may hold a clear word by chance; how many it holds tells.
    vocabulary = [w for w in sorted(in_clean) if not any(x in clear for x in _stems([w]))]
    negative = dict.fromkeys([*(w for w in frequent[:4000] if not has_clear.get(w)), *vocabulary[:: max(1, len(vocabulary) // 4000)]])
    model = Model()
    for turn in range(rounds):
        pos = list(positive)
        shown = [v for w in pos for v in inserted(w)]
        neg = [w for w in negative if w not in positive]
        y = np.concatenate([np.ones(len(pos) + len(shown)), -np.ones(len(neg))])
        # An example weighs as many documents as it explains, its variants a share of that.
        count = np.array([positive[w] for w in pos], dtype=float) / 10
        weight = np.concatenate([count, np.repeat(count, len(shown) // max(1, len(pos))) * 0.2, np.full(len(neg), 1.0)])
        model = marks.folded(_svm(marks.map([*pos, *shown, *neg]), y, weight))
        if turn == rounds - 1:
            break
        # Highest-scoring words of the clean texts become negative examples.
        margins = _word_margins(model, vocabulary)
        for i in np.argsort(-margins, kind="stable")[:2000]:
            negative[vocabulary[i]] = None
        # The best words of each toxic text become positive ones if no clean word reaches them.
        bound = max(0.0, np.quantile(margins, 0.9999)) if len(margins) else 0.0
        positive = Counter()
        for ws in toxic_words:
            positive.update(w for w in ws if has_clear[w])
            if ws:
                m = _word_margins(model, ws)
                for i in np.argsort(-m, kind="stable")[:4]:
                    if not has_clear[ws[i]] and m[i] > bound:
                        positive[ws[i]] += 1
        if not positive:
            break
    model.slope, model.shift, model.share = _logistic(model.tops(toxic), model.tops(clean))
    return model


def _word_margins(model: Model, words: list[str]) -> np.ndarray:
    """Margins of single words (joined ones count as the unit they are)."""
    return model.margins([w.replace("\x1f", " ") for w in words])


def _logistic(pos: np.ndarray, neg: np.ndarray) -> tuple[float, float, tuple[float, ...]]:
    """Slope, shift and shares of the score curve (Platt's smoothed targets, Newton steps).

    A better word never lowers a score: a share below 0 is left out and the rest fitted again.
    """
    t = np.concatenate([np.full(len(pos), (len(pos) + 1) / (len(pos) + 2)), np.full(len(neg), 1 / (len(neg) + 2))])
    weight = np.concatenate([np.full(len(pos), 0.5 / len(pos)), np.full(len(neg), 0.5 / len(neg))]) * len(t)
    used = list(range(pos.shape[1]))
    while True:
        design = np.concatenate([np.concatenate([pos, neg])[:, used], np.ones((len(t), 1))], axis=1)
        ridge = np.array([*[0.1] * len(used), 1e-3])
        w = np.array([*[1.0 / len(used)] * len(used), 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            grad = design.T @ (weight * (p - t)) + ridge * w
            hess = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
            step = np.linalg.solve(hess, grad)
            w -= np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        if w[:-1].min() >= 0 or len(used) == 1:
            break
        used.pop(int(np.argmin(w[:-1])))
    slope = float(max(w[:-1].sum(), 1e-6))
    share = np.zeros(pos.shape[1])
    share[used] = np.maximum(w[:-1], 0) / slope
    return slope, float(w[-1]), tuple(share.tolist())


# ---------------------------------------------------------------------------
# Spark


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample_rows(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> DataFrame:
    """(doc_id, toxic, text): whole texts of at most ``sample`` training documents of each class.

    The ids are drawn from the labels alone, by hash; only their documents are
    fetched, by a broadcast of these bounded ids.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    draw = F.xxhash64(F.lit(11), "doc_id")
    ids = known.where("toxic = 1").orderBy(draw, "doc_id").limit(sample[1]).unionByName(
        known.where("toxic = 0").orderBy(draw, "doc_id").limit(sample[0])
    )
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .where((F.length("text") <= SAMPLE_CHARS) & (F.length("text") > 0))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))
    )
    so_far = Window.partitionBy("toxic").orderBy(draw, "doc_id")
    total = F.when(F.col("toxic") == 1, SAMPLE_TOTAL[1]).otherwise(SAMPLE_TOTAL[0])
    return texts.withColumn("chars", F.sum(F.length("text")).over(so_far)).where(F.col("chars") <= total).drop("chars")


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> tuple[list[str], list[str]]:
    """The texts of ``sample_rows``: toxic ones, clean ones."""
    rows = sample_rows(docs, labels, sample).orderBy("doc_id").collect()
    return [r.text for r in rows if r.toxic == 1], [r.text for r in rows if r.toxic == 0]


_FIT = "import pickle, sys; from strata.llm.toxicity import train; sys.stdout.buffer.write(pickle.dumps(train(*pickle.load(sys.stdin.buffer))))"


def _apart(toxic: list[str], clean: list[str]) -> bytes:
    """The pickled machine, fitted in a process of its own: Spark keeps a worker for later
    tasks, and with it whatever memory the fit took."""
    env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
    done = subprocess.run([sys.executable, "-c", _FIT], input=pickle.dumps((toxic, clean)), stdout=subprocess.PIPE, env=env, check=True)
    return done.stdout


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The machine trained by one task over the bounded sample."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, list[str]] = {0: [], 1: []}
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                texts[toxic].append(text)
        pa.default_memory_pool().release_unused()
        model = _apart(texts[1], texts[0])
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    rows = sample_rows(docs, labels).repartition(1).sortWithinPartitions("doc_id")
    got = rows.mapInArrow(fit, "model binary").collect()
    return pickle.loads(got[0].model) if got else Model()


def scored(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A score column for the whole texts of ``docs``."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist()), dtype="float64")

    return F.pandas_udf(score, "double")(F.coalesce(F.col(text), F.lit("")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    return (
        docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(docs, model).alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def not_toxic(docs: DataFrame, labels: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` scored below one half, all columns as they were."""
    model = fitted(docs if documents is None else documents, labels)
    return docs.where(scored(docs, model) < 0.5)
