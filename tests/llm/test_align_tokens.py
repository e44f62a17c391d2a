"""Cross-tokenizer alignment against a brute-force version on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from strata.llm import align_tokens as at

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, h1 string, block int, `a.b` string"


@pytest.fixture(scope="module")
def al():
    return at.Aligner(A, B)


def _brute(al, text):
    """(tokens of A, of B, groups, links) of one whole text, by offsets."""
    if not text:
        return None
    spaced = " " + text
    a, b = al.a.encode(spaced, add_special_tokens=False).ids, al.b.encode(text)
    a_bytes, b_bytes = [al.a_bytes[i] for i in a], [al.b_bytes[i] for i in b]
    if b"".join(a_bytes) != spaced.encode() or b"".join(b_bytes) != spaced.encode():
        return None
    a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        hi, hj = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        groups.append(",".join(map(str, a[i:hi])) + "|" + ",".join(map(str, b[j:hj])))
        i, j = hi, hj
    links = []
    for k, (x, end) in enumerate(zip(a_bytes, a_ends, strict=True)):
        for m in range(int(np.searchsorted(b_ends, end - len(x), side="right")), len(b)):
            if b_ends[m] - len(b_bytes[m]) >= end:
                break
            links.append((a[k], b[m]))
    return len(a), len(b), groups, links


def _want(al, rows):
    found = [(d, _brute(al, t)) for d, t in rows]
    counts = Counter(p for _, v in found if v for p in set(v[3]))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for d, v in found:
        if v is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            best, total = sum(counts[p] == top[p[0]] for p in v[3]), sum(counts[p] for p in v[3])
            out.append((d, v[0], v[1], len(v[2]), len(v[3]), best, total, hashlib.sha256(";".join(v[2]).encode()).hexdigest()))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark, al):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = at.op11_align_tokens(spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert _got(got) == _want(al, [tuple(r) for r in docs])


def test_hostile_rows_in_small_blocks(spark, al):
    rng = random.Random(2)
    bits = [*" \n\taé1!２Σß가가🙂▁　", "the", "Thing", "<|endoftext|>", "</s>", "<0x41>", "\x00", "​", "  "]
    texts = [None, "", " ", "  ", "\n", "▁", "a ", " a", "y" * 20_000, "word " * 5_000, "same", "same", "same"]
    texts += ["".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(80)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(3, "x y"), (3, "x y"), (3, "z"), (None, None)]
    docs = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], DOCS)
    assert _got(at.alignment(docs, A, B, block_pairs=40)) == _want(al, rows)


def test_a_text_of_a_third_of_all_rows_counts_by_its_copies(spark, al):
    rows = [(i, "common text of many" if i % 3 == 0 else f"own text {i}") for i in range(90)]
    assert _got(at.alignment(spark.createDataFrame(rows, "doc_id long, text string"), A, B)) == _want(al, rows)


def test_empty_table(spark):
    assert at.alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_words_apart_are_the_whole_text(al, monkeypatch):
    rng = random.Random(1)
    assert al.by_word
    bits = [*" \n\taBéΣß1２!가가ﬁ▁🙂", "́", "<|endoftext|>", "'s", " ", " ", "\x1c", "\x00", "　", "\u0085", "  ", "</s>", "the", "y" * 60, "².", "a.", "b,", "!?", "..."]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 14))) for _ in range(4000)]
    want = [_brute(al, t) for t in texts]
    for words, memory in ((True, at.MEMORY_WORDS), (True, 100), (False, 100)):
        monkeypatch.setattr(at, "MEMORY_WORDS", memory)
        monkeypatch.setattr(al, "by_word", words)
        monkeypatch.setattr(al, "seen", at.Memory())
        for text, v, got in zip(texts, want, al.texts(pa.array(texts)), strict=True):
            assert (v is None) == (got is None), repr(text)
            if got:
                links = Counter(a << at.SHIFT | b for a, b in v[3])
                digest = hashlib.sha256(";".join(v[2]).encode()).hexdigest()
                assert got[:5] == (v[0], v[1], len(v[2]), len(v[3]), digest), repr(text)
                assert dict(zip(got[5].tolist(), got[6].tolist(), strict=True)) == links, repr(text)


def test_words_of_a_few_megabytes_are_held_at_once():
    batch = pa.RecordBatch.from_pydict({"text": ["ab " * 20_000] * 100})  # 6 MB in one Arrow batch
    parts = list(at._stretches(batch))
    assert sum(p.num_rows for p in parts) == 100
    assert max(p.num_rows for p in parts) * 60_000 <= 1 << 21
