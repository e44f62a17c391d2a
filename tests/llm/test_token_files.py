"""Token-id files: round trip against the tokenizer library, coding, hostile rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import token_files as tf
from strata.session import work_dir

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, part int, n string, tie long, `a.b` string"


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, tf.END_ID], dtype="<u4")


def _want(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in rows:
        ids = _ids(tokenizer, text)
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = [tuple(r) for r in tf.op13_token_files(spark, SMALL).orderBy("start").collect()]
    assert got == _want(docs, Tokenizer.from_file(WORDS))


def test_many_files_and_segments_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(tf, "SEGMENT_IDS", 500)
    monkeypatch.setattr(tf, "STRETCH_BYTES", 1_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    folder = work_dir(spark, "token-files")
    files = tf.write_files(docs, WORDS, folder, file_bytes=20_000)
    assert len(files) > 10 and sum(n for _, n, _ in files) == docs.count()
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    got = tf.read_files(spark, folder, files).orderBy("start").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert all(r.ids == _ids(tokenizer, d.text).tobytes() for r, d in zip(got, rows, strict=True))


def test_hostile_rows(spark):
    texts = [None, "", " ", "\n", "é́ Σ <|endoftext|> a", "x" * 30_000, "word " * 20_000, "\x00\x1c", "🙂 가", "a", "a"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "z"), (None, None), (-5, "minus"), (-(2**63), "least"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(*r, 1, "n", 2, "c") for r in rows], DOCS)
    folder = work_dir(spark, "token-files")
    files = tf.write_files(docs, WORDS, folder, file_bytes=9_000)
    got = tf.read_files(spark, folder, files).orderBy("start").collect()
    low = -(2**63)
    ids = [low if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and got[0].doc_id is None
    tokenizer = Tokenizer.from_file(WORDS)
    want = sorted((d is None, d or 0, _ids(tokenizer, t).tobytes()) for d, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in got) == want
    starts = np.cumsum([0, *(r.n_tokens for r in got)])
    assert [r.start for r in got] == starts[:-1].tolist()


def test_one_id_of_a_third_of_all_rows_is_dealt_out(spark):
    rows = [(None, f"text {i} " * 20) for i in range(300)] + [(i, f"other {i} " * 20) for i in range(600)]
    folder = work_dir(spark, "token-files")
    files = tf.write_files(spark.createDataFrame(rows, "doc_id long, text string"), WORDS, folder, file_bytes=9_000)
    assert max(n for _, n, _ in files) < 250 and sum(n for _, n, _ in files) == 900
    got = tf.read_files(spark, folder, files).orderBy("start").collect()
    assert [r.doc_id for r in got[:300]] == [None] * 300 and [r.doc_id for r in got[300:]] == list(range(600))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = work_dir(spark, "token-files")
    files = tf.write_files(docs, WORDS, folder)
    assert files == [] and tf.read_files(spark, folder, files).collect() == []


@pytest.mark.parametrize("top", [200, 70_000, 1 << 31])
def test_coding_round_trip(top):
    rng = np.random.default_rng(top)
    sizes = np.array([1, 0, 3, 4, 5, 0, 1000, 2])
    ranks = rng.integers(0, top, sizes.sum()).astype(np.uint32)
    control, data = tf.packed(ranks, sizes)
    assert len(control) == (-(-sizes // 4)).sum()
    assert (tf.unpacked(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), sizes) == ranks).all()


def _encoded(e, texts):
    ids, sizes = e.ids(pa.array([t or "" for t in texts], pa.string()))
    return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_ids_are_those_of_the_library(monkeypatch):
    rng, tokenizer, e = random.Random(1), Tokenizer.from_file(WORDS), tf.Encoder(WORDS, tf.END_ID)
    assert e.words is not None and not tf._cuts_words(public_tokenizers.path("byte_bpe_50k.json"))
    hostile = [*" \n\taA1!２éÉΣßﬁ가가İŉ🙂", "́", "'s", "'LL", " ", "\x1c", "\x00", "\u0085", "  ", "</w>", "y" * 60, "²."]
    plain = [*"abBÉéßöøØŒœŁžĳŸſ÷×0 '.!?<|", "’", "…", "ll", "  ", "\n", "Word", "'re", "</w>"]
    for bits in (hostile, [*hostile, "<|endoftext|>", "<|ENDOFTEXT|>"], plain):
        texts = ["".join(rng.choices(bits, k=rng.randrange(0, 14))) for _ in range(5000)] + [None, "", "w" * 3000]
        assert _encoded(e, texts) == [_ids(tokenizer, t).tobytes() for t in texts]
    # every letter that counts as plain
    letters = [chr(c) for c in range(32, 0x2030) if not tf._NOT_PLAIN.search(chr(c))]
    texts = [f"{x}a b{x}c {x} {x}{x}. 1{x}" for x in letters]
    assert len(letters) > 300 and _encoded(e, texts) == [_ids(tokenizer, t).tobytes() for t in texts]
    e.words = None
    assert _encoded(e, texts) == [_ids(tokenizer, t).tobytes() for t in texts]
