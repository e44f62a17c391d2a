"""WARC: brute force over hostile payloads, whole-file gzip in, members and sidecars out."""

import io
import base64
import gzip
import hashlib
import random
import zlib

import pytest
from oracle import compare, duck

from strata.llm import warc
from strata.session import work_dir

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, payload string"


def _rows():
    rng = random.Random(7)
    html = [None, "", "\r\n\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "é\x00🙂", "x" * 700_000, "same", "a\nb\r\n"]
    rows = [(i, rng.choice([None, "http://a/b c", "http://x/\r\ny\n"]), rng.choice(html), "clash") for i in range(120)]
    rows += [(500 + i, "http://u", f"page {i}" * 300, None) for i in range(100)]
    return rows + rows[:5] + [(None, "http://n", "same", None), (None, "http://n", "only null id", None)]


def _brute(rows):
    first = {}
    for page, _, html, _ in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        best = first.get(html or "")
        refers = best if best is not None and best != page else None
        out.append((page, len(raw), digest, "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 30)
    monkeypatch.setattr(warc, "PIECE", 1000)
    rows = _rows()
    df = spark.createDataFrame(rows, PAGES)
    mono, target = work_dir(spark, "m"), work_dir(spark, "t")
    warc.write_archives(df, mono)
    files = warc.normalise(spark, mono, target)
    assert files.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc.read_records(spark, target).drop("target_uri").collect()
    assert sorted(map(tuple, got), key=repr) == _brute(rows)
    # Every indexed member inflates alone; all members together are the monolithic stream.
    for name in [r.file for r in files.collect() if r.records]:
        raw = open(f"{target.removeprefix('file://')}/{name}.gz", "rb").read()
        lines = open(f"{target.removeprefix('file://')}/{name}.idx").read().splitlines()
        parts = [zlib.decompress(raw[int(o) : int(o) + int(n)], wbits=31) for o, n, *_ in map(str.split, lines)]
        assert b"".join(parts) == gzip.decompress(raw)
        assert all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") for p in parts)


def test_broken_streams_are_errors():
    whole = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    assert len(list(warc.records(warc.inflated(io.BytesIO(whole + whole))))) == 2
    with pytest.raises(EOFError):
        list(warc.records(warc.inflated(io.BytesIO(whole[:-12]))))
    with pytest.raises(EOFError):
        list(warc.records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))


def test_small_payloads_are_not_revisited(spark):
    rows = [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abc", None), (4, "u", "abc", None)]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES), min_bytes=3).collect()
    assert {r.page_id: r.refers_to for r in got} == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_query(spark):
    ok, why = compare(warc.op6_warc(spark, SMALL), duck(SMALL), warc.OP6_SQL)
    assert ok, why


def test_archives_of_large_pages_are_streamed(spark, monkeypatch):
    """An archive far larger than a piece: what a task asks the store for at a time stays a piece."""
    asked = []

    class Source(io.BytesIO):
        def read(self, n=-1):
            asked.append(n)
            return super().read(n)

    body = b"".join(bytes([i % 251]) * 997 for i in range(3000))
    record = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    source = Source(warc.member(record * 3))
    pieces = list(warc.inflated(source))
    assert max(asked) <= warc.PIECE and max(map(len, pieces)) <= warc.PIECE and b"".join(pieces) == record * 3
    rows = [(i, f"http://x/{i}", chr(97 + i % 26) * 3_000_000) for i in range(6)] + [(9, None, None)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in got) == [*((i, 3_000_000) for i in range(6)), (9, 0)]
