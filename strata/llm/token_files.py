"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

A file is a sequence of segments of about ``SEGMENT_IDS`` ids.  A segment ranks its
ids by falling frequency, so its 256 most frequent ones take one byte, the next
ones two, and so on.  Lengths stand apart from the bytes: a control byte holds
the lengths (two bits each) of four ids, and control bytes come before data bytes.
A segment is decoded without a loop over ids: a table gives the four lengths of
each control byte, their running sum the place of each id's bytes, and the segment's
rank table turns ranks back into ids.

Files (numbers little endian): ``part-NNNNN.ids`` holds its segments, then one
index row per segment (offset, first document, documents, ids before the segment: 64
bits each), then the number of segments (64 bits) and ``MAGIC``.  A segment:
documents, ranks, control bytes, data bytes (64 bits each); per document its id (64
bits), whether it has one (8 bits) and its number of token ids (64 bits); the id of
each rank (32 bits); control bytes (each document starts a new one); data bytes.

Documents are range-partitioned by ``doc_id`` and text hash, a partition is a file
and lies sorted in it; texts are shuffled once and tokenised once.  Files are written
under a name of the task attempt and then moved, so a repeated task replaces its own
file.  The driver sees one row per file.

Tokenizing: a text of lower- and upper-case Latin letters, ASCII and common punctuation is cut
by the tokenizer's own pattern, and its words are merged by ``tiktoken`` over the
same vocabulary, in which a zero byte stands for the end of a word; every other
text, and one with a very long word, goes through the ``tokenizers`` library whole.
``Encoder`` checks that the tokenizer's file is of this kind (lower case, white space
dropped, marked word ends) and gives all texts to the library otherwise.

Edge cases: null and empty texts have the end id alone; a null ``doc_id`` comes
first; rows that repeat a ``doc_id`` are ordered by text hash, equal rows lie side by
side; one long document is one segment; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe_count import _byte_symbols
from strata.llm.common import steps, table, text_buffers, written
from strata.llm.warc import _opened
from strata.session import work_dir

END_ID = 2
# Text bytes of a file, about, and token ids of a segment.
FILE_BYTES = 1 << 25
SEGMENT_IDS = 1 << 21
MAGIC = b"RANKIDS1"
# Bytes of texts encoded before a segment may be closed.
STRETCH_BYTES = 1 << 21
# Longer words are left to the library.
WORD_CHARS = 1000
# How the vocabulary marks the last token of a word.
WORD_END = "</w>"
# The split pattern of the word tokenizer (public; fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for lower-cased texts of letters up to U+017F that lower-casing and normalisation treat one by one.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿĀ-ſ]+|[0-9]|[^\sa-zß-öø-ÿĀ-ſ0-9]+")
_NOT_PLAIN = re.compile(r"[^\t\n\r -~À-ÖØ-öø-įĲ-ňŊ-ſ‐-‧]|<\|")

LENGTHS = np.stack([(np.arange(256) >> (2 * k) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)


# ---------------------------------------------------------------------------
# tokenizing


class Encoder:
    """Ids of whole texts as the library gives them, without special tokens added."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.end_id = end_id
        self.words = word_encoding(self.library) if _cuts_words(path) else None

    def _ids(self, text: str) -> list[int]:
        if not text:
            return []
        if self.words is not None and not _NOT_PLAIN.search(text):
            words = _WORDS.findall(text.lower())
            if max(map(len, words), default=0) <= WORD_CHARS:
                return self.words.encode_ordinary("\0".join(words) + "\0") if words else []
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all texts, each with the end id; ids of each text)."""
        out, sizes = [], []
        for text in texts.to_pylist():
            found = self._ids(text)
            out += found
            out.append(self.end_id)
            sizes.append(len(found) + 1)
        return np.array(out, dtype="<u4"), np.array(sizes, dtype=np.int64)


def word_encoding(library):
    """The vocabulary as merge ranks over bytes, a zero byte behind the last letter of a word."""
    import tiktoken

    byte = {s: i for i, s in enumerate(_byte_symbols())}
    ranks = {}
    for token, i in library.get_vocab(with_added_tokens=False).items():
        end = token.endswith(WORD_END)
        ranks[bytes(byte[c] for c in token.removesuffix(WORD_END)) + b"\0" * end] = i
    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})


def _cuts_words(path: str) -> bool:
    """Whether the tokenizer lower-cases, cuts by ``PATTERN`` and marks word ends, and added tokens are of the form ``<|..``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    splits = [s for s in steps if s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")]
    plain = [s for s in steps if s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex")]
    normal = {s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])} == {"NFC", "Replace", "Lowercase"}
    added = all(t["content"].startswith("<|") for t in spec.get("added_tokens", []))
    words = spec["model"]["type"] == "BPE" and spec["model"].get("end_of_word_suffix") == WORD_END
    return len(steps) == 2 and len(splits) == 1 and len(plain) == 1 and splits[0]["pattern"]["Regex"] == PATTERN and normal and added and words


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One encoder per vocabulary file and Python worker."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


# ---------------------------------------------------------------------------
# coding


def packed(ranks: np.ndarray, sizes: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of a segment."""
    length = np.ones(len(ranks), dtype=np.uint8)
    for bound in (0xFF, 0xFFFF, 0xFFFFFF):
        length += ranks > bound
    at = np.cumsum(length, dtype=np.int64) - length
    data = np.empty(int(length.sum(dtype=np.int64)), dtype=np.uint8)
    data[at] = ranks & 0xFF
    for k in range(1, int(length.max(initial=1))):
        more = np.flatnonzero(length > k)
        data[at[more] + k] = ranks[more] >> np.uint32(8 * k) & 0xFF
    controls = -(-sizes // 4)
    lanes = np.zeros(int(controls.sum()) * 4, dtype=np.uint8)
    lanes[_lanes(sizes, controls)] = length - 1
    control = (lanes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), data.tobytes()


def _lanes(sizes: np.ndarray, controls: np.ndarray) -> np.ndarray:
    """The lane of each id: documents start on a control byte."""
    ends = np.cumsum(sizes)
    shift = (np.cumsum(controls) - controls) * 4 - (ends - sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(shift, sizes)


def unpacked(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranks of a segment's documents, by table look-ups."""
    length = LENGTHS[control].ravel()[_lanes(sizes, -(-sizes // 4))].astype(np.int64)
    at = np.cumsum(length) - length
    out = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(length > k)
        if len(more):
            out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# ---------------------------------------------------------------------------
# Spark


def segment_of(doc: np.ndarray, has: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one segment."""
    count = np.bincount(ids)
    id_of = np.argsort(-count, kind="stable")[: np.count_nonzero(count)].astype("<u4")
    rank_of = np.zeros(len(count), dtype=np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    control, data = packed(rank_of[ids], sizes)
    head = np.array([len(doc), len(id_of), len(control), len(data)], dtype="<i8")
    parts = (head, doc.astype("<i8"), has.astype("u1"), sizes.astype("<i8"), id_of)
    return b"".join([*(x.tobytes() for x in parts), control, data])


def write_files(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> list[tuple[int, int, int]]:
    """Encode all texts into ``folder``; (file number, documents, ids) of each file, in order."""
    spark = docs.sparkSession
    parts = 1 + (docs.agg(F.sum(F.octet_length("text") + F.lit(1))).first()[0] or 0) // file_bytes

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, base = _opened(folder)
        store.create_dir(base, recursive=True)
        e, out, block, held, index = encoder(path, end_id), None, [], 0, []
        draft, offset, documents, total = f"{base}/.part-{part:05d}.{attempt}", 0, 0, 0

        def flush() -> None:
            nonlocal out, offset, documents, total, block, held
            if not block:
                return
            out = out or store.open_output_stream(draft)
            doc, has, sizes, ids = (np.concatenate(x) for x in zip(*block, strict=True))
            raw = segment_of(doc, has, sizes, ids)
            out.write(raw)
            index.append((offset, documents, len(doc), total))
            offset, documents, total = offset + len(raw), documents + len(doc), total + held
            block, held = [], 0

        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            for lo, hi in steps(offsets, STRETCH_BYTES):
                doc = batch.column("doc_id").slice(lo, hi - lo)
                ids, sizes = e.ids(batch.column("text").slice(lo, hi - lo))
                block.append((doc.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(doc.is_valid()), sizes, ids))
                held += len(ids)
                if held >= SEGMENT_IDS:
                    flush()
        flush()
        if out is None:
            return
        out.write(np.array(index, dtype="<i8").tobytes() + np.array([len(index)], dtype="<i8").tobytes() + MAGIC)
        out.close()
        store.move(draft, f"{base}/part-{part:05d}.ids")
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, documents, total)], names=["part", "documents", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    files = written(dealt.select("doc_id", "text").mapInArrow(write, "part long, documents long, ids long"), "token-file-list")
    return [(r.part, r.documents, r.ids) for r in files.orderBy("part").collect()]  # one row per file


def segments_of(store, base: str, part: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(document ids, whether they have one, ids per document, ids, ids before) of a file's segments."""
    with store.open_input_file(f"{base}/part-{part:05d}.ids") as source:

        def numbers(n: int, dtype: str) -> np.ndarray:
            return np.frombuffer(source.read(n * np.dtype(dtype).itemsize), dtype=dtype)

        end = source.size()
        source.seek(end - 16)
        segments = int(numbers(1, "<i8")[0])
        if source.read(8) != MAGIC:
            raise ValueError(f"part {part}: no file of ranked ids")
        source.seek(end - 16 - 32 * segments)
        for offset, _, docs, before in numbers(4 * segments, "<i8").reshape(-1, 4).tolist():
            source.seek(offset)
            n, ranks, control, data = numbers(4, "<i8").tolist()
            if n != docs:
                raise ValueError(f"part {part}: index and segment at {offset} differ")
            doc, has, sizes, id_of = numbers(n, "<i8"), numbers(n, "u1"), numbers(n, "<i8"), numbers(ranks, "<u4")
            lanes = numbers(control, "u1")
            yield doc, has, sizes, id_of[unpacked(lanes, numbers(data, "u1"), sizes)], before


def read_files(spark: SparkSession, folder: str, files: list[tuple[int, int, int]], digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids (32 bits each) of every document of the files; ``digest``: ids_crc32 in place of ids."""
    starts, before = [], 0
    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    for i, (part, _, ids) in enumerate(files):
        starts.append((i, part, before))
        before += ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        for batch in batches:
            for part, first in zip(batch.column("part").to_pylist(), batch.column("first").to_pylist(), strict=True):
                for doc, has, sizes, ids, ahead in segments_of(store, base, part):
                    ends = np.cumsum(sizes)
                    columns = [pa.array(doc, mask=has == 0), pa.array(first + ahead + ends - sizes), pa.array(sizes)]
                    if digest:
                        raw = memoryview(ids.astype("<u4").tobytes())
                        spans = zip((ends - sizes).tolist(), ends.tolist(), strict=True)
                        columns.append(pa.array([zlib.crc32(raw[4 * lo : 4 * hi]) for lo, hi in spans], pa.int64()))
                    else:
                        offsets = np.concatenate([[0], ends * 4]).astype(np.int64)
                        lists = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
                        columns.append(lists.cast(pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    # One task per file.
    listed = spark.createDataFrame(starts, "place int, part int, first long").repartitionById(max(1, len(starts)), F.col("place"))
    return listed.mapInArrow(read, f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids binary'}")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded with word_bpe_49k, written, and read back."""
    import public_tokenizers

    folder = work_dir(spark, "token-files")
    files = write_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_files(spark, folder, files, digest=True)
