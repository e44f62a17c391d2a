"""Cross-tokenizer alignment over exactly deduplicated texts.

Two tokenizers A and B cut the same bytes (a space and the text).  Offsets where
a token of both ends cut the tokens into groups, and an A token is linked with
every B token whose bytes overlap its own.  How often a pair of ids is linked is
counted in documents over the whole corpus.

Documents are shuffled by their full text, so each distinct text is tokenised
and aligned once and stands for as many documents as have it.  Aligned texts are
dealt into blocks of bounded size.  A block lists its distinct pairs once, with
the documents that hold each, and a text of it refers to that list by position.
Pair counts are sums over blocks; each block then asks for the counts of its own
pairs, so a pair that nearly every document holds is one row per block, in the count as
well as in the answer.  With the answers beside it a block's texts get
their corpus-wide measures, which go back to the documents by text hash (two
hashes of 64 bits).

Words are independent under both tokenizers where a blank follows a character that is
no white space: A's pattern never matches across it, and no piece of B holds a
blank behind another character (checked when the model is loaded; whole texts are
encoded otherwise).  A worker remembers the alignments of short words.  Short words of
A are merged by ``tiktoken`` over A's own vocabulary, which gives the ids of the
``tokenizers`` library.

Edge cases: null and empty texts, and texts whose tokens do not spell the text
back, have no tokens: zeros and an empty digest; special strings in a text are plain
text; a text of any length is one row of one block; repeated rows and repeated or
null ``doc_id`` get their text's measures each; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe_count import PATTERN, _byte_symbols
from strata.llm.common import shuffle_parts, steps, table, text_buffers, written

# Distinct pairs of its texts, summed, that close a block, and texts that do.
BLOCK_PAIRS = 1 << 18
BLOCK_TEXTS = 4096
# Words that a worker remembers, their longest, and words encoded together.
MEMORY_WORDS = 1 << 16
MEMORY_CHARS = 48
TOGETHER = 512
# Bytes of texts whose words are looked up together.
STRETCH_BYTES = 1 << 21
# A pair of ids as one number.
SHIFT = 32

# A blank behind a character that is no white space.
_CUT = re.compile(r" (?<=\S )")
# A blank at the ends or behind white space.
_RUN = re.compile(r"^ | $|\s ")


@dataclass(slots=True)
class Aligned:
    """Alignment of one stretch of text; ``pairs`` has a number per link."""

    n_a: int
    n_b: int
    n_groups: int
    pairs: list[int]
    groups: str


_NOTHING = Aligned(0, 0, 0, [], "")


def overlaps(a_ids: list[int], a_ends: list[int], b_ids: list[int], b_ends: list[int]) -> Aligned:
    """Groups and links of two tokenisations of the same bytes, given where each token ends."""
    pairs, groups, i, j, first_a, first_b = [], [], 0, 0, 0, 0
    while i < len(a_ids) and j < len(b_ids):
        pairs.append(a_ids[i] << SHIFT | b_ids[j])
        a_end, b_end = a_ends[i], b_ends[j]
        i += a_end <= b_end
        j += b_end <= a_end
        if a_end == b_end:
            if i - first_a == 1 == j - first_b:
                groups.append(f"{a_ids[first_a]}|{b_ids[first_b]}")
            else:
                groups.append(",".join(map(str, a_ids[first_a:i])) + "|" + ",".join(map(str, b_ids[first_b:j])))
            first_a, first_b = i, j
    return Aligned(len(a_ids), len(b_ids), len(groups), pairs, ";".join(groups))


def _ends(pieces: list[bytes]) -> list[int]:
    out, at = [], 0
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


class Memory:
    """What is known of words: those met lately stay, others go when ``MEMORY_WORDS`` are there."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def found(self, words: Iterable[str]) -> tuple[dict, list[str]]:
        """(words known and what of them, new words)."""
        young, old, known, new = self.young, self.old, {}, []
        for w in words:
            if w in young:
                known[w] = young[w]
            elif w in old:
                known[w] = young[w] = old[w]
            else:
                new.append(w)
        return known, new

    def add(self, learned: dict) -> None:
        self.young.update(learned)
        if len(self.young) > MEMORY_WORDS // 2:
            self.old, self.young = self.young, {}


def spread(lengths: list[int], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the joined lists, length at each code) for a sequence of codes that each stand for a list."""
    length = np.array(lengths, dtype=np.int64)
    n = length[codes]
    ends = np.cumsum(n)
    small = np.int32 if max(int(n.sum()), int(length.sum())) < 1 << 31 else np.int64
    begin = (np.cumsum(length) - length)[codes] - (ends - n)
    places = np.repeat(begin.astype(small), n)
    places += np.arange(len(places), dtype=small)
    return places, n


class Aligner:
    """The two tokenizers and the alignments of words seen."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = {s: bytes([i]) for i, s in enumerate(_byte_symbols())}
        self.a_bytes = {i: b"".join(byte.get(c, c.encode()) for c in t) for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b_bytes, self.by_word = [], True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode("utf-8"))
                self.by_word &= "▁" not in piece.lstrip("▁")
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, dtype=np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        ranks = {self.a_bytes[i]: i for i in self.a.get_vocab(with_added_tokens=False).values()}
        self.a_words = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.names = list(map(str, range(max(len(self.a_sizes), len(self.b_sizes)))))
        self.seen = Memory()

    def whole(self, spaced: str) -> Aligned | None:
        """Alignment of a stretch that begins with a space; None where the tokens do not spell it."""
        a_ids = self.a.encode(spaced, add_special_tokens=False).ids
        b_ids = self.b.encode(spaced[1:])
        a, b, want = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b_ids], spaced.encode("utf-8")
        if b"".join(a) != want or b"".join(b) != want:
            return None
        return overlaps(a_ids, _ends(a), b_ids, _ends(b))

    def _learn(self, words: list[str]) -> dict[str, Aligned | None]:
        """Alignments of words that begin with a blank: encoded together, and cut apart where both tokenizers cut."""
        out: dict[str, Aligned | None] = {}
        for lo in range(0, len(words), TOGETHER):
            some = words[lo : lo + TOGETHER]
            joined = "".join(some)
            ends = np.cumsum([len(w.encode("utf-8")) for w in some])
            a_ids, b_ids = self.a_words.encode_ordinary(joined), self.b.encode(joined[1:])
            a_codes, b_codes = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
            a_ends, b_ends = np.cumsum(self.a_sizes[a_codes]), np.cumsum(self.b_sizes[b_codes])
            both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
            twice = both[1:] == both[:-1]
            cuts, common = both[np.append(~twice, True)], both[1:][twice]
            raw = joined.encode("utf-8")
            if not np.isin(ends, common).all() or a_ends[-1] != ends[-1] or b_ends[-1] != ends[-1] or b"".join(map(self.b_bytes.__getitem__, b_ids)) != raw:
                out.update((w, self.whole(w)) for w in some)
                continue
            # Between two neighbouring ends, of A or B, lies the overlap of one linked pair.
            c_at = np.searchsorted(cuts, common) + 1
            pairs = (a_codes[np.searchsorted(a_ends, cuts)] << SHIFT | b_codes[np.searchsorted(b_ends, cuts)]).tolist()
            a_names, b_names = list(map(self.names.__getitem__, a_ids)), list(map(self.names.__getitem__, b_ids))
            a_at, b_at = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
            groups, x, y, c = [], 0, 0, 0
            for i, j, k in zip(a_at.tolist(), b_at.tolist(), c_at.tolist(), strict=True):
                if k - c == 1:
                    groups.append(f"{a_names[x]}|{b_names[y]}")
                else:
                    groups.append(f"{','.join(a_names[x:i])}|{','.join(b_names[y:j])}")
                x, y, c = i, j, k
            last = [(np.searchsorted(at, ends) + 1).tolist() for at in (a_ends, b_ends, cuts, common)]
            x, y, c, g = 0, 0, 0, 0
            for word, x2, y2, c2, g2 in zip(some, *last, strict=True):
                out[word] = Aligned(x2 - x, y2 - y, g2 - g, pairs[c:c2], ";".join(groups[g:g2]))
                x, y, c, g = x2, y2, c2, g2
        return out

    def known(self, words: list[str]) -> list[Aligned | None]:
        """Alignments of words, a blank before each; None where the tokens do not spell it."""
        known, new = self.seen.found(words)
        learned = self._learn([w for w in new if len(w) <= MEMORY_CHARS])
        self.seen.add(learned)
        known.update(learned)
        known.update((w, self.whole(w)) for w in new if len(w) > MEMORY_CHARS)
        return [known[w] for w in words]

    def texts(self, texts: pa.Array) -> Iterator[tuple | None]:
        """The measures of each text, a blank before it; None where the tokens do not spell it."""
        cut = [_cut(t) if self.by_word else [" " + t] for t in texts.to_pylist()]
        coded = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
        found = self.known(coded.dictionary.to_pylist())
        odd = np.array([x is None for x in found], dtype=bool)
        found = [_NOTHING if x is None else x for x in found]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        places, per_word = spread([len(x.pairs) for x in found], codes)
        links = np.fromiter(chain.from_iterable(x.pairs for x in found), dtype=np.int64)[places]
        figures = np.array([[x.n_a for x in found], [x.n_b for x in found], [x.n_groups for x in found]], dtype=np.int64).T[codes]
        groups, at, link = [x.groups for x in found], 0, 0
        for words in cut:
            mine = codes[at : at + len(words)]
            n = int(per_word[at : at + len(words)].sum())
            if odd[mine].any():
                yield None
            else:
                keys, times = np.unique(links[link : link + n], return_counts=True)
                digest = hashlib.sha256(";".join(map(groups.__getitem__, mine.tolist())).encode("ascii")).hexdigest()
                yield (*figures[at : at + len(words)].sum(axis=0).tolist(), n, digest, keys, times)
            at, link = at + len(words), link + n


def _cut(text: str) -> list[str]:
    """The words of a text, each with the blank before it."""
    if not _RUN.search(text):
        return [" " + w for w in text.split(" ")]
    parts = _CUT.split(" " + text)
    words = [parts[0], *(" " + p for p in parts[1:])]
    if words[-1] == " " and len(words) > 1:  # B gives no token for an empty text
        words[-2:] = [words[-2] + " "]
    return words


def _stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with texts of about ``STRETCH_BYTES`` bytes, one row at least."""
    _, offsets = text_buffers(batch.column("text"))
    for lo, hi in steps(offsets, STRETCH_BYTES):
        yield batch.slice(lo, hi - lo)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per pair of files and Python worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


# ---------------------------------------------------------------------------
# Spark

# Rows of a text: h1, h2, its figures, places in the block's list (32 bits) and how often (32 bits).
# The row of a block: its pairs and the documents that hold each (64 bits), h1 null.
BLOCK_SCHEMA = (
    "block long, h1 long, h2 long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places binary, times binary, pairs binary, docs binary"
)
_BLOCK_TYPES = [*[pa.int64()] * 7, pa.string(), *[pa.binary()] * 4]
_BLOCK_NAMES = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Every distinct text tokenised and aligned once, in blocks; written to the shared folder."""
    distinct = docs.where(F.length("text") > 0).groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(*_text_key(), "copies", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        al = aligner(a_path, b_path)
        block, held, size = TaskContext.get().partitionId() << 33, [], 0

        def closed() -> pa.RecordBatch:
            everything = np.concatenate([x[-2] for x in held])
            pairs, place = np.unique(everything, return_inverse=True)
            docs = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(docs, place, np.repeat([x[0] for x in held], [len(x[-2]) for x in held]))
            out, at = [], 0
            for _, *figures, keys, times in held:
                mine = place[at : at + len(keys)].astype("<u4")
                at += len(keys)
                out.append((block, *figures, mine.tobytes(), times.astype("<u4").tobytes(), None, None))
            out.append((block, *[None] * 9, pairs.astype("<i8").tobytes(), docs.astype("<i8").tobytes()))
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _BLOCK_TYPES, strict=True)], names=_BLOCK_NAMES)

        for batch in chain.from_iterable(map(_stretches, batches)):
            found = al.texts(batch.column("text"))
            for h1, h2, copies, measured in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "copies")), found, strict=True):
                if measured is None:
                    continue
                *figures, keys, times = measured
                held.append((copies, h1, h2, *figures, keys, times))
                size += len(keys)
                if size >= block_pairs or len(held) >= BLOCK_TEXTS:
                    yield closed()
                    block, held, size = block + 1, [], 0
        if held:
            yield closed()

    return written(keyed.mapInArrow(rows, BLOCK_SCHEMA), "aligned")


def _text_key() -> list:
    """A text's name: two hashes of 64 bits."""
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2")]


def _numbers(raw, dtype: str) -> np.ndarray:
    return np.frombuffer(raw.as_buffer(), dtype=dtype)


def _asked(blocks: DataFrame) -> DataFrame:
    """(block, pair, docs): the lists of the blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, docs in zip(*(batch.column(c) for c in ("block", "pairs", "docs")), strict=True):
                pair = _numbers(pairs, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), block.as_py())), pa.array(pair), pa.array(_numbers(docs, "<i8"))], names=["block", "pair", "docs"]
                )

    return blocks.where("h1 is null").select("block", "pairs", "docs").mapInArrow(rows, "block long, pair long, docs long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each linked pair; best: the highest count of its A id, ties included."""
    counts = written(_asked(blocks).groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", SHIFT)), "pair-counts")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def measures(blocks: DataFrame) -> DataFrame:
    """h1, h2 and the measures of every aligned text."""
    answers = _asked(blocks).drop("docs").join(pair_counts(blocks), "pair").select(
        "block", F.lit(0).alias("role"), "pair", "n", "best"
    )
    names = ["h1", "h2", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times"]
    types = dict(blocks.dtypes)
    texts = blocks.where("h1 is not null").select(
        "block", F.lit(1).alias("role"), *(F.lit(None).cast(t).alias(c) for c, t in (("pair", "long"), ("n", "long"), ("best", "boolean"))), *names
    )
    both = texts.unionByName(answers.select("*", *(F.lit(None).cast(types[c]).alias(c) for c in names)))
    dealt = both.repartition(shuffle_parts(blocks.sparkSession), "block").sortWithinPartitions("block", "role", "pair")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, best = None, [], []
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            roles = batch.column("role").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((blocks[1:] != blocks[:-1]) | (roles[1:] != roles[:-1])) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(blocks)], strict=True):
                if hi == lo:
                    continue
                run = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, n, best = blocks[lo], [], []
                if roles[lo] == 0:  # in the order of the block's list
                    n.append(run.column("n").to_numpy(zero_copy_only=False))
                    best.append(run.column("best").to_numpy(zero_copy_only=False).astype(np.int64))
                    continue
                n, best = [np.concatenate(n)], [np.concatenate(best)]
                n_best, count_sum = [], []
                for places, times in zip(run.column("places"), run.column("times"), strict=True):
                    at, often = _numbers(places, "<u4"), _numbers(times, "<u4").astype(np.int64)
                    n_best.append(int(best[0][at] @ often))
                    count_sum.append(int(n[0][at] @ often))
                yield pa.RecordBatch.from_arrays(
                    [*(run.column(c) for c in names[:7]), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                    names=[*names[:7], "n_best", "count_sum"],
                )

    return dealt.mapInArrow(
        rows, "h1 long, h2 long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )


def alignment(docs: DataFrame, a_path: str, b_path: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """doc_id and the measures of its text, one row per row of ``docs``."""
    found = written(measures(aligned_blocks(docs, a_path, b_path, block_pairs)), "alignment")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_key())
    figures = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return rows.join(found, ["h1", "h2"], "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in figures), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` under byte_bpe_50k and piece_bpe_32k."""
    import public_tokenizers

    return alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
