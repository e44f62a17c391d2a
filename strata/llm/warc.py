"""WARC archives: write whole-file gzip, normalise to one member per record.

``write_archives`` turns rows into WARC records and lets Spark's text writer
lay them down as ``.txt.gz`` files, each one a single gzip stream: the
"monolithic" archives found in the wild.  Of records with equal payloads
one is a ``response``; the others are ``revisit`` records that refer to it and
carry no payload.  ``normalise`` inflates each file's stream once, front to
back, rewrites every record as a gzip member of its own into
``<name>.warc.gz`` and writes ``<name>.warc.idx`` beside it: one line of
``offset length type id`` per record.  ``read_records`` reads the normalised
archives by their sidecars: each member is fetched and inflated on its own.

A file has at most ``FILE_RECORDS`` records; of any number of bytes, as it is read as a
stream and its records one by one.  The monolithic archives are
written and read by Spark.  The normalised ones go through ``pyarrow.fs`` to
the same shared folder, under a name of the task attempt first and then moved,
so a repeated task replaces its own file.

Edge cases: a null html is an empty payload; line ends, NULs and record-like
text inside a payload are read by length, never by search; a null URL is
written as an empty target, line ends in a URL as ``%0D`` and ``%0A``; a row
with a null page id is written with an empty id, it revisits a numbered row
with the same payload if there is one and is a response otherwise; repeated
rows with the smallest id of their payload are responses, each of them; an
empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.session import work_dir

FILE_RECORDS = 2000
# Bytes inflated, and read ahead, at a time.
PIECE = 1 << 18
DATE = "2024-01-01T00:00:00Z"  # fixed, so that reruns agree
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"


# ---------------------------------------------------------------------------
# records


def base32_of_hex(hexed: Column) -> Column:
    """Upper-case base32 of 40 hex digits (160 bits: 32 symbols, no padding)."""
    bits = F.concat(*(F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 2), 20, "0") for i in range(8)))
    symbols = F.array(*(F.lit(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.lit(31)),
            lambda i: F.get(symbols, F.conv(F.substring(bits, i * 5 + 1, F.lit(5)), 2, 10).cast("int")),
        ),
        "",
    )


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, sha1, refers_to (null: a response).

    Payloads are equal when SHA-1 and SHA-256 agree.  Groups are counted on
    digests alone, combined before the shuffle.  Only groups of two rows and
    more meet their rows again, as one row per group, so the planner may split
    a payload that a third of all pages share.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"),
        F.sha2(payload.cast("binary"), 256).alias("sha256"),
    )
    groups = (
        rows.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("sha1", "sha256")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return rows.join(groups, ["sha1", "sha256"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "sha1",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"),
    )


def record_text(rows: DataFrame) -> DataFrame:
    """One text column: a WARC record without its last line end."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        name("page_id"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        base32_of_hex(F.col("sha1")),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name("refers_to"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return rows.select(F.concat(head, block, F.lit("\r\n")).alias("record"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Monolithic archives: every file one gzip stream over all its records."""
    (
        record_text(with_responses(pages, min_bytes))
        .write.option("compression", "gzip")
        .option("lineSep", "\r\n")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(folder)
    )


# ---------------------------------------------------------------------------
# parsing


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def inflated(source) -> Iterator[bytes]:
    """The bytes of an open gzip file, in pieces, read front to back; further members are read on."""
    raw = source.read(PIECE)
    while raw:
        stream = zlib.decompressobj(wbits=31)
        while not stream.eof:
            # At most a piece at a time comes out; what is left of the input waits.
            piece = stream.decompress(raw, PIECE)
            raw = stream.unconsumed_tail
            if piece:
                yield piece
            elif not raw and not stream.eof:
                raw = source.read(PIECE)
                if not raw:
                    raise EOFError("gzip stream ends early")
        raw = stream.unused_data or source.read(PIECE)


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record with its two closing line ends), by length."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while fill(1):
        end, seen = -1, 0
        while end < 0:
            end = held.find(b"\r\n\r\n", max(0, seen - 3))
            seen = len(held)
            if end < 0 and not fill(seen + 1):
                raise EOFError("record header ends early")
        headers = _headers(bytes(held[:end]))
        size = end + 4 + int(headers["content-length"]) + 4
        if not fill(size) or held[size - 4 : size] != b"\r\n\r\n":
            raise EOFError("record ends early")
        yield headers, bytes(held[:size])
        del held[:size]


def _opened(uri: str):
    """(file system, path) of a shared folder's URI or absolute path."""
    from pyarrow import fs

    scheme, sep, rest = uri.partition(":")
    if sep and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri)


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(level=6, wbits=31)
    return packer.compress(record) + packer.flush()


def normalise(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Rewrite all archives of ``folder`` into ``target``; (file, records, bytes) per archive.

    The returned table is written below ``target``, so the work is done once.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        store, base = _opened(target)
        store.create_dir(base, recursive=True)
        for batch in batches:
            done = []
            for path in batch.column("path").to_pylist():
                stem = path.rsplit("/", 1)[-1].removesuffix(".gz").removesuffix(".txt")
                draft = f"{base}/.{stem}.{attempt}"
                offset, index = 0, []
                archives, place = _opened(path)
                with archives.open_input_stream(place, compression=None) as source, store.open_output_stream(draft) as out:
                    for headers, record in records(inflated(source)):
                        packed = member(record)
                        out.write(packed)
                        index.append(f"{offset} {len(packed)} {headers['warc-type']} {headers['warc-record-id']}\n")
                        offset += len(packed)
                store.move(draft, f"{base}/{stem}.warc.gz")
                with store.open_output_stream(f"{draft}.idx") as out:
                    out.write("".join(index).encode("utf-8"))
                store.move(f"{draft}.idx", f"{base}/{stem}.warc.idx")
                done.append((f"{stem}.warc", len(index), offset))
            cols = list(zip(*done, strict=True)) if done else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["file", "records", "bytes"],
            )

    # Only the names: the archives are streamed from the store, so a task holds a piece and a record of one at a time.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    files.mapInArrow(rewrite, "file string, records long, bytes long").write.parquet(f"{target}/_files")
    return spark.read.schema("file string, records long, bytes long").parquet(f"{target}/_files")


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """(file, offset, length, record_type, record_id) of all sidecars."""
    lines = spark.read.schema("offset long, length long, record_type string, record_id string").option("sep", " ").option("pathGlobFilter", "*.warc.idx").csv(target)
    return lines.select(F.regexp_replace("_metadata.file_name", r"\.idx$", ".gz").alias("file"), "*")


def read_records(spark: SparkSession, target: str) -> DataFrame:
    """Every record of the normalised archives, fetched by its index entry.

    The digest of a response is computed from its payload and held against
    the one in its header; a revisit has both figures of the full payload in
    its headers.
    """

    def number(name: str | None) -> int | None:
        digits = (name or "")[len("<urn:page:") : -1]
        return int(digits) if digits else None

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(target)
        name, source = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{base}/{file}")
                source.seek(offset)
                record = zlib.decompress(source.read(length), wbits=31)
                headers = _headers(record[: record.index(b"\r\n\r\n")])
                start = record.index(b"\r\n\r\n") + 4
                block = record[start : start + int(headers["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = headers["warc-payload-digest"].removeprefix("sha1:")
                size = int(_headers(http)["content-length"])
                if headers["warc-type"] == "response":
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")
                    if (found, len(payload)) != (digest, size):
                        raise ValueError(f"{file} at {offset}: payload does not fit its digest")
                out.append(
                    (number(headers["warc-record-id"]), size, digest, headers["warc-type"], number(headers.get("warc-refers-to")), headers["warc-target-uri"])
                )
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            cols = list(zip(*out, strict=True)) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri"],
            )

    return read_index(spark, target).select("file", "offset", "length").mapInArrow(fetch, RECORD_SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back; one row per row of ``pages``."""
    spark = pages.sparkSession
    mono, target = work_dir(spark, "warc-mono"), work_dir(spark, "warc")
    write_archives(pages, mono, min_bytes)
    if normalise(spark, mono, target).isEmpty():
        return spark.createDataFrame([], RECORD_SCHEMA)
    return read_records(spark, target)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per row of ``pages``, read back from the normalised archives."""
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (((instr('0123456789abcdef', substr(hex, 1 + CAST(5 * i // 4 AS INT), 1)) - 1) * 16
           + instr('0123456789abcdef', substr(hex, 2 + CAST(5 * i // 4 AS INT), 1)) - 1) >> CAST(3 - 5 * i % 4 AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM p
"""
