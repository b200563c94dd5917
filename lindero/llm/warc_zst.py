"""WARC archives in Zstandard with a shared dictionary (``.warc.zst``).

A file starts with a skippable frame that holds the dictionary (itself compressed or plain); then each record is a
frame of its own, compressed with it. The reader finds a frame's end from its block headers, decodes one record at a
time, and checks versions, mandatory headers, lengths, digests and the closing line ends.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filesystem, frugal, limit_batches, partitions_of, put_file, salted_lookup, work_dir, written

DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
#: Records that a file's dictionary is made from, the dictionary's size, and uncompressed bytes after which a file ends.
SAMPLE_RECORDS, DICTIONARY_BYTES, FILE_BYTES = 200, 16 << 10, 32 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    """A whole record; ValueError if its version, headers, lengths or ends are wrong."""
    head, split, body = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not split or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"header line {line!r}")
        headers[name.decode()] = value.strip().decode()
    if missing := [x for x in _MANDATORY if x not in headers]:
        raise ValueError(f"headers missing: {missing}")
    length = int(headers["Content-Length"])
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError("the block's length is not that of its header")
    block = body[:length]
    if (said := headers.get("WARC-Block-Digest")) and said != f"sha1:{sha1_base32(block)}":
        raise ValueError("the block's digest is not that of its header")
    return Record(headers, block)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def dictionary_of(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on ``samples``; of too few or too small ones, their first bytes as they are."""
    if len(samples) >= 32 and sum(map(len, samples)) > 8 * DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes]) -> list[bytes]:
    """The parts of an archive of whole records."""
    dictionary = dictionary_of(records[:SAMPLE_RECORDS])
    stored = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    packer = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True, write_content_size=True)
    return [struct.pack("<II", DICTIONARY_MAGIC, len(stored)), stored, *(packer.compress(x) for x in records)]


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its headers alone."""
    if len(data) < at + 5 or int.from_bytes(data[at : at + 4], "little") != FRAME_MAGIC:
        raise ValueError("no Zstandard frame")
    descriptor = data[at + 4]
    single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
    size_field = (1 if single else 0, 2, 4, 8)[descriptor >> 6]
    at += 5 + (0 if single else 1) + (0, 1, 2, 4)[descriptor & 3] + size_field
    while True:
        if len(data) < at + 3:
            raise ValueError("a frame is cut short")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        if kind == 3:
            raise ValueError("reserved block type")
        at += 3 + (1 if kind == 1 else size)
        if last:
            at += 4 * checksum
            if at > len(data):
                raise ValueError("a frame is cut short")
            return at


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive, one frame at a time; ValueError if anything in it is not as it should be."""
    view, at = memoryview(data), 0
    dictionary = None
    if len(data) >= 8 and int.from_bytes(view[:4], "little") == DICTIONARY_MAGIC:
        at = 8 + int.from_bytes(view[4:8], "little")
        if at > len(data):
            raise ValueError("the dictionary is cut short")
        stored = bytes(view[8:at])
        if stored[:4] == FRAME_MAGIC.to_bytes(4, "little"):
            stored = zstandard.ZstdDecompressor().decompress(stored)
        dictionary = zstandard.ZstdCompressionDict(stored)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        if 0x184D2A50 <= int.from_bytes(view[at : at + 4], "little") <= 0x184D2A5F:
            at += 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            continue
        end = frame_end(view, at)
        try:
            yield parse_record(reader.decompress(view[at:end], max_output_size=1 << 31 if zstandard.get_frame_parameters(view[at:end]).content_size == zstandard.CONTENTSIZE_UNKNOWN else 0))
        except zstandard.ZstdError as e:
            raise ValueError(f"a frame can't be decoded: {e}") from e
        at = end


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    inner = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _urn(page_id), "WARC-Date": date}
    if url and (target := "".join(url.split())):
        headers["WARC-Target-URI"] = target
    headers |= {"WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{sha1_base32(block)}", "Content-Type": "application/http; msgtype=response"}
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _urn(refers_to)}
    return record_bytes(headers, block)


def page_of(record: Record) -> tuple:
    """(page_id, payload bytes, payload digest, record type, response's page_id) of a record of :func:`page_record`."""
    head, split, payload = record.block.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    if not split or not head.startswith(b"HTTP/1.1 "):
        raise ValueError("no HTTP response in the block")
    size, kind, digest = int(fields[b"Content-Length"]), record.headers["WARC-Type"], record.headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size or sha1_base32(payload) != digest:
            raise ValueError("the payload's length or digest is not that of its header")
    elif kind != "revisit" or payload:
        raise ValueError(f"record type {kind!r}")
    return _page_of(record.headers["WARC-Record-ID"]), size, digest, kind, _page_of(record.headers["WARC-Refers-To"]) if kind == "revisit" else None


def write_archives(pages: DataFrame, folder: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) below ``folder``; one row a file (path, n_records, n_bytes).

    Of equal payloads of at least ``least`` bytes the smallest page_id is written whole, others as revisits of it.
    A null html is empty; a null url has no target header; rows that repeat the smallest page_id are whole records;
    rows without page_id are, too, unless a row with one has their payload. An empty table has no files. Digests are
    counted before pages move; a payload that many pages share is met under salts.
    """
    rows = limit_batches(pages).select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    # The format's digest is SHA-1, of which different payloads with one value are known; SHA-256 tells payloads apart.
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("size", F.octet_length("payload")).withColumn("content", F.unhex(F.sha2("payload", 256)))
    groups = rows.filter(F.col("size") >= least).groupBy("content").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    dealt = salted_lookup(rows, groups, ["content"], F.col("page_id"))
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False))
    dealt = dealt.select("page_id", "url", "payload", F.unhex("sha").alias("sha"), "first", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, held, size = TaskContext.get().partitionId(), [], [], 0

        def flush() -> None:
            path = f"{folder}/pages-{shard:06d}-{len(out):06d}.warc.zst"
            out.append({"path": path, "n_records": len(held), "n_bytes": put_file(path, archive_bytes(held))})
            held.clear()

        for batch in batches:
            for page_id, url, payload, sha, first, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(page_record(page_id, url, payload, base64.b32encode(sha).decode(), first, again, date))
                size += len(held[-1])
                if size >= file_bytes:
                    flush()
                    size = 0
        if held:
            flush()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return written(dealt.mapInArrow(frugal(run), "path string, n_records long, n_bytes long"), "warc-manifest")


_PAGES = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the files of ``manifest`` (path): page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null and repeated ids are read as they were written; an empty manifest gives no rows; a file that is not whole, or
    a record whose lengths or digests are wrong, is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, inner = filesystem(path)
                with store.open_input_file(inner) as f:
                    rows = [page_of(r) for r in read_archive(f.read())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PAGES.types, strict=True)], schema=_PAGES)

    return manifest.select("path").repartition(partitions_of(manifest)).mapInArrow(frugal(run), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op9(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read them back; nulls and repeats as in :func:`write_archives`."""
    return read_archives(write_archives(pages, work_dir(pages.sparkSession, "warc")))
