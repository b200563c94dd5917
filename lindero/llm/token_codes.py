"""Token ids in files of directly addressable codes.

An id is cut into chunks of fixed widths, the lowest first. Level k of a file holds the k-th chunks of the ids that
have one, densely, and a bitmap with a bit for each of them: set if the id goes on in the next level. The position
there is the number of set bits before it, which a rank directory (one total for each 512 bits) gives in constant
time. So any token is read from a few bytes at computed places; nothing around it is decoded.

File: ``DACIDS01``, length of a JSON header (u32), the header, then sections at multiples of 8 bytes: the documents'
ids, a null mark for each, first positions, and for each level codes, bitmap and rank directory.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, frugal, limit_batches, partitions_of, put_file, text_of, work_dir, written
from .pretokens import in_order
from .wordcache import word_cache

MAGIC = b"DACIDS01"
WIDTHS = (8, 8, 16)
BLOCK = 512
#: Tokens after which a file is closed: bounds a task's memory (about 3 bytes a token) and a file's size.
FILE_TOKENS = 1 << 23
MANIFEST = "shard int, segment int, path string, n_docs long, n_tokens long, n_bytes long"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _aligned(parts: list[bytes], at: int, data: bytes) -> tuple[int, int]:
    pad = -at % 8
    parts += [b"\0" * pad, data]
    return at + pad, at + pad + len(data)


def dump(doc_ids: Sequence[int | None], starts: np.ndarray, ids: np.ndarray, widths: Sequence[int] = WIDTHS) -> list[bytes]:
    """The parts of a file with the documents ``doc_ids``, whose tokens are ``ids[starts[i]:starts[i + 1]]``."""
    sections: dict[str, int] = {}
    body: list[bytes] = []
    at = 0

    def put(name: str, data: bytes) -> None:
        nonlocal at
        sections[name], at = _aligned(body, at, data)

    put("docs", np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes())
    put("nulls", np.array([x is None for x in doc_ids], "u1").tobytes())
    put("starts", np.asarray(starts, "<i8").tobytes())
    levels, rest = [], np.asarray(ids, np.uint32)
    for k, width in enumerate(widths):
        if k and not len(rest):
            break
        kind = "<u1" if width <= 8 else "<u2" if width <= 16 else "<u4"
        more = (rest >> np.uint32(width)) != 0 if width < 32 else np.zeros(len(rest), bool)
        if k == len(widths) - 1 and more.any():
            raise ValueError("an id needs more bits than the chunk widths have")
        put(f"codes{k}", (rest & np.uint32((1 << width) - 1)).astype(kind).tobytes())
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        totals = _ONES[bits].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)
        put(f"bitmap{k}", bits.tobytes())
        put(f"ranks{k}", np.concatenate([[0], np.cumsum(totals)]).astype("<u8").tobytes())
        levels.append({"n": len(rest), "kind": kind, "width": width})
        rest = rest[more] >> np.uint32(width) if width < 32 else rest[:0]
    header = json.dumps({"n_docs": len(doc_ids), "n_tokens": len(ids), "levels": levels, "sections": sections}).encode()
    header += b" " * (-(len(MAGIC) + 4 + len(header)) % 8)
    return [MAGIC, len(header).to_bytes(4, "little"), header, *body]


class CodeFile:
    """Reads a file of :func:`dump` through a random access file (anything with ``read_at(n, offset)``)."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(12, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n = int.from_bytes(head[8:12], "little")
        self.header = json.loads(file.read_at(n, 12))
        self.base = 12 + n
        self.levels = self.header["levels"]
        self.n_docs, self.n_tokens = self.header["n_docs"], self.header["n_tokens"]

    @classmethod
    def open(cls, uri: str) -> CodeFile:
        store, path = filesystem(uri)
        return cls(store.open_input_file(path))

    def _array(self, name: str, kind: str, first: int, last: int) -> np.ndarray:
        size = np.dtype(kind).itemsize
        data = self.file.read_at((last - first) * size, self.base + self.header["sections"][name] + first * size)
        return np.frombuffer(data, kind, last - first)

    def _rank(self, k: int, i: int) -> int:
        """Set bits before bit ``i`` of level ``k``."""
        block = i // BLOCK
        total = int(self._array(f"ranks{k}", "<u8", block, block + 1)[0])
        bits = self._array(f"bitmap{k}", "u1", block * BLOCK // 8, (i + 7) // 8)
        if i % 8:
            return total + int(_ONES[bits[:-1]].sum()) + int(_ONES[bits[-1] & ((1 << i % 8) - 1)])
        return total + int(_ONES[bits].sum())

    def token(self, i: int) -> int:
        """The token at position ``i``: one code, one bit and one rank a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for k, level in enumerate(self.levels):
            value |= int(self._array(f"codes{k}", level["kind"], i, i + 1)[0]) << shift
            if not self._array(f"bitmap{k}", "u1", i // 8, i // 8 + 1)[0] >> i % 8 & 1:
                break
            i, shift = self._rank(k, i), shift + level["width"]
        return value

    def tokens(self, first: int, last: int) -> np.ndarray:
        """The tokens from ``first`` up to ``last``."""
        return self._range(0, first, last)

    def _range(self, k: int, first: int, last: int) -> np.ndarray:
        level = self.levels[k]
        out = self._array(f"codes{k}", level["kind"], first, last).astype("<u4")
        if k + 1 < len(self.levels) and last > first:
            bits = self._array(f"bitmap{k}", "u1", first // 8, (last + 7) // 8)
            more = np.unpackbits(bits, bitorder="little")[first % 8 : first % 8 + last - first].astype(bool)
            if n := int(more.sum()):
                at = self._rank(k, first)
                out[more] |= self._range(k + 1, at, at + n) << np.uint32(level["width"])
        return out

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """(document ids, first positions and the end)."""
        ids = self._array("docs", "<i8", 0, self.n_docs).tolist()
        nulls = self._array("nulls", "u1", 0, self.n_docs)
        return [None if x else i for i, x in zip(ids, nulls, strict=True)], self._array("starts", "<i8", 0, self.n_docs + 1)


def write_codes(docs: DataFrame, tokenizer: str, end_id: int, folder: str, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into files below ``folder``; one row a file (MANIFEST).

    Documents are dealt by ranges of doc_id, ties by the text's hash, so that rows that repeat one id do not meet in
    one task. A null text is empty and has the end id alone; a null doc_id comes first and is read back as null; rows
    that repeat are all written; an empty table has no files. Other columns are not read.
    """
    n = partitions_of(limit_batches(docs))
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard, segment = word_cache(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], cache.dtype)
        doc_ids: list = []
        coded: list[np.ndarray] = []
        held = 0

        def flush() -> dict:
            ids = np.concatenate(coded)
            starts = np.cumsum([0, *map(len, coded[::2])]) + np.arange(len(doc_ids) + 1)  # each document has its end id
            path = f"{folder}/ids-{shard:06d}-{segment:06d}.dac"
            size = put_file(path, dump(doc_ids, starts, ids))
            return {"shard": shard, "segment": segment, "path": path, "n_docs": len(doc_ids), "n_tokens": len(ids), "n_bytes": size}

        out = []
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), in_order(cache, batch.column(1).to_pylist()), strict=True):
                doc_ids.append(doc_id)
                coded += [ids, end]
                held += len(ids) + 1
                if held >= file_tokens:
                    out.append(flush())
                    segment, held = segment + 1, 0
                    doc_ids, coded = [], []
        if doc_ids:
            out.append(flush())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

    return written(rows.mapInArrow(frugal(run), MANIFEST), "dac-manifest")


READ = "doc_id long, start long, n_tokens long, ids_crc32 long, path string, position long"
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("path", pa.string()), ("position", pa.int64())])


def read_codes(manifest: DataFrame) -> DataFrame:
    """One row per document from the files of ``manifest``: where its ids start among all, how many, their crc32.

    The files' totals are summed in their order over the manifest alone, which has one row for each file.
    """
    before = Window.orderBy("shard", "segment").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    files = files.repartition(partitions_of(manifest))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = CodeFile.open(row["path"])
                doc_ids, starts = file.documents()
                first = 0
                while first < len(doc_ids):
                    last = max(first + 1, int(np.searchsorted(starts, starts[first] + (1 << 20), "right")) - 1)  # about a million ids at once
                    ids = file.tokens(int(starts[first]), int(starts[last]))
                    cut = (starts[first : last + 1] - starts[first]).tolist()
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(cut, cut[1:], strict=False)]
                    at = starts[first:last]
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[first:last], pa.int64()), pa.array(at + row["base"]), pa.array(np.diff(starts[first : last + 1])), pa.array(crc, pa.int64()), pa.array([row["path"]] * len(crc)), pa.array(at)], schema=_READ)
                    first = last

    return files.mapInArrow(frugal(run), READ)


def op1(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return what reading them back gives."""
    return read_codes(write_codes(docs, tokenizer, end_id, work_dir(docs.sparkSession, "dac")))
