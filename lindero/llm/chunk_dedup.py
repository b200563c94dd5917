"""Exact duplicates by recipes of content-defined chunks.

A normalised text is cut where a rolling hash of its last bytes meets a mask, and becomes the ordered list of its
chunks' digests: its recipe. Texts of different recipes differ. Only texts whose recipe another text has, too, move
again: their chunks are brought together by digest and compared byte by byte, so that a digest is an identifier only
of one content; where contents collide, their order number is added to the recipes that hold them. Texts are equal when
their lists of verified identifiers are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, joined, limit_batches, partitions_of, salted_lookup, text_of, written

#: Chunks have at least LEAST bytes (but the last) and at most MOST; a cut comes once in 2**CUT_BITS bytes on average.
LEAST, MOST, CUT_BITS = 1024, 32768, 12
#: Bytes of chunks that a task keeps to skip those it has already sent.
KEPT_BYTES = 8 << 20
_SPACES = bytes(0x20 if 9 <= c <= 13 else c for c in range(256))
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([c]), seed=7) for c in range(256)], np.uint32)


def normalise(text: str) -> bytes:
    """Each run of space, tab and line ends (x20, x09-x0D) as one space, in UTF-8."""
    data = text.encode("utf-8", "surrogatepass").translate(_SPACES)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    return data


def chunks(data: bytes) -> list[bytes]:
    """``data`` cut at places that its content names; equal data, equal chunks."""
    if len(data) <= LEAST * 2:
        return [data]
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # the last 32 bytes, doubling
        h[step:] += h[:-step] << np.uint32(step)
    cuts, at = [], 0
    for place in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while place - at > MOST:
            at += MOST
            cuts.append(at)
        if place - at >= LEAST and place < len(data):
            at = place
            cuts.append(at)
    while len(data) - at > MOST:
        at += MOST
        cuts.append(at)
    return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]


def _digests(parts: list[bytes], size: int) -> list[bytes]:
    return [xxhash.xxh3_128_digest(p)[:size] for p in parts]


def recipes(docs: DataFrame, digest_bytes: int = 16, row: str | None = None) -> DataFrame:
    """doc_id, the normalised text's sha256, the recipe (digests one after another) for every row of ``docs``, and, if
    the name of a column is given, that one as ``row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha, recipe = [], []
            for text in batch.column(1):
                data = normalise(text.as_py())
                sha.append(hashlib.sha256(data).hexdigest())
                recipe.append(b"".join(_digests(chunks(data), digest_bytes)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sha, pa.string()), pa.array(recipe, pa.binary()), *batch.columns[2:]], names=["doc_id", "text_sha256", "recipe", *["row"] * (row is not None)])

    columns = ["doc_id", text_of().alias("text"), *([] if row is None else [F.col(row).alias("row")])]
    source = limit_batches(docs).select(*columns)
    out = source.mapInArrow(frugal(run), "doc_id long, text_sha256 string, recipe binary" + (f", row {source.schema['row'].dataType.simpleString()}" if row else ""))
    return out


_CHUNKS = "text_sha256 string, place int, digest binary, data binary"


def _occurrences(texts: DataFrame, digest_bytes: int, every: bool) -> DataFrame:
    """The chunks of ``texts``: every one with its text and place, or else each about once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, bytes]] = set()
        held = 0
        for batch in batches:
            rows: list[tuple[str, int, bytes, bytes]] = []
            size = 0
            for text in batch.column(0):
                whole = normalise(text.as_py())
                sha, parts = hashlib.sha256(whole).hexdigest() if every else "", chunks(whole)
                for place, (digest, data) in enumerate(zip(_digests(parts, digest_bytes), parts, strict=True)):
                    if not every:
                        if (digest, data) in seen:
                            continue
                        if held > KEPT_BYTES:
                            seen.clear()
                            held = 0
                        seen.add((digest, data))
                        held += len(data)
                    rows.append((sha, place, digest, data))
                    size += len(data)
                if size > 8 << 20:
                    yield _batch(rows, _CHUNKS)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, _CHUNKS)

    return texts.mapInArrow(frugal(run), _CHUNKS)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in ddl.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


_COLLIDED = "digest binary, data binary, number int"


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chunks sorted by digest and content: second and further contents of a digest, numbered from 1."""
    digest = data = None
    number = 0
    for batch in batches:
        found: list[tuple[bytes, bytes, int]] = []
        for d, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if d != digest:
                digest, data, number = d, x, 0
            elif x != data:
                data, number = x, number + 1
                found.append((d, x, number))
        if found:
            yield _batch(found, _COLLIDED)


def exact_groups(docs: DataFrame, digest_bytes: int = 16, row: str | None = None) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256; and ``row``, if
    a column of that name is given, which has a different value in each row and tells whose decision it is.

    A null text counts as empty; a text of spaces and line ends alone becomes one space, which differs from it. Of equal texts the row with the smallest doc_id stays, a null doc_id only if the
    group has no other; of rows with the same doc_id and text one stays. Empty tables give no rows. Long texts move
    once more only if another text has the same recipe. Other columns are not read. A group of any size is
    pre-aggregated before the shuffle and met under salts.
    """
    rows = written(recipes(docs, digest_bytes, row), "recipes", narrow=True, number=None if row else "row")
    shared = rows.groupBy("recipe").agg(F.count("*").alias("n")).filter("n > 1")
    candidates = written(salted_lookup(rows, shared, ["recipe"], F.col("row")).filter("n is not null").select("row", "doc_id", "recipe", "text_sha256"), "candidates", narrow=True)

    def key(column: str) -> Column:
        """The row, or else the doc_id, which several rows may have: then all their texts are looked at."""
        return F.col(column) if row else F.coalesce("doc_id", F.lit(-(1 << 63)))

    texts = joined(docs.select(key(row).alias("key"), text_of().alias("text")), candidates.select(key("row").alias("key")).distinct(), ["key"], "left_semi").select("text")
    once = _occurrences(texts, digest_bytes, every=False).select("digest", "data")
    collided = written(once.repartition(partitions_of(docs), "digest").sortWithinPartitions("digest", "data").mapInArrow(frugal(_collisions), _COLLIDED), "collided", narrow=True)

    if collided.isEmpty():
        marked = candidates.withColumn("marks", F.lit(""))
    else:
        marks = _occurrences(texts, digest_bytes, every=True).join(collided, ["digest", "data"]).groupBy("text_sha256")
        marks = marks.agg(F.sort_array(F.collect_set(F.struct("place", "number"))).cast("string").alias("marks"))
        marked = salted_lookup(candidates, marks, ["text_sha256"], F.col("row")).na.fill("", ["marks"])
    id_ = ["recipe", "marks"]
    groups = marked.groupBy(*id_).agg(F.count("*").alias("group_size"), F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("first")).filter("group_size > 1")
    groups = groups.select(*id_, "group_size", F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row"))
    of = written(salted_lookup(marked.select("row", *id_), groups, id_, F.col("row")).filter("group_size is not null").drop(*id_), "copies", narrow=True)
    return joined(rows.drop("recipe"), of, ["row"], "left").select(
        "doc_id",
        F.when(F.col("first_row").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("first_row", "row") == F.col("row")).alias("kept"),
        "text_sha256",
        *([] if row is None else [F.col("row").alias(row)]),
    )
