"""TIFF media columns: a reader that gives one row per page, and a writer for lossless storage.

The reader walks the chain of image directories (little or big endian), decodes strips or tiles that are plain,
PackBits, LZW or deflate, undoes predictors (differences, floating point) and byte order, unpacks samples of 1, 2 and 4
bits, and lays tiles into the page.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, limit_batches, text_of, written

#: Tags and values of the format (fixed values).
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 284, 317, 322, 323, 324, 325, 339
FILL_ORDER = 266
PLAIN, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
_TYPES = {1: "B", 3: "H", 4: "I", 16: "Q"}
#: Bytes of a page, or of a tile, from which on it is not read: what a few broken bytes in a directory can ask for is bounded.
MOST_BYTES = 1 << 28
_REVERSED = bytes(int(f"{c:08b}"[::-1], 2) for c in range(256))


class Page(NamedTuple):
    page: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    pixels: bytes  # rows, then pixels, then samples; samples of over 8 bits are little-endian


# --- codecs ---------------------------------------------------------------------------------------------------------

_RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)


def packbits_encode(data: bytes) -> bytes:
    out, at = bytearray(), 0

    def literal(upto: int) -> None:
        for a in range(at, upto, 128):
            part = data[a : min(a + 128, upto)]
            out.append(len(part) - 1)
            out.extend(part)

    for run in _RUN.finditer(data):
        literal(run.start())
        out.append(257 - len(run[0]))
        out.extend(run[1])
        at = run.end()
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, at, held = [], 0, 0
    while held < size and at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            held, at = held + n + 1, at + n + 2
        elif n > 128:
            out.append(data[at + 1 : at + 2] * (257 - n))
            held, at = held + 257 - n, at + 2
        else:
            at += 1
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; the width grows one code early, as TIFF has it."""
    start = {bytes([i]): i for i in range(256)}
    codes, widths = [256], [9]
    table, nxt, width, prefix = dict(start), 258, 9, b""
    for c in data:
        longer = prefix + bytes((c,))
        if longer in table:
            prefix = longer
            continue
        codes.append(table[prefix])
        widths.append(width)
        table[longer] = nxt
        nxt += 1
        if nxt == 4094:
            codes.append(256)
            widths.append(12)
            table, nxt, width = dict(start), 258, 9
        elif nxt + 1 > 1 << width:
            width += 1
        prefix = bytes((c,))
    if prefix:
        codes.append(table[prefix])
        widths.append(width)
        nxt += 1
        if nxt + 1 > 1 << width and width < 12:
            width += 1
    codes.append(257)
    widths.append(width)
    return _pack(np.array(codes, np.int64), np.array(widths, np.int64))


def _pack(codes: np.ndarray, widths: np.ndarray) -> bytes:
    ends = np.cumsum(widths)
    place = np.arange(int(ends[-1])) - np.repeat(ends - widths, widths)
    return np.packbits((np.repeat(codes, widths) >> (np.repeat(widths, widths) - 1 - place) & 1).astype(np.uint8)).tobytes()


def lzw_decode(data: bytes, size: int) -> bytes:
    start = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, held = list(start), [], 0
    width, last, bits, have, at = 9, None, 0, 0, 0
    while held < size:
        while have < width:
            if at >= len(data):
                return b"".join(out)
            bits, have, at = (bits << 8 | data[at]) & 0xFFFFFF, have + 8, at + 1
        have -= width
        code = bits >> have & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(start), 9, None
            continue
        if last is None:
            word = table[code]
        else:
            if code < len(table):
                word = table[code]
            elif code == len(table):
                word = last + last[:1]
            else:
                raise ValueError("an LZW code stands before its entry")
            table.append(last + word[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        out.append(word)
        held += len(word)
        last = word
    return b"".join(out)


def _decode(data: bytes, compression: int, size: int) -> bytes:
    if compression == PLAIN:
        out = data
    elif compression == PACKBITS:
        out = packbits_decode(data, size)
    elif compression == LZW:
        out = lzw_decode(data, size)
    elif compression in (DEFLATE, OLD_DEFLATE):
        out = zlib.decompressobj().decompress(data, size)
    else:
        raise ValueError(f"compression {compression} is not known")
    if len(out) < size:
        raise ValueError("a strip or tile is cut short")
    return out[:size]


# --- reader ---------------------------------------------------------------------------------------------------------


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple[int, ...]]]]:
    """(byte order, tags) of each image directory, in the order of the chain; ValueError for a loop or a cut file. A tag
    whose values lie outside of the file is left out."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        n = struct.unpack_from(order + "H", data, at)[0] if at + 2 <= len(data) else 0
        if at in seen or at + 6 + 12 * n > len(data):
            raise ValueError("the chain of directories is broken")
        seen.add(at)
        tags: dict[int, tuple[int, ...]] = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            if kind in _TYPES:
                size = struct.calcsize(_TYPES[kind]) * count
                place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
                if count and place + size <= len(data):
                    tags[tag] = struct.unpack_from(f"{order}{count}{_TYPES[kind]}", data, place)
        yield order, tags
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def _samples(raw: bytes, order: str, bits: int, rows: int, values: int) -> np.ndarray:
    """(rows, values) of samples; rows of less than a byte a sample end at a byte's end."""
    if bits >= 8:
        return np.frombuffer(raw, f"{order}u{bits // 8}").astype(f"<u{bits // 8}").reshape(rows, values)
    each = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(rows, -1)[:, : values * bits].reshape(rows, values, bits)
    return (each << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(2, dtype=np.uint8)


def _float_rows(raw: bytes, bits: int, rows: int, columns: int, samples: int) -> np.ndarray:
    """Predictor 3: bytes of a row differ from those a sample before and stand most significant first, plane by plane."""
    size = bits // 8
    steps = np.frombuffer(raw, np.uint8).reshape(rows, columns * size, samples)
    planes = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(rows, size, columns * samples)
    return np.ascontiguousarray(planes[:, ::-1].transpose(0, 2, 1)).view(f"<u{size}").reshape(rows, columns, samples)


def _block(data: bytes, order: str, tags: dict, offset: int, count: int, rows: int, columns: int, samples: int) -> np.ndarray:
    bits = tags.get(BITS, (1,))[0]
    if offset + count > len(data):
        raise ValueError("a strip or tile lies outside the file")
    part = data[offset : offset + count]
    if tags.get(FILL_ORDER, (1,))[0] == 2:
        part = part.translate(_REVERSED)
    raw = _decode(part, tags.get(COMPRESSION, (PLAIN,))[0], rows * (-(-columns * samples * bits // 8)))
    predictor = tags.get(PREDICTOR, (1,))[0]
    if predictor == 3 and bits in (16, 32):
        return _float_rows(raw, bits, rows, columns, samples)
    pixels = _samples(raw, order, bits, rows, columns * samples).reshape(rows, columns, samples)
    if predictor == 2 and bits >= 8:
        return np.cumsum(pixels, axis=1, dtype=pixels.dtype)
    if predictor != 1:
        raise ValueError(f"predictor {predictor} is not known for {bits} bits a sample")
    return pixels


def _page(data: bytes, number: int, order: str, tags: dict[int, tuple[int, ...]]) -> Page:
    width, height, samples = tags[WIDTH][0], tags[LENGTH][0], tags.get(SAMPLES, (1,))[0]
    bits = tags.get(BITS, (1,))[0]
    if bits not in (1, 2, 4, 8, 16, 32) or set(tags.get(BITS, (1,))) != {bits}:
        raise ValueError(f"{'/'.join(map(str, tags[BITS]))} bits a sample are not read here")
    if not (width and height and samples):
        raise ValueError("a page without pixels")
    if width * height * samples * max(8, bits) // 8 > MOST_BYTES:
        raise ValueError(f"a page of {width} x {height} x {samples} samples is larger than {MOST_BYTES} bytes")
    planes = samples if tags.get(PLANAR, (1,))[0] == 2 and samples > 1 else 1
    inner = samples // planes
    page = np.zeros((height, width, samples), f"<u{max(8, bits) // 8}")
    if TILE_OFFSETS in tags:
        w, h = tags[TILE_WIDTH][0], tags[TILE_LENGTH][0]
        if not (w and h) or w * h * inner * max(8, bits) // 8 > MOST_BYTES:
            raise ValueError(f"tiles of {w} x {h}")
        across, down = -(-width // w), -(-height // h)
        places = [(k % (across * down) // across * h, k % across * w, k // (across * down)) for k in range(across * down * planes)]
        offsets, counts, size = tags[TILE_OFFSETS], tags[TILE_COUNTS], (h, w)
    else:
        step = min(height, tags.get(ROWS_PER_STRIP, (height,))[0]) or height
        strips = -(-height // step)
        places = [(k % strips * step, 0, k // strips) for k in range(strips * planes)]
        offsets, counts, size = tags[STRIP_OFFSETS], tags[STRIP_COUNTS], (step, width)
    for (y, x, plane), offset, count in zip(places, offsets, counts, strict=True):
        rows = size[0] if TILE_OFFSETS in tags else min(size[0], height - y)
        block = _block(data, order, tags, offset, count, rows, size[1], inner)[: height - y, : width - x]
        page[y : y + size[0], x : x + size[1], plane * inner : (plane + 1) * inner] = block
    return Page(number, width, height, samples, bits, tags.get(COMPRESSION, (PLAIN,))[0], page.tobytes())


def pages_and_faults(data: bytes) -> Iterator[Page | tuple[int | None, Exception]]:
    """The pages of a file in the order of its directories; (number, fault) for one that can't be read, and at the end
    (none, fault) if the chain of directories is broken. Samples of less than a byte become bytes."""
    number = 0
    try:
        for order, tags in directories(data):
            try:
                yield _page(data, number, order, tags)
            except Exception as e:  # whatever a broken page leads to stays with it
                yield number, e
            number += 1
    except (ValueError, struct.error) as e:
        yield None, e


def read_pages(data: bytes) -> Iterator[Page]:
    """The pages of a file in the order of its directories; ValueError at the first that can't be read."""
    for page in pages_and_faults(data):
        if not isinstance(page, Page):
            raise page[1] if isinstance(page[1], ValueError) else ValueError(f"{type(page[1]).__name__}: {page[1]}")
        yield page


# --- writer ---------------------------------------------------------------------------------------------------------


class Layout(NamedTuple):
    compression: int = DEFLATE
    predictor: int = 1
    tile: int = 0  # side of square tiles, a multiple of 16; 0: strips
    rows_per_strip: int = 64


def _encode(data: bytes, compression: int) -> bytes:
    return {PLAIN: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda x: zlib.compress(x, 6)}[compression](data)


def write_tiff(pages: list[tuple[np.ndarray, Layout]], order: str = "<") -> bytes:
    """A file of pages (height, width, samples) of 8-bit samples, each in its own layout."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 8))
    link = 4
    for pixels, layout in pages:
        height, width, samples = pixels.shape
        if layout.tile:
            t = layout.tile
            padded = np.zeros((-(-height // t) * t, -(-width // t) * t, samples), np.uint8)
            padded[:height, :width] = pixels
            blocks = [padded[y : y + t, x : x + t] for y in range(0, height, t) for x in range(0, width, t)]
        else:
            blocks = [pixels[y : y + layout.rows_per_strip] for y in range(0, height, layout.rows_per_strip)]
        if layout.predictor == 2:
            blocks = [np.diff(b, axis=1, prepend=np.zeros((b.shape[0], 1, samples), np.uint8)) for b in blocks]
        offsets, counts = [], []
        for block in blocks:
            data = _encode(block.tobytes(), layout.compression)
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        tags: list[tuple[int, int, list[int]]] = [(WIDTH, 4, [width]), (LENGTH, 4, [height]), (BITS, 3, [8] * samples), (COMPRESSION, 3, [layout.compression]), (PHOTOMETRIC, 3, [2 if samples == 3 else 1]), (SAMPLES, 3, [samples]), (PREDICTOR, 3, [layout.predictor])]
        if layout.tile:
            tags += [(TILE_WIDTH, 4, [layout.tile]), (TILE_LENGTH, 4, [layout.tile]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)]
        else:
            tags += [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, [layout.rows_per_strip]), (STRIP_COUNTS, 4, counts)]
        entries = bytearray()
        for tag, kind, values in sorted(tags):
            data = struct.pack(f"{order}{len(values)}{_TYPES[kind]}", *values)
            if len(data) > 4:
                out += b"\0" * (len(out) % 2)
                place = struct.pack(order + "I", len(out))
                out += data
            else:
                place = data.ljust(4, b"\0")
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + place
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags)) + entries
        link = len(out)
        out += b"\0" * 4
    return bytes(out)


# --- Spark ----------------------------------------------------------------------------------------------------------

PAGES = "page int, width int, height int, samples int, bits int, compression int, pixels binary, error string"
_PAGES = [("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("samples", pa.int32()), ("bits", pa.int32()), ("compression", pa.int32()), ("pixels", pa.binary()), ("error", pa.string())]


def tiff_pages(media: DataFrame, column: str = "media") -> DataFrame:
    """One row per page of the TIFF file in ``column``, after the row's other columns.

    A null file has no pages. A page that can't be read is a row with its number whose ``error`` says what is wrong and
    whose other page columns are null; the pages behind it are read. Where the chain of directories is broken, such a
    row without a number is the last. Rows that repeat are read as often as they
    come; an empty table gives no rows. Other columns whose names clash with the page columns are left out.
    """
    kept = [c for c in media.columns if c != column and c not in dict(_PAGES)]
    source = limit_batches(media).select(*kept, column)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            which: list[int] = []
            size = 0

            def flush() -> pa.RecordBatch:
                carried = [batch.column(i).take(pa.array(which, pa.int64())) for i in range(len(kept))]
                out = pa.RecordBatch.from_arrays([*carried, *(pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _PAGES, strict=True))], names=[*kept, *(n for n, _ in _PAGES)])
                rows.clear()
                which.clear()
                return out

            for i, value in enumerate(batch.column(len(kept))):
                for page in pages_and_faults(value.as_py()) if value.is_valid else ():
                    if isinstance(page, Page):
                        rows.append((*page, None))
                        size += len(page.pixels)
                    else:
                        rows.append((page[0], *[None] * 6, f"{type(page[1]).__name__}: {page[1]}"))
                    which.append(i)
                    if size > 16 << 20:
                        yield flush()
                        size = 0
            if rows:
                yield flush()

    return source.mapInArrow(frugal(run), ", ".join(x for x in (fields, PAGES) if x))


#: How texts are stored: pixels of three samples, rows of 192 bytes, pages of at most 288 rows.
BLOCK, ROW, PAGE_BYTES = 576, 192, 288 * 192
#: The layouts that pages take in turn. LZW is decoded code by code in Python, so one page in eight has it.
LAYOUTS = (Layout(DEFLATE, 2), Layout(PACKBITS), Layout(DEFLATE, 1, tile=64), Layout(LZW, 1), Layout(DEFLATE, 1), Layout(PACKBITS, 1, rows_per_strip=16), Layout(DEFLATE, 2, tile=32), Layout(PLAIN))


def payload_of(text: str) -> bytes:
    data = text.encode("utf-8", "surrogatepass")
    return data + b"\xff" * (max(BLOCK, -(-len(data) // BLOCK) * BLOCK) - len(data))


def media_of(payload: bytes) -> bytes:
    """The payload as a TIFF file of one or more pages."""
    turn = len(payload) // BLOCK
    return write_tiff([(np.frombuffer(payload[at : at + PAGE_BYTES], np.uint8).reshape(-1, ROW // 3, 3), LAYOUTS[(turn + k) % len(LAYOUTS)]) for k, at in enumerate(range(0, len(payload), PAGE_BYTES))])


def feature_of(payload: bytes) -> str:
    """Mean and a difference hash: whether the mean brightness rises between neighbours of 65 equal spans."""
    data = np.frombuffer(payload, np.uint8)
    edges = np.arange(65) * len(data) // 65
    means = np.add.reduceat(data, edges, dtype=np.int64) / np.diff(np.append(edges, len(data)))
    return f"{data.mean():.3f}-{np.packbits(means[1:] > means[:-1]).tobytes().hex()}"


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every text of ``docs`` (doc_id, text) as a TIFF file, written to the shared folder.

    A null or empty text is one block of bytes 255. Null and repeated doc_ids are carried; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(1).to_pylist()
                media = [media_of(payload_of(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return written(limit_batches(docs).select("doc_id", text_of().alias("text")).mapInArrow(frugal(run), "doc_id long, n_bytes long, media binary"), "tiff")


def stored_digests(media: DataFrame) -> DataFrame:
    """Digests and a feature of the payloads that the stored files give back: their pages one after another.

    One row for every row of ``media`` (doc_id, n_bytes, media of :func:`store_texts`), repeated and null ids as they are;
    an empty table gives no rows. A file that is not whole is an error: it was written here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2):
                data = value.as_py()
                pages = list(read_pages(data))
                payload = b"".join(p.pixels for p in pages)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature_of(payload), len(pages)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_pages"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True))], names=["doc_id", "n_bytes", *names])

    return limit_batches(media).select("doc_id", "n_bytes", F.col("media")).mapInArrow(frugal(run), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages int")
