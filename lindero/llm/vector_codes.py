"""Product codes of vectors, their codebooks fitted by rounds of nearest entries found through a VA file.

A codebook's entries are known by cells: each coordinate's values are cut into at most ``CELLS`` intervals, and an entry
is a row of cell numbers. A query part has a table with the least and the greatest squared distance of each of its
coordinates to each cell; sums over an entry's cells bound its distance from below and above. Only entries whose lower
bound does not exceed the least upper bound are refined by their distances in whole numbers, so the nearest entry
(the lowest index of equals) is never lost.

Vectors stay where they lie: a round is one scan whose tasks send sums a part and entry, and the codebooks, which have
one bounded size, go back with the next round's tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, limit_batches, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Intervals of a coordinate in the VA file: four bits.
CELLS = 16


class Cells(NamedTuple):
    """The VA file of one part's codebook (entries x coordinates)."""

    entries: np.ndarray
    cell: np.ndarray  # of each entry and coordinate
    low: np.ndarray  # least value in each coordinate's cells
    high: np.ndarray


def quantised(entries: np.ndarray, cells: int = CELLS) -> Cells:
    """Cells of about equally many different values, as wide as what lies in them."""
    cell = np.zeros(entries.shape, np.int64)
    low, high = (np.zeros((entries.shape[1], cells), np.int64) for _ in range(2))
    for j in range(entries.shape[1]):
        values = np.unique(entries[:, j])
        of = np.arange(len(values)) * min(cells, len(values)) // len(values)
        cell[:, j] = of[np.searchsorted(values, entries[:, j])]
        for c in range(of[-1] + 1):
            low[j, c], high[j, c] = values[of == c][0], values[of == c][-1]
        low[j, of[-1] + 1 :], high[j, of[-1] + 1 :] = low[j, of[-1]], high[j, of[-1]]
    return Cells(entries, cell, low, high)


def candidates(parts: np.ndarray, va: Cells) -> np.ndarray:
    """Which entries (columns) may be nearest to which parts (rows)."""
    lower = np.zeros((len(parts), len(va.entries)), np.int64)
    upper = np.zeros_like(lower)
    for j in range(parts.shape[1]):
        below, above = va.low[j] - parts[:, j, None], parts[:, j, None] - va.high[j]
        near = np.maximum(np.maximum(below, above), 0) ** 2
        far = np.maximum(np.abs(below), np.abs(above)) ** 2
        lower += near[:, va.cell[:, j]]
        upper += far[:, va.cell[:, j]]
    return lower <= upper.min(axis=1, keepdims=True)


def nearest(parts: np.ndarray, va: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and the squared distance to it, for each row of ``parts``."""
    row, entry = np.nonzero(candidates(parts, va))
    distance = ((parts[row] - va.entries[entry]) ** 2).sum(axis=1)
    starts = np.searchsorted(row, np.arange(len(parts)))
    least = np.minimum.reduceat(distance, starts) if len(parts) else distance
    hits = np.flatnonzero(distance == least[row])
    first = hits[np.searchsorted(row[hits], np.arange(len(parts)))]
    return entry[first], least


def whole(vectors: pa.ListArray, width: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that can be coded, their components as whole numbers)."""
    offsets = np.asarray(vectors.offsets)
    sizes = np.diff(offsets)
    fit = sizes == width
    x = np.asarray(vectors.values, np.float64)
    flat = x[offsets[0] : offsets[-1]][np.repeat(fit, sizes)].reshape(-1, width) if width else np.zeros((0, 0))
    scaled = np.floor(flat * SCALE)
    small = (np.abs(scaled) <= most).all(axis=1)
    fit[np.flatnonzero(fit)[~small]] = False
    return fit, scaled[small].astype(np.int64)


def _vectors(embeddings: DataFrame, id_column: str, column: str, label: str) -> DataFrame:
    inf = F.lit(float("inf"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))
    rows = limit_batches(embeddings).select(F.col(id_column).alias("vec_id"), F.col(column).alias("v"), F.col(label).alias("label"))
    return rows.filter(F.col("v").isNotNull() & finite)


def _sums(vectors: DataFrame, books: list[Cells], width: int, most: int) -> list[tuple[int, int, int, int, int]]:
    """(part, entry, position, sum, count) over all vectors: as many rows as the codebooks have numbers."""
    parts, step = len(books), width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, max(len(b.entries) for b in books), step), np.int64)
        counts = np.zeros(sums.shape[:2], np.int64)
        found: list[tuple] = []

        def send() -> None:
            for p, e in zip(*np.nonzero(counts), strict=True):
                found.extend((int(p), int(e), j, int(sums[p, e, j]), int(counts[p, e])) for j in range(step))
            sums[:], counts[:] = 0, 0

        rows = 0
        for batch in batches:
            _, x = whole(batch.column(0), width, most)
            for p, va in enumerate(books):
                at, _ = nearest(x[:, p * step : (p + 1) * step], va)
                np.add.at(sums[p], at, x[:, p * step : (p + 1) * step])
                counts[p] += np.bincount(at, minlength=counts.shape[1])
            rows += len(x)
            if rows > 1 << 24:  # sums of so many components fit
                send()
                rows = 0
        send()
        names = ["part", "entry", "position", "total", "n"]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), [pa.int32()] * 3 + [pa.int64()] * 2, strict=True)], names=names)

    each = vectors.select("v").mapInArrow(frugal(run), "part int, entry int, position int, total long, n long")
    return each.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()


def fitted(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[Cells], int, int]:
    """(codebooks of the parts, width of the vectors, greatest size of a component). The first ``entries`` vectors are all
    that is taken as rows."""
    fit = (F.size("v") > 0) & (F.size("v") % parts == 0)
    first = vectors.filter(fit).orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v")).first()
    if first is None:
        return [], 0, 0
    width = first[0]
    most = math.isqrt((1 << 62) // width) // 2  # sums of squared differences fit in 63 bits
    inside = F.forall("v", lambda x: F.abs(F.floor(x.cast("double") * SCALE)) <= most)
    rows = vectors.filter((F.size("v") == width) & inside).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not rows:
        return [], width, most
    start = np.floor(np.array([r[0] for r in rows], np.float64) * SCALE).astype(np.int64)
    books = [quantised(x) for x in np.split(start, parts, axis=1)]
    for _ in range(rounds):
        now = [b.entries.copy() for b in books]
        for r in _sums(vectors, books, width, most):
            now[r["part"]][r["entry"], r["position"]] = int(r["total"]) // r["n"]
        books = [quantised(x) for x in now]
    return books, width, most


def coded(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every row of ``embeddings`` whose vector is there and finite.

    The codebooks start as the vectors with the smallest ids (equal ids by their components, null ids last), all of them
    where there are fewer. Vectors have the length of the first one that can be cut into ``parts``; rows of another
    length, or with components too large for sums of squares in 64 bits, stay with a null code and error and count in no
    sum. Repeated rows are coded each. Rows without a label form one group. An empty table gives no rows. Other columns
    are not read. A label's rows are summed before the shuffle and met in several tasks.
    """
    vectors = _vectors(embeddings, id_column, column, label)
    books, width, most = fitted(vectors, parts, entries, rounds)
    said = hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit, x = whole(batch.column(2), width if books else 0, most)
            codes, errors = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p, va in enumerate(books):
                at, distance = nearest(x[:, p * (width // parts) : (p + 1) * (width // parts)], va)
                codes[:, p] = at
                errors += distance
            place = np.where(fit, np.cumsum(fit) - 1, -1).tolist()
            texts, numbers = [c.tobytes().hex() for c in codes], errors.tolist()
            both = [pa.array([texts[i] if i >= 0 else None for i in place], pa.string()), pa.array([numbers[i] if i >= 0 else None for i in place], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *both], names=["vec_id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    rows = written(vectors.select("vec_id", "label", "v").mapInArrow(frugal(run), f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long"), "codes")
    salts = 8
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).select("label", "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int")).alias("r")
    out = dealt.join(sums.alias("s").hint("merge"), F.col("r.label").eqNullSafe(F.col("s.label")) & (F.col("r.salt") == F.col("s.salt")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(said).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in SQL, every part against every entry."""
    out = [
        f"k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * x) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS q FROM k, (SELECT unnest(range({parts})) AS part))",
        f"c0 AS (SELECT part, entry, q AS c FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k QUALIFY entry < {entries}) USING (vec_id))",
    ]
    near = "list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(rounds + 1):
        out.append(f"a{r} AS (SELECT vec_id, any_value(label) AS label, p.part, any_value(q) AS q, min(CAST({near} AS BIGINT) * {entries} + entry) AS best FROM p JOIN c{r} USING (part) GROUP BY vec_id, p.part)")
        if r < rounds:
            out.append(f"m{r} AS (SELECT part, best % {entries} AS entry, j, sum(q[j]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, (SELECT max(len(q)) FROM p) + 1)) AS j) GROUP BY ALL)")
            out.append(f"n{r} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM m{r} GROUP BY 1, 2)")
            out.append(f"c{r + 1} AS (SELECT o.part, o.entry, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN n{r} n ON n.part = o.part AND n.entry = o.entry)")
    out.append(f"e AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    head = "WITH " + ",\n    ".join(out)
    return head + f"\n    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256 FROM e"
