"""Packing of documents into training sequences by minimum bin slack.

A document's ids are cut into pieces of a whole sequence and a remainder. The remainders of a window of documents are
packed bin by bin: the longest remaining one opens the bin, then dynamic programming over a bitset (bit s is set if
some multiset of remaining lengths sums to s) finds the fill closest to the capacity, and walking back through the
bitsets gives how many pieces of each length it takes. A pattern is used as often as the counts allow. What a window
leaves in bins that are not full goes to the next window. Where that is most of a window, and at the end of a partition,
such bins keep the pieces that were chosen for them and are topped up by one cut piece, whose rest is cut further before
another piece is; what is less than a sequence is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import frugal, limit_batches, text_of
from .pretokens import in_order
from .wordcache import word_cache

#: Ids in remainders after which a window is packed: bounds a task's memory.
WINDOW_TOKENS = 1 << 22


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset {length: how many} with the largest sum up to ``capacity``, longer lengths taken first.

    ``counts`` says how many pieces of each length there are. The search ends once the capacity is met.
    """
    mask, reach = (1 << capacity + 1) - 1, 1
    steps: list[tuple[int, int, int]] = []  # length, how many at once, sums reachable before
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        batch = 1
        while left > 0:
            take = min(batch, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left -= take
            batch *= 2
            if reach >> capacity:
                break
        if reach >> capacity:
            break
    total, picked = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            picked[length] += take
            total -= length * take
    return dict(picked)


def minimum_slack(lengths: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Patterns ({length: how many}, times used) that pack all pieces; every pattern holds the longest piece left."""
    left = {k: v for k, v in lengths.items() if v}
    while left:
        top = max(left)
        left[top] -= 1
        pattern = best_fill({k: v for k, v in left.items() if v and k <= capacity - top}, capacity - top)
        left[top] += 1
        pattern[top] = pattern.get(top, 0) + 1
        times = min(left[k] // v for k, v in pattern.items())
        for k, v in pattern.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
        yield pattern, times


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096, with_ids: bool = False, window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of ``capacity`` ids; one row per piece, with its ids if wanted.

    Each input split is packed for itself, in windows; nothing is shuffled. A null text is empty and gives the end id
    alone; a null doc_id is carried as null; rows that repeat are packed as often as they come; an empty table gives no
    rows; a text of any length is cut. Pieces of a sequence lie one after another from offset 0. Other columns are
    not read. Sequences are full but for those that are as long as a power of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer)
        end = np.array([end_id], cache.dtype)
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        kept: dict[int, deque] = defaultdict(deque)  # by length: (doc, start, ids, tokens of the document)
        held = 0

        def put(doc: tuple, at: int, first: int = 0, last: int | None = None) -> int:
            doc_id, start, ids, total = doc
            part = ids[first:last].astype("<u4")
            rows.append((doc_id, start + first, len(part), zlib.crc32(part), total, sequence, at, *([part.tolist()] if with_ids else [])))
            return at + len(part)

        def topped_up() -> None:
            """Bins of what is kept, while it fills one: the closest fill, then a cut piece."""
            nonlocal sequence, held
            rest = 0  # length of the piece that a bin before this one was topped up from
            while held >= capacity:
                counts = {k: len(v) for k, v in kept.items() if v}
                top = max(counts)
                counts[top] -= 1
                pattern = best_fill({k: v for k, v in counts.items() if v and k <= capacity - top}, capacity - top)
                pattern[top] = pattern.get(top, 0) + 1
                at = 0
                for k, n in pattern.items():
                    for _ in range(n):
                        at = put(kept[k].popleft(), at)
                if slack := capacity - at:  # every piece that is left is longer
                    k = rest if kept[rest] else max(k for k, v in kept.items() if v)
                    doc_id, start, ids, total = doc = kept[k].pop()
                    put(doc, at, 0, slack)
                    rest = k - slack
                    kept[rest].append((doc_id, start + slack, ids[slack:], total))
                held -= capacity
                sequence += 1

        def window(final: bool) -> None:
            nonlocal sequence, held
            before, over = held, []
            for pattern, times in minimum_slack({k: len(v) for k, v in kept.items() if v}, capacity):
                if sum(k * n for k, n in pattern.items()) < capacity:
                    over += [kept[k].popleft() for k, n in pattern.items() for _ in range(n * times)]
                    continue
                for _ in range(times):
                    at = 0
                    for k, n in pattern.items():
                        for _ in range(n):
                            at = put(kept[k].popleft(), at)
                    sequence += 1
            kept.clear()
            held = 0
            for doc in over:
                kept[len(doc[2])].append(doc)
                held += len(doc[2])
            if final or held > before // 2:  # lengths that never fill a sequence
                topped_up()
            if not final:
                return
            over = [doc for k in sorted(kept, reverse=True) for doc in kept[k]]
            kept.clear()
            held = 0
            room, at = _sizes(sum(len(doc[2]) for doc in over), capacity), 0
            size = next(room, 0)
            for doc in over:  # cut where a sequence ends
                first = 0
                while first < len(doc[2]):
                    last = min(len(doc[2]), first + size - at)
                    at = put(doc, at, first, last)
                    first = last
                    if at == size:
                        size, at = next(room, 0), 0
                        sequence += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [*_PIECES, *([("ids", pa.list_(pa.int64()))] if with_ids else [])]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), in_order(cache, batch.column(1).to_pylist()), strict=True):
                ids = np.concatenate([ids, end])
                for start in range(0, len(ids) - capacity + 1, capacity):
                    put((doc_id, start, ids[start : start + capacity], len(ids)), 0)
                    sequence += 1
                if rest := len(ids) % capacity:
                    kept[rest].append((doc_id, len(ids) - rest, ids[len(ids) - rest :].copy(), len(ids)))
                    held += rest
                if held >= window_tokens:
                    window(final=False)
            if len(rows) >= (500 if with_ids else 20_000):
                yield batch_of()
        window(final=True)
        if rows:
            yield batch_of()

    return limit_batches(docs).select("doc_id", text_of().alias("text")).mapInArrow(frugal(run), PIECES + (", ids array<long>" if with_ids else ""))


def _sizes(total: int, capacity: int) -> Iterator[int]:
    """Lengths of sequences for ``total`` ids: full ones, then powers of two."""
    yield from [capacity] * (total // capacity)
    for bit in reversed(range(capacity.bit_length())):
        if total % capacity >> bit & 1:
            yield 1 << bit
