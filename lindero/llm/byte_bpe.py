"""Byte-level BPE from a rank file, with two tiers.

Tier one: a minimal perfect hash over the vocabulary gives the one place where a pre-token could stand; if its bytes
stand there, its rank is its only id. Tier two: the pre-tokens that miss start as bytes in a linked list, and a heap
yields the pair with the lowest rank, leftmost first, until no adjacent pair is in the vocabulary. A batch asks tier one
for all its pre-tokens at once; what tier two gave for a pre-token is kept under its characters (bounded).
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from contextlib import suppress
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import CACHES, filesystem, frugal, limit_batches, text_of
from .pretokens import BYTE_LEVEL_SPLIT, FAMILIAR, VectorEncoder, in_order, same_characters

_MIX, _FOLD, _MASK = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


def _slot(h: int, pilot: int, n: int) -> int:
    h = (h ^ pilot * _MIX) & _MASK
    h = (h ^ h >> 32) * _FOLD & _MASK
    return (h >> 32) % n


class PerfectHash:
    """Minimal perfect hash by displacement: keys fall into buckets, largest first each bucket tries pilots until its
    keys land on free slots; a bucket with one key stores the slot itself (as a negative pilot). Of n slots none stays
    free. ``find`` gives the key's index in ``keys``, or -1 for what is not a key."""

    def __init__(self, keys: list[bytes], load: int = 3, hashes: list[int] | None = None):
        """``hashes``: 64-bit numbers of the keys, all different, if they are not to be the keys' XXH3."""
        self.n, self.m, self.keys = len(keys), len(keys) // load + 1, keys
        buckets: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, h in enumerate(map(xxhash.xxh3_64_intdigest, keys) if hashes is None else hashes):
            buckets[h % self.m].append((h, i))
        self.pilots, self.index = np.zeros(self.m, np.int32), np.full(self.n, -1, np.int32)
        free: list[int] | None = None
        for b, members in sorted(buckets.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:
                if free is None:
                    free = np.flatnonzero(self.index < 0).tolist()
                slot = free.pop()
                self.pilots[b], self.index[slot] = -slot - 1, members[0][1]
                continue
            pilot = 0
            while True:
                slots = {_slot(h, pilot, self.n) for h, _ in members}
                if len(slots) == len(members) and all(self.index[s] < 0 for s in slots):
                    break
                pilot += 1
            self.pilots[b] = pilot
            for h, i in members:
                self.index[_slot(h, pilot, self.n)] = i
        self._pilots, self._index = self.pilots.tolist(), self.index.tolist()

    def find(self, key: bytes) -> int:
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        pilot = self._pilots[h % self.m]
        i = self._index[-pilot - 1 if pilot < 0 else _slot(h, pilot, self.n)]
        return i if self.keys[i] == key else -1


class Vocabulary:
    """Tier one for many pre-tokens at once: the entries that are text of familiar characters under a minimal perfect
    hash of the hashes that ``encoder`` makes of pre-tokens. Entries whose hashes are equal stay out, all but one: tier
    two finds their ids, too."""

    def __init__(self, ranks: dict[bytes, int], encoder: VectorEncoder):
        words: dict[str, int] = {}
        for data, rank in ranks.items():
            with suppress(UnicodeDecodeError):
                word = data.decode()
                if word and max(map(ord, word)) < FAMILIAR:
                    words[word] = rank
        length = np.fromiter(map(len, words), np.int64, len(words))
        at = np.cumsum(length) - length
        chars = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)
        h = encoder.hashed(chars, at, at + length)[0]
        _, one = np.unique(h, return_index=True)
        self.chars, self.at, self.length, self.rank = chars, at[one], length[one], np.fromiter(words.values(), np.int64, len(words))[one]
        table = PerfectHash([b""] * len(one), hashes=h[one].tolist())
        self.pilots, self.index, self.n, self.m = table.pilots.astype(np.int64), table.index, np.uint64(max(1, table.n)), np.uint64(table.m)

    def __call__(self, h: np.ndarray, codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        if not len(self.index):
            return np.full(len(h), -1, np.int64)
        pilot = self.pilots[(h % self.m).astype(np.int64)]
        with np.errstate(over="ignore"):
            x = h ^ pilot.astype(np.uint64) * np.uint64(_MIX)
            x = (x ^ x >> np.uint64(32)) * np.uint64(_FOLD)
        i = self.index[np.where(pilot < 0, -pilot - 1, ((x >> np.uint64(32)) % self.n).astype(np.int64))]
        return np.where(same_characters(codes, first, length, self.chars, self.at[i], self.length[i]), self.rank[i], -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of ``piece`` after all merges, by a heap over linked bytes."""
    n = len(piece)
    nxt, prv = list(range(1, n + 2)), list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    gone = bytearray(n + 1)
    while heap:
        _, i, mid, end = heappop(heap)
        if gone[i] or nxt[i] != mid or gone[mid] or nxt[mid] != end:
            continue  # one of its halves has been merged meanwhile
        gone[mid], nxt[i] = 1, end
        if end < n:
            prv[end] = i
            if (r := ranks.get(piece[i : nxt[end]])) is not None:
                heappush(heap, (r, i, end, nxt[end]))
        if i and (r := ranks.get(piece[prv[i] : end])) is not None:
            heappush(heap, (r, prv[i], i, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : nxt[i]]])
        i = nxt[i]
    return out


class ByteBPE:
    """Ids by the ranks of a file. Texts are split by ``pattern``; the split of PATTERN below is made for many texts at
    once (see :mod:`.pretokens`), any other by the pattern itself."""

    def __init__(self, path: str, pattern: str):
        store, inner = filesystem(path)
        with store.open_input_stream(inner) as f:
            lines = f.read().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.table, self.ids_of = PerfectHash(list(self.ranks)), list(self.ranks.values())
        self.vocabulary = {i: w for w, i in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.dtype = np.dtype("<u2" if max(self.ids_of) < 1 << 16 else "<u4")
        self.vector = VectorEncoder(True, lambda words: [self.piece(w.encode()) for w in words], self.whole, self.dtype) if pattern == BYTE_LEVEL_SPLIT else None
        if self.vector:
            self.vector.direct = Vocabulary(self.ranks, self.vector)

    def piece(self, word: bytes) -> list[int]:
        """The ids of a pre-token: its own if it is in the vocabulary, else those that merging its bytes gives."""
        at = self.table.find(word)
        return [self.ids_of[at]] if at >= 0 else merge(word, self.ranks)

    def whole(self, text: str) -> list[int]:
        return [i for word in self.find(text) for i in self.piece(word.encode())]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        return self.vector.encode_many(texts) if self.vector else [np.array(self.whole(t), self.dtype) for t in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``; KeyError if one is not in the vocabulary."""
        return b"".join(map(self.vocabulary.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBPE:
    """One codec in each worker process."""
    return ByteBPE(path, pattern)


CACHES["codecs"] = codec.cache_clear


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids array<int>`` for every row of ``docs`` (doc_id, text).

    A null or empty text has no ids; null and repeated doc_ids are carried as they are; an empty table gives no rows;
    a text of any length is encoded whole; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [x.astype(np.int32) for x in in_order(bpe, part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return limit_batches(docs).select("doc_id", text_of().alias("text")).mapInArrow(frugal(run), "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``bytes binary`` for every row of ``coded`` (doc_id, ids).

    Null ids are none and give no bytes; a row with an id that is null or not in the vocabulary gives null. Null and
    repeated doc_ids are carried as they are; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path, pattern).vocabulary
        for batch in batches:
            data = []
            for row in batch.column(1).to_pylist():
                parts = [words.get(i) for i in row or []]
                data.append(None if None in parts else b"".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "bytes"])

    return limit_batches(coded).select("doc_id", "ids").mapInArrow(frugal(run), "doc_id long, bytes binary")


def round_trip_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every text, decode its ids, and return digests of both; rows and nulls as in :func:`encode`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            n, coded, decoded = [], [], []
            for ids in in_order(bpe, batch.column(1).to_pylist()):
                n.append(len(ids))
                coded.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return limit_batches(docs).select("doc_id", text_of().alias("text")).mapInArrow(frugal(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
