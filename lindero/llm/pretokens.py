"""Splitting and encoding of many texts at once, with numpy.

The pre-tokens of a batch of texts are found by comparing the classes of neighbouring characters, hashed by prefix
sums, and looked up in an open-addressing table that holds the ids of the pre-tokens seen before. A hash only says where
to look: what is found there counts if its characters are the pre-token's. Only pre-tokens that are not there reach the
encoder. Texts with contractions or with characters whose class depends on the Unicode version go to the encoder as a
whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import regex

#: The split made here with ``joined`` (fixed value of byte-level vocabularies).
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters encoded at once: bounds the memory of a batch (about 100 bytes a character).
BATCH_CHARS = 1 << 19
#: Texts with characters from here on are not split here.
FAMILIAR = 0x530
#: Longer pre-tokens are encoded each time they come.
LONGEST = 64
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
_CONTRACTION = regex.compile(r"'(?:[stmd]|re|ve|ll)")
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point; the last entry stands for all that are not familiar."""
    kinds = [(regex.compile(p), k) for p, k in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE))]
    return np.array([next((k for p, k in kinds if p.match(chr(c))), _OTHER) for c in range(FAMILIAR)], np.uint8)


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, a random value for each code point."""

    def __init__(self, base: int, seed: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.values = _mixed(np.arange(FAMILIAR, dtype=_U) + _U(seed))
        self.up = self.down = np.ones(1, _U)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, self.base, _U)]))
                self.down = np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, self.inverse, _U)]))

    def hashes(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        sums = np.empty(len(codes) + 1, _U)
        sums[0] = 0
        np.cumsum(self.values[codes] * self.up[: len(codes)], out=sums[1:])
        return _mixed((sums[last] - sums[first]) * self.down[first])


def same_characters(codes: np.ndarray, first: np.ndarray, length: np.ndarray, chars: np.ndarray, at: np.ndarray, its: np.ndarray) -> np.ndarray:
    """Whether ``length`` codes from ``first`` on are the ``its`` characters from ``at`` on, for each pair of them."""
    out = length == its
    rows = np.flatnonzero(out)
    n = length[rows]
    if not len(rows):
        return out
    begins = np.cumsum(n) - n
    within = np.arange(int(n.sum())) - np.repeat(begins, n)
    differ = codes[np.repeat(first[rows], n) + within] != chars[np.repeat(at[rows], n) + within]
    out[rows] = ~np.logical_or.reduceat(differ, begins)
    return out


class VectorEncoder:
    """``encode_missing`` gives the ids of distinct pre-tokens, ``encode_whole`` those of a text that isn't split here.

    ``joined``: a space before a run belongs to it and white space is kept (byte-level split); else white space is
    dropped and digits stand alone. At most ``limit`` pre-tokens are kept (about 80 bytes each); when that many are
    known, further ones are encoded each time they come. ``direct``: gives the ids of the pre-tokens that have one id of
    their own, -1 for others, from (hashes, codes, first positions, lengths), before the table is asked.
    """

    def __init__(self, joined: bool, encode_missing: Callable[[list[str]], Sequence[Sequence[int]]], encode_whole: Callable[[str], Sequence[int]], dtype: np.dtype, limit: int = 1_000_000, direct: Callable[..., np.ndarray] | None = None):
        self.direct = direct
        self.joined, self.encode_missing, self.encode_whole, self.dtype, self.limit = joined, encode_missing, encode_whole, dtype, limit
        self.bits = max(8, int(2 * limit).bit_length())
        self.keys, self.checks, self.at = np.zeros(1 << self.bits, _U), np.zeros(1 << self.bits, _U), np.full(1 << self.bits, -1, np.int32)
        self.offsets, self.lengths, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(4096, dtype)
        self.char_at, self.char_n, self.chars = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(4096, np.uint16)
        self.n, self.used, self.char_used = 0, 0, 0
        self.powers = (_Powers(0x9E3779B97F4A7C15, 1), _Powers(0xC2B2AE3D27D4EB4F, 1 << 32))

    def _spans(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of each pre-token; ``starts``: where texts begin (none is empty)."""
        kind = _classes()[codes]
        edge = np.zeros(len(codes) + 1, bool)  # a text begins or ends here
        edge[starts] = edge[-1] = True
        turn = edge.copy()
        turn[1:-1] |= kind[1:] != kind[:-1]
        if self.joined:
            space = kind == _SPACE
            before = np.zeros(len(codes) + 1, bool)  # a plain space of the same text stands before
            before[1:] = codes == 32
            before &= ~edge
            begins = turn[:-1] & (space | ~before[:-1])
            begins |= space & turn[1:] & ~edge[1:]  # the last of a run of white space before something else
            first = np.flatnonzero(begins)
            return first, np.append(first[1:], len(codes))
        number = kind == _NUMBER
        begins, ends = turn[:-1] | number, turn[1:] | number
        solid = kind != _SPACE
        return np.flatnonzero(begins & solid), np.flatnonzero(ends & solid) + 1

    def hashed(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
        """Two hashes of the codes between each ``first`` and ``last``."""
        with np.errstate(over="ignore"):
            for p in self.powers:
                p.grow(len(codes) + 1)
            return [p.hashes(codes, first, last) for p in self.powers]

    def _find(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Index of each known pre-token, or -1."""
        slot = (h >> _U(64 - self.bits)).astype(np.int64)
        out = self.at[slot]
        wrong = np.flatnonzero((out >= 0) & ((self.keys[slot] != h) | (self.checks[slot] != check)))
        mask = (1 << self.bits) - 1
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & mask
            s = slot[wrong]
            out[wrong] = self.at[s]
            wrong = wrong[(out[wrong] >= 0) & ((self.keys[s] != h[wrong]) | (self.checks[s] != check[wrong]))]
        return out

    def _keep(self, h: np.ndarray, check: np.ndarray, index: np.ndarray) -> None:
        """Put distinct new pre-tokens into the table."""
        slot, left, mask = (h >> _U(64 - self.bits)).astype(np.int64), np.arange(len(h)), (1 << self.bits) - 1
        while len(left):
            free = left[self.at[slot[left]] < 0]
            _, one = np.unique(slot[free], return_index=True)
            won = free[one]
            self.keys[slot[won]], self.checks[slot[won]], self.at[slot[won]] = h[won], check[won], index[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & mask

    def _append(self, ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, int, int]:
        """Add the ids of pre-tokens behind the known ones; their indices, and how much is in use if they are kept."""
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for y in ids for x in y), self.dtype, int(lengths.sum()))
        while self.n + len(ids) > len(self.offsets):
            self.offsets, self.lengths = np.concatenate([self.offsets, self.offsets]), np.concatenate([self.lengths, self.lengths])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.offsets[self.n : self.n + len(ids)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.n : self.n + len(ids)] = lengths
        self.flat[self.used : self.used + len(flat)] = flat
        return np.arange(self.n, self.n + len(ids), dtype=np.int32), self.n + len(ids), self.used + len(flat)

    def _append_characters(self, words: list[str]) -> None:
        """The characters of the ``words`` whose ids come behind the known ones."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16)
        while self.n + len(words) > len(self.char_at):
            self.char_at, self.char_n = np.concatenate([self.char_at, self.char_at]), np.concatenate([self.char_n, self.char_n])
        while self.char_used + len(chars) > len(self.chars):
            self.chars = np.concatenate([self.chars, self.chars])
        self.char_at[self.n : self.n + len(words)] = self.char_used + np.cumsum(lengths) - lengths
        self.char_n[self.n : self.n + len(words)] = lengths
        self.chars[self.char_used : self.char_used + len(chars)] = chars
        self.char_used += len(chars)

    def _lookup(self, h: np.ndarray, check: np.ndarray, codes: np.ndarray, first: np.ndarray, length: np.ndarray, joined: str) -> np.ndarray:
        """Where the ids of each pre-token stand, of new ones behind the known ones."""
        index = self._find(h, check)
        unknown = index < 0
        known = np.flatnonzero(~unknown)
        at = index[known]
        index[known[~same_characters(codes, first[known], length[known], self.chars, self.char_at[at], self.char_n[at])]] = -1
        missing = np.flatnonzero(index < 0)
        if not len(missing):
            return index
        numbers: dict[str, int] = {}
        back = [numbers.setdefault(joined[a : a + n], len(numbers)) for a, n in zip(first[missing].tolist(), length[missing].tolist(), strict=True)]
        words, back = list(numbers), np.array(back)
        # First those that the table can take: not too long, and no other pre-token with their hashes there.
        one = np.full(len(words), len(h), np.int64)
        np.minimum.at(one, back, missing)
        fresh = unknown[one] & (length[one] <= LONGEST)
        order = np.argsort(~fresh, kind="stable")
        places, _, _ = self._append(self.encode_missing([words[i] for i in order.tolist()]))
        place_of = np.empty(len(words), np.int32)
        place_of[order] = places
        index[missing] = place_of[back]
        k = int(fresh.sum())
        if k and self.n + k <= self.limit:
            kept = order[:k]
            self._append_characters([words[i] for i in kept.tolist()])
            self._keep(h[one[kept]], check[one[kept]], places[:k])
            last = places[k - 1]
            self.n, self.used = self.n + k, int(self.offsets[last] + self.lengths[last])
        return index

    def _familiar(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, str, list[int]]:
        """Codes of the texts that are split here, where they begin, their numbers, their text, and the others' numbers."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(lengths)
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(codes >= FAMILIAR), "right")).tolist()
        if "'" in joined:
            odd = sorted({*odd, *(i for i, t in enumerate(texts) if "'" in t and _CONTRACTION.search(t))})
        if odd:
            rest = sorted(set(range(len(texts))) - set(odd))
            codes, starts, _, joined, _ = self._familiar([texts[i] for i in rest]) if rest else (codes[:0], lengths[:0], None, "", None)
            return codes, starts, np.array(rest, np.int64), joined, odd
        return codes, ends - lengths, np.arange(len(texts)), joined, odd

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out = [np.zeros(0, self.dtype)] * len(texts)
        codes, starts, numbers, joined, odd = self._familiar(texts)
        for i in odd:
            out[i] = np.asarray(self.encode_whole(texts[i]), self.dtype)
        if not len(codes):
            return out
        bounds = np.append(starts, len(codes))
        filled = bounds[:-1] < bounds[1:]
        first, last = self._spans(codes, starts[filled])
        h, check = self.hashed(codes, first, last)
        codes, length = codes.astype(np.uint16), last - first
        own = self.direct(h, codes, first, length) if self.direct else np.full(len(h), -1, np.int64)
        rest = np.flatnonzero(own < 0)
        index = self._lookup(h[rest], check[rest], codes, first[rest], length[rest], joined)
        lengths = np.ones(len(h), np.int64)
        lengths[rest] = self.lengths[index]
        ends = np.cumsum(lengths)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, self.dtype)
        flat[(ends - lengths)[own >= 0]] = own[own >= 0]
        n = lengths[rest]
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        flat[np.repeat((ends - lengths)[rest], n) + within] = self.flat[np.repeat(self.offsets[index], n) + within]
        cuts = np.concatenate([[0], ends])[np.searchsorted(first, bounds)].tolist()
        for i, a, b in zip(numbers.tolist(), cuts, cuts[1:], strict=False):
            out[i] = flat[a:b]
        return out


def batches_of(texts: Iterable[str], chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Texts in lists of about ``chars`` characters; a longer text stands alone."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def in_order(encoder, texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The ids of each text, one after another."""
    for part in batches_of(texts):
        yield from encoder.encode_many(part)
