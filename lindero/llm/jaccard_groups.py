"""Set similarity join on word shingles with a token-group matrix.

Distinct shingle sets are partitioned into groups of similar sets: each set has a few sketches (pairs of min-hashes) and
goes to the group of the sketch that most sets have, so that a family of near copies is a few groups, whatever its size.
The matrix says which groups hold a token. Only tokens that a qualifying pair must share are put into it: sets are
ordered by one order of all tokens (those that many texts hold last), and two sets within the threshold share some of
the first tokens of each. A row of the matrix stands for all members of a group with a token and a size, so a token that
a whole family holds is a few rows. Where groups meet in the matrix, or members of one group do, texts are read again:
members are compared with their group's pivot and within their part of the group, and pivots with each other; what is
connected by then needs no further look. For the rest, each query set's overlap with the token union of a part of a group bounds its overlap with any member,
and the part is opened for it only if the bound reaches the least overlap. No link between two texts that would join two
components is dropped.

Words are known by 64 bits of a keyed BLAKE2b under a key that is drawn anew for each run and stands nowhere, shingles by
a mix of their words' hashes, sets by 128-bit digests of their shingles. So nobody can write two words that are taken for
one; that any two given words are has a chance of 2**-64.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHES, frugal, joined, limit_batches, partitions_of, salted_lookup, text_of, written

#: Sets and tokens in a part of a group, about; queries against a part in one task; tokens of a block of the matrix.
PART, PART_TOKENS, QUERIES, BLOCK = 256, 1 << 22, 256, 1 << 19
#: Sketches of a set, each of two min-hashes; tokens that two sets must share among their first ones (fewer at low thresholds).
SKETCHES, SHARED = 4, 4
#: Frequent tokens are counted in blocks of so many tokens, from so many texts of a block on; the most frequent ones, at
#: most this many, come last in the order. The order changes only the cost, never the result; its size is bounded.
COUNT_BLOCK, COUNT_LEAST, FREQUENT = 1 << 20, 6, 150_000
_UPPER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words whose hashes a worker keeps, and the bytes of the longest of them.
KEPT_WORDS, KEPT_BYTES = 100_000, 48


class Words(dict):
    """The hash of each word under one key; those that came first are kept."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.key).digest(), "little")
        if len(self) < KEPT_WORDS and len(word) <= KEPT_BYTES:
            self[word] = h
        return h

    def of(self, data: bytes) -> np.ndarray:
        """The hashes of the words (runs of bytes that are not space or line ends) of ``data``."""
        words = data.split()  # at x20 and x09-x0D
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_WORDS = [Words(b"")]
CACHES["jaccard_groups"] = lambda: _WORDS[0].clear()


def _words(key: bytes) -> Words:
    if _WORDS[0].key != key:
        _WORDS[0] = Words(key)
    return _WORDS[0]


def shingles(text: str, size: int, key: bytes = b"") -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles of the text with A-Z lower-cased; with fewer words the whole
    sequence is the only one, without words there is none."""
    with np.errstate(over="ignore"):
        words = _words(key).of(text.encode("utf-8", "surrogatepass").translate(_UPPER))
        if not len(words):
            return words
        k = min(size, len(words))
        h = np.full(len(words) - k + 1, np.uint64(k))
        for i in range(k):
            h = _mixed(h * _M1 + words[i : len(words) - k + 1 + i])
    return np.unique(h)


def least_overlap(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that it shares at least with any set of that similarity."""
    return -(-n * percent // 100)


def shared_tokens(percent: int) -> int:
    """Tokens that any two different sets within the threshold share among their first ones: as many more come into
    the prefix, so that at least so many of it are common; two such sets have percent / (100 - percent) in common."""
    return max(1, min(SHARED, -(-percent // (100 - percent)))) if percent < 100 else 1


def prefix_length(n: int, percent: int) -> int:
    return n - least_overlap(n, percent) + shared_tokens(percent)


def similar(common: np.ndarray | int, n: int, m: np.ndarray | int, percent: int):
    return 100 * common >= percent * (n + m - common)


def _prefix(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens in the order: rare ones by hash, then frequent ones by hash."""
    p = prefix_length(len(tokens), percent)
    if not len(frequent):
        return tokens[:p]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    common = frequent[at] == tokens
    return np.concatenate([tokens[~common], tokens[common]])[:p]


def _sketches(s: np.ndarray) -> list[int]:
    """A number for each pair of min-hashes; two sets have one in common with a chance of their similarity squared."""
    with np.errstate(over="ignore"):
        seen = s * _M2
        out = np.arange(1, SKETCHES + 1, dtype=np.uint64)
        for k in range(2):
            out = _mixed(out * _M1 + np.array([_mixed(seen + np.uint64(2 * i + k + 1) * _M1).min() for i in range(SKETCHES)], np.uint64))
        return out.view(np.int64).tolist()


def _row_key(row: str | None) -> Column:
    """The key that a text is found again by: its row's, if there is one."""
    return F.col(row) if row else F.xxhash64("doc_id", text_of())


_SKETCHES = [f"b{i}" for i in range(SKETCHES)]


def _profiles(docs: DataFrame, size: int, key: bytes, row: str | None = None) -> DataFrame:
    """A row per text: its set's size, digest and sketches; and rows with the frequent tokens of each block (n is null)."""
    source = limit_batches(docs).select(F.col("doc_id").cast("long"), _row_key(row).alias("row_key"), text_of().alias("text"))
    names = ["doc_id", "row_key", "n", "set_id", *_SKETCHES, "token", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[np.ndarray] = []
        held = 0
        key_type = pa.int64()

        def counted() -> pa.RecordBatch:
            tokens, texts = np.unique(np.concatenate(block), return_counts=True)
            some = texts >= COUNT_LEAST
            k = int(some.sum())
            nulls = [pa.nulls(k, t) for t in (pa.int64(), key_type, pa.int64(), pa.binary(), *[pa.int64()] * SKETCHES)]
            return pa.RecordBatch.from_arrays([*nulls, pa.array(tokens[some].view(np.int64)), pa.array(texts[some].astype(np.int64))], names=names)

        for batch in batches:
            key_type = batch.column(1).type
            n, ids, sketches = [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py(), size, key)
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sketches.append(_sketches(s) if len(s) else [0] * SKETCHES)
                block.append(s)
                held += len(s)
                if held >= COUNT_BLOCK:
                    yield counted()
                    block.clear()
                    held = 0
            k = len(n)
            columns = [pa.array(x, pa.int64()) for x in zip(*sketches, strict=True)] if k else [pa.nulls(0, pa.int64())] * SKETCHES
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), *columns, pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)
        if block:
            yield counted()

    kind = source.schema["row_key"].dataType.simpleString()
    return source.mapInArrow(frugal(run), f"doc_id long, row_key {kind}, n long, set_id binary, {', '.join(f'{b} long' for b in _SKETCHES)}, token long, texts long")


def _prefixes(docs: DataFrame, size: int, percent: int, frequent: np.ndarray, key: bytes) -> DataFrame:
    """(set_id, tokens): the first tokens of the sets of ``docs``, each set about once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ids, held = [], []
            for text in batch.column(0):
                s = shingles(text.as_py(), size, key)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if not len(s) or digest in seen:
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(digest)
                ids.append(digest)
                held.append(_prefix(s, frequent, percent).view(np.int64))
            if ids:
                offsets = np.cumsum([0, *map(len, held)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(held)))], names=["set_id", "tokens"])

    return docs.select(text_of().alias("text")).mapInArrow(frugal(run), "set_id binary, tokens array<long>")


def _meetings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (token, n, g, place, several) of the matrix sorted by token, n and g: pairs of groups, a group with itself
    among them, and how many tokens they share in members that can be similar.

    Their sizes must fit, and with that token as one of the first that they share, what stands behind its places in
    both must be enough for the least overlap. Rows of a token are kept only as long as a later one can fit their size.
    """
    rest = np.zeros((5, 0), np.int64)
    slack = shared_tokens(percent) - 1

    def fitting(n: np.ndarray, m: np.ndarray, behind: np.ndarray) -> np.ndarray:
        return behind >= -(-percent * (n + m) // (100 + percent)) - slack

    for batch in batches:
        rows = np.concatenate([rest, _merged(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))], axis=1)
        token, n, g, place, several = rows
        behind = n - place
        old, total = rest.shape[1], rows.shape[1]
        if not total:
            continue
        found, size = [], 0
        own = np.flatnonzero((several == 1) & fitting(n, n, behind))
        own = own[own >= old]
        if len(own):
            found.append(np.stack([g[own], g[own], token[own]]))
            size += len(own)
        # Who can be the smaller of a pair at all, and the largest size that it can be paired with.
        most = np.minimum(100 * n // percent, (behind + slack) * (100 + percent) // percent - n)
        first = np.flatnonzero(most[:-1] >= n[:-1])
        for step in range(1, total):
            first = first[first + step < total]
            second = first + step
            first = first[(token[first] == token[second]) & (most[first] >= n[second])]  # sizes only grow with the step
            if not len(first):
                break
            second = first + step
            good = (second >= old) & fitting(n[first], n[second], behind[second])
            if good.any():
                a, b = g[first[good]], g[second[good]]
                found.append(np.stack([np.maximum(a, b), np.minimum(a, b), token[first[good]]]))
                size += int(good.sum())
                if size > 200_000:
                    yield _unique_pairs(found)
                    found, size = [], 0
        if found:
            yield _unique_pairs(found)
        rest = rows[:, (token == token[-1]) & (100 * n >= percent * n[-1])]


def _merged(rows: np.ndarray) -> np.ndarray:
    """Rows (token, n, g, place, several) in order, those of one token, size and group as one: its least place, and
    whether several sets stand behind it."""
    if not rows.shape[1]:
        return rows
    first = np.flatnonzero(np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(0)]))
    out = rows[:, first]
    out[3] = np.minimum.reduceat(rows[3], first)
    out[4] = np.minimum(np.add.reduceat(rows[4] + 1, first) - 1, 1)
    return out


def _matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, n, g, place, several) of the matrix from sets (sid, n, g, tokens) in the order of g and sid; of a set
    that comes several times the first row counts. What members of a group have in common is one row a block."""
    held: list[tuple[int, int, np.ndarray]] = []
    size, last = 0, None

    def block() -> pa.RecordBatch:
        lengths = [len(h[2]) for h in held]
        token = np.concatenate([h[2] for h in held])
        n, g = (np.repeat(np.array([h[k] for h in held], np.int64), lengths) for k in (0, 1))
        place = np.concatenate([np.arange(k) for k in lengths])
        order = np.lexsort((place, g, n, token))
        rows = _merged(np.stack([token, n, g, place, np.zeros(len(token), np.int64)])[:, order])
        return pa.RecordBatch.from_arrays(list(map(pa.array, rows)), names=["token", "n", "g", "place", "several"])

    for batch in batches:
        lists = batch.column(3)
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        for sid, n, g, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if sid == last:
                continue
            last = sid
            held.append((n, g, flat[a:b].astype(np.int64)))
            size += b - a
            if size >= BLOCK:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def _unique_pairs(found: list[np.ndarray]) -> pa.RecordBatch:
    """Pairs and their numbers of tokens; a token that several members bring counts once, unless it comes in pieces
    (then the number is too high, which lets a pair through that a closer look drops)."""
    rows = np.concatenate(found, axis=1)
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])
    rows = rows[:2, new]
    edge = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0), [True]]))
    return pa.RecordBatch.from_arrays([pa.array(rows[0, edge[:-1]]), pa.array(rows[1, edge[:-1]]), pa.array(np.diff(edge))], names=["a", "b", "shared"])


def _tokens(texts: DataFrame, size: int, key: bytes) -> DataFrame:
    """(sid, g, n, own, parts, pivot, tokens) of rows that have the set's digest and a text in front of these."""
    names = ["sid", "g", "n", "own", "parts", "pivot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                data, keep = [], []
                for sid, set_id, text in zip(part.column("sid").to_pylist(), part.column("set_id").to_pylist(), part.column("text"), strict=True):
                    keep.append(sid != last)  # rows of one key stand one behind another
                    last = sid
                    tokens = shingles(text.as_py(), size, key).tobytes() if keep[-1] else b""
                    if keep[-1] and hashlib.blake2b(tokens, digest_size=16).digest() != set_id:
                        keep[-1], last = False, None  # another text under the same key
                    data.append(tokens)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(data, pa.binary())], names=[*names, "tokens"]).filter(pa.array(keep, pa.bool_()))

    return texts.select("set_id", "text", *names).mapInArrow(frugal(run), "sid long, g long, n long, own boolean, parts long, pivot long, tokens binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, x, b, y) of sets and their tokens, (a, b) of those within the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                keep.append(bool(similar(_common(s, t), len(s), len(t), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    lengths = [F.octet_length("x"), F.octet_length("y")]
    fits = F.least(*lengths) * 100 >= F.greatest(*lengths) * percent
    return pairs.filter(fits).select("a", "b", "x", "y").mapInArrow(frugal(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node in a link.

    Large-star and small-star steps (each node hands its neighbours to the smallest one it knows) until every node has
    one edge, to a node without one; every step is a table in the shared folder. A node with very many neighbours is
    pre-aggregated and met under salts.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links", narrow=True)
    while True:
        total, nodes = edges.agg(F.count("*"), F.count_distinct("u")).first()
        if total == nodes and (not total or joined(edges.select(F.col("v").alias("u")), edges.select("u"), ["u"], "left_semi").isEmpty()):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_lookup(both.filter("v > u"), least, ["u"], F.col("v")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = joined(large, large.groupBy("u").agg(F.min("v").alias("m")), ["u"])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = written(small, "links", narrow=True)
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))


class _Joined(dict):
    """What links have joined so far, by one of each lot."""

    def root(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x


def _links_within(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (part_id, role, sid, tokens) in that order: links between the sets of a part that join what no other link
    has joined. A set that comes twice counts once."""
    part, last = None, None
    members: list[tuple[int, np.ndarray]] = []
    lots = _Joined()
    for batch in batches:
        found: list[tuple[int, int]] = []
        for part_id, sid, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            if part_id != part:
                part, members, lots = part_id, [], _Joined()
            elif sid == last or (members and sid == members[0][0]):
                continue
            last, own = sid, np.frombuffer(data.as_py(), np.uint64)
            for other, tokens in members:
                n, m = len(own), len(tokens)
                if min(n, m) * 100 >= max(n, m) * percent and lots.root(other) != lots.root(sid) and similar(_common(own, tokens), n, m, percent):
                    found.append((sid, other))
                    lots[lots.root(sid)] = lots.root(other)
            members.append((sid, own))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])


def _opened(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (part_id, chunk, role, sid, label, tokens) in that order, a part's members (role 0) before what is asked of
    it: the labels that links join."""
    part = None
    members: list[tuple[int, np.ndarray]] = []
    union, sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lots = _Joined()
    for batch in batches:
        found: list[tuple[int, int]] = []
        for part_id, chunk, role, label, data in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), batch.column(5), strict=True):
            if (part_id, chunk) != part:
                part, members, lots, sizes = (part_id, chunk), [], _Joined(), sizes[:0]
            tokens = np.frombuffer(data.as_py(), np.uint64)
            if not role:
                members.append((label, tokens))
                continue
            if len(sizes) != len(members):
                sizes, union = np.array([len(m[1]) for m in members]), np.unique(np.concatenate([m[1] for m in members]))
            n = len(tokens)
            if not len(sizes) or _common(tokens, union) < least_overlap(n, percent):  # no member shares more than the union
                continue
            for k in np.flatnonzero(np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * percent).tolist():
                its, other = members[k]
                if lots.root(its) != lots.root(label) and similar(_common(tokens, other), n, len(other), percent):
                    found.append((label, its))
                    lots[lots.root(its)] = lots.root(label)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])


def _grouped(sets: DataFrame) -> DataFrame:
    """``sets`` with g and score: each in the group of the sketch that most sets have, its own sketch if it shares none.
    The score says how many sets share its sketches: a family's center has the highest."""
    each = sets.select("set_id", F.explode(F.array(*_SKETCHES)).alias("b"))
    popular = each.groupBy("b").agg(F.count("*").alias("times")).filter("times > 1")
    best = salted_lookup(each, popular, ["b"], F.col("set_id"), how="inner").groupBy("set_id").agg(F.max(F.struct("times", "b"))["b"].alias("best"), F.sum("times").alias("score"))
    return joined(sets, best, ["set_id"], "left").select(*[c for c in sets.columns if c not in _SKETCHES], F.coalesce("best", "b0").alias("g"), F.coalesce("score", F.lit(0)).alias("score"))


def _met(docs: DataFrame, places: DataFrame, size: int, percent: int, frequent: np.ndarray, key: bytes) -> DataFrame:
    """(a, b): groups with members that can be similar, a >= b; a = b if it is two of its own."""
    sets = joined(_prefixes(docs, size, percent, frequent, key), places.select("set_id", "sid", "n", "g"), ["set_id"])
    tasks = max(partitions_of(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sets = sets.repartition(tasks, "g", F.pmod("sid", F.lit(32))).sortWithinPartitions("g", "sid")
    matrix = sets.select("sid", "n", "g", "tokens").mapInArrow(frugal(_matrix), "token long, n long, g long, place long, several long")
    found = matrix.repartition(tasks, "token").sortWithinPartitions("token", "n", "g").mapInArrow(frugal(lambda batches: _meetings(batches, percent)), "a long, b long, shared long")
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared")).filter(F.col("shared") >= shared_tokens(percent)).select("a", "b")


def _in_parts(held: DataFrame) -> DataFrame:
    """``held`` with part_id: groups with more than about PART sets or PART_TOKENS tokens are cut."""
    return held.withColumn("part_id", F.xxhash64("g", F.pmod(F.xxhash64(F.lit(5), "sid"), F.col("parts"))))


def _first_links(held: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Links within each part and with its group's pivot, and of pivots whose groups meet."""
    pivots = held.filter("sid = pivot").select("g", "sid", "n", "tokens")
    sizes = pivots.select("g", "sid", "n")
    own = _in_parts(held.filter("own")).select("part_id", F.lit(1).alias("role"), "sid", "tokens")
    # The pivot is compared in every part of its group, before the others.
    each = held.filter("own and sid = pivot").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    each = each.select(F.xxhash64("g", "k").alias("part_id"), F.lit(0).alias("role"), "sid", "tokens")
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    within = own.unionByName(each).repartition(tasks, "part_id").sortWithinPartitions("part_id", "role", "sid").mapInArrow(frugal(lambda batches: _links_within(batches, percent)), "a long, b long")
    pairs = salted_lookup(met.filter("a <> b"), sizes.toDF("a", "p", "n"), ["a"], F.col("b"))
    pairs = salted_lookup(pairs, sizes.toDF("b", "q", "m"), ["b"], F.col("a")).filter(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
    pairs = pairs.select(F.col("p").alias("a"), F.col("q").alias("b"))
    pairs = salted_lookup(pairs, pivots.select(F.col("sid").alias("a"), F.col("tokens").alias("x")), ["a"], F.col("b"), salts=2)
    pairs = salted_lookup(pairs, pivots.select(F.col("sid").alias("b"), F.col("tokens").alias("y")), ["b"], F.col("a"), salts=2).select("a", "x", "b", "y")
    return within.unionByName(_verified(pairs, percent))


def _labelled(held: DataFrame, label: DataFrame) -> DataFrame:
    """(sid, g, parts, part_id, label): each set with its part and the component that the first links put it in."""
    members = joined(_in_parts(held).select("sid", "g", "parts", "part_id"), label.toDF("sid", "label"), ["sid"], "left")
    return members.withColumn("label", F.coalesce("label", "sid"))


def _unsettled(members: DataFrame, met: DataFrame) -> DataFrame:
    """(part_id, sid, label) to be asked: sets that are not connected yet, of the group with fewer members against the
    parts of the other one, or of a group in several parts against its other parts."""
    spans = members.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m"), F.max("parts").alias("p"))
    ways = salted_lookup(met, spans.toDF("a", "low_a", "high_a", "m_a", "p_a"), ["a"], F.col("b"))
    ways = salted_lookup(ways, spans.toDF("b", "low_b", "high_b", "m_b", "p_b"), ["b"], F.col("a"))
    apart = "(low_a <> high_a or low_b <> high_b or low_a <> low_b)"
    ways = ways.filter(f"{apart} and case when a = b then p_a > 1 else m_a > 1 or m_b > 1 end")
    fewer = F.col("m_a") <= F.col("m_b")
    ways = ways.select(F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("g"), F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("to"))
    parts = members.groupBy(F.col("g").alias("to"), "part_id").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    asked = salted_lookup(members.select("g", "sid", "label", F.col("part_id").alias("mine")), ways, ["g"], F.col("sid"), how="inner").drop("g")
    asked = salted_lookup(asked, parts, ["to"], F.col("sid"), how="inner").filter("part_id <> mine and (label <> low or label <> high)")
    return asked.select("part_id", "sid", "label").distinct()


def _links_in_parts(held: DataFrame, members: DataFrame, asked: DataFrame, percent: int) -> DataFrame:
    """Links of labels by opening parts for what is asked of them."""
    chunks = asked.groupBy("part_id").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"))
    full = held.select("sid", "tokens")
    queries = salted_lookup(asked, chunks, ["part_id"], F.col("sid")).withColumn("chunk", F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int")).withColumn("role", F.lit(1))
    opened = salted_lookup(members.select("part_id", "sid", "label"), chunks, ["part_id"], F.col("sid"), how="inner").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("role", F.lit(0))
    columns = ["part_id", "chunk", "role", "sid", "label"]
    both = salted_lookup(queries.select(columns).unionByName(opened.select(columns)), full, ["sid"], F.col("part_id"), how="inner", salts=2)
    tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.select(*columns, "tokens").repartition(tasks, "part_id", "chunk").sortWithinPartitions("part_id", "chunk", "role", "sid")
    return both.mapInArrow(frugal(lambda batches: _opened(batches, percent)), "a long, b long")


def similarity_components(docs: DataFrame, size: int = 5, percent: int = 80, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    ``row``: a column with a different value in each row. It is handed on, with ``kept``: true for the one row of a
    component with the smallest doc_id (a null only if there is no other) and the smallest ``row``, and for empty sets.

    Two texts link when their sets of distinct ``size``-word shingles have a Jaccard similarity of ``percent``/100 or
    more; component_id is the smallest doc_id that links reach (null if none of them has one). A text with fewer words
    is one shingle; a null text or one without words has the empty set and links with nothing. Rows that repeat share
    a component; an empty table gives no rows; texts are read whole. Other columns are not read.
    """
    key = secrets.token_bytes(32)  # one for all tasks of this run
    both = written(_profiles(docs, size, key, row), "profiles", narrow=True)
    rows = both.filter("n is not null").select("doc_id", "n", "set_id", "row_key")
    top = both.filter("n is null").groupBy("token").agg(F.sum("texts").alias("texts")).filter(F.col("texts") >= 2 * COUNT_LEAST).orderBy(F.desc("texts"), "token").limit(FREQUENT)
    frequent = np.sort(top.select("token").toArrow().column(0).to_numpy().view(np.uint64))  # at most FREQUENT numbers

    lead = [F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row_key")).alias("lead")] if row else []
    least = [F.min(c).alias(c) for c in ("n", "row_key", *_SKETCHES)]
    sets = both.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first"), *least, *lead)
    places = written(_grouped(sets), "places", narrow=True, number="sid")
    met = written(_met(docs, places, size, percent, frequent, key), "met", narrow=True)

    ends = met.select(F.explode(F.array("a", "b")).alias("g"), (F.col("a") == F.col("b")).alias("own")).groupBy("g").agg(F.max("own").alias("own"))
    parts = F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum("n") / PART_TOKENS))
    groups = places.groupBy("g").agg(parts.alias("parts"), F.max(F.struct("score", (-F.col("sid")).alias("s"))).alias("best"))
    needed = joined(ends, groups, ["g"]).select("g", "own", "parts", (-F.col("best.s")).alias("pivot"))
    wanted = salted_lookup(places.select("g", "sid", "set_id", "n", "row_key"), needed, ["g"], F.col("sid"), how="inner")
    # One text a set moves: that of the row with the smallest key.
    texts = joined(docs.select(_row_key(row).alias("row_key"), text_of().alias("text")), wanted, ["row_key"])
    held = written(_tokens(texts, size, key), "tokens")

    label = components(_first_links(held, met, percent))
    members = _labelled(held, label)
    asked = written(_unsettled(members, met), "asked", narrow=True)
    if not asked.isEmpty():
        onward = components(_links_in_parts(held, members, asked, percent)).toDF("component", "onward")
        # Sets that had no link before are labels of their own.
        alone = joined(onward, label.select(F.col("node").alias("component")), ["component"], "left_anti").toDF("node", "component")
        label = salted_lookup(label, onward, ["component"], F.col("node")).select("node", F.coalesce("onward", "component").alias("component")).unionByName(alone)
        label = written(label, "labels", narrow=True)

    leads = ["lead"] if row else []
    found = joined(places.select("set_id", "sid", "first", *leads), label.withColumnRenamed("node", "sid"), ["sid"], "left").withColumn("component", F.coalesce("component", "sid"))
    smallest = found.groupBy("component").agg(F.min("first").alias("component_id"), *(F.min(c)["row_key"].alias("first_row") for c in leads))
    of_set = salted_lookup(found.drop("lead"), smallest, ["component"], F.col("sid")).select("set_id", "component_id", *["first_row"] * len(leads))
    decided = [F.col("row_key").alias(row), F.coalesce(F.col("first_row") == F.col("row_key"), F.lit(True)).alias("kept")] if row else []
    return salted_lookup(rows, of_set, ["set_id"], F.coalesce("doc_id", F.xxhash64("row_key"))).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *decided)
