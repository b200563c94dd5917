"""A Merkle manifest of a table: a tree of each source's rows, a tree over the sources, a proof for every row.

Leaves are digests of rows; only they are moved. They are dealt by ranges of (source, order) and numbered within their
source. Each task climbs the mountains of its own stretch of numbers: a stack with one list of siblings a level, where
the last of a full, aligned run of ``FANOUT`` siblings is a carry, that is, emits the run's parent, which joins the list
above. What a stretch can't complete (siblings before its first aligned number, and the last runs, which other
stretches go on with or which are short) stays open; level by level, open nodes meet their siblings from other
stretches by (tree, parent's number), at most ``FANOUT`` of them. A short last run is hashed as it is, without padding.

Paths go the other way: from the root a node's path is its parent's and its own run's other members, again met by
(tree, parent's number). So no key of any join or group has more than ``FANOUT`` rows, however large a source is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, joined, numbered, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NODES = "tree string, leaves long, level int, place long, hash string, open boolean"
_SIDES = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex of the SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as a leaf has it: ``-`` if it is null, else its length in UTF-8 bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def climbed(nodes: Iterator[tuple[str, int, int, str]], fanout: int = FANOUT) -> Iterator[tuple[str, int, int, int, str, bool]]:
    """(tree, leaves, level, place, hash, open) from (tree, leaves of the tree, place, hash) of leaves.

    Places that follow each other in one tree are a stretch. Every node above the leaves is given, and those leaves that
    stay open: whose run is not whole in their stretch.
    """
    tree, leaves, after = None, 0, -1
    peaks: list[list[str]] = []  # by level: the siblings of a run that began at its first place
    firsts: list[int] = []

    def rest() -> Iterator[tuple[str, int, int, int, str, bool]]:
        for level, run in enumerate(peaks):
            for k, h in enumerate(run):
                yield tree, leaves, level, firsts[level] + k, h, True
            run.clear()

    for of, n, place, h in nodes:
        if of != tree or place != after:
            yield from rest()
            tree, leaves = of, n
        after, level = place + 1, 0
        while True:
            if level == len(peaks):
                peaks.append([])
                firsts.append(0)
            run = peaks[level]
            if not run:
                if place % fanout:  # its run began in another stretch
                    yield tree, leaves, level, place, h, True
                    break
                firsts[level] = place
            run.append(h)
            if len(run) < fanout:
                break
            if level:
                for k, x in enumerate(run):
                    yield tree, leaves, level, firsts[level] + k, x, False
            h, place, level = hashlib.sha256("".join(run).encode()).hexdigest(), place // fanout, level + 1
            run.clear()
    yield from rest()


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[str, int, int, str]]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]
    names = ["tree", "leaves", "level", "place", "hash", "open"]
    held: list[tuple] = []
    for node in climbed(rows()):
        held.append(node)
        if len(held) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of the task and their place among the task's rows of their tree (the first column)."""
    from pyspark import TaskContext

    task, tree, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = []
        for of in batch.column(0).to_pylist():
            tree, at = of, at + 1 if of == tree else 0
            places.append(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(places), pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "task", "local"])


class Forest(NamedTuple):
    rows: DataFrame  # tree, hash, further columns, leaves (of the tree), place
    levels: list[DataFrame]  # nodes of level 1, 2, …: tree, leaves, place, hash
    open: DataFrame  # nodes that a stretch left open, leaves among them


def forest(rows: DataFrame, order: list[str], name: str) -> Forest:
    """Trees over ``rows`` (tree, hash and further columns), whose leaves stand by ``order``. Rows that ``order`` does not
    tell apart must have equal hashes."""
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    kept = dealt.select("tree", *[c for c in rows.columns if c != "tree"])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    local = written(kept.mapInArrow(frugal(_local), ddl + ", task int, local long"), f"{name}-local")
    counts = local.groupBy("tree", "task").agg(F.count("*").alias("n"))  # at most one row a task and tree
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("tree")).alias("leaves"))
    placed = joined(local, starts, ["tree", "task"]).withColumn("place", F.col("first") + F.col("local")).drop("task", "local", "first")
    indexed = written(placed.sortWithinPartitions("tree", "place"), f"{name}-rows")
    nodes = written(indexed.select("tree", "leaves", "place", "hash").mapInArrow(frugal(_climb), _NODES), f"{name}-nodes")
    height, most = 0, indexed.agg(F.max("leaves")).first()[0] or 0  # one number
    while FANOUT**height < most:
        height += 1
    levels, carried = [], nodes.filter("open and level = 0").drop("level", "open")
    for level in range(height):
        runs = carried.filter(F.col("leaves") > FANOUT**level).groupBy("tree", "leaves", F.floor(F.col("place") / FANOUT).alias("place"))
        hashes = F.transform(F.sort_array(F.collect_list(F.struct(F.col("place").alias("at"), "hash"))), lambda x: x["hash"])
        met = written(runs.agg(F.sha2(F.array_join(hashes, ""), 256).alias("hash")), f"{name}-level", narrow=True)
        above = nodes.filter(F.col("level") == level + 1)
        levels.append(above.select(*met.columns).unionByName(met))
        carried = above.filter("open").select(*met.columns).unionByName(met)
    return Forest(indexed, levels, nodes.filter("open"))


def _tops_at(level: int) -> Column:
    """The tree's root has this level."""
    most = F.col("leaves") <= FANOUT**level
    return most & (F.col("leaves") > FANOUT ** (level - 1)) if level else most


def roots(trees: Forest) -> DataFrame:
    """(tree, leaves, hash) of each tree's root, a lone leaf's own hash."""
    out = trees.open.filter(_tops_at(0) & (F.col("level") == 0)).select("tree", "leaves", "hash")
    for level, nodes in enumerate(trees.levels, 1):
        out = out.unionByName(nodes.filter(_tops_at(level)).select("tree", "leaves", "hash"))
    return out


def with_paths(trees: Forest, tops: DataFrame) -> DataFrame:
    """The rows with ``path``: what stands left and right of the node, level by level; and with the columns of ``tops``
    (tree, leaves, path from the tree's root on, and further ones)."""
    extra = [c for c in tops.columns if c not in ("tree", "leaves", "path")]
    own = [c for c in trees.rows.columns if c not in ("tree", "leaves", "place")]
    state = None
    for level in reversed(range(len(trees.levels) + 1)):
        nodes, kept = (trees.levels[level - 1], ["hash"]) if level else (trees.rows, own)
        above = tops.filter(_tops_at(level)).select("tree", F.lit(0).cast("long").alias("parent"), "path", *extra, F.lit(True).alias("whole"))
        if state is not None:
            above = above.unionByName(state.select("tree", F.col("place").alias("parent"), "path", *extra, F.lit(False).alias("whole")))
        runs = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("parent")).agg(F.sort_array(F.collect_list(F.struct("place", *kept))).alias("run"))
        met = joined(runs, above, ["tree", "parent"]).withColumn("hashes", F.col("run.hash")).select("tree", "path", "whole", "hashes", *extra, F.posexplode("run").alias("at", "node"))
        side = F.struct(F.array_join(F.slice("hashes", 1, F.col("at")), "").alias("left"), F.array_join(F.slice("hashes", F.col("at") + 2, FANOUT), "").alias("right"))
        path = F.when(F.col("whole"), F.col("path")).otherwise(F.concat(F.array(side), F.col("path")))
        state = met.select("tree", F.col("node.place").alias("place"), path.alias("path"), *extra, *[F.col(f"node.{c}").alias(c) for c in kept if level == 0])
    return state


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    Trees of sources stand null first, then bytewise. Rows with one source and doc_id stand by their leaf, so that the roots
    do not depend on the order of files; a null doc_id is before all others and is never tampered with. Nulls in other
    columns are fields of their own kind, not empty texts. An empty table has no root and no row. A lone row is its
    source's subroot, a lone source's subroot the root. Other columns are not read.
    """
    tampered = F.when(F.col("text").isNotNull(), F.translate("text", _UPPER, _LOWER))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = numbered(docs.select(*FIELDS), "number")
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("tree"),
        digest(*[field(F.col(c)) for c in FIELDS]).alias("hash"),
        "doc_id",
        F.when(hit, digest(*[field(tampered if c == "text" else F.col(c)) for c in FIELDS])).alias("tampered"),
        F.xxhash64("number").alias("spread"),  # deals equal rows
    )
    sources = forest(leaves, ["doc_id", "hash", "spread"], "merkle")
    subroots = roots(sources).select(F.lit("").alias("tree"), "hash", F.col("tree").alias("source"), F.col("leaves").alias("size"))
    whole = forest(subroots, ["source"], "merkle-top")
    none = F.array().cast(_SIDES)
    tops = with_paths(whole, roots(whole).select("tree", "leaves", none.alias("path"), F.col("hash").alias("root")))
    # A row a source, which every level looks for its roots in.
    tops = written(tops.select(F.col("source").alias("tree"), F.col("size").alias("leaves"), "path", F.col("hash").alias("subroot"), "root"), "merkle-tops", narrow=True)
    out = with_paths(sources, tops).withColumn("folded_root", folded(F.coalesce("tampered", "hash"), F.col("path")))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


#: CRC-32 of doc_id's decimal form, bit by bit: a byte is mixed in, then eight shifts.
_SQL_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: [ascii(CAST(doc_id AS VARCHAR)[i]), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"""


def sql(levels: int = 6) -> str:
    """The same in SQL for sources, and numbers of them, of up to 16**levels."""
    leaf = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS)
    low = leaf.replace("text", f"translate(text, '{_UPPER}', '{_LOWER}')")
    out = [f"l AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({leaf}) AS leaf, CASE WHEN {_SQL_CRC} % 5 = 0 THEN sha256({low}) END AS tampered FROM documents)"]
    out.append("s0 AS (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n, doc_id, tampered FROM l)")
    for k in range(levels):
        out.append(f"s{k + 1} AS (SELECT tree, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 15) // 16 AS n FROM s{k} GROUP BY tree, i // 16)")
    out.append(f"t0 AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS i, h, count(*) OVER () AS n FROM s{levels})")
    for k in range(levels):
        out.append(f"t{k + 1} AS (SELECT i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 15) // 16 AS n FROM t{k} GROUP BY i // 16)")
    for t, by in (("s", "tree, "), ("t", "")):
        for k in range(levels):
            run = f"OVER (PARTITION BY {by}i // 16 ORDER BY i ROWS BETWEEN"
            out.append(f"{t}p{k} AS (SELECT {by}i, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a, coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {t}{k})")
    out.append("f0 AS (SELECT s0.*, h AS leaf, coalesce(tampered, h) AS cur, '' AS proof FROM s0)")
    for k in range(levels):
        fold = "CASE WHEN p.n > 1 THEN sha256(p.a || f.cur || p.b) ELSE f.cur END AS cur, f.proof || p.a || p.b AS proof"
        out.append(f"f{k + 1} AS (SELECT f.* EXCLUDE (cur, proof), {fold} FROM f{k} f JOIN sp{k} p ON p.tree = f.tree AND p.i = f.i // {16**k})")
    out.append(f"g0 AS (SELECT f.*, t0.i AS j, t0.h AS subroot FROM f{levels} f JOIN t0 USING (tree))")
    for k in range(levels):
        fold = "CASE WHEN p.n > 1 THEN sha256(p.a || f.cur || p.b) ELSE f.cur END AS cur, f.proof || p.a || p.b AS proof"
        out.append(f"g{k + 1} AS (SELECT f.* EXCLUDE (cur, proof), {fold} FROM g{k} f JOIN tp{k} p ON p.i = f.j // {16**k})")
    head = "WITH " + ",\n    ".join(out)
    return head + f"\n    SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified FROM g{levels}, t{levels} r"
