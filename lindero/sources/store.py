"""Keyed tables that grow by what changes.

A table is a folder with data folders (``v-…``) and one small document for each version, named by its number alone. A
version lists its segments: a base and, later ones first to count, logs of changed rows; of rows with one key the one in
the last segment holds. So a change of a few rows writes those rows, whatever the table's size. Segments are
partitioned by buckets of the key's hash, so that a lookup reads one bucket.

A version is committed by creating the document with the next number, which exactly one of several writers can: the
others get :class:`Conflict`, look at the new version and try again. What a version names is never changed; documents
older than the last ``KEPT`` versions go, with the data that no kept version names.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a new table's key, versions that stay readable, logs of about one size that are merged into one.
BUCKETS, KEPT, MERGED = 32, 3, 8
#: Logs of at most so many rows are broadcast to the base; longer ones are joined by sorting.
FEW_ROWS = 100_000
BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has committed this version's number."""


class Segment(NamedTuple):
    path: str  # below the table's folder
    rows: int
    bucketed: bool


class Version(NamedTuple):
    number: int  # 0: there is none yet
    key: str | None
    buckets: int
    rows: int  # with different keys
    base: Segment | None
    logs: tuple[Segment, ...]

    @property
    def log_rows(self) -> int:
        return sum(s.rows for s in self.logs)


NONE = Version(0, None, 0, 0, None, ())


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs = _fs(spark, root)
    if not fs.exists(_path(spark, root)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(_path(spark, root))]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"CURRENT-(\d+)", n)))


def _document(root: str, number: int) -> str:
    return f"{root}/CURRENT-{number:09d}"


def _read(spark: SparkSession, root: str, number: int) -> Version:
    stream = _fs(spark, root).open(_path(spark, _document(root, number)))
    try:
        d = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Version(d["number"], d["key"], d["buckets"], d["rows"], Segment(*d["base"]) if d["base"] else None, tuple(Segment(*s) for s in d["logs"]))


def version(spark: SparkSession, root: str) -> Version:
    """The current version."""
    for _ in range(5):
        found = _numbers(spark, root)
        if not found:
            return NONE
        try:
            return _read(spark, root, found[-1])
        except Exception:  # it may have been cleared by several later commits
            if _numbers(spark, root)[-1:] == found[-1:]:
                raise
    raise OSError(f"{root}: versions change faster than they can be read")


def _created(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with its whole content, unless there is one."""
    part = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    fs = _fs(spark, path)
    out = fs.create(_path(spark, part), True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        at = urlsplit(_path(spark, path).makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString())
        if at.scheme == "file":  # Hadoop's local rename overwrites
            name = unquote(at.path)
            try:
                os.link(f"{os.path.dirname(name)}/{os.path.basename(part)}", name)
            except FileExistsError:
                return False
            return True
        jvm = spark._jvm.org.apache.hadoop.fs
        none = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        none[0] = jvm.Options.Rename.NONE
        try:
            jvm.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(_path(spark, part), _path(spark, path), none)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(_path(spark, part), False)


def _named(v: Version) -> set[str]:
    return {s.path for s in (*([v.base] if v.base else []), *v.logs)}


def _drop(spark: SparkSession, root: str, paths: set[str]) -> None:
    for p in paths:
        _fs(spark, root).delete(_path(spark, f"{root}/{p}"), True)


def _all_named(spark: SparkSession, root: str, numbers: list[int]) -> set[str]:
    return {p for n in numbers for p in _named(_read(spark, root, n))}


def _clear(spark: SparkSession, root: str, number: int) -> None:
    """Documents below ``number`` go, with the data that no later version names."""
    numbers = _numbers(spark, root)
    gone, kept = [n for n in numbers if n < number], [n for n in numbers if n >= number]
    if gone and kept:
        dead = _all_named(spark, root, gone) - _all_named(spark, root, kept)
        for n in gone:
            _fs(spark, root).delete(_path(spark, _document(root, n)), False)
        _drop(spark, root, dead)


def commit(spark: SparkSession, root: str, new: Version) -> Version:
    """``new`` as the version with its number; :class:`Conflict` if there is one."""
    text = json.dumps({**new._asdict(), "base": list(new.base) if new.base else None, "logs": [list(s) for s in new.logs]})
    if not _created(spark, _document(root, new.number), text):
        raise Conflict(f"{root}: version {new.number} is there")
    _clear(spark, root, new.number - KEPT + 1)
    return new


def unnamed(spark: SparkSession, root: str, before_ms: int) -> list[str]:
    """Remove data folders that no kept version names and that were last changed before a time (in milliseconds): what
    writers that ended or lost have left. Younger ones may be a running writer's."""
    named = _all_named(spark, root, _numbers(spark, root))
    found = [(f.getPath().getName(), f.getModificationTime()) for f in _fs(spark, root).listStatus(_path(spark, root))]
    dead = {name for name, at in found if name.startswith("v-") and name not in named and at < before_ms}
    _drop(spark, root, dead)
    return sorted(dead)


def _kind(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def write_segment(df: DataFrame, root: str, key: str | None = None, buckets: int = BUCKETS) -> Segment:
    """``df`` as a new data folder, which no version names yet."""
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    out = df.write
    if key:
        out = df.withColumn(BUCKET, bucket_of(F.col(key), buckets)).repartition(BUCKET).write.partitionBy(BUCKET)
    out.parquet(f"{root}/{name}")
    rows = spark.read.schema(df.schema).parquet(f"{root}/{name}").count()  # from the files' footers
    return Segment(name, rows, key is not None)


def _segment(spark: SparkSession, root: str, s: Segment, schema: T.StructType, bucket: Column | None) -> DataFrame:
    kind = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]) if s.bucketed else schema
    df = spark.read.schema(kind).parquet(f"{root}/{s.path}")
    if s.bucketed and bucket is not None:
        df = df.filter(F.col(BUCKET) == bucket)
    return df.select(*[f"`{c}`" for c in schema.names])


def rows_of(spark: SparkSession, root: str, v: Version, schema: str | T.StructType, only: str | None = None) -> DataFrame:
    """The rows of a version, or those of one key, for which one bucket is read."""
    kind = _kind(schema)
    own = None if only is None or not v.key else F.col(v.key) == only
    bucket = None if own is None else bucket_of(F.lit(only), v.buckets)

    def part(s: Segment) -> DataFrame:
        df = _segment(spark, root, s, kind, bucket)
        return df if own is None else df.filter(own)

    base = part(v.base) if v.base else spark.createDataFrame([], kind)
    if not v.logs:
        return base
    log = None
    for i, s in enumerate(v.logs):
        each = part(s).withColumn("_segment", F.lit(i))
        log = each if log is None else log.unionByName(each)
    last = log.groupBy(v.key).agg(F.max_by(F.struct(*[f"`{c}`" for c in kind.names]), "_segment").alias("_row")).select("_row.*")
    if not v.base:
        return last
    changed = last.select(v.key)
    changed = F.broadcast(changed) if v.log_rows <= FEW_ROWS else changed.hint("merge")
    return base.join(changed, v.key, "left_anti").select(*[f"`{c}`" for c in kind.names]).unionByName(last)


def _tier(rows: int) -> int:
    tier = 0
    while MERGED ** (tier + 1) <= rows:
        tier += 1
    return tier


def tidied(spark: SparkSession, root: str, v: Version, schema: T.StructType) -> Version:
    """``v`` with fewer segments: the last MERGED logs of about one size as one, all as a base once the logs have half as
    many rows. A row is so rewritten about once a size, not once a change."""
    if v.base is None and len(v.logs) == 1:
        return v._replace(base=v.logs[0], logs=())
    if v.base is None or (len(v.logs) > 1 and v.log_rows * 2 > v.base.rows):
        return v._replace(base=write_segment(rows_of(spark, root, v, schema), root, v.key, v.buckets), logs=())
    tier = _tier(v.logs[-1].rows) if v.logs else 0
    small = 0
    while small < len(v.logs) and _tier(v.logs[-1 - small].rows) <= tier:
        small += 1
    if small < MERGED:
        return v
    old = v._replace(base=None, logs=v.logs[-small:])
    return v._replace(logs=(*v.logs[:-small], write_segment(rows_of(spark, root, old, schema), root, v.key, v.buckets)))


def put(spark: SparkSession, root: str, old: Version, changed: Segment, added: int, key: str, schema: str | T.StructType, buckets: int = BUCKETS) -> Version:
    """Commit ``changed`` (a written segment of one row a key, ``added`` of which are new) on top of ``old``."""
    if old.key and old.key != key:
        raise ValueError(f"{root} is keyed by {old.key}")
    new = Version(old.number + 1, key, old.buckets or buckets, old.rows + added, old.base, (*old.logs, changed))
    tidy = tidied(spark, root, new, _kind(schema))
    try:
        done = commit(spark, root, tidy)
    except Conflict:
        _drop(spark, root, _named(tidy) - _named(new))
        raise
    _drop(spark, root, _named(new) - _named(tidy) - _named(old))  # went into a larger one at once
    return done


def replace(df: DataFrame, root: str, attempts: int = 5) -> Segment:
    """``df`` as the whole of the next version."""
    spark = df.sparkSession
    new = write_segment(df, root)
    for _ in range(attempts):
        try:
            commit(spark, root, Version(version(spark, root).number + 1, None, 0, new.rows, new, ()))
            return new
        except Conflict:
            continue
    raise Conflict(f"{root}: {attempts} attempts failed")


def changed(spark: SparkSession, root: str, key: str, schema: str | T.StructType, change: Callable[[Version], tuple[DataFrame, int | Callable[[DataFrame], int]]], buckets: int = BUCKETS, attempts: int = 10) -> Version:
    """Commit what ``change`` makes of the current version: rows of changed keys, and how many of them are new, or a
    function that tells from the written rows. If another writer was faster, it is asked again."""
    kind = _kind(schema)
    for _ in range(attempts):
        old = version(spark, root)
        rows, added = change(old)
        s = write_segment(rows.select(*[f"`{c}`" for c in kind.names]), root, key, old.buckets or buckets)
        if not s.rows:
            _drop(spark, root, {s.path})
            return old
        if callable(added):
            added = added(_segment(spark, root, s, kind, None))
        try:
            return put(spark, root, old, s, added, key, kind, buckets)
        except Conflict:
            _drop(spark, root, {s.path})
    raise Conflict(f"{root}: {attempts} attempts failed")
